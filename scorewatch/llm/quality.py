"""Quality rules with adaptive thresholds.

A document is measured once. Documents that pass the base rules enter
quantile sketches per language and source: counts of log-linear buckets, which
merge by addition, so the sketch of a language, or of all, is the sum of its
parts. A measure's limits are the far-out fences of its group, q3 + 3 (q3 -
q1) and q1 - 3 (q3 - q1), plus a tolerance that keeps a group without spread
from rejecting its own ordinary documents. The fences of a source are blended
with those of its language, and these with those of all documents, in
proportion to how many documents stand behind each, and may not lie beyond
twice, or below half of, what they are blended with: a few documents hardly
move their limits, and a source that is mostly junk cannot lift them to its
own level. The limits are then joined to the documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise
from .common import longs, map_arrow, texts

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
WINDOW = 5
#: A wider group's fences weigh as much as those of so many documents of the group itself.
PRIOR = 200
#: Measures in whole units, and the tolerance above the upper fence: symbols and repeated lines in thousandths, word length in hundredths.
TOLERANCE = {"symbols": 100, "lines": 400, "length": 200}
#: The measures that have a lower limit too.
BOTH_SIDES = ["length"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]


def repeated_words(words: list) -> int:
    """Words that lie in a window of five words found at least twice, the first one included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words))
    shift = np.uint64(32)

    def ranked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a << shift | b, return_inverse=True)[1].astype(np.uint64)

    if len(known) == len(words):
        return 0
    twos = ranked(ids[:-1], ids[1:])
    fours = ranked(twos[:-2], twos[2:])
    _, which, times = np.unique(fours[:n] << shift | ids[WINDOW - 1:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[which] > 1)
    if not len(starts):
        return 0
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + WINDOW, -1)
    return int((np.cumsum(marks) > 0).sum())


def measure(text: str) -> tuple[int, ...]:
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return (
        len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeated_words(words), len(lines),
    )


def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        rows = list(map(measure, texts(batch.column(at))))
        counts = [longs([r[i] for r in rows]) for i in range(len(COUNTS))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *counts], names=[*batch.schema.names, *(f"q_{c}" for c in COUNTS)])


def with_counts(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns (text among them) and the counts, named q_ and the count."""
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), *(f"q_{c} long" for c in COUNTS)])
    return map_arrow(docs.select(*columns), measured, schema)


def base_failed() -> Column:
    return (F.col("q_n_words") < 10) | (100 * F.col("q_n_repeat_words") > 20 * F.col("q_n_words"))


def measures() -> dict[str, Column]:
    words, lines = F.greatest("q_n_words", F.lit(1)), F.greatest("q_n_lines", F.lit(1))
    return {
        "symbols": F.floor(1000 * F.col("q_n_symbols") / words),
        "lines": F.floor(1000 * F.col("q_n_dup_lines") / lines),
        "length": F.floor(100 * F.col("q_word_chars") / words),
    }


def bucket(value: Column) -> Column:
    """The sketch bucket of a value: its first six binary digits, so an error of at most one part in 32."""
    cut = F.greatest(F.lit(0), F.length(F.bin(value)) - 6)
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def sketches(counted: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, rows: the mergeable sketches of documents that pass the base rules."""
    each = F.array(*[F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket")) for k, v in measures().items()])
    return (
        counted.where(~base_failed()).select("lang", "source", F.explode(each).alias("m"))
        .groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count(F.lit(1)).alias("rows"))
    )


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """n and both fences per group and measure. A group has at most a few thousand buckets, however many rows."""
    merged = sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("rows").alias("rows"))
    group = Window.partitionBy(*keys, "measure")
    so_far = F.sum("rows").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.withColumn("so_far", so_far).withColumn("n", F.sum("rows").over(group))
    q1, q3 = F.expr("min(bucket) FILTER (WHERE 4 * so_far >= n)"), F.expr("min(bucket) FILTER (WHERE 4 * so_far >= 3 * n)")
    return ranked.groupBy(*keys, "measure").agg(
        F.max("n").alias("n"), (q3 + 3 * (q3 - q1)).alias("upper"), F.greatest(F.lit(0), q1 - 3 * (q3 - q1)).alias("lower"),
    )


def blended(n: Column, own: Column, wider: Column, prior: int, above: bool) -> Column:
    """``own`` of n documents and ``wider`` as of ``prior``, rounded down, not beyond twice or below half of ``wider``."""
    mean = F.floor((n * own + prior * wider) / F.lit(float(prior) + n)).cast("long")
    return F.least(mean, 2 * wider) if above else F.greatest(mean, F.floor(wider / 2).cast("long"))


def limits(sketch: DataFrame, prior: int) -> DataFrame:
    """lang, source and the limits of each measure: one row per language and source."""
    sketch = materialise(sketch, "sketches")
    of_lang, of_all = fences(sketch, ["lang"]), fences(sketch, [])
    of_all = of_all.select("measure", F.col("upper").alias("all_upper"), F.col("lower").alias("all_lower"))
    lang = of_lang.join(of_all, "measure").select(
        F.col("lang").alias("lang_2"), F.col("measure").alias("measure_2"),
        blended(F.col("n"), F.col("upper"), F.col("all_upper"), prior, True).alias("lang_upper"),
        blended(F.col("n"), F.col("lower"), F.col("all_lower"), prior, False).alias("lang_lower"),
    )
    joined = fences(sketch, ["lang", "source"]).join(lang, F.col("lang").eqNullSafe(F.col("lang_2")) & (F.col("measure") == F.col("measure_2")))
    upper = blended(F.col("n"), F.col("upper"), F.col("lang_upper"), prior, True)
    lower = blended(F.col("n"), F.col("lower"), F.col("lang_lower"), prior, False)
    found = joined.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == k, upper + v)).alias(f"{k}_limit") for k, v in TOLERANCE.items()],
        *[F.max(F.when(F.col("measure") == k, lower)).alias(f"{k}_least") for k in BOTH_SIDES],
    )
    return materialise(found.withColumnsRenamed({"lang": "limit_lang", "source": "limit_source"}), "limits")


def judged(counted: DataFrame, limit_rows: DataFrame) -> DataFrame:
    """The counted rows with base_failed and kept. The limits are a written table: its size decides the kind of join."""
    same = F.col("lang").eqNullSafe(F.col("limit_lang")) & F.col("source").eqNullSafe(F.col("limit_source"))
    within = F.lit(True)
    for k, value in measures().items():
        within = within & F.coalesce(value <= F.col(f"{k}_limit"), F.lit(False))
        if k in BOTH_SIDES:
            within = within & F.coalesce(value >= F.col(f"{k}_least"), F.lit(False))
    joined = counted.join(limit_rows, same, "left")
    return joined.withColumn("q_base_failed", base_failed()).withColumn("q_kept", ~F.col("q_base_failed") & within)


def quality_rules(docs: DataFrame, prior: int = PRIOR) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    A null text has no words, so base_failed is true and kept false, as for an
    empty text. Null lang or source are groups of their own. Repeated rows and
    doc_ids keep a row each, and count as often as they are there. A very long
    text needs a few numbers for each word. Columns other than doc_id, text,
    lang and source are ignored; an empty table gives an empty table.
    """
    columns = ["doc_id", "lang", "source", *(f"q_{c}" for c in COUNTS)]
    counted = materialise(with_counts(docs, ["doc_id", "text", "lang", "source"]).select(*columns), "counts")
    out = judged(counted, limits(sketches(counted), prior))
    return out.select("doc_id", *(F.col(f"q_{c}").alias(c) for c in COUNTS[:-1]), F.col("q_base_failed").alias("base_failed"), F.col("q_kept").alias("kept"))


def keep_good(docs: DataFrame, columns: list[str], prior: int = PRIOR) -> DataFrame:
    """The documents kept, with ``columns``. Texts are measured again rather than written with their counts."""
    counted = with_counts(docs, columns)
    return judged(counted, limits(sketches(counted), prior)).where("q_kept").select(*columns)


#: The same rules over the table documents, for DuckDB.
ORACLE = f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(text, '') AS text, lang, source FROM documents),
parts AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS w,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM docs),
wins AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM parts WHERE len(w) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM wins) WHERE c > 1),
reps AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(5) t(k) GROUP BY doc_id),
counted AS (SELECT doc_id, lang, source, len(w) AS n_words,
                   length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
                   length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines
            FROM parts LEFT JOIN reps USING (doc_id)),
based AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                 1000 * n_symbols // greatest(n_words, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS lines,
                 100 * word_chars // greatest(n_words, 1) AS length FROM counted),
vals AS (SELECT lang, source, unnest(['symbols', 'lines', 'length']) AS measure, unnest([symbols, lines, length]) AS v
         FROM based WHERE NOT base_failed),
cells AS (SELECT lang, source, measure, (v >> greatest(0, length(bin(v)) - 6)) << greatest(0, length(bin(v)) - 6) AS b,
                 count(*) AS c FROM vals GROUP BY ALL),
levels AS (SELECT 0 AS lvl, lang, source, measure, b, c FROM cells UNION ALL
           SELECT 1, lang, NULL, measure, b, c FROM cells UNION ALL SELECT 2, NULL, NULL, measure, b, c FROM cells),
merged AS (SELECT lvl, lang, source, measure, b, sum(c) AS c FROM levels GROUP BY ALL),
ranked AS (SELECT *, sum(c) OVER (PARTITION BY lvl, lang, source, measure ORDER BY b) AS so_far,
                  sum(c) OVER (PARTITION BY lvl, lang, source, measure) AS n FROM merged),
fence AS (SELECT lvl, lang, source, measure, max(n) AS n, min(b) FILTER (WHERE 4 * so_far >= 3 * n) * 4
                 - 3 * min(b) FILTER (WHERE 4 * so_far >= n) AS u, greatest(0, 4 * min(b) FILTER (WHERE 4 * so_far >= n)
                 - 3 * min(b) FILTER (WHERE 4 * so_far >= 3 * n)) AS d FROM ranked GROUP BY ALL),
of_lang AS (SELECT b.lang, b.measure, least((b.n * b.u + {PRIOR} * c.u) // (b.n + {PRIOR}), 2 * c.u) AS u,
                   greatest((b.n * b.d + {PRIOR} * c.d) // (b.n + {PRIOR}), c.d // 2) AS d
            FROM fence b JOIN fence c ON c.lvl = 2 AND b.measure = c.measure WHERE b.lvl = 1),
lim AS (SELECT a.lang, a.source, a.measure,
               least((a.n * a.u + {PRIOR} * b.u) // (a.n + {PRIOR}), 2 * b.u)
               + CASE a.measure {" ".join(f"WHEN '{k}' THEN {v}" for k, v in TOLERANCE.items())} END AS m,
               greatest((a.n * a.d + {PRIOR} * b.d) // (a.n + {PRIOR}), b.d // 2) AS least
        FROM fence a JOIN of_lang b ON a.lang IS NOT DISTINCT FROM b.lang AND a.measure = b.measure WHERE a.lvl = 0),
wide AS (SELECT lang, source, max(m) FILTER (WHERE measure = 'symbols') AS ms, max(m) FILTER (WHERE measure = 'lines') AS ml,
                max(m) FILTER (WHERE measure = 'length') AS mw, max(least) FILTER (WHERE measure = 'length') AS lw FROM lim GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(symbols <= ms AND lines <= ml AND length <= mw AND length >= lw, false) AS kept
FROM based LEFT JOIN wide ON based.lang IS NOT DISTINCT FROM wide.lang AND based.source IS NOT DISTINCT FROM wide.source
""".replace("WITH RECURSIVE", "WITH")
