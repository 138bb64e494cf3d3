"""Mixing sources to target weights by hash-threshold histograms, in DataFrame functions alone.

Every document has a hash that does not depend on its place. A source takes
all documents below a threshold, once more than it takes the others, so larger
budgets contain smaller ones. The threshold is found without sorting
documents: sum sizes by source and hash bucket, find the bucket where the
budget runs out, and look into that bucket alone with the next bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise
from .common import WORD

#: Weights of the sources in order, repeating; words to take per word there is, as a fraction; most copies of a document.
WEIGHTS = (5, 2, 1)
SHARE = (3, 2)
COPIES = 2
#: Bits of a hash, and of one histogram.
HASH_BITS, LEVEL_BITS = 48, 12


def size(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The document's hash: 48 bits of an MD5 over doc_id and text."""
    named = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """source, source_size, target of (source, source_size): one row per source.

    The share is dealt by weight; a source that would get more than ``COPIES``
    times its size is held there and the rest is dealt again, until none is.
    Each round is one sum over the sources; amounts are exact integers.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))  # one row per source
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(rank - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    sources = materialise(sources.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    wide = "decimal(38,0)"
    up, down = SHARE
    cap = F.col("source_size").cast(wide) * (COPIES * down)  # amounts are in parts of a word: ``down`` to a word
    held = F.lit(False)
    while True:
        row = sources.select(
            F.sum(F.col("source_size").cast(wide) * up).alias("total"), F.coalesce(F.sum(F.when(held, cap)), F.lit(0).cast(wide)).alias("held"),
            F.coalesce(F.sum(F.when(~held, F.col("weight"))), F.lit(0)).alias("weights"), F.count_if(held).alias("n"),
        ).first()
        rest, weights = int((row["total"] or 0) - row["held"]), int(row["weights"])
        if not weights:
            break
        above = held | (F.col("source_size").cast(wide) * (COPIES * down * weights) < F.col("weight").cast(wide) * F.lit(str(rest)).cast(wide))
        if sources.select(F.count_if(above)).first()[0] == row["n"]:
            break
        held = above
    share = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(max(1, down * weights)))
    return sources.select("source", "source_size", F.when(held, (F.col("source_size") * COPIES).cast("double")).otherwise(share).alias("target"))


def thresholds(sized: DataFrame) -> DataFrame:
    """source, source_size, target, whole (copies of all documents), limit (hashes below it are taken once more)."""
    aims = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    whole = F.when(F.col("source_size") == 0, 0).otherwise(F.least(F.lit(COPIES), F.floor(F.col("target") / F.col("source_size"))))
    aims = materialise(
        aims.withColumn("whole", whole.cast("long")).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")), "aims",
    )
    # The open bucket of each source: the hashes that start with ``prefix``, and how many words of them are still to take.
    open_ = aims.select(F.col("source").alias("s"), F.lit(0).cast("long").alias("prefix"), "need")
    for left in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        inside = F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("place", left + LEVEL_BITS) == F.col("prefix"))
        histogram = sized.join(open_, inside).groupBy("s", F.shiftright("place", left).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("need").alias("need"), F.count(F.lit(1)).alias("rows"),
        )
        before = F.coalesce(F.sum("words").over(Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        crossed = histogram.withColumn("before", before).where("before + words > need")
        edge = crossed.groupBy("s").agg(F.min(F.struct("bucket", "before", "words", "need", "rows")).alias("e"))
        edge = materialise(edge.select("s", "e.*"), "edges")
        open_ = edge.select("s", F.col("bucket").alias("prefix"), (F.col("need") - F.col("before")).alias("need"))
        if (edge.select(F.max("rows")).first()[0] or 0) <= 1:
            break
    # What is left open is one document, or equal ones: as many are taken as come nearest.
    takes = F.ceil((F.col("need") - F.col("before")) * F.col("rows") / F.col("words") - 0.5)
    takes = F.greatest(F.lit(0), F.least(takes, F.col("rows"))).cast("long")
    ends = edge.withColumn("takes", takes).select(
        "s", F.shiftleft(F.col("bucket") + (F.col("takes") == F.col("rows")).cast("long"), left).alias("end"),
        F.when((F.col("takes") > 0) & (F.col("takes") < F.col("rows")), F.shiftleft("bucket", left)).alias("shared_place"), "takes",
    )
    found = aims.join(ends, F.col("source").eqNullSafe(F.col("s")), "left")
    # No bucket crosses where the budget covers all that is there.
    needs = F.col("need") > 0
    limit = F.when(~needs, 0).otherwise(F.coalesce("end", F.lit(1 << HASH_BITS)))
    return materialise(found.select(
        F.col("source").alias("of_source"), "source_size", "target", "whole", limit.cast("long").alias("limit"),
        F.when(needs, F.col("shared_place")).alias("shared_place"), F.when(needs, F.col("takes")).alias("takes"),
    ), "thresholds")


def with_limits(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of (source, place) with their source's thresholds and ``copies``.

    Equal rows on a threshold are numbered, each task's share on its own from
    where the shares before it end, and the first ``takes`` are taken once
    more. Which of them those are cannot be told, for they are equal.
    """
    joined = rows.join(found, F.col("source").eqNullSafe(F.col("of_source")))
    joined = joined.withColumn("copies", F.col("whole") + (F.col("place") < F.col("limit")).cast("long"))
    if found.where("shared_place IS NOT NULL").isEmpty():
        return joined
    shared = F.coalesce(F.col("place") == F.col("shared_place"), F.lit(False))
    equal = materialise(joined.where(shared).withColumn("share", F.spark_partition_id()), "equal")
    shares = equal.groupBy("of_source", "share").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("of_source").orderBy("share").rowsBetween(Window.unboundedPreceding, -1))
    shares = shares.select(F.col("of_source").alias("share_source"), F.col("share").alias("share_no"), F.coalesce(before, F.lit(0)).alias("ahead"))
    own = F.row_number().over(Window.partitionBy("of_source", "share").orderBy("place"))
    same = F.col("of_source").eqNullSafe(F.col("share_source")) & (F.col("share") == F.col("share_no"))
    numbered = equal.withColumn("own", own).join(shares, same)
    numbered = numbered.withColumn("copies", F.col("copies") + (F.col("ahead") + F.col("own") <= F.col("takes")).cast("long"))
    return joined.where(~shared).unionByName(numbered.select(*joined.columns))


def mix(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken.

    A null text has size 0 and takes nothing. Null sources are one source,
    last in order. The hash is over doc_id and text; of equal rows as many are
    taken as the target asks for. A source whose documents are few or long
    comes as near its target as its boundary document allows. Reruns agree, whatever the partitions. Columns other than
    doc_id, text and source are ignored; an empty table gives an empty table.
    """
    sized = materialise(docs.select("doc_id", "source", size().alias("size"), place().alias("place")), "sized")
    out = with_limits(sized, thresholds(sized))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with ``columns``."""
    sized = materialise(docs.select("source", size().alias("size"), place().alias("place")), "sized")
    rows = with_limits(docs.select(*columns, place().alias("place")), thresholds(sized))
    return rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*columns)


#: The same mix over the table documents, for DuckDB: documents sorted by hash.
ORACLE = """
WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
                      CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 12) AS BIGINT) AS place
               FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM sums),
-- Sources in the order in which they would be held at twice their size; k of them are held.
filled AS (SELECT *, row_number() OVER (ORDER BY s / w, source) AS k,
                  sum(4 * s) OVER (ORDER BY s / w, source) - 4 * s AS held, sum(w) OVER () - sum(w) OVER (ORDER BY s / w, source) + w AS ws,
                  3 * sum(s) OVER () AS total FROM weighed),
first_free AS (SELECT min(k) AS k FROM filled WHERE NOT 4 * s * ws < w * (total - held)),
aims AS (SELECT f.source, f.s AS source_size, CASE WHEN f.k < x.k THEN CAST(2 * f.s AS DOUBLE)
                ELSE CAST(f.w AS DOUBLE) * CAST(x.total - x.held AS DOUBLE) / CAST(2 * x.ws AS DOUBLE) END AS target
         FROM filled f, (SELECT filled.* FROM filled JOIN first_free USING (k)) x),
needs AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE least(2, CAST(floor(target / source_size) AS BIGINT)) END AS whole FROM aims),
runs AS (SELECT source, place, sum(size) AS words, count(*) AS n FROM sized GROUP BY ALL),
placed AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY place) - words AS before FROM runs),
picked AS (SELECT n.source, p.place, whole, CASE WHEN target - whole * source_size <= 0 THEN 0 WHEN before + words <= target - whole * source_size THEN p.n
                  WHEN target - whole * source_size <= before THEN 0
                  ELSE greatest(0, least(p.n, ceil((target - whole * source_size - before) * p.n / words - 0.5::DOUBLE))) END AS takes
           FROM placed p JOIN needs n ON p.source IS NOT DISTINCT FROM n.source),
numbered AS (SELECT *, row_number() OVER (PARTITION BY source, place) AS k FROM sized)
SELECT d.doc_id, d.size, n.source_size, n.target, CAST(d.size * (p.whole + CASE WHEN d.k <= p.takes THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM numbered d JOIN needs n ON d.source IS NOT DISTINCT FROM n.source
JOIN picked p ON d.source IS NOT DISTINCT FROM p.source AND d.place = p.place
"""
