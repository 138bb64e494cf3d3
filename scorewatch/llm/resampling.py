"""Importance resampling towards a target distribution.

Words are hashed to buckets; a bucket's gain compares its share in the target
texts with that in all documents. A document's weight is its mean gain, and
Gumbel noise from a hash of its id turns weights into scores whose highest are
a draw without replacement. The k highest are found without sorting all:
random pivots, exact counts before, at and behind each, and what lies between
the two pivots around the k-th is looked at again. Winners alone are sorted.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import local_table, materialise
from .common import longs, map_arrow, texts
from .terms import TERMS_SQL, pieces

#: Rows whose keys cut the candidates in one round of the selection.
PIVOTS = 15
#: Words whose bucket a worker keeps, and the longest of them.
KNOWN_WORDS, KNOWN_BYTES = 200_000, 32


@dataclass(frozen=True)
class Plan:
    """Longest run of words that is a feature, buckets, words of a document that may be drawn, share of those to draw, seed."""

    longest: int = 1
    buckets: int = 10_000
    min_words: int = 20
    percent: int = 10
    seed: str = "2024"


class Buckets(dict):
    """word -> bucket; what is long is not kept."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % self.n
        if len(word) <= KNOWN_BYTES:
            if len(self) >= KNOWN_WORDS:
                self.clear()
            self[word] = bucket
        return bucket


def features(text: str, plan: Plan, known: Buckets) -> tuple[int, np.ndarray]:
    """The number of words of a text, and the bucket of every feature."""
    n_words, found, tail = 0, [], []
    for words in pieces(text):
        n_words += len(words)
        found.append(np.fromiter(map(known.__getitem__, words), "<u4", len(words)))
        joined = tail + words
        for n in range(2, plan.longest + 1):  # runs that end in this piece
            first = max(0, len(tail) - n + 1)
            runs = (b" ".join(joined[i:i + n]) for i in range(first, len(joined) - n + 1))
            found.append(np.fromiter((zlib.crc32(r) % plan.buckets for r in runs), "<u4"))
        tail = joined[len(joined) - plan.longest + 1:] if plan.longest > 1 else []
    return n_words, np.concatenate(found) if found else np.zeros(0, "<u4")


def bucketed(df: DataFrame, plan: Plan, *keys: str) -> DataFrame:
    """``keys``, n_words, and ``buckets``: the features' buckets as little-endian 16 or 32 bits each, as wide as they need."""
    width = "<u2" if plan.buckets <= 1 << 16 else "<u4"

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(plan.buckets)
        for batch in batches:
            n_words, found = [], []
            for text in texts(batch.column(0)):
                n, own = features(text, plan, known)
                n_words.append(n)
                found.append(own.astype(width).tobytes())
            columns = [longs(n_words), pa.array(found, pa.binary()), *batch.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns, names=["n_words", "buckets", *keys])

    kinds = dict(df.dtypes)
    schema = ", ".join(["n_words long", "buckets binary", *(f"{k} {kinds[k]}" for k in keys)])
    return map_arrow(df.select("text", *keys), each, schema)


def totals(found: DataFrame, plan: Plan) -> np.ndarray:
    """How many features fall into each bucket; a task gives one row per bucket it has."""
    width = "<u2" if plan.buckets <= 1 << 16 else "<u4"

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(plan.buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                counts += np.bincount(np.frombuffer(value.as_buffer(), width), minlength=plan.buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([longs(held), longs(counts[held])], names=["bucket", "n"])

    rows = map_arrow(found.select("buckets"), summed, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(plan.buckets, np.int64)  # the driver sees one number per bucket
    for bucket, n in rows:
        counts[bucket] = n
    return counts


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    n, all_target, all_source = len(target), float(target.sum()), float(source.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (all_source + n) / ((s + 1) * (all_target + n))))
        for t, s in zip(target.astype(float).tolist(), source.astype(float).tolist())
    ], np.int64)


def scored(found: DataFrame, gain: np.ndarray, plan: Plan) -> DataFrame:
    """row, doc_id, n_words, n_features, weight, score: the gains as an array, one look-up per feature."""
    width = "<u2" if plan.buckets <= 1 << 16 else "<u4"
    shared = found.sparkSession.sparkContext.broadcast(gain)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_features, weights, scores = [], [], []
            for doc_id, value in zip(batch.column(1).to_pylist(), batch.column(3)):
                own = np.frombuffer(value.as_buffer(), width)
                weight = int(shared.value[own].sum()) // len(own) if len(own) else 0
                name = f"{plan.seed}:{'null' if doc_id is None else doc_id}"
                h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
                n_features.append(len(own))
                weights.append(weight)
                scores.append(weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], longs(n_features), longs(weights), longs(scores)],
                names=["row", "doc_id", "n_words", "n_features", "weight", "score"],
            )

    schema = "row long, doc_id long, n_words long, n_features long, weight long, score long"
    return map_arrow(found.select("row", "doc_id", "n_words", "buckets"), each, schema)


def literal(rows: DataFrame, key: list[str], values) -> Column:
    """A composite key as a constant."""
    kinds = dict(rows.dtypes)
    return F.struct(*(F.lit(v).cast(kinds[n]).alias(n) for n, v in zip(key, values)))


def lowest(rows: DataFrame, k: int, key: list[str], pivots: int = PIVOTS):
    """The k-th lowest (from 1) of the unique composite keys; null if there are fewer than k.

    Each round takes the keys of ``pivots`` random rows, counts the rows
    before, at and behind each exactly, and writes what lies between the two
    pivots around the k-th, about two of ``pivots`` parts, for the next round.
    """
    named, rows, round_ = rows, rows.select(F.struct(*key).alias("key")), 0
    while k > 0:
        round_ += 1
        cuts = sorted(r["key"] for r in rows.orderBy(F.xxhash64("key", F.lit(round_)), "key").limit(pivots).collect())
        if not cuts:
            return None
        marks = [literal(named, key, cut) for cut in cuts]
        # How many pivots are below a key says in which part it lies, the pivot itself included with the part before it.
        below = F.size(F.filter(F.array(*marks), lambda mark: mark < F.col("key")))
        parts = rows.groupBy(below.alias("part"), F.array_contains(F.array(*marks), F.col("key")).alias("equal")).count().collect()
        counts = {(r["part"], r["equal"]): r["count"] for r in parts}
        part = 0
        while k > (size := counts.get((part, False), 0) + counts.get((part, True), 0)):
            k -= size
            part += 1
            if part > len(cuts):
                return None
        if k > counts.get((part, False), 0):
            return cuts[part]
        inside = F.lit(True)
        if part < len(cuts):
            inside &= F.col("key") < marks[part]
        if part:
            inside &= F.col("key") > marks[part - 1]
        rows = materialise(rows.where(inside), "candidates")
    return None


def ranked(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``rank`` from 1 in the order of ``key``: sorted ranges, numbered each, behind what the ranges before hold."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = rows.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ")

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = np.arange(n + 1, n + batch.num_rows + 1)
            n += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int64()), longs(places)],
                names=[*batch.schema.names, "part", "place"],
            )

    ordered = rows.repartitionByRange(parts, *key).sortWithinPartitions(*key)
    placed = materialise(map_arrow(ordered, numbered, f"{schema}, part long, place long"), "winners")
    sizes = sorted(placed.groupBy("part").agg(F.max("place")).collect())  # one row per range
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    starts = [(part, start) for (part, _), start in zip(sizes, before)]
    if not starts:
        return placed.select(*rows.columns, F.col("place").alias("rank"))
    offsets = F.broadcast(local_table(rows.sparkSession, starts, "part long, start long"))
    return placed.join(offsets, "part").select(*rows.columns, (F.col("place") + F.col("start")).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank (null where it is not drawn).

    ``target`` has a column text. Null and empty texts have no features and
    weight 0. Ties in score go to the smaller doc_id; null doc_ids come last
    and are hashed as the text null. Of several rows with one doc_id each is a
    candidate of its own; among those of equal score the shorter comes first.
    A text is read once and whole; later passes read its buckets, two bytes a
    feature. Other columns are ignored. No documents give no rows; with an
    empty target all counts of it are 0.
    """
    found = materialise(bucketed(docs, plan, "doc_id").withColumn("row", F.monotonically_increasing_id()), "buckets")
    gain = gains(totals(bucketed(target, plan), plan), totals(found, plan))
    rows = materialise(scored(found, gain, plan), "scores")
    key = ["cost", "unknown", "known_id", "n_features", "row"]
    rows = rows.withColumns({
        "cost": -F.col("score"), "unknown": F.col("doc_id").isNull().cast("long"), "known_id": F.coalesce("doc_id", F.lit(0)).cast("long"),
    })
    able: Column = F.col("n_words") >= plan.min_words
    k = rows.where(able).count() * plan.percent // 100
    last = lowest(rows.where(able), k, key)
    out = ["doc_id", "n_features", "weight", "score"]
    if last is None:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    drawn = able & (F.struct(*key) <= literal(rows, key, last))
    winners = ranked(rows.where(drawn).select(*out, *key[:3], "row"), key)
    return winners.select(*out, "rank").unionByName(rows.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))


#: The same over the tables documents and benchmark, for DuckDB; a CRC by its table, made from its polynomial.
ORACLE = f"""
WITH RECURSIVE bits(n, c, step) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE step = 8),
d AS (SELECT row_number() OVER () AS row, doc_id, coalesce({TERMS_SQL.format("text")}, []) AS words FROM documents),
dw AS (SELECT row, doc_id, unnest(words) AS word FROM d), bw AS (SELECT unnest({TERMS_SQL.format("text")}) AS word FROM benchmark),
spelled AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
hashed AS (SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(x) + 1, 2), lambda i: CAST('0x' || substr(x, i, 2) AS BIGINT))),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM spelled, crc),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN hashed USING (word) GROUP BY 1), t AS (SELECT bucket, count(*) AS n FROM bw JOIN hashed USING (word) GROUP BY 1),
g AS (SELECT b.range AS bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000.0::DOUBLE)
        / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
      FROM range(10000) b LEFT JOIN s ON s.bucket = b.range LEFT JOIN t ON t.bucket = b.range),
sums AS (SELECT row, sum(gain) AS total FROM dw JOIN hashed USING (word) JOIN g USING (bucket) GROUP BY row),
w AS (SELECT row, doc_id, len(words) AS n_features, CASE WHEN len(words) > 0 THEN CAST(floor(total / CAST(len(words) AS DOUBLE)) AS BIGINT) ELSE 0 END AS weight,
             CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN sums USING (row)),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features, row) AS k,
             count(*) FILTER (WHERE n_features >= 20) OVER () * 10 // 100 AS most FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= most THEN k END AS rank FROM r
"""
