"""Ranked lexical search without random access (NRA).

Documents are dealt into shards of a bounded number of postings. A shard keeps
a list for each term of the queries, sorted by impact, and answers each query
by reading its terms' lists from their heads in step. What has been read of a
document is the lower end of its score; the upper end adds, for each term not
yet seen in it, the next impact of that term's list. A document that was never
read can score no more than the sum of these over all terms; once this is
below the k-th lower end no document comes in any more, and those whose upper
end is below it go. Reading ends when all that are left have been read to the
end of their interval. A task carries its k-th score from shard to shard, so
later shards are read less deeply; the shards' results meet in one ranking.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise
from .common import longs, map_arrow, texts
from .terms import TERMS_SQL, pieces

TOP = 20
#: (query, term) pairs of one block of queries, on average; what is broadcast has at most a row for each.
BLOCK_PAIRS = 1 << 17
#: Postings of a shard; one document more may be begun.
SHARD_POSTINGS = 1 << 19
#: Each step reads all lists down to this share of the impact that the step before went down to.
STEP = 0.5


def forward(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the text), terms and tfs of those in ``vocabulary``."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            n, found, tfs = [], [], []
            for text in texts(batch.column(1)):
                held: Counter = Counter()
                n.append(0)
                for words in pieces(text):
                    n[-1] += len(words)
                    held.update(filter(number.__contains__, words))
                found.append([number[w] for w in held])
                tfs.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), longs(n), pa.array(found, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["doc_id", "n", "terms", "tfs"],
            )

    rows = map_arrow(docs.select("doc_id", "text"), each, "doc_id long, n long, terms array<int>, tfs array<long>")
    return materialise(rows, "forward")


class Lists:
    """The postings of a shard: of each term the places of its documents and their impacts, the highest first."""

    def __init__(self, places: np.ndarray, numbers: np.ndarray, impacts: np.ndarray, n_terms: int):
        order = np.lexsort((places, -impacts, numbers))
        self.places, self.impacts = places[order], impacts[order]
        self.ends = np.searchsorted(numbers[order], np.arange(n_terms + 1))

    def of(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.ends[number], self.ends[number + 1]
        return self.places[a:b], self.impacts[a:b]


def resolve(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, top: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of all documents that may be among the ``top`` best, ties included, and the postings read.

    ``lists`` holds places and falling additions to the score of each term;
    ``known`` the best scores found elsewhere. The scores are final.
    """
    lists = [(places, adds) for places, adds in lists if len(places)]
    lower = np.zeros(n_docs, np.int64)
    seen = np.zeros((len(lists), n_docs), bool)
    at = [0] * len(lists)
    left = np.array([int(adds[0]) for _, adds in lists], np.int64)  # the most that each list can still add
    candidates: np.ndarray | None = None  # None: documents may still come in
    read = 0
    while True:
        if left.any():
            down_to = max(1, int(left.max() * STEP))
            for i, (places, adds) in enumerate(lists):
                if left[i] < down_to:
                    continue
                stop = at[i] + int(np.searchsorted(-adds[at[i]:], -down_to, "right"))
                own = places[at[i]:stop]
                lower[own] += adds[at[i]:stop]
                seen[i, own] = True
                read += stop - at[i]
                at[i], left[i] = stop, adds[stop] if stop < len(adds) else 0
        if candidates is None:
            met = np.flatnonzero(lower)
        else:
            met = candidates
        best = np.concatenate([lower[met], known])
        kth = int(np.partition(best, len(best) - top)[len(best) - top]) if len(best) >= top else 0
        upper = lower[met] + left @ ~seen[:, met]
        stays = upper >= max(kth, 1)
        if int(left.sum()) < kth or not left.any():
            candidates = met[stays]
            if (upper[stays] == lower[candidates]).all():
                return candidates, lower[candidates], read


def shard_results(parts: list[tuple], queries: list[tuple], weights: np.ndarray, n_docs: int, all_terms: int, top: int, best: list) -> None:
    """Merge the shard's documents into ``best``: for each query the rows (-score, doc_id unknown, doc_id, row) of the best so far."""
    doc_ids = [d for ids, *_ in parts for d in ids]
    n = np.concatenate([lengths for _, lengths, *_ in parts])
    sizes = np.concatenate([counts for _, _, counts, *_ in parts])
    numbers = np.concatenate([found for *_, found, _ in parts])
    tf = np.concatenate([found for *_, found in parts])
    places = np.repeat(np.arange(len(n)), sizes)
    length = 100 - 25 + (25 * n * n_docs) // max(1, all_terms)
    impacts = weights[numbers] * ((1_000_000_000 * tf) // (1000 * tf + 12 * length[places]))
    some = impacts > 0
    lists = Lists(places[some], numbers[some], impacts[some], len(weights))
    for i, (_, own, q) in enumerate(queries):
        asked = [(where, adds * times) for (where, adds), times in ((lists.of(number), times) for number, times in zip(own, q))]
        if not any(len(where) for where, _ in asked):
            continue
        found, scores, _ = resolve(asked, len(n), top, np.array([-row[0] for row in best[i]], np.int64))
        rows = [(-s, doc_ids[p] is None, doc_ids[p] or 0) for p, s in zip(found.tolist(), scores.tolist())]
        best[i] = sorted(best[i] + rows)[:top]


def shards(batches: Iterable[pa.RecordBatch], queries, weights, totals: tuple[int, int], top: int) -> Iterator[pa.RecordBatch]:
    """The best documents of a task for each query, found shard by shard."""
    best: list[list] = [[] for _ in queries.value]
    parts, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            rows = batch.slice(start, 512)
            found, tfs = rows.column(2), rows.column(3)
            counts = np.diff(found.offsets.to_numpy())
            parts.append((rows.column(0).to_pylist(), rows.column(1).to_numpy(), counts, found.flatten().to_numpy(), tfs.flatten().to_numpy()))
            size += int(counts.sum())
            if size >= SHARD_POSTINGS:
                shard_results(parts, queries.value, weights.value, *totals, top, best)
                parts, size = [], 0
    if parts:
        shard_results(parts, queries.value, weights.value, *totals, top, best)
    out = [(query, None if unknown else doc_id, -cost) for (query, *_), rows in zip(queries.value, best) for cost, unknown, doc_id in rows]
    yield pa.RecordBatch.from_arrays(
        [longs([r[0] for r in out]), longs([r[1] for r in out]), longs([r[2] for r in out])], names=["query", "doc_id", "score"],
    )


def block_results(docs: DataFrame, pairs: DataFrame, top: int) -> DataFrame:
    """query, rank, doc_id, score for the queries (query, term, q) of one block of them."""
    spark = docs.sparkSession
    asked: dict[int, list] = {}
    vocabulary: dict[bytes, int] = {}
    for query, term, q in sorted(pairs.collect()):  # the block's pairs
        asked.setdefault(query, []).append((vocabulary.setdefault(bytes(term), len(vocabulary)), q))
    rows = forward(docs, vocabulary)
    n_docs, all_terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for number, df in rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1))).collect():
        weights[number] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    listed = [(query, [number for number, _ in own], [q for _, q in own]) for query, own in asked.items()]
    shared, weighed = spark.sparkContext.broadcast(listed), spark.sparkContext.broadcast(weights)
    found = map_arrow(
        rows.select("doc_id", "n", "terms", "tfs"),
        lambda batches: shards(batches, shared, weighed, (n_docs, all_terms), top), "query long, doc_id long, score long",
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= top)


def ranked_search(docs: DataFrame, queries: DataFrame, top: int = TOP, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """The ``top`` highest-scoring documents of each row of ``queries`` (item_id, text): item_id, rank, doc_id, score.

    A null or empty text, of either side, has no term and is never in a
    result; queries without a result have no rows. Equal scores go by
    ascending doc_id, null last; rows of equal doc_id are documents of their
    own, and queries of equal item_id are answered each. Other columns are
    ignored; empty tables give an empty table.

    Queries are answered in blocks of about ``block_pairs`` (query, term)
    pairs, so that what is broadcast is bounded however many queries there
    are. Documents are read once per block; what they hold of the queries'
    terms is written, for their numbers in all documents are needed first. No
    posting is shuffled, only ``top`` rows per task and query.
    """
    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                held: Counter = Counter()
                for words in pieces(text):
                    held.update(words)
                yield pa.RecordBatch.from_arrays(
                    [longs([query] * len(held)), pa.array(list(held), pa.binary()), longs(list(held.values()))], names=["query", "term", "q"],
                )

    items = materialise(queries.select("item_id", "text", F.monotonically_increasing_id().alias("query")), "items")
    pairs = materialise(map_arrow(items.select("query", "text"), split, "query long, term binary, q long"), "terms")
    blocks = -(-pairs.count() // block_pairs)
    found = []
    for block in range(blocks):
        own = pairs.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)
        found.append(materialise(block_results(docs, own, top), "results"))
    if not found:
        return items.select("item_id", F.lit(0).alias("rank"), F.col("item_id").alias("doc_id"), F.col("query").alias("score")).limit(0)
    results = found[0]
    for more in found[1:]:
        results = results.unionByName(more)
    return results.join(items.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


#: The same over the tables documents and benchmark, for DuckDB.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {TERMS_SQL.format("text")} AS words FROM documents),
i AS (SELECT row_number() OVER () AS query, item_id, {TERMS_SQL.format("text")} AS words FROM benchmark),
q AS (SELECT query, item_id, term, count(*) AS q FROM (SELECT query, item_id, unnest(words) AS term FROM i) GROUP BY ALL),
p AS (SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(words) AS n, unnest(words) AS term FROM d) GROUP BY ALL),
c AS (SELECT count(*) FILTER (WHERE len(words) > 0) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS all_terms FROM d),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, c WHERE term IN (SELECT term FROM q) GROUP BY term, n_docs),
s AS (SELECT query, item_id, row, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // all_terms)))) AS BIGINT) AS score
      FROM p JOIN w USING (term) JOIN q USING (term), c GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id NULLS LAST, row) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""
