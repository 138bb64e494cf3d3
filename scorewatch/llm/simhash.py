"""SimHash near-duplicates by a binary trie self-join.

Fingerprints within the error budget of 4 bits agree wholly in at least two of
six blocks of bits (each differing bit spoils one block), so for each of the
15 pairs of blocks the fingerprints are gathered by those blocks' bits. A
bucket is the trie node that this common prefix leads to, with the remaining
bits below it. The node is joined with itself: pairs of nodes are traversed
together, their differing bits add up, and a pair is left as soon as they
exceed the budget. Buckets too large for one task are cut at a lower level of
the trie into the node pairs still within the budget.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import longs, map_arrow, runs, texts
from .components import components

BUDGET = 4
#: First bit and width of the blocks.
BLOCKS = [(0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10)]
PAIRS = list(combinations(range(len(BLOCKS)), 2))
#: Shingles hashed at a time.
STEP = 65_536
#: Fingerprints of a bucket that one task takes undivided, and of a trie node compared directly.
UNDIVIDED, LEAF = 20_000, 64


def fingerprint(text: str, words: int = 4) -> int:
    """Bit by bit the majority of the XXH64 hashes (seed 42) of the word shingles."""
    found = text.encode().lower().split()  # bytes: lowers A-Z alone, splits at the six ASCII white space characters
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    starts = np.cumsum(sizes + 1) - sizes - 1
    k = min(words, len(found))
    firsts, ends = starts[: len(found) - k + 1], (starts + sizes)[k - 1:]
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(firsts), STEP):
        pairs = zip(firsts[i:i + STEP].tolist(), ends[i:i + STEP].tolist())
        hashes = np.array([digest(joined[a:b], 42) for a, b in pairs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * ones > len(firsts)).astype(np.uint64)).sum())


def fingerprint_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter(map(fingerprint, texts(batch.column(1))), np.uint64, batch.num_rows).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), longs(prints)], names=["doc_id", "print"])


def bits_of(values: np.ndarray, block: int) -> np.ndarray:
    first, width = BLOCKS[block]
    return values >> np.uint64(first) & np.uint64((1 << width) - 1)


def below(values: np.ndarray, pair: int) -> np.ndarray:
    """The bits outside the pair's two blocks, packed from the top of a 64-bit word: the path below the trie node."""
    out, at = np.zeros(len(values), np.uint64), 64
    for block in (b for b in range(len(BLOCKS)) if b not in PAIRS[pair]):
        at -= BLOCKS[block][1]
        out |= bits_of(values, block) << np.uint64(at)
    return out


def bucket_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint under the prefix of each pair of blocks, with its path below."""
    for batch in batches:
        values = batch.column(0).to_numpy().view(np.uint64)
        for pair, (x, y) in enumerate(PAIRS):
            prefix = bits_of(values, x) << np.uint64(11) | bits_of(values, y)
            key = (np.uint64(pair << 22) | prefix).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [longs(key), longs(below(values, pair).view(np.int64)), batch.column(0)], names=["bucket", "path", "print"],
            )


class Labels:
    """Components within one bucket; labels are indices."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.of[i], self.of[j]
            differ = a != b
            if not differ.any():
                return
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            low, high = np.minimum(a, b), np.maximum(a, b)
            target = np.arange(len(self.of))
            np.minimum.at(target, high, low)
            while not np.array_equal(target, target[target]):
                target = target[target]
            self.of = target[self.of]


def trie_join(paths: np.ndarray, sides: tuple[np.ndarray, np.ndarray], depth: int, spent: int, labels: Labels) -> None:
    """Link all of one node with all of another (or of itself) within the budget. ``sides``: indices sorted by path."""
    same = sides[0] is sides[1]
    stack = [(0, len(sides[0]), 0, len(sides[1]), depth, spent)]
    left, right = paths[sides[0]], paths[sides[1]]
    while stack:
        a, b, c, d, bit, used = stack.pop()
        if b - a <= 0 or d - c <= 0 or used > BUDGET or same and c < a:
            continue
        if bit >= 64 or (b - a <= LEAF and d - c <= LEAF):
            mask = np.uint64((1 << 64 - bit) - 1)
            apart = np.bitwise_count((left[a:b, None] ^ right[None, c:d]) & mask)
            i, j = np.nonzero(apart <= BUDGET - used)
            labels.join(sides[0][a + i], sides[1][c + j])
            continue
        flag = np.uint64(63 - bit)
        m = a + int(np.searchsorted(left[a:b] >> flag & np.uint64(1), 1))
        n = c + int(np.searchsorted(right[c:d] >> flag & np.uint64(1), 1))
        stack += [(a, m, c, n, bit + 1, used), (m, b, n, d, bit + 1, used), (a, m, n, d, bit + 1, used + 1), (m, b, c, n, bit + 1, used + 1)]


def join_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each bucket, or of each pair of its nodes, as a star around each local component's first print."""
    tails, heads = [], []
    for (_, low, high), rows in runs(batches, 3):
        levels, node = rows.column(3)[0].as_py(), rows.column(4).to_numpy()
        paths, prints = rows.column(5).to_numpy().view(np.uint64), rows.column(6).to_numpy()
        n = len(prints)
        if n < 2:
            continue
        order = np.argsort(paths, kind="stable")
        labels = Labels(n)
        if n <= LEAF and low == high:
            apart = np.bitwise_count(paths[:, None] ^ paths[None, :])
            labels.join(*np.nonzero(np.triu(apart <= BUDGET, 1)))
        elif low == high:
            trie_join(paths, (order, order), levels, 0, labels)
        else:
            trie_join(paths, (order[node[order] == low], order[node[order] == high]), levels, (low ^ high).bit_count(), labels)
        moved = np.flatnonzero(labels.of != np.arange(n))
        tails.append(prints[moved])
        heads.append(prints[labels.of[moved]])
        if len(tails) >= 1000:
            yield star(tails, heads)
            tails, heads = [], []
    yield star(tails, heads)


def star(tails: list[np.ndarray], heads: list[np.ndarray]) -> pa.RecordBatch:
    empty = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays([longs(np.concatenate(x or empty)) for x in (tails, heads)], names=["a", "b"])


def node_partners(levels: int) -> list[int]:
    """Differences between two nodes of a level that are within the budget."""
    return [m for m in range(1 << levels) if m.bit_count() <= BUDGET]


def near_prints(prints: DataFrame, undivided: int = UNDIVIDED) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (``print`` long) within the budget of one another."""
    buckets = map_arrow(prints.select("print"), bucket_rows, "bucket long, path long, print long")
    sizes = buckets.groupBy("bucket").count().where("count > 1")
    # A larger bucket is cut so many levels further down that its nodes hold about ``undivided`` prints.
    levels = F.when(F.col("count") <= undivided, 0).otherwise(F.least(F.lit(12), F.ceil(F.log2(F.col("count") / undivided))))
    sizes = sizes.select("bucket", levels.cast("long").alias("levels"))
    found = buckets.join(sizes, "bucket")
    node = F.expr("CASE WHEN levels = 0 THEN 0L ELSE shiftrightunsigned(path, CAST(64 - levels AS INT)) END")
    # All other nodes of the level within the budget; each pair is kept in ascending order.
    masks = F.expr("CASE WHEN levels = 0 THEN array(0L) ELSE filter(sequence(0L, shiftleft(1L, CAST(levels AS INT)) - 1), m -> bit_count(m) <= 4) END")
    split = found.withColumn("node", node).withColumn("mask", F.explode(masks))
    other = F.col("node").bitwiseXOR(F.col("mask"))
    rows = split.select(
        "bucket", F.least("node", other).alias("low"), F.greatest("node", other).alias("high"), "levels", "node", "path", "print",
    )
    keys = ["bucket", "low", "high"]
    return map_arrow(rows.repartition(*keys).sortWithinPartitions(*keys), join_rows, "a long, b long")


def simhash_components(docs: DataFrame, undivided: int = UNDIVIDED) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hexadecimal digits) and component_id.

    component_id is the smallest doc_id reachable over links of at most 4
    differing bits, equal fingerprints included. A null or wordless text has
    fingerprint zero and is linked like any other. Rows with a null doc_id keep
    their row; they connect others but give no component its name, unless it
    has no other rows: then component_id is null. Repeated rows and doc_ids
    keep a row each. Only doc_id and text are read; an empty table gives an
    empty table.
    """
    printed = materialise(map_arrow(docs.select("doc_id", "text"), fingerprint_rows, "doc_id long, print long"), "prints")
    # Equal fingerprints are one node, whatever the number of documents behind it.
    distinct = materialise(printed.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    roots = components(near_prints(distinct, undivided)).select(F.col("node").alias("print"), "root")
    named = materialise(distinct.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print")), "rooted-prints")
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = named.join(names, "root").select("print", "component_id")
    return printed.join(of_print, "print").select(
        "doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id",
    )
