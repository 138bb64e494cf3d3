"""Near-duplicate vectors by p-stable hashing.

Vectors are scaled to length one, where cosine 0.95 is a Euclidean distance.
Each of several tables projects a vector on Gaussian directions, shifts and
quantises the projections, and gathers vectors of equal quantised projections
in a bucket. Vectors of a bucket are compared exactly, in double precision.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .common import longs, map_arrow, runs
from .components import components

COSINE = 0.95
#: Width of a quantisation step; least share of pairs at exactly the threshold to be found (closer pairs are found more surely).
WIDTH, RECALL = 2.0, 0.99
#: Unrelated vectors wanted in a bucket at most, which sets the number of projections of a table.
STRANGERS = 64
#: Vectors of one block; larger buckets are compared block by block. Rows of a block compared at a time.
BLOCK, TILE = 2048, 512
SEED = 7


def collision(distance: float, width: float) -> float:
    """Probability that two points at a distance share one quantised projection."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(n: int, cosine: float = COSINE) -> tuple[int, int]:
    """Projections of a table and number of tables for ``n`` vectors: the usual choice of this kind of hashing."""
    near, far = collision(math.sqrt(2 - 2 * cosine), WIDTH), collision(math.sqrt(2), WIDTH)
    k = max(4, math.ceil(math.log(max(n, 1) / STRANGERS) / -math.log(far))) if n > STRANGERS else 4
    return k, math.ceil(math.log(1 - RECALL) / math.log(1 - near**k))


@functools.lru_cache(maxsize=4)
def directions(dimension: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, dimension])
    mix = rng.integers(1 << 63, size=(tables, k), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return rng.standard_normal((dimension, tables * k)), rng.uniform(0, WIDTH, tables * k), mix


def bucket_keys(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """A 64-bit key for each vector and table."""
    lines, shifts, mix = directions(unit.shape[1], k, tables)
    steps = np.floor((unit @ lines + shifts) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(unit), tables, k)
    keys = (steps * mix).sum(axis=2, dtype=np.uint64)
    keys ^= keys >> np.uint64(29)
    return (keys * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def units(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of one dimension as double vectors of length one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    n = len(column)
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # first by the largest component: no square overflows or vanishes
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def hashed(batches: Iterable[pa.RecordBatch], k: int, tables: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.diff(batch.column(1).offsets.to_numpy())
        for dimension in np.unique(sizes).tolist():
            rows = batch.filter(pa.array(sizes == dimension))
            keys = bucket_keys(units(rows.column(1)), k, tables)
            for t in range(tables):
                yield pa.RecordBatch.from_arrays(
                    [longs(np.full(len(keys), dimension << 16 | t)), longs(keys[:, t]), *rows.columns],
                    names=["tab", "bucket", "class", "embedding", "copies"],
                )


def compared(batches: Iterable[pa.RecordBatch], k: int, tables: int, cosine: float) -> Iterator[pa.RecordBatch]:
    """For each block, or pair of blocks, of a bucket: the linked classes, a root nearby and how many vectors they link with.

    A pair is counted in the first table that brings it together, so it is
    counted once; both blocks know all keys, as they follow from the vectors.
    """
    for (tab, _, low, high), rows in runs(batches, 4):
        if rows.num_rows < 2:
            continue
        classes, copies, block = rows.column(5).to_numpy(), rows.column(7).to_numpy(), rows.column(4).to_numpy()
        unit = units(rows.column(6))
        earlier = bucket_keys(unit, k, tables)[:, : tab & 0xFFFF]
        n = len(classes)
        links, root = np.zeros(n, np.int64), np.arange(n)
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        for a in range(0, len(left), TILE):
            for b in range(a if low == high else 0, len(right), TILE):
                x, y = left[a:a + TILE], right[b:b + TILE]
                i, j = np.nonzero(unit[x] @ unit[y].T >= cosine)
                i, j = x[i], y[j]
                keep = i < j if low == high else np.ones(len(i), bool)
                i, j = i[keep], j[keep]
                if earlier.shape[1]:
                    first = ~(earlier[i] == earlier[j]).any(axis=1)
                    i, j = i[first], j[first]
                if not len(i):
                    continue
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                while True:
                    p, q = root[i], root[j]
                    differ = p != q
                    if not differ.any():
                        break
                    target = np.arange(n)
                    np.minimum.at(target, np.maximum(p, q)[differ], np.minimum(p, q)[differ])
                    while not np.array_equal(target, target[target]):
                        target = target[target]
                    root = target[root]
        hit = np.flatnonzero(links)
        if len(hit):
            yield pa.RecordBatch.from_arrays([longs(classes[hit]), longs(classes[root[hit]]), longs(links[hit])], names=["a", "b", "links"])


def near_links(classes: DataFrame, n: int, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(a, b, links): partial link counts of class ``a``, and a root ``b`` in its component, from (class, embedding, copies)."""
    k, tables = shape(n, cosine)
    buckets = map_arrow(
        classes.select("class", "embedding", "copies"), lambda batches: hashed(batches, k, tables),
        "tab long, bucket long, class long, embedding array<float>, copies long".replace("array<float>", dict(classes.dtypes)["embedding"]),
    )
    sizes = buckets.groupBy("tab", "bucket").count().where("count > 1").select("tab", "bucket", F.ceil(F.col("count") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("class"), F.col("blocks"))
    rows = (
        buckets.join(sizes, ["tab", "bucket"]).withColumn("block", own)
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select("tab", "bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "class", "embedding", "copies")
    )
    keys = ["tab", "bucket", "low", "high"]
    return map_arrow(
        rows.repartition(*keys).sortWithinPartitions(*keys), lambda batches: compared(batches, k, tables, cosine),
        "a long, b long, links long",
    )


def near_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """Per row of (vec_id, embedding): vec_id, n_links, component_id, kept.

    Links are the pairs that hashing brings together and whose cosine is at
    least ``cosine``. Equal vectors are one class and count as linked with one
    another. Null vectors, and vectors that are zero or empty or hold null or
    non-finite components, link with nothing and are components of their own;
    so do vectors of different dimension among each other. component_id is the
    smallest vec_id of the component. Rows of equal vec_id are rows of their
    own, kept where vec_id equals component_id; rows with a null vec_id give no
    name to a component and are not kept. Other columns are ignored.
    """
    rows = vectors.select("vec_id", "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("sound", sound)
    classes = rows.where("sound").groupBy("embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
    # The number of a class is fixed by writing it.
    classes = materialise(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    found = materialise(near_links(classes, classes.count(), cosine, block), "links")
    links = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b")).select(F.col("node").alias("class"), "root")
    named = materialise(
        classes.join(links, "class", "left").join(roots, "class", "left")
        .select("class", "embedding", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "class").alias("root")),
        "named",
    )
    names = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    per_class = named.join(names, "root").select(
        F.col("embedding"), (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id",
    )
    linked = rows.where("sound").join(per_class, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
