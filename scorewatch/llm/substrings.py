"""Repeated passages by content-defined chunking.

A gear hash rolls over a text's bytes; where its tested bits are zero a chunk
ends, so borders depend on the last 16 bytes alone and an insertion moves only
the chunks around it. Chunks are compared by digest over all documents; runs
of repeated chunks are the repeated passages.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ..session import materialise
from .common import longs, map_arrow, texts

#: A border needs these five bits of the gear hash to be zero; the highest depends on the last 16 bytes.
BORDER = 0xF800
#: Bytes of the shortest and longest chunk; only a text's last chunk may be shorter.
LEAST, MOST = 16, 512
#: Words of a passage to report.
PASSAGE_WORDS = 50
STEP = 1 << 22
SPACES = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8))


def gear() -> np.ndarray:
    """A pseudo-random number for each byte."""
    return np.random.default_rng(11).integers(0, 1 << 32, 256, dtype=np.uint32)


GEAR = gear()


def candidates(raw: np.ndarray) -> np.ndarray:
    """Positions behind a byte at which the gear hash allows a border, at character borders only."""
    found = []
    for start in range(0, len(raw), STEP):
        low = max(0, start - 16)
        part = raw[low:start + STEP]
        rolled = GEAR[part]
        for width in (1, 2, 4, 8):  # sums over 2, 4, 8 and 16 bytes, each byte shifted by its age
            older = np.zeros_like(rolled)
            older[width:] = rolled[:-width] << np.uint32(width)
            rolled = rolled + older
        hits = np.flatnonzero(rolled & np.uint32(BORDER) == 0) + low + 1
        found.append(hits[hits > start])
    hits = np.concatenate(found) if found else np.zeros(0, np.int64)
    hits = hits[hits < len(raw)]
    return hits[raw[hits] & 0xC0 != 0x80]


def borders(raw: np.ndarray) -> list[int]:
    """Ends of the chunks of a text's bytes."""
    out, last = [], 0
    for hit in [*candidates(raw).tolist(), len(raw)]:
        while hit - last > MOST:
            last += MOST
            while raw[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if hit - last >= LEAST or hit == len(raw) > last:
            out.append(hit)
            last = hit
    return out


def chunk_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
            data = text.encode()
            raw = np.frombuffer(data, np.uint8)
            ends = np.array(borders(raw), np.int64)
            starts = np.r_[0, ends[:-1]].astype(np.int64)[: len(ends)]
            space = SPACES[raw]
            firsts = np.r_[0, np.cumsum(~space & np.r_[True, space[:-1]])] if len(raw) else np.zeros(1, np.int64)
            digests = np.fromiter((digest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(ends))
            yield pa.RecordBatch.from_arrays([
                longs([doc_id]), pa.array([digests.view(np.int64)], pa.list_(pa.int64())),
                pa.array([ends - starts], pa.list_(pa.int64())).cast(pa.list_(pa.int32())),
                pa.array([firsts[ends] - firsts[starts]], pa.list_(pa.int64())).cast(pa.list_(pa.int32())),
            ], names=["doc_id", "digests", "sizes", "words"])


def chunked(docs: DataFrame) -> DataFrame:
    """Per row a number of its own, doc_id, and its chunks' digests, sizes in bytes and words (counted where they begin)."""
    schema = "doc_id long, digests array<long>, sizes array<int>, words array<int>"
    rows = map_arrow(docs.select("doc_id", "text"), chunk_rows, schema)
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "chunks")


def repeated_passages(docs: DataFrame, min_words: int = PASSAGE_WORDS) -> DataFrame:
    """Passages that stand in an earlier document too: row, doc_id, first_doc_id, start, n_bytes, n_words.

    The first document that holds a chunk, by doc_id and then by row, keeps
    it; in later ones it is repeated. A run of neighbouring repeated chunks is
    reported with the bytes of its whole chunks if it holds at least half of
    ``min_words`` words, and ``min_words`` with the parts of chunks that a
    passage may reach into on either side. Lengths are thus judged by whole
    chunks: of passages just over ``min_words`` words a few are missed (one in
    twenty at 51 words, one in a hundred at 60), and some shorter ones are
    reported. A chunk repeated only within one document is none. Digests have 64 bits: two different chunks may share one
    by chance, a run of them does not.

    Null and empty texts have no passages; null doc_ids come first. Rows of
    equal doc_id are documents of their own, so repeated rows repeat each
    other. Only doc_id and text are read; no rows give no rows.
    """
    rows = chunked(docs)
    each = rows.select("row", "doc_id", F.posexplode("digests").alias("seq", "digest"))
    owner = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row")
    shared = each.groupBy("digest").agg(F.min(owner).alias("first"), F.max("row").alias("last_row"), F.min("row").alias("first_row"))
    shared = shared.where("first_row < last_row").select("digest", F.col("first.doc_id").alias("first_doc_id"), F.col("first.row").alias("keeper"))
    repeats = each.join(shared, "digest").where("row <> keeper")
    # A document's chunks are at most its own length; the sequence numbers of a run minus their ranks agree.
    ranked = repeats.withColumn("run", F.col("seq") - F.row_number().over(Window.partitionBy("row").orderBy("seq")))
    found = ranked.groupBy("row", "run").agg(
        F.min("seq").alias("a"), F.max("seq").alias("b"), F.mode("first_doc_id", deterministic=True).alias("first_doc_id"),
    ).where("b > a")
    part = F.expr("aggregate(slice(words, a + 1, b - a + 1), 0, (s, x) -> s + x)")
    around = F.expr("aggregate(slice(words, greatest(a, 1), b - greatest(a, 1) + 3), 0, (s, x) -> s + x)")
    joined = found.join(rows.select("row", "doc_id", "sizes", "words"), "row").select("*", part.alias("n_words"), around.alias("reach"))
    return joined.where(f"n_words >= {min_words // 2} AND reach >= {min_words}").select(
        "row", "doc_id", "first_doc_id",
        F.expr("aggregate(slice(sizes, 1, a), 0L, (s, x) -> s + x)").alias("start"),
        F.expr("aggregate(slice(sizes, a + 1, b - a + 1), 0L, (s, x) -> s + x)").alias("n_bytes"),
        F.col("n_words").cast("long").alias("n_words"),
    )
