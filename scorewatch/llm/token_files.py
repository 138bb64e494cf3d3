"""Token-id files: a concatenated id array with Elias-Fano encoded document boundaries.

Documents are range-partitioned and sorted by doc_id; each task streams the
ids of its documents into files and adds, behind the ids, the monotone
boundaries in Elias-Fano form: the low bits of each offset packed, the high
bits in unary, with the position of every 256th one kept for select. A
document costs about 2 + log2(ids / documents) bits instead of 64.

A file: ids (unsigned 16 or 32 bit, little-endian) | low bits | high bits |
select samples | doc_ids as the same structure or plain | JSON footer |
footer length (4 bytes) | magic (8 bytes).
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from ..session import fresh_path
from .common import longs, map_arrow
from .pieces import loaded

MAGIC = b"EFTOKEN1"
#: Ids after which a task starts its next file.
FILE_IDS = 1 << 26
#: Ones between two select samples.
SAMPLE = 256
#: Values whose low bits are packed at a time, a multiple of 8; documents whose boundaries are decoded at a time.
PACKED, DECODED = 1 << 16, 4096
#: Ids read from a file at a time.
READ_IDS = 1 << 22


class EliasFano:
    """A non-decreasing sequence of non-negative integers."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        packed = [
            np.packbits((values[i:i + PACKED, None] >> shifts & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
            for i in range(0, n, PACKED)
        ]
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) // 8 + 1 if n else 0, np.uint8)
        np.bitwise_or.at(high, ones >> 3, np.left_shift(np.uint8(1), (ones & 7).astype(np.uint8)))
        return cls(n, low_bits, np.concatenate(packed) if packed else np.zeros(0, np.uint8), high, ones[::SAMPLE].astype("<u4"))

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()]

    @classmethod
    def read(cls, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes) -> EliasFano:
        return cls(n, low_bits, np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(samples, "<u4"))

    def low_of(self, i: int, count: int) -> np.ndarray:
        """Low parts of ``count`` values from index ``i``."""
        if not self.low_bits:
            return np.zeros(count, np.uint64)
        a, b = i * self.low_bits, (i + count) * self.low_bits
        bits = np.unpackbits(self.low[a // 8:-(-b // 8)], bitorder="little")[a % 8:a % 8 + b - a]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return bits.reshape(count, self.low_bits).astype(np.uint64) @ weights

    def select(self, i: int, count: int = 1) -> np.ndarray:
        """``count`` values from the ``i``-th on, decoded from the nearest sample before them to the one behind."""
        if count <= 0:
            return np.zeros(0, np.uint64)
        block, behind = i // SAMPLE, -(-(i + count) // SAMPLE)
        start = int(self.samples[block])
        stop = int(self.samples[behind]) if behind < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[start // 8:-(-stop // 8)], bitorder="little")
        skip = i - block * SAMPLE
        ones = np.flatnonzero(bits[start % 8:])[skip:skip + count] + start
        return ((ones - np.arange(i, i + count)).astype(np.uint64) << np.uint64(self.low_bits)) + self.low_of(i, count)


class Writer:
    """Streams one file; what stays in memory is a length and a doc_id for each document."""

    def __init__(self, folder: str, task: int, number: int, width: int):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        self.name = f"part-{task:06d}-{number:04d}-{uuid.uuid4().hex}.ids"
        self.stream = store.open_output_stream(f"{root}/{self.name}")
        self.width, self.lengths, self.doc_ids, self.n_ids = width, [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.stream.write(ids.astype(f"<u{self.width}").tobytes())
        self.lengths.append(len(ids))
        self.doc_ids.append(doc_id)
        self.n_ids += len(ids)

    def close(self) -> dict:
        bounds = EliasFano.of(np.cumsum([0, *self.lengths]))
        known = [d for d in self.doc_ids if d is not None]  # nulls come first in ascending order
        least = min(known, default=0)
        names = EliasFano.of(np.array([d - least for d in known], np.uint64))
        parts = [*bounds.parts(), *names.parts()]
        footer = json.dumps({
            "width": self.width, "n_ids": self.n_ids, "n_docs": len(self.lengths), "n_nulls": len(self.lengths) - len(known),
            "least": least, "low_bits": [bounds.low_bits, names.low_bits], "sizes": [len(p) for p in parts],
        }).encode()
        for part in (*parts, footer, len(footer).to_bytes(4, "little"), MAGIC):
            self.stream.write(part)
        self.stream.close()
        return {"file": self.name, "n_docs": len(self.lengths), "n_ids": self.n_ids}


class Reader:
    """One file: the packed boundaries and doc_ids in memory, decoded where they are asked for; ids in blocks."""

    def __init__(self, folder: str, name: str):
        store, root = fs.FileSystem.from_uri(folder)
        self.stream = store.open_input_file(f"{root}/{name}")
        end = self.stream.size()
        tail = self.stream.read_at(12, end - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{name} is not a token-id file")
        length = int.from_bytes(tail[:4], "little")
        self.footer = json.loads(self.stream.read_at(length, end - 12 - length))
        at, parts = end - 12 - length - sum(self.footer["sizes"]), []
        for size in self.footer["sizes"]:
            parts.append(self.stream.read_at(size, at))
            at += size
        n, nulls = self.footer["n_docs"], self.footer["n_nulls"]
        self.bounds = EliasFano.read(n + 1, self.footer["low_bits"][0], *parts[:3])
        self.names = EliasFano.read(n - nulls, self.footer["low_bits"][1], *parts[3:])

    def doc_ids(self, first: int, count: int) -> list[int | None]:
        nulls = self.footer["n_nulls"]
        none = max(0, min(nulls, first + count) - first)
        known = self.names.select(first + none - nulls, count - none)
        return [None] * none + (known.astype(np.int64) + self.footer["least"]).tolist()

    def ids(self, start: int, stop: int) -> np.ndarray:
        width = self.footer["width"]
        return np.frombuffer(self.stream.read_at((stop - start) * width, start * width), f"<u{width}")

    def document(self, i: int) -> np.ndarray:
        return self.ids(*self.bounds.select(i, 2).tolist())


def write_task(batches: Iterable[pa.RecordBatch], vocabulary, folder: str, end_id: int, width: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    pieces, task = loaded(vocabulary.value), TaskContext.get().partitionId()
    end, writer, done = np.array([end_id], "<u4"), None, []
    for batch in batches:
        doc_ids, at = batch.column(0).to_pylist(), 0
        for ids, ends in pieces.encode_all(batch.column(1)):
            start = 0
            for stop in ends.tolist():
                if writer is None:
                    writer = Writer(folder, task, len(done), width)
                writer.add(doc_ids[at], np.concatenate([ids[start:stop], end]))
                start, at = stop, at + 1
                if writer.n_ids >= FILE_IDS:
                    done.append(writer.close())
                    writer = None
    if writer is not None:
        done.append(writer.close())
    yield pa.RecordBatch.from_arrays([
        longs([task] * len(done)), longs(list(range(len(done)))), pa.array([d["file"] for d in done], pa.string()),
        longs([d["n_docs"] for d in done]), longs([d["n_ids"] for d in done]),
    ], names=["task", "number", "file", "n_docs", "n_ids"])


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 2) -> list[tuple[str, int, int]]:
    """Write all documents in ascending doc_id order; returns (file, documents, ids) of each file in order.

    Only files that this list names belong to the output: a task that is run
    again writes under new names. Rows of equal doc_id are ordered by the hash
    and then by the text itself; null doc_ids come first; a null text is empty
    and holds the end id alone; an empty table gives no file.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        content = f.read()
    vocabulary = spark.sparkContext.broadcast(content)
    width = 2 if max(loaded(content).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    parts = max(1, docs.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions(*order)
    written = map_arrow(
        ordered, lambda batches: write_task(batches, vocabulary, folder, end_id, width),
        "task long, number long, file string, n_docs long, n_ids long",
    )
    files = sorted(written.collect())  # one row for each file of up to FILE_IDS ids
    return [(name, n_docs, n_ids) for _, _, name, n_docs, n_ids in files]


def read_task(batches: Iterable[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            reader = Reader(folder, name)
            for at in range(0, reader.footer["n_docs"], DECODED):
                n = min(DECODED, reader.footer["n_docs"] - at)
                bounds, doc_ids = reader.bounds.select(at, n + 1).astype(np.int64), reader.doc_ids(at, n)
                first = 0
                while first < n:  # as many whole documents as fit a block, at least one
                    last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + READ_IDS, "right")) - 1)
                    ids = reader.ids(int(bounds[first]), int(bounds[last])).astype("<u4")
                    cut = (bounds[first:last + 1] - bounds[first]).tolist()
                    yield pa.RecordBatch.from_arrays([
                        longs(doc_ids[first:last]), longs(base + bounds[first:last]), longs(np.diff(bounds[first:last + 1])),
                        longs([zlib.crc32(ids[a:b]) for a, b in zip(cut[:-1], cut[1:])]),
                    ], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    first = last


def read_token_files(spark, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    bases = np.cumsum([0, *(n_ids for _, _, n_ids in files)]).tolist()
    rows = [(name, base) for (name, _, _), base in zip(files, bases)]
    if not rows:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame(rows, "file string, base long").repartition(len(rows), "base")
    return map_arrow(listed, lambda batches: read_task(batches, folder), schema)


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the documents' ids to a new folder in the shared folder, and read them back."""
    spark = docs.sparkSession
    folder = fresh_path(spark, "token-files")
    if "://" not in folder:
        folder = folder if folder.startswith("file:") else f"file://{folder}"
    return read_token_files(spark, folder, write_token_files(docs, tokenizer_path, folder, end_id))
