"""Content hashes for lineage."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

# A binary cell cannot hold more.
MAX_FILE_BYTES = (1 << 31) - 16
CHUNK = 1 << 22


def file_hashes(spark: SparkSession, path: str, cell_bytes: int = MAX_FILE_BYTES) -> DataFrame:
    """SHA-256 of each file (path, length, data_hash).

    A file of at most ``cell_bytes`` is one cell of Spark's own reader; the
    task of a larger one reads it through one digest, chunk by chunk.
    """
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= cell_bytes).select("path", "length", F.sha2("content", 256).alias("data_hash"))
    large = files.where(F.col("length") > cell_bytes).select("path", "length")
    return small.unionByName(large.mapInArrow(_digests, "path string, length long, data_hash string"))


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = []
        for name in batch.column("path").to_pylist():
            scheme, _, rest = name.partition(":")
            rest = rest if rest.startswith("//") else f"//{rest}"
            store, inside = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")
            digest = hashlib.sha256()
            with store.open_input_stream(inside) as stream:
                while chunk := stream.read(CHUNK):
                    digest.update(chunk)
            hashes.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.string())], names=["path", "length", "data_hash"])


def table_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-free fingerprint of a table of any size: one partial aggregate per task."""
    columns = list(columns or df.columns)
    row_hash = F.xxhash64(*[F.col(c) for c in columns])
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor(row_hash), F.lit(0)).alias("xor_hash"),
        F.coalesce(F.sum(row_hash.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("sum_hash"),
    )


def row_hashes(df: DataFrame, key: str, text: str) -> DataFrame:
    """SHA-256 of each row's whole text."""
    return df.select(key, F.sha2(text, 256).alias("data_hash"))


def text_fingerprint(df: DataFrame, text: str) -> DataFrame:
    """Order-free fingerprint of a text table: exclusive-or of the leading 60 bits of the rows' SHA-256."""
    bits = F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.bit_xor(bits).cast("string").alias("data_hash"))
