"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialise

#: White space of words: space, tab, line feed, vertical tab, form feed, carriage return. ``bytes.split()`` splits on the same six.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of rows in one Arrow batch, so that a batch of very long texts stays small.
BATCH_BYTES = 16 << 20
#: A group with more than this share of the rows is joined by broadcast; there are at most as many.
HOT_GROUPS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded by bytes as well as by rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def texts(column: pa.Array) -> Iterator[str]:
    """The column's strings one at a time; null is the empty text."""
    for value in column:
        yield value.as_py() or ""


def longs(values) -> pa.Array:
    return pa.array(values, pa.int64())


def runs(batches: Iterable[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple[int, ...], pa.Table]]:
    """Groups of rows sorted by their first ``n_keys`` integer columns, across batch borders."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows]).combine_chunks()
        keys = np.stack([rows.column(i).to_numpy() for i in range(n_keys)])
        starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            yield tuple(keys[:, a].tolist()), rows.slice(a, b - a)
        rest = rows.slice(int(starts[-1]))
    if rest is not None:
        yield tuple(rest.column(i)[0].as_py() for i in range(n_keys)), rest


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` with the columns of their group, null where ``groups`` has none; no key is null.

    ``groups`` has one row per group and how many of the rows it holds. Fewer
    than ``HOT_GROUPS`` groups hold more than that share of the rows each:
    they are broadcast. So no key that goes through the shuffle has many rows.
    """
    groups = materialise(groups, "groups")
    least = rows.count() // HOT_GROUPS
    hot = F.broadcast(groups.where(F.col(size) > least))
    cold = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(groups.where(F.col(size) <= least), keys, "left")
    return rows.join(hot, keys).unionByName(cold)
