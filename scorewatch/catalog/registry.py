"""Where queries and their SQL are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where one exists, its SQL."""
    def add(build):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return add


def r6(column: str | Column, places: int = 6) -> Column:
    """Round for comparison; sums of doubles depend on their order in the last digits."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c, places) + F.lit(0.0)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column."""
    return df.select(*[(r6(n, places) if t == "double" else F.col(n)).alias(n) for n, t in df.dtypes])
