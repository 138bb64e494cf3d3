"""Small result tables as JSON, and training statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .logs import path_exists


def write_report(df: DataFrame, path: str) -> None:
    """Replace a report; keys in name order, nulls kept."""
    df.select(*sorted(df.columns)).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


STATS_SCHEMA = (
    "feature string, mean double, std double, missing_pct double, "
    "min_num double, max_num double, min_str string, max_str string, rows bigint"
)


def read_training_stats(spark: SparkSession, path: str) -> DataFrame:
    """Feature statistics written at training time; absent statistics are an error."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"training feature statistics not found at {path}")
    return spark.read.schema(STATS_SCHEMA).json(path)
