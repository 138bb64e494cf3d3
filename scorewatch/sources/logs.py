"""Prediction logs and request samples as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("input_hash", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("decision", T.StringType()),
        T.StructField("client_id", T.StringType()),
        T.StructField("features_count", T.IntegerType()),
        T.StructField("latency_ms", T.DoubleType()),
    ]
)

EVENT_SCHEMA = "ts timestamp, kind string, message string"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def parse_log_lines(lines: DataFrame, line: str = "value", schema: T.StructType = LOG_SCHEMA) -> DataFrame:
    """Log records of JSON text; lines that are no JSON objects are left out."""
    corrupt = "_corrupt"
    wide = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    parsed = lines.select(
        F.from_json(line, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).alias("r")
    )
    return parsed.where(F.col("r").isNotNull() & F.col(f"r.{corrupt}").isNull()).select(
        *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields]
    )


def read_log(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Prediction log; an absent path is an empty log, corrupt lines are skipped.

    ``limit`` counts lines before they are parsed; 0 and ``None`` mean all.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA)
    lines = spark.read.text(path)
    if limit:
        lines = lines.limit(limit)
    return parse_log_lines(lines)


def read_samples(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Request samples; a corrupt line raises. Without a schema the columns are inferred."""
    reader = spark.read.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def append_log(entries: DataFrame, path: str) -> None:
    """Append records as JSON lines, keys in name order."""
    entries.select(*sorted(entries.columns)).write.mode("append").option("ignoreNullFields", "false").json(path)


def append_events(events: DataFrame, path: str) -> None:
    """Append time-stamped monitoring lines."""
    stamped = events.select(F.current_timestamp().alias("ts"), "kind", "message")
    stamped.write.mode("append").json(path)
