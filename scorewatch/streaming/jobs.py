"""Streams over request and event tables, each built from the batch operators."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import fixed
from ..functions.decisions import decide, request_outcome
from ..operators import drift, feature_stats, metrics, model as models
from ..session import fresh_path, shared_dir


def stream_session(spark: SparkSession) -> SparkSession:
    """A session for streams: a checkpoint keeps its shuffle width for life, so it is set on its own."""
    base = shared_dir(spark)
    session = spark.newSession()
    width = spark.conf.get("scorewatch.stream.partitions", None) or str(spark.sparkContext.defaultParallelism)
    session.conf.set("spark.sql.shuffle.partitions", width)
    session.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    if not spark.conf.get("spark.checkpoint.dir", None):
        session.conf.set("scorewatch.shared.dir", base)
    return session


def read_stream(spark: SparkSession, folder: str, glob: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_append(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Drain an append stream into a Parquet table."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_update(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = (), fold_every: int = 32) -> list[dict]:
    """Drain an aggregating stream into a table of changes, which ``latest`` reads; the progress of each batch.

    A batch writes only the rows it has touched, into a folder named by its
    number, so one that is repeated after a failure replaces itself. Every
    ``fold_every`` batches the current rows are written together and what is
    older than the fold before is deleted. Groups behind the watermark leave
    the state; their rows stay in the table.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/changes/batch={number}")
        if number % fold_every == fold_every - 1:
            spark = batch.sparkSession
            earlier = batches(spark, f"{path}/folded")
            latest(spark, path, batch.schema, keys, number).write.mode("overwrite").parquet(f"{path}/folded/batch={number}")
            old = max((n for n in earlier if n < number), default=-1)
            drop(spark, [f"{path}/changes/batch={n}" for n in batches(spark, f"{path}/changes") if n <= old])
            drop(spark, [f"{path}/folded/batch={n}" for n in earlier if n < old])

    query = (
        stream.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return [json.loads(p.json) if hasattr(p, "json") else dict(p) for p in query.recentProgress]


def _paths(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches that are wholly written to a folder."""
    target, store = _paths(spark, f"{folder}/batch=*/_SUCCESS")
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in store.globStatus(target) or ())


def drop(spark: SparkSession, folders: Sequence[str]) -> None:
    for folder in folders:
        target, store = _paths(spark, folder)
        store.delete(target, True)


def latest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = (), up_to: int | None = None) -> DataFrame:
    """Of each key the row of the last batch that touched it; without keys the rows of the last batch that had any."""
    fold = max((n for n in batches(spark, f"{path}/folded") if up_to is None or n < up_to), default=-1)
    changed = [n for n in batches(spark, f"{path}/changes") if n > fold and (up_to is None or n <= up_to)]
    parts = [spark.read.schema(schema).parquet(f"{path}/folded/batch={fold}").withColumn("batch", F.lit(fold))] if fold >= 0 else []
    if changed:
        wide = T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])
        folders = [f"{path}/changes/batch={n}" for n in changed]
        parts.append(spark.read.schema(wide).option("basePath", f"{path}/changes").parquet(*folders))
    if not parts:
        return spark.createDataFrame([], schema)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*schema.names), "batch").alias("row"))
    return newest.where(F.col("row").isNotNull()).select("row.*")


def drain(
    spark: SparkSession, source: Callable[[SparkSession], DataFrame], mode: str, label: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Run a stream to the end of its input in a session of its own; its result as a batch table.

    ``mode`` is append, or update for an aggregation with ``keys`` (none: a single row).
    """
    session = stream_session(spark)
    stream = source(session)
    path, checkpoint = fresh_path(session, label), fresh_path(session, f"{label}-checkpoint")
    if mode == "append":
        run_append(stream, path, checkpoint)
        return spark.read.schema(stream.schema).parquet(path)
    run_update(stream, path, checkpoint, keys)
    return latest(spark, path, stream.schema, keys)


def timed(stream: DataFrame, timestamp: str, tolerance: str, out: str = "event_at") -> DataFrame:
    """Add the row's time with a watermark: rows later than ``tolerance`` are left out of windows and counted by Spark."""
    return stream.withColumn(out, F.col(timestamp).cast("timestamp")).withWatermark(out, tolerance)


def score_with_model(stream: DataFrame, model: PipelineModel, flags: dict[str, Column]) -> DataFrame:
    """``score_requests`` with a fitted model; its SQL stage runs on streams as it does on tables."""
    scored = models.score(model, stream)
    return score_requests(scored, F.col(models.SCORE), flags)


def score_requests(stream: DataFrame, score: Column, flags: dict[str, Column]) -> DataFrame:
    """Outcome of every request, and score and decision of the successful ones; stateless."""
    ok = F.col("outcome") == "success"
    return (
        stream.withColumn("outcome", request_outcome(flags))
        .withColumn("prediction", F.when(ok, F.round(score, fixed.SCORE_DECIMALS)))
        .withColumn("decision", F.when(ok, decide(score)))
    )


def window_counts(df: DataFrame, timestamp: str, size: str, slide: str | None = None, error: Column | None = None) -> DataFrame:
    """Requests, errors and error rate per window; batch or stream."""
    window = F.window(timestamp, size, slide) if slide else F.window(timestamp, size)
    bad = F.count_if(error) if error is not None else F.lit(0).cast("bigint")
    return df.groupBy(window.alias("w")).agg(F.count(F.lit(1)).alias("requests"), bad.alias("errors")).select(
        F.col("w.start").alias("window_start"), "requests", "errors", (F.col("errors") / F.col("requests")).alias("error_rate")
    )


def request_rate(df: DataFrame, timestamp: str, size: str, seconds: int, slide: str | None = None) -> DataFrame:
    """Requests per second in each window."""
    return window_counts(df, timestamp, size, slide).select(
        "window_start", "requests", (F.col("requests") / F.lit(float(seconds))).alias("per_second")
    )


def latency_cells(df: DataFrame, timestamp: str, value: str, size: str, bounds: Sequence[float]) -> DataFrame:
    """Rows per window and histogram cell; batch or stream."""
    window = F.window(timestamp, size).alias("w")
    cells = df.where(F.col(value).isNotNull()).groupBy(window, metrics.histogram_cells(value, bounds).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    return cells.select(F.col("w.start").alias("window_start"), "cell", "n")


def latency_quantiles(
    df: DataFrame, timestamp: str, value: str, size: str,
    bounds: Sequence[float] = fixed.LATENCY_BOUNDS, probabilities: Sequence[float] = (0.5, 0.95),
) -> DataFrame:
    """Histogram quantiles per window."""
    cells = latency_cells(df, timestamp, value, size, bounds)
    return metrics.quantiles_from_cells(cells, bounds, probabilities, ["window_start"])


def stream_psi_frequencies(stream: DataFrame, features: drift.Features, edges: dict[str, list[float]], timestamp: str) -> DataFrame:
    """Frequency table per calendar day against fixed reference edges; ``timestamp`` may carry a watermark."""
    counted = drift.frequency_table(stream.withColumn("w", F.window(timestamp, "1 day")), features, edges, ["w"])
    return counted.select(F.col("w.start").cast("date").alias("event_day"), "feature", "bucket", "category", "n")


def running_feature_stats(stream: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Statistics of everything seen so far; one state row."""
    return feature_stats.feature_stats(stream, columns)


def running_counters(stream: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Running counts per label value of several columns."""
    from ..operators.log_analytics import outcome_counters

    return outcome_counters(stream, columns)


def late_counter(stream: DataFrame, timestamp: str, tolerance: str = "1 day") -> DataFrame:
    """Rows per day as an append stream; rows behind the watermark are left out and counted by Spark."""
    timed = stream.withColumn("__ts", F.col(timestamp).cast("timestamp")).withWatermark("__ts", tolerance)
    return timed.groupBy(F.window("__ts", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("rows")).select(
        F.col("w.start").cast("date").alias("day"), "rows"
    )
