"""The whole request chain as one stream: shape, limiter, values, feature check, model, decision, log.

The limiter keeps its state in the state store. What passes it is settled in
whole micro-batches: the running feature statistics of a batch start from the
totals after the batch before, which are one row in a folder named by that
batch's number, as is the log. A batch that is repeated after a failure
replaces both, so the stream has one checkpoint and no request is lost or
counted twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import fixed
from ..functions.decisions import decide, request_outcome, status_code
from ..functions.text import canonical_json, input_hash
from ..operators import model as models, ordered
from ..operators.log_analytics import log_entries
from ..operators.contract import Contract, payload_fields, request_flags, request_violations
from ..session import fresh_path, materialise
from .jobs import batches, stream_session
from .rate_limit import rate_limit, stream_rate_limit


@dataclass(frozen=True)
class Chain:
    """What a request has to pass.

    Requests have the columns request_id, client, ts and payload (JSON text),
    and may have elapsed, the seconds their scoring took. ``training`` holds
    mean and deviation of each numeric feature to check; without a ``model``
    every request fails.
    """

    contract: Contract
    model: PipelineModel | None
    training: dict[str, tuple[float, float]]
    ranges: dict[str, tuple[int, int]] = field(default_factory=lambda: dict(fixed.REQUEST_RANGES))
    window_seconds: int = fixed.RATE_WINDOW_SECONDS
    limit: int = fixed.RATE_LIMIT
    mean_tolerance: float = fixed.MEAN_SHIFT_STDS
    relative_tolerance: float = fixed.MEAN_SHIFT_RELATIVE
    time_limit_seconds: float = fixed.PREDICTION_TIME_LIMIT
    model_version: str = fixed.MODEL_VERSION


CARRIED = ("payload", "elapsed", "malformed", "validation_error")


def shaped(requests: DataFrame, chain: Chain) -> DataFrame:
    """Requests with their violations as two flags."""
    if "elapsed" not in requests.columns:
        requests = requests.withColumn("elapsed", F.lit(None).cast("double"))
    parsed = requests.withColumn("fields", payload_fields(F.col("payload")))
    violations = parsed.withColumn("violations", request_violations("fields", chain.contract, chain.ranges))
    return violations.withColumns(request_flags(F.col("violations"))).select("request_id", "client", "ts", *CARRIED)


def unlimited(chain: Chain) -> Column:
    """What never reaches the limiter: malformed requests, and all while there is no model."""
    return F.col("malformed") if chain.model is not None else F.lit(True)


def limited_stream(requests: DataFrame, chain: Chain) -> DataFrame:
    found = stream_rate_limit(
        shaped(requests, chain), "client", "ts", "request_id", chain.window_seconds, chain.limit, exempt=unlimited(chain), carry=CARRIED,
    )
    return found.withColumnRenamed("key", "request_id")


def limited_table(requests: DataFrame, chain: Chain) -> DataFrame:
    rows = materialise(shaped(requests, chain), "requests")
    passed = rate_limit(rows.where(~unlimited(chain)), "client", "ts", "request_id", chain.window_seconds, chain.limit)
    limited = passed.unionByName(rows.where(unlimited(chain)).withColumn("accepted", F.lit(None).cast("boolean")))
    return limited.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).select("client", "request_id", "us", "accepted", *CARRIED)


def _names(chain: Chain) -> list[str]:
    """The checked features in a fixed order; columns are numbered by it."""
    return sorted(chain.training)


def _features(chain: Chain) -> list[Column]:
    """The model's inputs from the payload; whole numbers may be written with a fraction of zero."""
    def value(spec) -> Column:
        text = F.try_element_at(F.col("fields"), F.lit(spec.name))
        if spec.kind != "integer":
            return text
        return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))

    by_name = {f.name: f for f in chain.contract.fields}
    return [value(by_name[name]).alias(name) for name in chain.contract.features]


def running_sums(samples: DataFrame, chain: Chain, before: dict[str, int]) -> DataFrame:
    """``samples`` with sums and counts (s0, c0, ...) of all samples up to each, in order of time and request_id.

    The order is cut into cells of balanced size. Each cell is added up on its
    own, and starts from what the cells before it hold, one row per cell.
    """
    names = _names(chain)
    totals = {f"s{i}": F.coalesce(F.sum(n), F.lit(0)) for i, n in enumerate(names)} | {f"c{i}": F.count(n) for i, n in enumerate(names)}
    cuts = ordered.sketch_columns(samples, ["__us"])["__us"].cuts
    celled = ordered.with_cell(samples, "__us", cuts)
    along = ordered.running_in_cell([], ["__us", "__key"], True)
    within = {f"s{i}": F.coalesce(F.sum(n).over(along), F.lit(0)) for i, n in enumerate(names)}
    within |= {f"c{i}": F.count(n).over(along) for i, n in enumerate(names)}
    summed = celled.select("*", *((v + F.lit(before.get(t, 0))).alias(t) for t, v in within.items()))
    if not cuts:
        return summed.drop("cell")
    cells = celled.groupBy("cell").agg(*(v.alias(t) for t, v in totals.items()))
    earlier = cells.select("cell", *(F.coalesce(F.sum(t).over(ordered.cells_before([])), F.lit(0)).alias(f"b{t}") for t in totals))
    joined = summed.join(F.broadcast(earlier), "cell")
    return joined.withColumns({t: F.col(t) + F.col(f"b{t}") for t in totals}).drop("cell", *(f"b{t}" for t in totals))


def mismatch(chain: Chain) -> Column:
    """Whether the running mean of any checked feature is too far from training."""
    found = F.lit(False)
    for i, name in enumerate(_names(chain)):
        mean, deviation = chain.training[name]
        distance = F.abs(F.col(f"s{i}") / F.nullif(F.col(f"c{i}"), F.lit(0)) - F.lit(mean))
        # Without a number on either side, or a deviation, there is nothing to compare.
        too_far = (distance / F.lit(deviation or 1.0) > chain.mean_tolerance) | (distance / F.lit(abs(mean) or 1.0) > chain.relative_tolerance)
        found = found | F.coalesce(too_far, F.lit(False))
    return found


def settle(limited: DataFrame, chain: Chain, before: dict[str, int]) -> tuple[DataFrame, dict[str, int]]:
    """Outcome, status, score and decision of requests whose ``accepted`` is known, and the totals after them.

    Valid requests that pass the limiter are samples of the feature check
    whatever becomes of them. Requests of one time are taken by request_id.
    """
    names = _names(chain)
    request = F.struct(*limited.columns).alias("__request")
    whole = limited.select(request, payload_fields(F.col("payload")).alias("fields"))
    sampled = F.coalesce(F.expr("__request.accepted AND NOT __request.malformed AND NOT __request.validation_error"), F.lit(False))
    inputs = _features(chain)
    samples = whole.where(sampled).select(
        "__request", F.col("__request.us").alias("__us"), F.col("__request.request_id").alias("__key"), *inputs,
    )
    checked = running_sums(samples, chain, before) if names else samples
    scored = models.score(chain.model, checked) if chain.model is not None else checked.withColumn(models.SCORE, F.lit(None).cast("double"))
    text = {f.name: True for f in chain.contract.fields if f.kind != "integer"}
    canonical = canonical_json({n: F.col(n) for n in chain.contract.features}, text)
    scored = scored.select("__request", F.col(models.SCORE).alias("score"), mismatch(chain).alias("mismatch"), input_hash(canonical).alias("input_hash"))
    rows = scored.unionByName(whole.where(~sampled).select("__request"), allowMissingColumns=True).select("__request.*", "score", "mismatch", "input_hash")
    flags = {
        "malformed": F.col("malformed"), "no_model": F.lit(chain.model is None), "rate_limited": ~F.col("accepted"),
        "validation_error": F.col("validation_error"), "feature_mismatch": F.col("mismatch"),
        "timeout": F.col("elapsed") > chain.time_limit_seconds,
    }
    ok = F.col("outcome") == "success"
    settled = rows.withColumn("outcome", request_outcome(flags)).withColumn("status", status_code(flags)).select(
        "request_id", "client", F.timestamp_micros("us").alias("timestamp"), "outcome", "status",
        F.when(ok, F.round("score", fixed.SCORE_DECIMALS)).alias("prediction"), F.when(ok, decide(F.col("score"))).alias("decision"),
        F.when(ok, F.col("input_hash")).alias("input_hash"), F.lit(chain.model_version).alias("model_version"),
        (F.col("elapsed") * 1000).alias("latency_ms"), F.lit(len(chain.contract.features)).alias("features_count"),
    )
    if not names:
        return settled, {}
    sums = samples.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(f"s{i}") for i, n in enumerate(names)), *(F.count(n).alias(f"c{i}") for i, n in enumerate(names)))
    after = {t: v + before.get(t, 0) for t, v in sums.first().asDict().items()}
    return settled, after


def score_shaped(requests: DataFrame, chain: Chain) -> DataFrame:
    """The chain without limiter and feature check: what a request shows by itself. Stateless, for tables and streams."""
    rows = shaped(requests, chain).select(F.struct("*").alias("__request"), payload_fields(F.col("payload")).alias("fields"))
    scored = models.score(chain.model, rows.select("__request", *_features(chain)))
    flags = {"malformed": F.col("__request.malformed"), "validation_error": F.col("__request.validation_error")}
    ok = F.col("outcome") == "success"
    return scored.withColumn("outcome", request_outcome(flags)).select(
        "__request.request_id", "__request.client", "outcome",
        F.when(ok, F.round(models.SCORE, fixed.SCORE_DECIMALS)).alias("prediction"), F.when(ok, decide(F.col(models.SCORE))).alias("decision"),
    )


def settle_table(requests: DataFrame, chain: Chain) -> DataFrame:
    """The chain over a table, all of it in order of time."""
    return settle(materialise(limited_table(requests, chain), "limited"), chain, {})[0]


def run_requests(stream: DataFrame, chain: Chain, folder: str) -> list[dict]:
    """Drain a request stream into ``folder``/log; checkpoint and totals are kept beside it.

    A later run on the same folder goes on where this one ended.
    """
    names = _names(chain)

    def totals(spark: SparkSession, number: int) -> dict[str, int]:
        done = [n for n in batches(spark, f"{folder}/totals") if n < number]
        return spark.read.json(f"{folder}/totals/batch={done[-1]}").first().asDict() if done and names else {}

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{folder}/limited/batch={number}")
        limited = spark.read.schema(batch.schema).parquet(f"{folder}/limited/batch={number}")
        settled, after = settle(limited, chain, totals(spark, number))
        settled.write.mode("overwrite").parquet(f"{folder}/log/batch={number}")
        if names:
            spark.createDataFrame([after]).coalesce(1).write.mode("overwrite").json(f"{folder}/totals/batch={number}")

    query = (
        limited_stream(stream, chain).writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return [dict(p) for p in query.recentProgress]


def read_requests(spark: SparkSession, folder: str) -> DataFrame:
    """The log of all batches that are wholly written."""
    done = [f"{folder}/log/batch={n}" for n in batches(spark, f"{folder}/log")]
    return spark.read.parquet(*done)


def stream_requests(spark: SparkSession, source: Callable[[SparkSession], DataFrame], chain: Chain) -> DataFrame:
    """Run the chain to the end of its input, in a session and a folder of its own."""
    session = stream_session(spark)
    folder = fresh_path(session, "requests")
    run_requests(source(session), chain, folder)
    return read_requests(spark, folder)


def log_records(settled: DataFrame) -> DataFrame:
    """The prediction log's records: the successful requests."""
    return log_entries(
        settled.where("outcome = 'success'"), "request_id", "timestamp", F.col("input_hash"), "prediction", "decision", "latency_ms",
        "client", F.col("features_count"), F.col("model_version"),
    )
