"""Analysis of prediction logs: traffic, decisions, latency, money."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed
from ..functions.text import utc_stamp
from .ordered import exact_quantiles, side_by_side


def log_entries(
    requests: DataFrame,
    request_id: str,
    timestamp: str,
    input_hash: Column,
    score: str,
    decision: str,
    latency_ms: str,
    client_id: str | None = None,
    features_count: Column | int = 0,
    model_version: Column | str = fixed.MODEL_VERSION,
) -> DataFrame:
    """Prediction log records; columns in name order, score and latency rounded."""
    version = F.lit(model_version) if isinstance(model_version, str) else model_version
    count = F.lit(features_count) if isinstance(features_count, int) else features_count
    client = F.col(client_id).cast("string") if client_id else F.lit(None).cast("string")
    columns = {
        "timestamp": utc_stamp(F.col(timestamp)),
        "request_id": F.col(request_id).cast("string"),
        "input_hash": input_hash,
        "model_version": version,
        "prediction": F.round(score, fixed.SCORE_DECIMALS),
        "decision": F.col(decision),
        "client_id": client,
        "features_count": count.cast("int"),
        "latency_ms": F.round(latency_ms, fixed.LATENCY_DECIMALS),
    }
    return requests.select(*[columns[n].alias(n) for n in sorted(columns)])


def decision_distribution(logs: DataFrame, decision: str = "decision") -> DataFrame:
    return logs.groupBy(decision).agg(F.count(F.lit(1)).alias("requests"))


def analyse_log(logs: DataFrame) -> DataFrame:
    """One row of totals, distinct inputs, versions, decisions, score and latency statistics.

    ``model_versions`` is a sorted list, ``decisions`` a list of (decision, n),
    both from one row per version and decision. Quantiles are exact and found
    by narrowing, so no task holds all values.
    """
    points = {"prediction": (0.5, 0.95, 0.99), "latency_ms": (0.5, 0.95, 0.99)}
    quantiles = exact_quantiles(logs, points)
    # Hashes are collapsed before they are counted, versions and decisions before they are listed.
    base = logs.agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.avg("prediction").alias("prediction_mean"),
        F.stddev_samp("prediction").alias("prediction_std"),
        F.min("prediction").alias("prediction_min"),
        F.max("prediction").alias("prediction_max"),
        F.avg("latency_ms").alias("latency_mean_ms"),
    )
    each = logs.groupBy("model_version", "decision").agg(F.count(F.lit(1)).alias("n"))
    versions = each.groupBy("model_version").agg(F.lit(1)).agg(F.array_sort(F.collect_list("model_version")).alias("model_versions"))
    decisions = each.where(F.col("decision").isNotNull()).groupBy("decision").agg(F.sum("n").alias("n"))
    decisions = decisions.agg(F.array_sort(F.collect_list(F.struct("decision", "n"))).alias("decisions"))
    inputs = logs.select("input_hash").distinct().agg(F.count("input_hash").alias("unique_inputs"))
    names = {"prediction": "prediction_p{:02d}", "latency_ms": "latency_p{:02d}_ms"}
    literals = [
        F.lit(value).cast("double").alias(names[c].format(round(p * 100)))
        for c, ps in points.items() for p, value in zip(ps, quantiles[c])
    ]
    return side_by_side(base, inputs, versions, decisions).select("*", *literals)


def outcome_counters(requests: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per value of several label columns, long form, in one pass."""
    pairs = [F.struct(F.lit(c).alias("counter"), F.col(c).cast("string").alias("label")) for c in columns]
    return (
        requests.select(F.inline(F.array(*pairs)))
        .where(F.col("label").isNotNull())
        .groupBy("counter", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def load_summary(responses: DataFrame, status: str, error: str, elapsed_ms: str, by: Sequence[str] = ()) -> DataFrame:
    """Requests, successes (status 200), errors and mean time."""
    return responses.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col(status) == 200).alias("success"),
        F.count_if(F.col(error).isNotNull() & (F.col(error) != "")).alias("errors"),
        F.avg(elapsed_ms).alias("avg_latency_ms"),
    )


def replayed_inputs(logs: DataFrame, key: str = "input_hash") -> DataFrame:
    """Inputs that were sent more than once, with their number of requests."""
    return logs.groupBy(key).agg(F.count(F.lit(1)).alias("requests")).where(F.col("requests") > 1)


def business_metrics(
    logs: DataFrame,
    loss_per_default: float = fixed.LOSS_PER_DEFAULT,
    processing_cost: float = fixed.PROCESSING_COST,
) -> DataFrame:
    """One row of decision rates, score distribution and estimated money flows.

    The approval and review losses are already divided by the number of
    requests; ``expected_loss_per_request_as_reported`` divides once more, and
    ``expected_loss_per_request`` does not.
    """
    ps = (0.25, 0.50, 0.75, 0.95)
    quantiles = exact_quantiles(logs, {"prediction": ps})["prediction"]
    score, tier = F.col("prediction"), F.col("decision")
    sums = logs.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(tier == t).alias(f"n_{t}") for t in ("approve", "review", "reject")],
        *[F.coalesce(F.sum(F.when(tier == t, score)), F.lit(0.0)).alias(f"s_{t}") for t in ("approve", "review")],
        F.avg(score).alias("mean"), F.stddev_samp(score).alias("std"), F.min(score).alias("min"), F.max(score).alias("max"),
    ).where(F.col("n") > 0)
    n = F.col("n")
    approval_loss = F.col("s_approve") * loss_per_default / n
    # mean review score x failure rate x loss x review count / n; the mean's divisor cancels the count
    review_loss = F.col("s_review") * fixed.REVIEW_FAILURE_RATE * loss_per_default / n
    approval_revenue = F.col("n_approve") * processing_cost * fixed.APPROVAL_MARGIN
    review_revenue = F.col("n_review") * processing_cost * fixed.REVIEW_MARGIN
    loss = approval_loss + review_loss
    net = approval_revenue + review_revenue - loss
    money = {
        "expected_loss_per_request_as_reported": loss / n,
        "expected_loss_per_request": loss,
        "approval_expected_loss": approval_loss,
        "review_expected_loss": review_loss,
        "approval_revenue": approval_revenue,
        "review_revenue": review_revenue,
        "net_profit": net,
        "net_profit_per_request": net / n,
    }
    rates = {"approval_rate": "n_approve", "review_rate": "n_review", "rejection_rate": "n_reject"}
    return sums.select(
        n.alias("total_requests"),
        *[F.round(F.col(c) / n, 4).alias(name) for name, c in rates.items()],
        F.col("n_approve").alias("approval_count"),
        F.col("n_review").alias("review_count"),
        F.col("n_reject").alias("rejection_count"),
        *[F.round(c, 4).alias(f"prediction_{c}") for c in ("mean", "std", "min", "max")],
        *[F.round(F.lit(v).cast("double"), 4).alias(f"prediction_p{round(p * 100)}") for p, v in zip(ps, quantiles)],
        *[F.round(v, 2).alias(f"{name}_usd") for name, v in money.items()],
        F.lit(float(loss_per_default)).alias("loss_per_default_usd"),
        F.lit(float(processing_cost)).alias("processing_cost_usd"),
        F.lit(1 - fixed.REVIEW_FAILURE_RATE).alias("review_screening_success_rate"),
        F.lit(fixed.INTEREST_RATE).alias("interest_rate"),
    )
