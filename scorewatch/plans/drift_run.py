"""A complete drift run: report, trend, breach, alerts, rollback actions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import fixed
from ..operators import drift, governance


@dataclass
class DriftRun:
    report: DataFrame
    trend: DataFrame
    run: DataFrame
    alerts: DataFrame
    events: DataFrame
    actions: DataFrame | None


def prediction_psi(reference: DataFrame, current: DataFrame, score: str) -> DataFrame:
    """PSI of a score column."""
    return drift.psi(reference, current, drift.Features(numeric=(score,))).select("psi")


def drift_run(
    reference: DataFrame,
    current: DataFrame,
    features: drift.Features,
    time_column: str,
    threshold: float = fixed.PSI_ALERT,
    score: str | None = None,
    registry: DataFrame | None = None,
) -> DriftRun:
    """Everything one monitoring run reports. Nothing is changed: alerts and actions are tables.

    Report and trend come from one cube of counts and are written once, a row
    for each feature and for each day; all else is read from them.
    """
    report, trend = drift.report_and_trend(reference, current, features, time_column)
    scores = prediction_psi(reference, current, score) if score else None
    run = drift.headline(report, scores, threshold)
    daily = trend.select(F.col("event_time").alias("event_day"), F.col("max_psi").alias("psi"))
    alerts = drift.alerts(daily, threshold=threshold)
    actions = governance.rollback_actions(alerts, registry) if registry is not None else None
    return DriftRun(report, trend, run, alerts, drift.monitoring_events(run, trend), actions)


def as_table(run: DriftRun) -> DataFrame:
    """The whole result in one table: part, item (a feature or a day), value, ks, flag, detail."""
    none_d, none_b, none_s = F.lit(None).cast("double"), F.lit(None).cast("boolean"), F.lit(None).cast("string")

    def rows(df: DataFrame, part: str, item, value, ks=none_d, flag=none_b, detail=none_s) -> DataFrame:
        return df.select(
            F.lit(part).alias("part"), item.alias("item"), value.cast("double").alias("value"), ks.alias("ks"), flag.alias("flag"), detail.alias("detail"),
        )

    day = lambda name: F.col(name).cast("string")
    out = rows(run.run, "run", F.lit("headline"), F.col("headline_psi"), flag=F.col("breach"))
    out = out.unionByName(rows(run.report, "report", F.col("feature"), F.col("psi"), F.col("ks"), F.col("alert")))
    out = out.unionByName(rows(run.trend, "trend", day("event_time"), F.col("max_psi"), detail=F.concat_ws(" ", "max_psi_feature", F.col("rows").cast("string"))))
    out = out.unionByName(rows(run.alerts, "alert", day("event_day"), F.col("value"), detail=F.col("status")))
    if run.actions is not None:
        out = out.unionByName(rows(run.actions, "action", day("event_day"), F.col("value"), detail=F.concat_ws(" ", "status", "active_model")))
    return out
