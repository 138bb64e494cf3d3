"""Model approval, the active version and rollbacks, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import fixed


class RegistryError(RuntimeError):
    """No registry, or nothing in it to go back to."""


def policy_gate(
    candidates: DataFrame,
    minimum_auc: float = fixed.MINIMUM_ROC_AUC,
    maximum_gap: float = fixed.MAXIMUM_CALIBRATION_GAP,
    auc: str = "roc_auc",
    gap: str = "calibration_gap_after",
) -> DataFrame:
    """Add ``approved``: AUC and calibration gap within the policy, bounds included."""
    passes = (F.col(auc) >= minimum_auc) & (F.col(gap) <= maximum_gap)
    return candidates.withColumn("approved", F.coalesce(passes, F.lit(False)))


def registry_entries(gated: DataFrame, seq: str, artifact: str) -> DataFrame:
    """Registry rows, rejected candidates included; the place tells approved from candidate."""
    place = F.when(F.col("approved"), "approved/").otherwise("candidate/")
    return gated.select(
        F.col(seq).alias("seq"), F.concat(place, F.col(artifact)).alias("artifact"), "approved", "roc_auc", "calibration_gap_after"
    )


def append_registry(entries: DataFrame, path: str) -> None:
    """Append entries to the registry table."""
    entries.write.mode("append").parquet(path)


def active_model_asof(registry: DataFrame, family: Sequence[str] = ()) -> DataFrame:
    """Per entry: the active artifact once the entry was decided; a rejection keeps the earlier one.

    One row per decided candidate and family is sorted here, not data rows.
    """
    upto = Window.partitionBy(*family).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    active = F.last(F.when(F.col("approved"), F.col("artifact")), ignorenulls=True).over(upto)
    return registry.withColumn("active_model", active)


def latest_approved(registry: DataFrame, family: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """The approved entry with the highest sequence number, per family.

    ``exclude`` steps past artifacts known to be unhealthy.
    """
    usable = registry.where("approved")
    if exclude:
        usable = usable.where(~F.col("artifact").isin(list(exclude)))
    return usable.groupBy(*family).agg(
        F.max("seq").alias("seq"), F.max_by("artifact", "seq").alias("active_model")
    ).where(F.col("seq").isNotNull())


def rollback(registry: DataFrame, exclude: Sequence[str] = ()) -> dict[str, str]:
    """Name the version to run after a rollback; an error when none is approved."""
    rows = latest_approved(registry, exclude=exclude).collect()
    if not rows:
        raise RegistryError("no approved model to roll back to")
    return {"status": "rolled_back", "active_model": rows[0]["active_model"]}


def rollback_actions(alerts: DataFrame, registry: DataFrame, day: str = "event_day", decided: str = "decided_on") -> DataFrame:
    """Per alert day: the latest version approved up to that day.

    Alerts and approvals of all days are put in one sequence and the last
    approval is carried forward: one sort of (alerts + entries), no range join.
    """
    calendar = registry.where("approved").select(
        F.col(decided).alias(day), F.col("artifact").alias("approved_artifact"), F.col("seq"), F.lit(0).alias("kind"),
        F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("value"),
    )
    asked = alerts.select(
        day, F.lit(None).cast("string").alias("approved_artifact"), F.lit(None).cast(registry.schema["seq"].dataType).alias("seq"),
        F.lit(1).alias("kind"), "metric", "value",
    )
    order = Window.orderBy(day, "kind", "seq").rowsBetween(Window.unboundedPreceding, 0)
    carried = F.last("approved_artifact", ignorenulls=True).over(order)
    return (
        calendar.unionByName(asked)
        .withColumn("active_model", carried)
        .where(F.col("kind") == 1)
        .select(
            day, "metric", "value",
            F.when(F.col("active_model").isNull(), "no_approved_model").otherwise("rolled_back").alias("status"),
            "active_model",
        )
    )
