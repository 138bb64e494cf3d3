"""Registry, approvals and rollbacks; every month of order lines is one candidate model."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift, governance, metrics
from ..plans.drift_run import as_table, drift_run as run_drift
from . import views
from .drift_queries import EVENT_DAILY, EVENT_FEATURES, FEATURES, HEADLINE, REPORT_CTES, TREND
from .metric_queries import auc_sql, gap_sql
from .psi_sql import psi_ctes
from .registry import query, r6, rounded
from .views import BIN_CTE, CATEGORICAL, EVENT_SIDES, NUMERIC

# Scores here rank hardly better than chance, so the gate is set where it splits the candidates.
MIN_AUC, MAX_GAP = 0.5, 0.55

CANDIDATES = f"""
{BIN_CTE},
cand AS (SELECT a.month, CAST(year(a.month) * 12 + month(a.month) AS BIGINT) AS seq, 'model-' || strftime(a.month, '%Y-%m') AS artifact,
                round(a.auc, 6) AS roc_auc, round(g.gap, 6) AS calibration_gap_after
         FROM {auc_sql('bin', 'p', 'y', 'month')} a JOIN {gap_sql('bin', 'p', 'y', 'month')} g ON g.month IS NOT DISTINCT FROM a.month),
gate AS (SELECT *, coalesce(roc_auc >= {MIN_AUC} AND calibration_gap_after <= {MAX_GAP}, false) AS approved FROM cand),
reg AS (SELECT seq, CASE WHEN approved THEN 'approved/' ELSE 'candidate/' END || artifact AS artifact, approved, roc_auc, calibration_gap_after, month FROM gate)
"""


def candidates(spark, sf):
    rows = views.scored_labels(spark, sf)
    auc = metrics.roc_auc(rows, "p", "y", ["month"])
    gap = metrics.calibration_gap(rows, "p", "y", ["month"]).withColumnRenamed("month", "gap_month")
    return auc.join(gap, F.col("month").eqNullSafe(F.col("gap_month"))).select(
        "month",
        (F.year("month") * 12 + F.month("month")).cast("bigint").alias("seq"),
        F.concat(F.lit("model-"), F.date_format("month", "yyyy-MM")).alias("artifact"),
        r6("roc_auc").alias("roc_auc"),
        r6("calibration_gap").alias("calibration_gap_after"),
    )


def gated(spark, sf):
    return governance.policy_gate(candidates(spark, sf), MIN_AUC, MAX_GAP)


def registry(spark, sf):
    return governance.registry_entries(gated(spark, sf), "seq", "artifact")


@query("policy_gate", f"WITH {CANDIDATES} SELECT seq, artifact, roc_auc, calibration_gap_after, approved FROM gate")
def policy_gate(spark, sf):
    return gated(spark, sf).select("seq", "artifact", "roc_auc", "calibration_gap_after", "approved")


@query("registry", f"WITH {CANDIDATES} SELECT seq, artifact, approved, roc_auc, calibration_gap_after FROM reg")
def registry_query(spark, sf):
    return registry(spark, sf)


@query(
    "active_model_asof",
    f"""WITH {CANDIDATES} SELECT seq, artifact, approved,
last_value(CASE WHEN approved THEN artifact END IGNORE NULLS) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS active_model FROM reg""",
)
def active_model_asof(spark, sf):
    return governance.active_model_asof(registry(spark, sf)).select("seq", "artifact", "approved", "active_model")


@query("latest_approved", f"WITH {CANDIDATES} SELECT seq, artifact AS active_model FROM reg WHERE approved ORDER BY seq DESC LIMIT 1")
def latest_approved(spark, sf):
    return governance.latest_approved(registry(spark, sf))


# Events are from 2024, order lines from the nineties: candidates are taken as decided day by day from 2024-01-10 on.
DECIDED_SQL = "CAST(DATE '2024-01-10' + CAST(seq % 30 AS INTEGER) AS DATE)"


@query(
    "rollback_actions",
    f"""WITH {CANDIDATES}, {EVENT_SIDES}, {EVENT_DAILY},
al AS (SELECT grp AS event_day, max(psi) AS psi FROM psi GROUP BY grp HAVING max(psi) > 0.02),
ok AS (SELECT {DECIDED_SQL} AS decided_on, seq, artifact FROM reg WHERE approved)
SELECT event_day, 'PSI' AS metric, round(psi, 6) AS value,
       CASE WHEN active_model IS NULL THEN 'no_approved_model' ELSE 'rolled_back' END AS status, active_model FROM (
  SELECT al.*, (SELECT artifact FROM ok WHERE decided_on <= event_day ORDER BY decided_on DESC, seq DESC LIMIT 1) AS active_model FROM al)""",
)
def rollback_actions(spark, sf):
    ref, cur = views.event_sides(spark, sf)
    alerts = drift.alerts(drift.psi_by_day(ref, cur, EVENT_FEATURES, "ts"), threshold=0.02)
    decided = registry(spark, sf).withColumn(
        "decided_on", F.date_add(F.to_date(F.lit("2024-01-10")), (F.col("seq") % 30).cast("int"))
    )
    return rounded(governance.rollback_actions(alerts, decided))


@query(
    "drift_run",
    f"""WITH {CANDIDATES}, {REPORT_CTES}, {psi_ctes(NUMERIC, CATEGORICAL, "event_time", prefix="d_")}, {TREND.replace("FROM psi)", "FROM d_psi)")}, {HEADLINE},
al AS (SELECT * FROM trend WHERE max_psi > 0.2), ok AS (SELECT month AS decided_on, seq, artifact FROM reg WHERE approved)
SELECT 'run' AS part, 'headline' AS item, round(headline_psi, 6) AS value, CAST(NULL AS DOUBLE) AS ks, alert OR headline_psi > 0.2 AS flag, CAST(NULL AS VARCHAR) AS detail FROM run
UNION ALL SELECT 'report', feature, round(psi, 6), round(ks, 6), alert, NULL FROM report
UNION ALL SELECT 'trend', CAST(event_time AS VARCHAR), round(max_psi, 6), NULL, NULL, max_psi_feature || ' ' || n_rows FROM trend
UNION ALL SELECT 'alert', CAST(event_time AS VARCHAR), round(max_psi, 6), NULL, NULL, 'unhealthy' FROM al
UNION ALL SELECT 'action', CAST(event_time AS VARCHAR), round(max_psi, 6), NULL, NULL, coalesce('rolled_back ' || active_model, 'no_approved_model') FROM (
  SELECT al.*, (SELECT artifact FROM ok WHERE decided_on <= event_time ORDER BY decided_on DESC, seq DESC LIMIT 1) AS active_model FROM al)""",
)
def drift_run(spark, sf):
    """A whole run: headline, report, trend, alerts, and the version each alert goes back to."""
    ref, cur = views.app_sides(spark, sf)
    decided = registry(spark, sf).join(gated(spark, sf).select("seq", F.col("month").alias("decided_on")), "seq")
    return rounded(as_table(run_drift(ref, cur, FEATURES, "event_time", registry=decided)))
