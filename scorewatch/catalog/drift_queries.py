"""Drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift
from ..operators.ordered import quantile_edges
from ..plans.drift_run import drift_run as run_drift, prediction_psi as plan_prediction_psi
from . import views
from .psi_sql import ks_ctes, psi_ctes
from .registry import query, r6, rounded
from .views import APP_SIDES, CATEGORICAL, EVENT_SIDES, NUMERIC

FEATURES = drift.Features(NUMERIC, CATEGORICAL)
EVENT_FEATURES = drift.Features(("value",), ("event_type",))
ORDER_SQL = "CASE feature " + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(FEATURES.names)) + " END"


@query("psi_numeric", f"WITH {APP_SIDES}, {psi_ctes(NUMERIC)} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi_numeric(spark, sf):
    ref, cur = views.app_sides(spark, sf)
    return drift.psi(ref, cur, drift.Features(NUMERIC)).select("feature", r6("psi").alias("psi"))


@query("psi_numeric_cells", f"WITH {APP_SIDES}, {psi_ctes(NUMERIC)} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi_numeric_cells(spark, sf):
    """The same with cells so small that edges are found as on the largest tables: by cut points, counts and narrowing."""
    ref, cur = views.app_sides(spark, sf)
    edges = quantile_edges(ref, list(NUMERIC), rows_per_cell=100)
    return drift.psi(ref, cur, drift.Features(NUMERIC), edges=edges).select("feature", r6("psi").alias("psi"))


@query("psi_categorical", f"WITH {APP_SIDES}, {psi_ctes((), CATEGORICAL)} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi_categorical(spark, sf):
    ref, cur = views.app_sides(spark, sf, lines=False)
    return drift.psi(ref, cur, drift.Features((), CATEGORICAL)).select("feature", r6("psi").alias("psi"))


EVENT_DAILY = psi_ctes(("value",), ("event_type",), "CAST(ts AS DATE)")


@query(
    "psi_by_day",
    f"""WITH {EVENT_SIDES}, {EVENT_DAILY}
SELECT grp AS event_day, round(max(psi), 6) AS psi FROM psi GROUP BY grp""",
)
def psi_by_day(spark, sf):
    ref, cur = views.event_sides(spark, sf)
    return drift.psi_by_day(ref, cur, EVENT_FEATURES, "ts").select("event_day", r6("psi").alias("psi"))


APP_DAILY = psi_ctes(NUMERIC, CATEGORICAL, "event_time")
TREND = f"""
best AS (SELECT grp, feature, psi, row_number() OVER (PARTITION BY grp ORDER BY round(psi, 9) DESC, {ORDER_SQL}) AS rn FROM psi),
day_rows AS (SELECT event_time, count(*) AS n FROM cur GROUP BY event_time),
trend AS (SELECT b.grp AS event_time, d.n AS n_rows, b.psi AS max_psi, b.feature AS max_psi_feature
          FROM best b JOIN day_rows d ON d.event_time = b.grp WHERE rn = 1)
"""


def _trend(spark, sf):
    ref, cur = views.app_sides(spark, sf)
    return drift.psi_trend(ref, cur, FEATURES, "event_time").withColumnRenamed("rows", "n_rows")


@query(
    "psi_trend",
    f"""WITH {APP_SIDES}, {APP_DAILY}, {TREND}
SELECT event_time, n_rows, round(max_psi, 6) AS max_psi, max_psi_feature FROM trend""",
)
def psi_trend(spark, sf):
    return rounded(_trend(spark, sf))


@query(
    "trend_head",
    f"""WITH {APP_SIDES}, {APP_DAILY}, {TREND}
SELECT event_time, n_rows, round(max_psi, 6) AS max_psi, max_psi_feature FROM trend ORDER BY event_time LIMIT 10""",
)
def trend_head(spark, sf):
    return rounded(drift.trend_head(_trend(spark, sf)))


@query("ks_two_sample", f"WITH {APP_SIDES}, {ks_ctes(NUMERIC)} SELECT feature, round(ks, 6) AS ks FROM ks")
def ks_two_sample(spark, sf):
    ref, cur = views.app_sides(spark, sf)
    return drift.ks_statistic(ref, cur, NUMERIC).select("feature", r6("ks").alias("ks"))


REPORT = f"""
report AS (SELECT p.feature, p.psi, k.ks, p.psi > 0.2 OR coalesce(k.ks > 0.1, false) AS alert
           FROM psi p LEFT JOIN ks k ON k.feature = p.feature)
"""
REPORT_CTES = f"{APP_SIDES}, {psi_ctes(NUMERIC, (*CATEGORICAL, 'event_time'))}, {ks_ctes(NUMERIC)}, {REPORT}"


def _report(spark, sf):
    ref, cur = views.app_sides(spark, sf)
    return drift.drift_report(ref, cur, FEATURES, "event_time")


@query(
    "drift_report",
    f"WITH {REPORT_CTES} SELECT feature, round(psi, 6) AS psi, round(ks, 6) AS ks, alert FROM report",
)
def drift_report(spark, sf):
    return rounded(_report(spark, sf))


EVENT_SCORE = f"""
{EVENT_SIDES},
rscore AS (SELECT value / (value + 50.0::DOUBLE) AS prediction FROM ref),
cscore AS (SELECT value / (value + 50.0::DOUBLE) AS prediction FROM cur),
{psi_ctes(("prediction",), (), None, "rscore", "cscore")}
"""


def _scores(spark, sf):
    score = (F.col("value") / (F.col("value") + 50.0)).alias("prediction")
    return [side.select(score) for side in views.event_sides(spark, sf)]


@query("prediction_psi", f"WITH {EVENT_SCORE} SELECT round(psi, 6) AS psi FROM psi")
def prediction_psi(spark, sf):
    return rounded(plan_prediction_psi(*_scores(spark, sf), "prediction"))


HEADLINE = """
run AS (SELECT bool_or(alert) AS alert, max(psi) AS headline_psi FROM report)
"""


@query(
    "drift_breaches",
    f"""WITH {EVENT_SIDES}, {psi_ctes(("value",), ("event_type",))}, {ks_ctes(("value",))}, {REPORT},
rscore AS (SELECT value / (value + 50.0::DOUBLE) AS prediction FROM ref),
cscore AS (SELECT value / (value + 50.0::DOUBLE) AS prediction FROM cur),
{psi_ctes(("prediction",), (), None, "rscore", "cscore", "s_")},
run AS (SELECT bool_or(alert) AS alert, (SELECT psi FROM s_psi) AS prediction_psi FROM report)
SELECT alert, 0.2::DOUBLE AS psi_threshold, round(prediction_psi, 6) AS prediction_psi,
       round(prediction_psi, 6) AS headline_psi, alert OR prediction_psi > 0.2 AS breach FROM run""",
)
def drift_breaches(spark, sf):
    ref, cur = views.event_sides(spark, sf)
    report = drift.drift_report(ref, cur, EVENT_FEATURES)
    return rounded(drift.headline(report, plan_prediction_psi(*_scores(spark, sf), "prediction")))


@query(
    "drift_events",
    f"""WITH {REPORT_CTES}, {psi_ctes(NUMERIC, CATEGORICAL, "event_time", prefix="d_")}, {TREND.replace("FROM psi)", "FROM d_psi)")}, {HEADLINE},
head AS (SELECT row_number() OVER (ORDER BY event_time) AS seq, * FROM trend ORDER BY event_time LIMIT 10)
SELECT 0 AS seq, 'METRIC' AS kind, printf('psi=%.4f threshold=%.4f', headline_psi, 0.2::DOUBLE) AS message FROM run
UNION ALL SELECT CAST(seq AS INTEGER), 'TEMPORAL_PSI', printf('event_time=%s max_psi=%.4f feature=%s rows=%d',
       CAST(event_time AS VARCHAR), max_psi, max_psi_feature, n_rows) FROM head
UNION ALL SELECT 100, 'BREACH', printf('psi=%.4f > threshold=%.4f', headline_psi, 0.2::DOUBLE) FROM run WHERE alert OR headline_psi > 0.2
UNION ALL SELECT 101, 'ALERT', 'drift threshold breached' FROM run WHERE alert OR headline_psi > 0.2""",
)
def drift_events(spark, sf):
    ref, cur = views.app_sides(spark, sf)
    return run_drift(ref, cur, FEATURES, "event_time").events


@query(
    "drift_alerts",
    f"""WITH {EVENT_SIDES}, {EVENT_DAILY}, daily AS (SELECT grp AS event_day, max(psi) AS psi FROM psi GROUP BY grp)
SELECT event_day, 'PSI' AS metric, round(psi, 6) AS value, 0.02::DOUBLE AS threshold, 'unhealthy' AS status,
       'PSI breach' AS reason FROM daily WHERE psi > 0.02""",
)
def drift_alerts(spark, sf):
    ref, cur = views.event_sides(spark, sf)
    daily = drift.psi_by_day(ref, cur, EVENT_FEATURES, "ts")
    # The events drift little; a low threshold gives alerts to look at.
    return rounded(drift.alerts(daily, threshold=0.02))
