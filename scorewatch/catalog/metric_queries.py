"""Score quality and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.buckets import unit_edges
from ..functions.decisions import decide
from ..operators import metrics
from ..operators.isotonic import apply_steps, isotonic_steps
from . import views
from .registry import query, r6, rounded
from .views import BIN_CTE, LOG_CTE


def auc_sql(table: str, score: str, label: str, by: str = "") -> str:
    """AUC by rank sums over values, for use in a FROM clause."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""(SELECT {keys}CASE WHEN sum(pos) > 0 AND sum(neg) > 0
        THEN sum(pos * (below + neg / 2.0::DOUBLE)) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) END AS auc
      FROM (SELECT {keys}pos, neg, coalesce(CAST(sum(neg) OVER ({part}ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0) AS below
            FROM (SELECT {keys}{score} AS s, CAST(sum({label}) AS DOUBLE) AS pos, CAST(sum(1 - {label}) AS DOUBLE) AS neg
                  FROM {table} WHERE {score} IS NOT NULL GROUP BY {keys}{score})) {group})"""


def gap_sql(table: str, score: str, label: str, by: str = "") -> str:
    """Calibration gap over the exact bin edges."""
    edges = unit_edges(fixed.CALIBRATION_BINS)
    cases = " ".join(
        f"WHEN {score} >= {edges[i]!r}::DOUBLE AND {score} {'<=' if i == 9 else '<'} {edges[i + 1]!r}::DOUBLE THEN {i}"
        for i in range(10)
    )
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""(SELECT {keys}max(abs(o - e)) AS gap FROM (
        SELECT {keys}bin, avg({label}) AS o, avg({score}) AS e FROM (
          SELECT *, CASE {cases} END AS bin FROM {table}) WHERE bin IS NOT NULL GROUP BY {keys}bin) {group})"""


@query("roc_auc", f"WITH {BIN_CTE} SELECT round(auc, 6) AS roc_auc FROM {auc_sql('bin', 'p', 'y')}")
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(views.scored_labels(spark, sf), "p", "y"))


@query(
    "roc_auc_by_month",
    f"WITH {BIN_CTE} SELECT month, round(auc, 6) AS roc_auc FROM {auc_sql('bin', 'p', 'y', 'month')}",
)
def roc_auc_by_month(spark, sf):
    return rounded(metrics.roc_auc(views.scored_labels(spark, sf), "p", "y", ["month"]))


@query(
    "evaluation",
    f"""WITH {BIN_CTE} SELECT round(auc, 6) AS roc_auc, (SELECT round(avg(CASE WHEN p < 0.3 THEN 1.0::DOUBLE ELSE 0 END), 6) FROM bin) AS approval_rate,
0.3::DOUBLE AS decision_threshold FROM {auc_sql('bin', 'p', 'y')}""",
)
def evaluation(spark, sf):
    return rounded(metrics.evaluate_scores(views.scored_labels(spark, sf), "p", "y"))


@query(
    "batch_summary",
    f"""WITH {LOG_CTE} SELECT CAST("timestamp" AS DATE) AS day, CAST(count(prediction) AS DOUBLE) AS batch_size,
round(avg(CASE WHEN prediction < 0.3 THEN 1.0::DOUBLE ELSE 0 END), 6) AS approval_rate, round(avg(prediction), 6) AS mean_risk_score
FROM log GROUP BY 1""",
)
def batch_summary(spark, sf):
    log = views.prediction_log(spark, sf).withColumn("day", F.col("timestamp").cast("date"))
    return rounded(metrics.summarise_batch(log, "prediction", ["day"]))


@query(
    "brier_score",
    f"WITH {BIN_CTE} SELECT round(avg((p - y) ** 2), 8) AS brier_p, round(avg((p2 - y) ** 2), 8) AS brier_p2 FROM bin",
)
def brier_score(spark, sf):
    # Squares are hundredths, so their means over 6, 60 or 600 thousand rows have no ties at 8 places.
    return rounded(metrics.brier_score(views.scored_labels(spark, sf), ["p", "p2"], "y"), 8)


@query("calibration_gap", f"WITH {BIN_CTE} SELECT round(gap, 6) AS calibration_gap FROM {gap_sql('bin', 'p', 'y')}")
def calibration_gap(spark, sf):
    return rounded(metrics.calibration_gap(views.scored_labels(spark, sf), "p", "y"))


# The increasing fit as the greatest lower mean over all intervals round a score.
FIT_CTE = """
pts AS (SELECT p AS s, CAST(sum(y) AS DOUBLE) AS sy, CAST(count(*) AS DOUBLE) AS w FROM bin GROUP BY p),
o AS (SELECT *, row_number() OVER (ORDER BY s) AS i, sum(sy) OVER (ORDER BY s) AS cs, sum(w) OVER (ORDER BY s) AS cw FROM pts),
iv AS (SELECT a.i AS a, b.i AS b, (b.cs - a.cs + a.sy) / (b.cw - a.cw + a.w) AS m FROM o a JOIN o b ON b.i >= a.i),
low AS (SELECT a, b AS i, min(m) OVER (PARTITION BY a ORDER BY b DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM iv),
fit AS (SELECT s, g FROM (SELECT i, max(v) AS g FROM low GROUP BY i) JOIN o USING (i)),
cal AS (SELECT p, y, g FROM bin JOIN fit ON s = p)
"""


@query(
    "calibration_report",
    f"""WITH {BIN_CTE}, {FIT_CTE} SELECT 'isotonic_regression' AS method, count(*) AS calibration_size,
round(avg((p - y) ** 2), 8) AS brier_score_before, round(avg((g - y) ** 2), 8) AS brier_score_after,
(SELECT round(gap, 8) FROM {gap_sql('cal', 'g', 'y')}) AS calibration_gap_after FROM cal""",
)
def calibration_report(spark, sf):
    """The report of an isotonic fit, on the rows it was fitted on."""
    scored = views.scored_labels(spark, sf)
    fitted = apply_steps(scored, "p", isotonic_steps(scored, "p", "y"), "calibrated")
    return rounded(metrics.calibration_report(fitted, "p", "calibrated", "y"), 8)


def _side(score: str, name: str) -> str:
    return f"""{name} AS (SELECT
  avg(CASE WHEN ({score} > 0.5) = (y = 1) THEN 1.0::DOUBLE ELSE 0 END) AS accuracy,
  (SELECT auc FROM {auc_sql('bin', score, 'y')}) AS auc,
  coalesce(count(*) FILTER (WHERE {score} > 0.5 AND y = 1) / nullif(CAST(count(*) FILTER (WHERE {score} > 0.5) AS DOUBLE), 0), 0) AS prec,
  coalesce(count(*) FILTER (WHERE {score} > 0.5 AND y = 1) / nullif(CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE), 0), 0) AS rec FROM bin)"""


@query(
    "compare_scores",
    f"""WITH {BIN_CTE}, {_side('p', 'a')}, {_side('p2', 'b')}
SELECT round(a.accuracy, 4) AS clean_accuracy, round(a.auc, 4) AS clean_auc, round(a.prec, 4) AS clean_precision, round(a.rec, 4) AS clean_recall,
       round(b.accuracy, 4) AS noisy_accuracy, round(b.auc, 4) AS noisy_auc, round(b.prec, 4) AS noisy_precision, round(b.rec, 4) AS noisy_recall,
       round(a.accuracy - b.accuracy, 4) + 0.0 AS delta_accuracy, round(a.auc - b.auc, 4) + 0.0 AS delta_auc,
       round(a.prec - b.prec, 4) + 0.0 AS delta_precision, round(a.rec - b.rec, 4) + 0.0 AS delta_recall FROM a, b""",
)
def compare_scores(spark, sf):
    return metrics.compare_scores(views.scored_labels(spark, sf), "p", "p2", "y")


BOUND_NAMES = [repr(b) for b in fixed.SCORE_BOUNDS] + ["+Inf"]
BOUND_VALUES = ", ".join(
    f"({i}, '{n}', {'1e308' if n == '+Inf' else n}::DOUBLE)" for i, n in enumerate(BOUND_NAMES)
)


@query(
    "histogram_le",
    f"""WITH {LOG_CTE}, bounds(cell, le, ub) AS (VALUES {BOUND_VALUES})
SELECT decision, b.cell, b.le, CAST(count(*) FILTER (WHERE prediction <= ub) AS BIGINT) AS cumulative,
       round(sum(prediction), 4) AS total, count(*) AS "count"
FROM log CROSS JOIN bounds b GROUP BY decision, b.cell, b.le""",
)
def histogram_le(spark, sf):
    log = views.prediction_log(spark, sf)
    h = metrics.cumulative_histogram(log, "prediction", fixed.SCORE_BOUNDS, ["decision"])
    return h.withColumn("total", r6("total", 4))


@query(
    "decision_tiers",
    """SELECT event_id, round(value / (value + 50.0::DOUBLE), 6) AS score,
CASE WHEN value / (value + 50.0::DOUBLE) < 0.3 THEN 'approve' WHEN value / (value + 50.0::DOUBLE) <= 0.7 THEN 'review' ELSE 'reject' END AS decision,
value / (value + 50.0::DOUBLE) < 0.3 AS approved FROM events""",
)
def decision_tiers(spark, sf):
    score = F.col("value") / (F.col("value") + 50.0)
    return views.events(spark, sf).select(
        "event_id", F.round(score, 6).alias("score"), decide(score).alias("decision"),
        (score < fixed.DECISION_THRESHOLD).alias("approved"),
    )
