"""Models: training, scoring, calibration, robustness. Checked for rows; values are tested against NumPy."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.decisions import decide
from ..operators import model as models, splits
from ..operators.contract import Contract, Field
from ..operators.features import Scale
from ..operators.isotonic import apply_steps, isotonic_steps
from ..operators.table_model import fit_table_model
from ..plans import noise, training
from ..session import materialise
from . import views
from .registry import query, r6, rounded
from .views import APP_CTES, DECISION_SQL

SCORED = Contract(
    name="applications",
    fields=(
        Field("event_time", "timestamp"),
        Field("segment", "categorical", ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")),
        Field("priority", "categorical", ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")),
        Field("status", "categorical", ("F", "O", "P")),
        Field("n_items", "integer"),
        Field("qty", "integer"),
        Field("total", "integer"),
        Field("balance", "integer"),
        Field("target", "target", ("1", "2")),
    ),
    target="target",
)


def rows(spark, sf):
    apps = views.applications(spark, sf)
    whole = {c: F.floor(c).cast("bigint") for c in ("total", "balance")}
    return materialise(apps.withColumns(whole).select("app_id", *SCORED.names), "applications")


@query("train_score")
def train_score(spark, sf):
    """Metadata and quality of a model trained on the first 60 % of the days."""
    run = training.train(rows(spark, sf), SCORED, "event_time")
    return rounded(run.metadata)


@query("batch_score")
def batch_score(spark, sf):
    """Scores and decisions of all applications, each with its part."""
    run = training.train(rows(spark, sf), SCORED, "event_time")
    scored = models.score(run.model, run.table)
    return scored.select("app_id", "split", F.round(models.SCORE, 6).alias("prediction"), decide(F.col(models.SCORE)).alias("decision"))


@query("model_evaluation")
def model_evaluation(spark, sf):
    """AUC and approval rate on the test part."""
    run = training.train(rows(spark, sf), SCORED, "event_time")
    return rounded(training.evaluate(run.model, run.table))


@query("isotonic_calibration")
def isotonic_calibration(spark, sf):
    """Calibration report, on the fitted part and on the test part."""
    run = training.train(rows(spark, sf), SCORED, "event_time")
    _, fitted = training.calibrate(run.model, run.table)
    _, held_out = training.calibrate(run.model, run.table, report_on=splits.TEST)
    both = fitted.withColumn("reported_on", F.lit(splits.CALIBRATION)).unionByName(
        held_out.withColumn("reported_on", F.lit(splits.TEST))
    )
    return rounded(both)


DECLARED = models.Encoding(
    categorical=("priority", "status"), numeric=("qty", "total"),
    fills={"priority": "5-LOW", "status": "O", "qty": 100.0, "total": 150000.0},
    values={"priority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"], "status": ["F", "O"]},
    scales={"qty": Scale(100.0, 60.0), "total": Scale(150000.0, 80000.0)},
)
WEIGHTS, INTERCEPT = (0.5, -0.25, 0.125, -0.75, 0.6, -0.9, 0.35, -0.15), 0.2


DECLARED_SQL = f"""WITH {APP_CTES}, s AS (SELECT app_id, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(0.2::DOUBLE
  + CASE priority WHEN '1-URGENT' THEN 0.5::DOUBLE WHEN '2-HIGH' THEN -0.25::DOUBLE WHEN '3-MEDIUM' THEN 0.125::DOUBLE WHEN '5-LOW' THEN -0.75::DOUBLE ELSE 0.0::DOUBLE END
  + CASE status WHEN 'F' THEN 0.6::DOUBLE WHEN 'O' THEN -0.9::DOUBLE ELSE 0.0::DOUBLE END
  + 0.35::DOUBLE * ((coalesce(CAST(qty AS DOUBLE), 100.0::DOUBLE) - 100.0::DOUBLE) / 60.0::DOUBLE)
  - 0.15::DOUBLE * ((CAST(total AS DOUBLE) - 150000.0::DOUBLE) / 80000.0::DOUBLE)))) AS p FROM app)
SELECT app_id, round(p, 6) AS prediction, {DECISION_SQL.format(p='p')} AS decision FROM s"""


def declared_model():
    statement = models.score_statement(DECLARED, WEIGHTS, INTERCEPT, models.SCORE)
    return PipelineModel(stages=[SQLTransformer(statement=statement)])


@query("declared_score", DECLARED_SQL)
def declared_score(spark, sf):
    """Scores and decisions of all applications by declared weights, unknown categories and missing numbers included."""
    scored = models.score(declared_model(), views.applications(spark, sf))
    return scored.select("app_id", F.round(models.SCORE, 6).alias("prediction"), decide(F.col(models.SCORE)).alias("decision"))


def fit_ctes(table: str) -> str:
    """The fit on one category of two values, h and not h, with label y.

    The intercept is the sum of their weights a and b, which leaves two equations for Newton steps.
    """
    c = fixed.INVERSE_REGULARISATION
    return f"""
n AS (SELECT CAST(count(*) FILTER (WHERE h AND y) AS DOUBLE) AS h1, CAST(count(*) FILTER (WHERE h AND NOT y) AS DOUBLE) AS h0,
             CAST(count(*) FILTER (WHERE NOT h AND y) AS DOUBLE) AS l1, CAST(count(*) FILTER (WHERE NOT h AND NOT y) AS DOUBLE) AS l0 FROM {table}),
w AS (SELECT h1 + h0 AS nh, l1 + l0 AS nl, h1 * t / (2 * p) AS h1, h0 * t / (2 * q) AS h0, l1 * t / (2 * p) AS l1, l0 * t / (2 * q) AS l0
      FROM (SELECT *, h1 + h0 + l1 + l0 AS t, h1 + l1 AS p, h0 + l0 AS q FROM n)),
step(k, a, b) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT k + 1, a - (f * jbb - g * jab) / (jaa * jbb - jab * jba), b - (g * jaa - f * jba) / (jaa * jbb - jab * jba)
  FROM (SELECT k, a, b, a + {c} * ((h1 + h0) * ph - h1) AS f, b + {c} * ((l1 + l0) * pl - l1) AS g,
               1 + 2 * {c} * (h1 + h0) * ph * (1 - ph) AS jaa, {c} * (h1 + h0) * ph * (1 - ph) AS jab,
               {c} * (l1 + l0) * pl * (1 - pl) AS jba, 1 + 2 * {c} * (l1 + l0) * pl * (1 - pl) AS jbb
        FROM (SELECT *, 1 / (1 + exp(-(2 * a + b))) AS ph, 1 / (1 + exp(-(a + 2 * b))) AS pl FROM step, w WHERE k < 30)))
"""


FIT_SQL = f"""
WITH RECURSIVE {APP_CTES}, bands AS (SELECT total > 150000 AS h, target = 2 AS y FROM app), {fit_ctes("bands")}
SELECT 'high' AS band, CAST(nh AS BIGINT) AS n_rows, round(1 / (1 + exp(-(2 * a + b))), 6) AS prediction FROM step, w WHERE k = 30
UNION ALL SELECT 'low', CAST(nl AS BIGINT), round(1 / (1 + exp(-(a + 2 * b))), 6) FROM step, w WHERE k = 30
"""


@query("fitted_score", FIT_SQL)
def fitted_score(spark, sf):
    """Scores of a balanced model with a penalised intercept, fitted on all applications by the band of their total."""
    band = F.when(F.col("total") > 150000, "high").otherwise("low")
    apps = views.applications(spark, sf)
    table = materialise(apps.select(band.alias("band"), (F.col("target") - 1).alias("label")), "bands")
    scored = models.score(models.fit_model(table, ["band"], [], "label"), table)
    return scored.groupBy("band").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.max(models.SCORE), 6).alias("prediction"))


# One category of many values: the curvature is a diagonal with the intercept's row and column, so a Newton step is one pass.
CATEGORY_SQL = f"""
WITH RECURSIVE li AS (SELECT CAST(l_partkey AS VARCHAR) AS part, l_returnflag = 'R' AS y FROM lineitem),
n AS (SELECT CAST(count(*) AS DOUBLE) AS t, CAST(count(*) FILTER (WHERE y) AS DOUBLE) AS p FROM li),
cat AS (SELECT part, count(*) AS n_rows, count(*) FILTER (WHERE y) * t / (2 * p) AS pos, count(*) FILTER (WHERE NOT y) * t / (2 * (t - p)) AS neg FROM li, n GROUP BY part, t, p),
step(k, part, a, b) AS (
  SELECT 0, part, 0.0::DOUBLE, 0.0::DOUBLE FROM cat
  UNION ALL
  SELECT k + 1, part, a - (f + e * db) / d, b + db
  FROM (SELECT *, -(fb - sum(e * f / d) OVER ()) / (db0 - sum(e * e / d) OVER ()) AS db
        FROM (SELECT k, part, a, b, a + c * ((pos + neg) * s - pos) AS f, 1 + c * (pos + neg) * s * (1 - s) AS d, c * (pos + neg) * s * (1 - s) AS e,
                     b + sum(c * ((pos + neg) * s - pos)) OVER () AS fb, 1 + sum(c * (pos + neg) * s * (1 - s)) OVER () AS db0
              FROM (SELECT step.*, pos, neg, {fixed.INVERSE_REGULARISATION}::DOUBLE AS c, 1 / (1 + exp(-(a + b))) AS s FROM step JOIN cat USING (part) WHERE k < 20))))
SELECT part, n_rows, round(1 / (1 + exp(-(a + b))), 4) AS prediction FROM step JOIN cat USING (part) WHERE k = 20
"""


@query("category_scores", CATEGORY_SQL)
def category_scores(spark, sf):
    """A balanced model with a weight for each part, fitted and scored without a column or literal per part."""
    lines = views.table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("part"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    # Lines of one part score alike, so each part is scored once.
    parts = lines.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))
    scored = fit_table_model(lines, ["part"], [], "label").score(parts)
    return scored.select("part", "n_rows", r6(models.SCORE, 4).alias("prediction"))


# Greatest lower, least upper mean over all intervals round a score: the increasing fit, written out.
ISOTONIC_SQL = """
WITH l AS (SELECT floor(l_extendedprice / 10.0::DOUBLE) AS s, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS y FROM lineitem),
p AS (SELECT s, CAST(sum(y) AS DOUBLE) AS sy, CAST(count(*) AS DOUBLE) AS w FROM l GROUP BY s),
o AS (SELECT *, row_number() OVER (ORDER BY s) AS i, sum(sy) OVER (ORDER BY s) AS cs, sum(w) OVER (ORDER BY s) AS cw FROM p),
iv AS (SELECT a.i AS a, b.i AS b, (b.cs - a.cs + a.sy) / (b.cw - a.cw + a.w) AS m FROM o a JOIN o b ON b.i >= a.i),
lower AS (SELECT a, b AS i, min(m) OVER (PARTITION BY a ORDER BY b DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM iv),
fit AS (SELECT i, max(v) AS g FROM lower GROUP BY i)
SELECT s AS score, CAST(w AS BIGINT) AS n_rows, round(g, 6) AS calibrated FROM fit JOIN o USING (i)
"""


@query("isotonic_scores", ISOTONIC_SQL)
def isotonic_scores(spark, sf):
    """Calibrated value of every price band of the order lines, fitted on all of them; nothing goes through the driver."""
    lines = views.table(spark, sf, "lineitem").select(
        F.floor(F.col("l_extendedprice") / 10.0).cast("double").alias("score"), (F.col("l_quantity") > 25).cast("int").alias("y"),
    )
    per_score = lines.groupBy("score").agg(F.count(F.lit(1)).alias("n_rows"))
    return rounded(apply_steps(per_score, "score", isotonic_steps(lines, "score", "y"), "calibrated"))


@query("noise_robustness")
def noise_robustness(spark, sf):
    """Metrics of a clean and a noisily trained model on clean labels."""
    return noise.noise_robustness(rows(spark, sf), SCORED, "event_time", "app_id").comparison
