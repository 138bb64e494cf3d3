"""Whole runs and what they keep: training, evaluation, calibration, saved models and statistics, request ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import request_id
from ..operators import feature_stats, model as models
from ..operators.contract import Contract, Field
from ..functions.decisions import decide
from ..plans import training
from ..session import fresh_path, materialise
from ..sources.models import load_active_model, save_model
from ..sources.reports import read_training_stats, write_report
from . import views
from .contract_queries import APPLICATION
from .metric_queries import FIT_CTE, auc_sql, gap_sql
from .model_queries import DECLARED_SQL, declared_model, fit_ctes
from .registry import query, rounded
from .split_queries import CUTS
from .stats_queries import STATS_COLUMNS, _stats_sql
from .views import APP_CTES, CATEGORICAL, NUMERIC

#: A contract of one category with two values, so that SQL can follow the fit.
BANDS = Contract(
    "bands", (Field("event_time", "timestamp"), Field("band", "categorical", ("high", "low")), Field("target", "target", ("1", "2"))), "target",
)
RUN = f"""{APP_CTES}, {CUTS},
banded AS (SELECT split, total > 150000 AS h, target = 2 AS y FROM split), part AS (SELECT * FROM banded WHERE split = 'train'), {fit_ctes("part")},
scored AS (SELECT split, CAST(y AS INTEGER) AS y, CASE WHEN h THEN 1 / (1 + exp(-(2 * a + b))) ELSE 1 / (1 + exp(-(a + 2 * b))) END AS p FROM banded, step WHERE k = 30)
"""


def quality_sql(split: str) -> str:
    return f"""part_scored AS (SELECT * FROM scored WHERE split = '{split}'),
quality AS (SELECT round(auc, 6) AS roc_auc, (SELECT round(avg(CASE WHEN p < 0.3 THEN 1.0::DOUBLE ELSE 0 END), 6) FROM part_scored) AS approval_rate,
            0.3::DOUBLE AS decision_threshold FROM {auc_sql("part_scored", "p", "y")})"""


def trained(spark, sf):
    band = F.when(F.col("total") > 150000, "high").otherwise("low").alias("band")
    apps = views.applications(spark, sf).select("app_id", "event_time", band, "target")
    return training.train(materialise(apps, "bands"), BANDS, "event_time")


@query(
    "train_run",
    f"""WITH RECURSIVE {RUN}, {quality_sql("train")}
SELECT 'v1' AS model_version, (SELECT count(*) FROM app) AS n_rows, 3 AS columns, decision_threshold, roc_auc, approval_rate FROM quality""",
)
def train_run(spark, sf):
    """Metadata of a model trained on the first days, and its quality there."""
    return rounded(trained(spark, sf).metadata.drop("data_hash")).withColumnRenamed("rows", "n_rows")


@query("evaluate_run", f"WITH RECURSIVE {RUN}, {quality_sql('test')} SELECT * FROM quality")
def evaluate_run(spark, sf):
    """The trained model on the last days."""
    run = trained(spark, sf)
    return rounded(training.evaluate(run.model, run.table))


@query(
    "calibrate_run",
    f"""WITH RECURSIVE {RUN}, bin AS (SELECT p, y FROM scored WHERE split = 'calibration'), {FIT_CTE}
SELECT 'isotonic_regression' AS method, count(*) AS calibration_size, round(avg((p - y) ** 2), 8) AS brier_score_before,
round(avg((g - y) ** 2), 8) AS brier_score_after, (SELECT round(gap, 8) FROM {gap_sql('cal', 'g', 'y')}) AS calibration_gap_after FROM cal""",
)
def calibrate_run(spark, sf):
    """The trained model calibrated on the days in between, and the report of it."""
    run = trained(spark, sf)
    return rounded(training.calibrate(run.model, run.table)[1], 8)


@query("active_model_score", DECLARED_SQL)
def active_model_score(spark, sf):
    """Models saved under a registry of versions; the active one is found, loaded and applied."""
    root = fresh_path(spark, "models")
    registry = spark.createDataFrame(
        [(1, "approved/m1", True), (2, "approved/m2", True), (3, "candidate/m3", False)], "seq bigint, artifact string, approved boolean",
    )
    registry.write.parquet(f"{root}/registry")
    save_model(declared_model(), f"{root}/approved/m2")
    scored = models.score(load_active_model(spark, f"{root}/registry", root), views.applications(spark, sf))
    return scored.select("app_id", F.round(models.SCORE, 6).alias("prediction"), decide(F.col(models.SCORE)).alias("decision"))


@query("training_stats_file", f"WITH {APP_CTES}, s AS ({_stats_sql('app', NUMERIC, CATEGORICAL)}) SELECT {STATS_COLUMNS} FROM s")
def training_stats_file(spark, sf):
    """Statistics written as a report at training time and read back for serving."""
    path = fresh_path(spark, "training-stats")
    write_report(feature_stats.feature_stats(views.applications(spark, sf), [*NUMERIC, *CATEGORICAL], NUMERIC), path)
    return rounded(read_training_stats(spark, path), 4).withColumnRenamed("rows", "n_rows")


ROLES = {"event_time": "time", "priority": "categorical", "status": "categorical", "qty": "numeric", "total": "numeric", "target": "target"}


@query(
    "column_roles",
    f"WITH {APP_CTES} " + " UNION ALL ".join(f"SELECT '{c}' AS field, '{role}' AS role, count({c}) AS n_values FROM app" for c, role in ROLES.items()),
)
def column_roles(spark, sf):
    """Every declared column with the role the contract gives it, and how many applications have a value."""
    roles = {f: "time" for f in APPLICATION.of_kind("timestamp")} | {f: "categorical" for f in APPLICATION.categorical}
    roles |= {f: "numeric" for f in APPLICATION.numeric} | {APPLICATION.target: "target"}
    counts = views.applications(spark, sf).agg(*(F.count(c).alias(c) for c in roles))
    return counts.select(F.inline(F.array(*(
        F.struct(F.lit(c).alias("field"), F.lit(role).alias("role"), F.col(c).alias("n_values")) for c, role in roles.items()
    ))))


@query("request_ids", "SELECT count(*) AS n_requests, count(*) AS n_ids, count(*) AS n_well_formed FROM events")
def request_ids(spark, sf):
    """Every request gets an id of its own."""
    named = materialise(views.events(spark, sf).select(request_id().alias("request_id")), "request-ids")
    form = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    well_formed = F.count_if(F.col("request_id").rlike(form)).alias("n")
    each = named.groupBy("request_id").agg(F.count(F.lit(1)).alias("rows"), well_formed)
    return each.agg(F.sum("rows").alias("n_requests"), F.count(F.lit(1)).alias("n_ids"), F.sum("n").alias("n_well_formed"))
