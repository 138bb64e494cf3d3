"""Feature statistics, the serving check, and preprocessing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import feature_stats, features
from ..session import materialise
from . import views
from .registry import query, r6, rounded
from .views import APP_CTES, APP_SIDES, CATEGORICAL, LOG_CTE, NUMERIC


def _stats_sql(table: str, numeric, categorical) -> str:
    parts = [
        f"""SELECT count(*) AS n_rows, '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS mean, stddev_samp(CAST({c} AS DOUBLE)) AS std,
        avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END) AS missing_pct, CAST(min({c}) AS DOUBLE) AS min_num, CAST(max({c}) AS DOUBLE) AS max_num,
        CAST(NULL AS VARCHAR) AS min_str, CAST(NULL AS VARCHAR) AS max_str FROM {table}"""
        for c in numeric
    ] + [
        f"""SELECT count(*), '{c}', NULL, NULL, avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END), NULL, NULL,
        CAST(min({c}) AS VARCHAR), CAST(max({c}) AS VARCHAR) FROM {table}"""
        for c in categorical
    ]
    return " UNION ALL ".join(parts)


STATS_COLUMNS = """n_rows, feature, round(mean, 4) AS mean, round(std, 4) AS std, round(missing_pct, 4) AS missing_pct,
round(min_num, 4) AS min_num, round(max_num, 4) AS max_num, min_str, max_str"""


@query("feature_stats", f"WITH {APP_CTES}, s AS ({_stats_sql('app', NUMERIC, CATEGORICAL)}) SELECT {STATS_COLUMNS} FROM s")
def feature_stats_query(spark, sf):
    apps = views.applications(spark, sf)
    stats = feature_stats.feature_stats(apps, [*NUMERIC, *CATEGORICAL], NUMERIC)
    return rounded(stats, 4).withColumnRenamed("rows", "n_rows")


LOG_NUMERIC = ("client_id", "prediction", "latency_ms", "k")
LOG_TEXT = ("decision", "outcome", "model_version")


@query(
    "feature_stats_by_type",
    f"WITH {LOG_CTE}, s AS ({_stats_sql('log', LOG_NUMERIC, LOG_TEXT)}) SELECT {STATS_COLUMNS} FROM s",
)
def feature_stats_by_type(spark, sf):
    log = views.prediction_log(spark, sf)
    stats = feature_stats.feature_stats(log, [*LOG_NUMERIC, *LOG_TEXT])
    return rounded(stats, 4).withColumnRenamed("rows", "n_rows")


# The serving side is shifted, loses a column and has more missing values.
SERVED = ("n_items", "qty", "total", "segment", "priority")
SERVED_SQL = """
served AS (SELECT n_items, CASE WHEN status = 'F' THEN qty END AS qty, total * 1.5::DOUBLE AS total,
                  CASE WHEN status <> 'P' THEN segment END AS segment, priority FROM cur)
"""


def _served(cur):
    return cur.select(
        "n_items",
        F.when(F.col("status") == "F", F.col("qty")).alias("qty"),
        (F.col("total") * 1.5).alias("total"),
        F.when(F.col("status") != "P", F.col("segment")).alias("segment"),
        "priority",
    )


CHECK = f"""
WITH {APP_SIDES}, {SERVED_SQL},
t AS ({_stats_sql('ref', NUMERIC, CATEGORICAL)}),
i AS ({_stats_sql('served', ('n_items', 'qty', 'total'), ('segment', 'priority'))}),
j AS (SELECT t.feature, t.mean AS train_mean, i.mean AS inference_mean, t.missing_pct AS train_missing_pct, i.missing_pct AS inference_missing_pct,
             i.feature IS NOT NULL AS seen, t.mean IS NULL OR i.mean IS NULL AS blank,
             abs(i.mean - t.mean) / CASE WHEN t.std = 0 THEN 1 ELSE t.std END AS stds,
             abs(i.mean - t.mean) / CASE WHEN t.mean = 0 THEN 1 ELSE abs(t.mean) END AS rel
      FROM t LEFT JOIN i ON i.feature = t.feature),
f AS (SELECT feature, CASE WHEN NOT seen THEN 'missing_feature' WHEN blank AND abs(train_missing_pct - inference_missing_pct) > 0.2 THEN 'missing_pct_change'
                  WHEN NOT blank AND (stds > 3.0 OR rel > 0.3) THEN 'mean_shift' END AS reason,
             train_mean, inference_mean, CASE WHEN NOT blank THEN stds END AS stds, CASE WHEN NOT blank THEN rel END AS rel,
             train_missing_pct, inference_missing_pct FROM j)
"""


def _failures(spark, sf):
    ref, cur = views.app_sides(spark, sf)
    training = feature_stats.feature_stats(ref, [*NUMERIC, *CATEGORICAL], NUMERIC)
    return feature_stats.feature_check(training, _served(cur), SERVED)


@query(
    "feature_check",
    f"""{CHECK} SELECT feature, reason, round(train_mean, 4) AS train_mean, round(inference_mean, 4) AS inference_mean, round(stds, 4) AS stds,
round(rel, 4) AS rel, round(train_missing_pct, 4) AS train_missing_pct, round(inference_missing_pct, 4) AS inference_missing_pct
FROM f WHERE reason IS NOT NULL""",
)
def feature_check(spark, sf):
    return rounded(_failures(spark, sf), 4)


@query(
    "feature_check_messages",
    f"""{CHECK} SELECT feature, reason, CASE WHEN reason = 'mean_shift'
THEN 'FEATURE_MISMATCH: ' || feature || ' mean deviation ' || CAST(CAST(round(rel * 100) AS BIGINT) AS VARCHAR) || '% REQUEST_REJECTED'
ELSE 'FEATURE_MISMATCH: ' || feature || ' missing in inference batch REQUEST_REJECTED' END AS message
FROM f WHERE reason IN ('mean_shift', 'missing_feature')""",
)
def feature_check_messages(spark, sf):
    return feature_stats.failure_messages(_failures(spark, sf))


# ---- preprocessing -----------------------------------------------------------

GAPS_SQL = """
gaps AS (SELECT app_id, CASE WHEN priority <> '1-URGENT' THEN priority END AS priority,
                CASE WHEN segment <> 'BUILDING' THEN segment END AS segment, qty, total, balance FROM app)
"""


def _gaps(spark, sf):
    apps = views.applications(spark, sf)
    return apps.select(
        "app_id",
        F.when(F.col("priority") != "1-URGENT", F.col("priority")).alias("priority"),
        F.when(F.col("segment") != "BUILDING", F.col("segment")).alias("segment"),
        "qty", "total", "balance",
    )


@query(
    "impute_mode",
    f"""WITH {APP_CTES}, {GAPS_SQL},
v AS (SELECT 'priority' AS feature, priority AS value, count(*) AS n FROM gaps WHERE priority IS NOT NULL GROUP BY priority
      UNION ALL SELECT 'segment', segment, count(*) FROM gaps WHERE segment IS NOT NULL GROUP BY segment),
b AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS rn FROM v)
SELECT app_id, coalesce(priority, (SELECT value FROM b WHERE feature = 'priority' AND rn = 1)) AS priority,
       coalesce(segment, (SELECT value FROM b WHERE feature = 'segment' AND rn = 1)) AS segment FROM gaps""",
)
def impute_mode(spark, sf):
    gaps = materialise(_gaps(spark, sf), "gaps")
    fills = {r["feature"]: r["fill"] for r in features.modes(gaps, ["priority", "segment"]).collect()}
    return features.impute(gaps, fills).select("app_id", "priority", "segment")


@query(
    "impute_median",
    f"""WITH {APP_CTES}, m AS (SELECT quantile_cont(CAST(qty AS DOUBLE), 0.5) AS med FROM app)
SELECT app_id, coalesce(CAST(qty AS DOUBLE), med) AS qty FROM app, m""",
)
def impute_median(spark, sf):
    apps = materialise(views.applications(spark, sf, customer=False).select("app_id", "qty"), "gaps")
    return features.impute(apps, features.medians(apps, ["qty"])).select("app_id", "qty")


@query(
    "standard_scale",
    f"""WITH {APP_CTES}, m AS (SELECT avg(total) AS mt, stddev_pop(total) AS st, avg(balance) AS mb, stddev_pop(balance) AS sb,
        1.0::DOUBLE AS mc FROM app)
SELECT app_id, round((total - mt) / st, 6) + 0.0 AS total, round((balance - mb) / sb, 6) + 0.0 AS balance, 0.0::DOUBLE AS constant FROM app, m""",
)
def standard_scale(spark, sf):
    apps = materialise(views.applications(spark, sf, lines=False).select("app_id", "total", "balance"), "scale")
    apps = apps.withColumn("constant", F.lit(7.0))
    scales = features.fit_scales(apps, ["total", "balance", "constant"])
    return apps.select("app_id", *[r6(s.apply(F.col(c))).alias(c) for c, s in scales.items()])


@query(
    "one_hot",
    f"""WITH {APP_CTES}, {GAPS_SQL}
SELECT app_id, {', '.join(f"CAST(coalesce(priority = '{v}', false) AS INTEGER) AS \"priority={v}\"" for v in ('2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'))} FROM gaps""",
)
def one_hot(spark, sf):
    gaps = materialise(_gaps(spark, sf).select("app_id", "priority"), "gaps")
    known = features.categories(gaps, ["priority"])["priority"]
    return gaps.select("app_id", *features.one_hot_columns("priority", known))
