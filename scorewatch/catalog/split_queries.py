"""Splits in time."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import splits
from . import views
from .registry import query, rounded
from .views import APP_CTES

CUTS = """
days AS (SELECT DISTINCT event_time AS day FROM app),
num AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS pos, count(*) OVER () AS n FROM days),
pos AS (SELECT max(n) AS n, greatest(1, least(CAST(floor(max(n) * 0.6::DOUBLE) AS BIGINT), max(n) - 2)) AS p1,
               CAST(floor(max(n) * 0.6::DOUBLE) AS BIGINT) AS p0, CAST(floor(max(n) * 0.8::DOUBLE) AS BIGINT) AS q FROM num),
cuts AS (SELECT n, (SELECT day FROM num WHERE num.pos = p1) AS t1,
                (SELECT day FROM num WHERE num.pos = greatest(p1 + 1, least(q, n - 1))) AS t2,
                (SELECT day FROM num WHERE num.pos = p0) AS t0 FROM pos),
split AS (SELECT app.*, CASE WHEN event_time < t1 THEN 'train' WHEN event_time < t2 THEN 'calibration' ELSE 'test' END AS split FROM app, cuts)
"""


@query("temporal_cutoffs", f"WITH {APP_CTES}, {CUTS} SELECT n AS days, t1, t2 FROM cuts")
def temporal_cutoffs(spark, sf):
    return splits.cutoff_table(views.applications(spark, sf, False, False), "event_time")


@query("temporal_split", f"WITH {APP_CTES}, {CUTS} SELECT app_id, event_time, split FROM split")
def temporal_split(spark, sf):
    apps = views.applications(spark, sf, False, False)
    return splits.with_split(apps, "event_time").select("app_id", "event_time", "split")


@query(
    "temporal_split_two_way",
    f"WITH {APP_CTES}, {CUTS} SELECT app_id, CASE WHEN event_time < t0 THEN 'train' ELSE 'test' END AS split FROM app, cuts",
)
def temporal_split_two_way(spark, sf):
    apps = views.applications(spark, sf, False, False)
    return splits.with_split(apps, "event_time", two_way=True).select("app_id", "split")


@query(
    "split_report",
    f"""WITH {APP_CTES}, {CUTS} SELECT split, min(event_time) AS "start", max(event_time) AS "end", count(*) AS n_rows FROM split GROUP BY split""",
)
def split_report(spark, sf):
    apps = splits.with_split(views.applications(spark, sf, False, False), "event_time")
    return splits.split_report(apps, "event_time").withColumnRenamed("rows", "n_rows")


@query(
    "leakage_check",
    f"""WITH {APP_CTES}, {CUTS},
b AS (SELECT min(event_time) FILTER (WHERE split = 'train') AS train_min, min(event_time) FILTER (WHERE split = 'calibration') AS calibration_min,
             min(event_time) FILTER (WHERE split = 'test') AS test_min, max(event_time) FILTER (WHERE split = 'train') AS train_max,
             max(event_time) FILTER (WHERE split = 'calibration') AS calibration_max, max(event_time) FILTER (WHERE split = 'test') AS test_max FROM split)
SELECT *, CASE WHEN train_max < calibration_min AND calibration_max < test_min THEN 'passed' ELSE 'failed' END AS status FROM b""",
)
def leakage_check(spark, sf):
    apps = splits.with_split(views.applications(spark, sf, False, False), "event_time")
    return splits.leakage_check(apps, "event_time")


@query(
    "split_semi_join",
    f"WITH {APP_CTES}, {CUTS} SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT app_id FROM split WHERE split = 'test')",
)
def split_semi_join(spark, sf):
    apps = splits.with_split(views.applications(spark, sf, False, False), "event_time")
    keys = apps.where(F.col("split") == splits.TEST).select(F.col("app_id").alias("l_orderkey"))
    return splits.select_split(views.table(spark, sf, "lineitem"), keys, "l_orderkey").select("l_orderkey", "l_linenumber")


def _stat(f: str, where: str) -> str:
    return f"{f} FILTER (WHERE split = '{where}')"


def _shift(c: str) -> str:
    return f"""SELECT '{c}' AS feature, {_stat(f'avg({c})', 'train')} AS a, {_stat(f'stddev_samp({c})', 'train')} AS sa,
      {_stat(f'avg({c})', 'test')} AS b, {_stat(f'stddev_samp({c})', 'test')} AS sb FROM split"""


@query(
    "split_stats",
    f"""WITH {APP_CTES}, {CUTS}, s AS ({' UNION ALL '.join(_shift(c) for c in views.NUMERIC)})
SELECT feature, round(a, 4) AS train_mean, round(sa, 4) AS train_std, round(b, 4) AS test_mean, round(sb, 4) AS test_std,
       round(CASE WHEN sa > 0 AND sb > 0 THEN abs(b - a) / (sa + 1e-8::DOUBLE) * 100 ELSE 0 END, 4) AS shift_pct FROM s""",
)
def split_stats(spark, sf):
    apps = splits.with_split(views.applications(spark, sf), "event_time")
    return rounded(splits.split_statistics(apps, views.NUMERIC), 4)


@query(
    "split_target_rates",
    f"""WITH {APP_CTES}, {CUTS},
r AS (SELECT count(*) AS n, count(*) FILTER (WHERE split = 'train') AS a, count(*) FILTER (WHERE split = 'test') AS b,
             avg(target - 1) FILTER (WHERE split = 'train') AS ra, avg(target - 1) FILTER (WHERE split = 'test') AS rb FROM split)
SELECT a AS train_rows, b AS test_rows, round(a * 100.0::DOUBLE / n, 6) AS train_pct, round(b * 100.0::DOUBLE / n, 6) AS test_pct,
       round(ra, 6) AS train_rate, round(rb, 6) AS test_rate, abs(ra - rb) > 0.05 AS target_shift FROM r""",
)
def split_target_rates(spark, sf):
    apps = splits.with_split(views.applications(spark, sf, customer=False), "event_time")
    return rounded(splits.split_target_rates(apps.withColumn("bad", F.col("target") - 1), "bad"))


@query(
    "infer_split_type",
    """SELECT 'events' AS source, CASE WHEN bool_and(up) OR bool_and(down) THEN 'temporal' ELSE 'random' END AS split_type FROM (
  SELECT coalesce(lag(ts) OVER (ORDER BY event_id) <= ts, true) AS up, coalesce(lag(ts) OVER (ORDER BY event_id) >= ts, true) AS down FROM events)
UNION ALL SELECT 'orders', CASE WHEN bool_and(up) OR bool_and(down) THEN 'temporal' ELSE 'random' END FROM (
  SELECT coalesce(lag(o_orderdate) OVER (ORDER BY o_orderkey) <= o_orderdate, true) AS up,
         coalesce(lag(o_orderdate) OVER (ORDER BY o_orderkey) >= o_orderdate, true) AS down FROM orders)
UNION ALL SELECT 'absent', 'unknown'""",
)
def infer_split_type(spark, sf):
    events, orders = views.events(spark, sf), views.table(spark, sf, "orders")
    cases = [("events", events, "ts", "event_id"), ("orders", orders, "o_orderdate", "o_orderkey"), ("absent", orders, "no_such_column", "o_orderkey")]
    out = None
    for name, df, column, key in cases:
        one = splits.infer_split_type(df, column, key).select(F.lit(name).alias("source"), "split_type")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "missing_days",
    """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
b AS (SELECT min(day) AS a, max(day) AS z FROM d)
SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM b EXCEPT SELECT day FROM d""",
)
def missing_days(spark, sf):
    return splits.missing_days(views.table(spark, sf, "orders"), "o_orderdate")


@query(
    "temporal_manifest",
    """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders),
l AS (SELECT day, max(day) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM o)
SELECT count(*) AS n_rows, CAST(date_diff('day', min(day), max(day)) + 1 AS BIGINT) AS calendar_days, count(DISTINCT day) AS days_present,
       CAST(date_diff('day', min(day), max(day)) + 1 - count(DISTINCT day) AS BIGINT) AS missing_days,
       count(*) FILTER (WHERE day < seen) AS late_rows, min(day) AS first_day, max(day) AS last_day FROM l""",
)
def temporal_manifest(spark, sf):
    return splits.temporal_manifest(views.table(spark, sf, "orders"), "o_orderdate", "o_orderkey").withColumnRenamed("rows", "n_rows")


@query(
    "date_coercion",
    """SELECT doc_id, TRY_CAST(CASE WHEN lang = 'en' THEN '2024-01-' || CAST(10 + n_chars % 30 AS VARCHAR) ELSE source END AS DATE) AS day
FROM documents WHERE TRY_CAST(CASE WHEN lang = 'en' THEN '2024-01-' || CAST(10 + n_chars % 30 AS VARCHAR) ELSE source END AS DATE) IS NOT NULL""",
)
def date_coercion(spark, sf):
    """Days made of text, many of them impossible; unreadable ones are dropped."""
    text = F.when(F.col("lang") == "en", F.concat(F.lit("2024-01-"), (10 + F.col("n_chars") % 30).cast("string"))).otherwise(F.col("source"))
    docs = views.table(spark, sf, "documents").select("doc_id", text.alias("day_text"))
    return docs.select("doc_id", splits.coerced_date("day_text").alias("day")).where(F.col("day").isNotNull())
