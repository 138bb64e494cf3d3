"""Derived tables the queries run on, in Spark and as SQL.

applications: one row per order, with its customer and its lines.
prediction log: one row per event.
scored labels: one row per order line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.decisions import decide
from ..functions.text import canonical_json, input_hash
from ..session import materialise


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def applications(spark: SparkSession, sf: str, lines: bool = True, customer: bool = True) -> DataFrame:
    """Only the joins asked for are planned; lines are summed per order before the join."""
    orders = table(spark, sf, "orders")
    out = orders.select(
        F.col("o_orderkey").alias("app_id"),
        F.col("o_orderdate").cast("date").alias("event_time"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_custkey").alias("customer_id"),
    )
    if lines:
        sums = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("app_id")).agg(
            F.count(F.lit(1)).alias("n_lines"),
            F.sum("l_quantity").cast("bigint").alias("qty"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        )
        returned = F.col("n_lines").isNotNull() & (2 * F.col("n_returned") >= F.col("n_lines"))
        out = (
            out.join(sums, "app_id", "left")
            .withColumn("n_items", F.coalesce("n_lines", F.lit(0)))
            .withColumn("target", F.when(returned, 2).otherwise(1))
            .drop("n_lines", "n_returned")
        )
    if customer:
        people = table(spark, sf, "customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"),
            F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
        )
        out = out.join(people, "customer_id")
    return out


APP_CTES = """
li AS (SELECT l_orderkey, count(*) AS n_lines, CAST(sum(l_quantity) AS BIGINT) AS qty,
              count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned FROM lineitem GROUP BY l_orderkey),
app AS (SELECT o_orderkey AS app_id, CAST(o_orderdate AS DATE) AS event_time, o_orderpriority AS priority,
               o_orderstatus AS status, o_totalprice AS total, o_custkey AS customer_id,
               coalesce(n_lines, 0) AS n_items, qty,
               CASE WHEN n_lines IS NOT NULL AND 2 * n_returned >= n_lines THEN 2 ELSE 1 END AS target,
               c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS balance
        FROM orders LEFT JOIN li ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey)
"""

NUMERIC = ("n_items", "qty", "total", "balance")
CATEGORICAL = ("segment", "priority", "status")
DRIFT_SPLIT = "1998-01-01"
EVENT_SPLIT = "2024-01-16"


def app_sides(spark: SparkSession, sf: str, lines: bool = True, customer: bool = True) -> tuple[DataFrame, DataFrame]:
    """Applications before, and from, a fixed day.

    Edges, frequencies and ranks read the sides several times, so the joins are
    done once and their result is written to the shared folder.
    """
    apps = materialise(applications(spark, sf, lines, customer), "applications")
    day = F.to_date(F.lit(DRIFT_SPLIT))
    return apps.where(F.col("event_time") < day), apps.where(F.col("event_time") >= day)


APP_SIDES = APP_CTES + f""",
ref AS (SELECT * FROM app WHERE event_time < DATE '{DRIFT_SPLIT}'),
cur AS (SELECT * FROM app WHERE event_time >= DATE '{DRIFT_SPLIT}')
"""


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


def event_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Events before, and from, a fixed time; the filter reaches the scan."""
    split = F.lit(EVENT_SPLIT).cast("timestamp_ntz")
    rows = events(spark, sf)
    return rows.where(F.col("ts") < split), rows.where(F.col("ts") >= split)


EVENT_SIDES = f"""
ref AS (SELECT * FROM events WHERE ts < TIMESTAMP '{EVENT_SPLIT} 00:00:00'),
cur AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{EVENT_SPLIT} 00:00:00')
"""


def prediction_log(spark: SparkSession, sf: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    canonical = canonical_json({"event_type": F.col("event_type"), "k": k}, {"event_type": True})
    score = F.col("value") / (F.col("value") + 50.0)
    return events(spark, sf).select(
        F.col("event_id").alias("request_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("client_id"),
        score.alias("prediction"),
        decide(score).alias("decision"),
        F.col("value").alias("latency_ms"),
        F.lit("v1").alias("model_version"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("outcome"),
        input_hash(canonical).alias("input_hash"),
        k.alias("k"),
    )


DECISION_SQL = "CASE WHEN {p} < 0.3 THEN 'approve' WHEN {p} <= 0.7 THEN 'review' ELSE 'reject' END"

LOG_CTE = """
log AS (SELECT event_id AS request_id, ts AS "timestamp", user_id AS client_id, value / (value + 50.0::DOUBLE) AS prediction,
               CASE WHEN value / (value + 50.0::DOUBLE) < 0.3 THEN 'approve'
                    WHEN value / (value + 50.0::DOUBLE) <= 0.7 THEN 'review' ELSE 'reject' END AS decision,
               value AS latency_ms, 'v1' AS model_version,
               CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS outcome,
               CAST(regexp_extract(props, '-?[0-9]+') AS BIGINT) AS k,
               sha256('{"event_type": "' || event_type || '", "k": ' || regexp_extract(props, '-?[0-9]+') || '}') AS input_hash
        FROM events)
"""


def scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Score from the discount, a second one from the tax, label from the return flag."""
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        (F.col("l_discount") * 10.0).alias("p"),
        (F.col("l_tax") * 12.5).alias("p2"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.date_trunc("month", "l_shipdate").cast("date").alias("month"),
    )


BIN_CTE = """
bin AS (SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_discount * 10.0::DOUBLE AS p, l_tax * 12.5::DOUBLE AS p2,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, CAST(date_trunc('month', l_shipdate) AS DATE) AS month
        FROM lineitem)
"""


def app_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Applications as rows of space-separated tokens."""
    a = applications(spark, sf)
    return a.select(
        "app_id",
        F.concat_ws(
            " ",
            F.date_format("event_time", "yyyy-MM-dd"), "priority", "status",
            F.coalesce(F.col("qty").cast("string"), F.lit("NA")),
            F.floor("total").cast("string"), F.col("target").cast("string"),
        ).alias("value"),
    )


LINES_CTE = """
lines AS (SELECT app_id, strftime(event_time, '%Y-%m-%d') || ' ' || priority || ' ' || status || ' ' ||
                 coalesce(CAST(qty AS VARCHAR), 'NA') || ' ' || CAST(CAST(floor(total) AS BIGINT) AS VARCHAR) || ' ' ||
                 CAST(target AS VARCHAR) AS value FROM app)
"""
