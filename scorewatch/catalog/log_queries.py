"""Prediction logs, hashes, counters, money."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F, types as T

from ..functions.text import canonical_json, input_hash
from ..operators import feature_stats, log_analytics, model as models
from ..operators.contract import Contract, Field
from ..operators.features import Scale
from ..sources.fingerprint import row_hashes
from ..sources.logs import parse_log_lines
from ..streaming.requests import Chain, settle_table
from . import views
from .registry import query, rounded
from .views import LOG_CTE

PROPS = T.StructType([T.StructField("k", T.LongType())])
K_SQL = "CAST(regexp_extract(props, '-?[0-9]+') AS BIGINT)"


@query(
    "log_scan",
    """SELECT event_id AS request_id, round(value / (value + 50.0::DOUBLE), 6) AS prediction, 'v1' AS model_version
FROM events WHERE event_type <> 'error'""",
)
def log_scan(spark, sf):
    """Log lines as JSON text, those of errors cut short; only whole records come back."""
    line = F.to_json(F.struct(
        F.lit("v1").alias("model_version"),
        F.round(F.col("value") / (F.col("value") + 50.0), 6).alias("prediction"),
        F.col("event_id").cast("string").alias("request_id"),
    ))
    cut = F.substring(line, 1, 20)
    lines = views.events(spark, sf).select(F.when(F.col("event_type") == "error", cut).otherwise(line).alias("value"))
    return parse_log_lines(lines).select(F.col("request_id").cast("bigint").alias("request_id"), "prediction", "model_version")


@query("props_json_scan", f"SELECT event_id, {K_SQL} AS k FROM events")
def props_json_scan(spark, sf):
    return views.events(spark, sf).select(
        "event_id", F.from_json("props", PROPS, {"mode": "FAILFAST"})["k"].alias("k")
    )


@query(
    "prediction_log",
    f"""WITH {LOG_CTE} SELECT CAST(client_id AS VARCHAR) AS client_id, decision, 2 AS features_count, input_hash,
round(latency_ms, 2) AS latency_ms, model_version, round(prediction, 6) AS prediction, CAST(request_id AS VARCHAR) AS request_id,
strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp" FROM log""",
)
def prediction_log(spark, sf):
    log = views.prediction_log(spark, sf)
    return log_analytics.log_entries(
        log, "request_id", "timestamp", F.col("input_hash"), "prediction", "decision", "latency_ms", "client_id", 2
    )


@query(
    "input_hash",
    f"""SELECT event_id, sha256('{{"event_type": "' || event_type || '", "k": ' || CAST({K_SQL} AS VARCHAR) || ', "user_id": ' || CAST(user_id AS VARCHAR) || '}}') AS input_hash FROM events""",
)
def input_hash_query(spark, sf):
    k = F.from_json("props", PROPS)["k"]
    text = canonical_json(
        {"user_id": F.col("user_id"), "event_type": F.col("event_type"), "k": k}, {"event_type": True}
    )
    return views.events(spark, sf).select("event_id", input_hash(text).alias("input_hash"))


@query("content_hash", "SELECT doc_id, sha256(text) AS data_hash FROM documents")
def content_hash(spark, sf):
    return row_hashes(views.table(spark, sf, "documents"), "doc_id", "text")


@query(
    "log_analytics",
    f"""WITH {LOG_CTE} SELECT count(*) AS total_requests, count(DISTINCT input_hash) AS unique_inputs, 'v1' AS model_versions,
(SELECT string_agg(decision || '=' || n, ',' ORDER BY decision) FROM (SELECT decision, count(*) AS n FROM log GROUP BY decision)) AS decisions,
round(avg(prediction), 6) AS prediction_mean, round(stddev_samp(prediction), 6) AS prediction_std,
round(min(prediction), 6) AS prediction_min, round(max(prediction), 6) AS prediction_max,
round(quantile_cont(prediction, 0.5), 6) AS prediction_p50, round(quantile_cont(prediction, 0.95), 6) AS prediction_p95,
round(quantile_cont(prediction, 0.99), 6) AS prediction_p99, round(avg(latency_ms), 6) AS latency_mean_ms,
round(quantile_cont(latency_ms, 0.5), 6) AS latency_p50_ms, round(quantile_cont(latency_ms, 0.95), 6) AS latency_p95_ms,
round(quantile_cont(latency_ms, 0.99), 6) AS latency_p99_ms FROM log""",
)
def log_analytics_query(spark, sf):
    found = log_analytics.analyse_log(views.prediction_log(spark, sf))
    listed = F.array_join(F.transform("decisions", lambda d: F.concat_ws("=", d["decision"], d["n"].cast("string"))), ",")
    return rounded(found.withColumn("model_versions", F.array_join("model_versions", ",")).withColumn("decisions", listed))


@query("decision_distribution", f"WITH {LOG_CTE} SELECT decision, count(*) AS requests FROM log GROUP BY decision")
def decision_distribution(spark, sf):
    return log_analytics.decision_distribution(views.prediction_log(spark, sf))


BUSINESS = """
s AS (SELECT count(*) AS n, count(*) FILTER (WHERE decision = 'approve') AS ca, count(*) FILTER (WHERE decision = 'review') AS cr,
             count(*) FILTER (WHERE decision = 'reject') AS cj,
             sum(prediction) FILTER (WHERE decision = 'approve') * 1000 / count(*) AS la,
             avg(prediction) FILTER (WHERE decision = 'review') * 0.5 * 1000 * count(*) FILTER (WHERE decision = 'review') / count(*) AS lr,
             avg(prediction) AS m, stddev_samp(prediction) AS sd, min(prediction) AS lo, max(prediction) AS hi,
             quantile_cont(prediction, 0.25) AS p25, quantile_cont(prediction, 0.5) AS p50,
             quantile_cont(prediction, 0.75) AS p75, quantile_cont(prediction, 0.95) AS p95 FROM log),
t AS (SELECT *, ca * 50.0::DOUBLE * 1.15::DOUBLE AS ra, cr * 50.0::DOUBLE * 0.8::DOUBLE AS rr FROM s)
"""


@query(
    "business_metrics",
    f"""WITH {LOG_CTE}, {BUSINESS}
SELECT n AS total_requests, round(ca / CAST(n AS DOUBLE), 4) AS approval_rate, round(cr / CAST(n AS DOUBLE), 4) AS review_rate,
round(cj / CAST(n AS DOUBLE), 4) AS rejection_rate, ca AS approval_count, cr AS review_count, cj AS rejection_count,
round(m, 4) AS prediction_mean, round(sd, 4) AS prediction_std, round(lo, 4) AS prediction_min, round(hi, 4) AS prediction_max,
round(p25, 4) AS prediction_p25, round(p50, 4) AS prediction_p50, round(p75, 4) AS prediction_p75, round(p95, 4) AS prediction_p95,
round((la + lr) / n, 2) AS expected_loss_per_request_as_reported_usd, round(la + lr, 2) AS expected_loss_per_request_usd,
round(la, 2) AS approval_expected_loss_usd, round(lr, 2) AS review_expected_loss_usd, round(ra, 2) AS approval_revenue_usd,
round(rr, 2) AS review_revenue_usd, round(ra + rr - la - lr, 2) AS net_profit_usd, round((ra + rr - la - lr) / n, 2) AS net_profit_per_request_usd,
1000.0::DOUBLE AS loss_per_default_usd, 50.0::DOUBLE AS processing_cost_usd, 0.5::DOUBLE AS review_screening_success_rate, 0.15::DOUBLE AS interest_rate FROM t""",
)
def business_metrics(spark, sf):
    return log_analytics.business_metrics(views.prediction_log(spark, sf))


#: The request chain over the event table: an event is a request, its type and numbers the payload, its value the milliseconds it took.
REQUESTS = Contract(
    name="requests",
    fields=(Field("event_type", "categorical", ("click", "purchase", "view")), Field("k", "integer"), Field("cents", "integer")),
)
RANGES = {"k": (0, 95)}
REQUEST_MODEL = models.Encoding(
    categorical=("event_type",), numeric=("k", "cents"), fills={}, values={"event_type": ["click", "purchase", "view"]},
    scales={"k": Scale(50.0, 30.0), "cents": Scale(5000.0, 5000.0)},
)


def requests(rows):
    """Requests of the event table, or of a stream of it; those of type error are cut short."""
    payload = F.to_json(F.struct("event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.round(F.col("value") * 100).cast("bigint").alias("cents")))
    return rows.select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("client"), "ts",
        F.when(F.col("event_type") == "error", F.substring(payload, 1, 20)).otherwise(payload).alias("payload"),
        (F.col("value") / 1000.0).alias("elapsed"),
    )


def request_chain(spark, sf):
    """Three requests a day and client; running means within 6 % of those of the first half; 0.2 seconds."""
    ref, _ = views.event_sides(spark, sf)
    known = ref.select(F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    training = {r["feature"]: (r["mean"], r["std"]) for r in feature_stats.feature_stats(known, ["k", "cents"]).collect()}
    statement = models.score_statement(REQUEST_MODEL, (0.5, -0.25, 0.125, 0.35, 0.6), -0.3, models.SCORE)
    return Chain(
        REQUESTS, PipelineModel(stages=[SQLTransformer(statement=statement)]), training, RANGES,
        window_seconds=86400, limit=3, relative_tolerance=0.06, time_limit_seconds=0.2,
    )


OUTCOME_CTE = f"""
e AS (SELECT event_id, user_id, epoch_us(ts) AS us, ts, event_type, value, {K_SQL} AS k, CAST(round(value * 100) AS BIGINT) AS cents,
             event_type = 'error' OR NOT {K_SQL} BETWEEN 0 AND 95 AS malformed FROM events),
l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM e WHERE NOT malformed),
-- One step per request: the accepted times of the last day are carried along.
r AS (SELECT event_id, user_id, us, rn, true AS accepted, [us] AS held FROM l WHERE rn = 1
  UNION ALL
  SELECT event_id, user_id, us, rn, len(f) < 3, CASE WHEN len(f) < 3 THEN list_append(f, us) ELSE f END FROM (
    SELECT l.event_id, l.user_id, l.us, l.rn, list_filter(r.held, lambda x: x > l.us - 86400000000) AS f
    FROM r JOIN l ON l.user_id = r.user_id AND l.rn = r.rn + 1)),
known AS (SELECT avg({K_SQL}) AS mk, stddev_samp({K_SQL}) AS dk, avg(CAST(round(value * 100) AS BIGINT)) AS mc, stddev_samp(CAST(round(value * 100) AS BIGINT)) AS dc
          FROM events WHERE ts < TIMESTAMP '{views.EVENT_SPLIT} 00:00:00'),
means AS (SELECT event_id, sum(k) OVER w / CAST(count(*) OVER w AS DOUBLE) AS ik, sum(cents) OVER w / CAST(count(*) OVER w AS DOUBLE) AS ic
          FROM l JOIN r USING (event_id) WHERE accepted AND event_type IN ('click', 'purchase', 'view') WINDOW w AS (ORDER BY ts, event_id)),
checked AS (SELECT event_id, abs(ik - mk) / dk > 3 OR abs(ik - mk) / mk > 0.06::DOUBLE OR abs(ic - mc) / dc > 3 OR abs(ic - mc) / mc > 0.06::DOUBLE AS mismatch
            FROM means, known),
scored AS (SELECT *, 1.0::DOUBLE / (1.0::DOUBLE + exp(-(-0.3::DOUBLE + CASE event_type WHEN 'click' THEN 0.5::DOUBLE WHEN 'purchase' THEN -0.25::DOUBLE ELSE 0.125::DOUBLE END
             + 0.35::DOUBLE * ((k - 50.0::DOUBLE) / 30.0::DOUBLE) + 0.6::DOUBLE * ((cents - 5000.0::DOUBLE) / 5000.0::DOUBLE)))) AS p FROM e),
passed AS (SELECT *, CASE WHEN malformed THEN 'malformed' WHEN NOT accepted THEN 'rate_limited' WHEN event_type = 'signup' THEN 'validation_error'
             WHEN mismatch THEN 'feature_mismatch' WHEN value / 1000.0::DOUBLE > 0.2::DOUBLE THEN 'timeout' ELSE 'success' END AS outcome
           FROM scored LEFT JOIN (SELECT event_id, accepted FROM r) USING (event_id) LEFT JOIN checked USING (event_id)),
req AS (SELECT *, CASE outcome WHEN 'malformed' THEN 422 WHEN 'rate_limited' THEN 429 WHEN 'validation_error' THEN 400
                  WHEN 'feature_mismatch' THEN 503 WHEN 'timeout' THEN 504 ELSE 200 END AS status,
        CASE WHEN outcome = 'success' THEN round(p, 6) END AS prediction,
        CASE WHEN outcome = 'success' THEN CASE WHEN p < 0.3 THEN 'approve' WHEN p <= 0.7 THEN 'review' ELSE 'reject' END END AS tier FROM passed)
"""


def settled(spark, sf):
    return settle_table(requests(views.events(spark, sf)), request_chain(spark, sf))


@query("request_outcome", f"WITH RECURSIVE {OUTCOME_CTE} SELECT event_id, outcome, status FROM req")
def request_outcome_query(spark, sf):
    return settled(spark, sf).select(F.col("request_id").alias("event_id"), "outcome", "status")


@query(
    "outcome_counters",
    f"""WITH RECURSIVE {OUTCOME_CTE}
SELECT 'outcome' AS counter, outcome AS label, count(*) AS n FROM req GROUP BY outcome
UNION ALL SELECT 'status', CAST(status AS VARCHAR), count(*) FROM req GROUP BY status
UNION ALL SELECT 'decision', tier, count(*) FROM req WHERE outcome = 'success' GROUP BY tier""",
)
def outcome_counters(spark, sf):
    return log_analytics.outcome_counters(settled(spark, sf), ["outcome", "status", "decision"])


@query(
    "load_summary",
    f"""WITH RECURSIVE {OUTCOME_CTE} SELECT event_type, count(*) AS requests, count(*) FILTER (WHERE status = 200) AS success,
count(*) FILTER (WHERE outcome <> 'success') AS errors, round(avg(value), 6) AS avg_latency_ms FROM req GROUP BY event_type""",
)
def load_summary(spark, sf):
    kinds = views.events(spark, sf).select(F.col("event_id").alias("request_id"), "event_type")
    rows = settled(spark, sf).join(kinds, "request_id").withColumn("error", F.when(F.col("outcome") != "success", F.col("outcome")))
    return rounded(log_analytics.load_summary(rows, "status", "error", "latency_ms", ["event_type"]))


@query(
    "replay_detection",
    f"WITH {LOG_CTE} SELECT input_hash, count(*) AS requests FROM log GROUP BY input_hash HAVING count(*) > 1",
)
def replay_detection(spark, sf):
    return log_analytics.replayed_inputs(views.prediction_log(spark, sf))
