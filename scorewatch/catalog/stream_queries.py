"""Streams, drained to the end and compared with their batch meaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift, feature_stats
from ..session import materialise
from ..streaming import jobs, requests as chained
from ..streaming.rate_limit import rate_limit as batch_rate_limit, stream_rate_limit
from . import views
from .drift_queries import EVENT_DAILY, EVENT_FEATURES
from .log_queries import OUTCOME_CTE, request_chain, requests
from .registry import query, rounded
from .stats_queries import _stats_sql
from .views import EVENT_SIDES

BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 200.0, 400.0)


#: How late a row may come before it is left out of a window.
TOLERANCE = "1 day"


def _events(spark, sf):
    schema = views.events(spark, sf).schema
    return lambda session: jobs.read_stream(session, sf, "events.parquet", schema)


def _timed_events(spark, sf):
    source = _events(spark, sf)
    return lambda session: jobs.timed(source(session), "ts", TOLERANCE)


@query("stream_requests", f"WITH RECURSIVE {OUTCOME_CTE} SELECT event_id, outcome, status, prediction, tier AS decision FROM req")
def stream_requests(spark, sf):
    """Limiter, values, feature check, model and decision in one stream."""
    source = _events(spark, sf)
    settled = chained.stream_requests(spark, lambda session: requests(source(session)), request_chain(spark, sf))
    return settled.select(F.col("request_id").alias("event_id"), "outcome", "status", "prediction", "decision")


@query(
    "stream_decisions",
    f"""WITH RECURSIVE {OUTCOME_CTE}, shape AS (SELECT event_id, p, CASE WHEN malformed THEN 'malformed' WHEN event_type = 'signup' THEN 'validation_error' ELSE 'success' END AS outcome FROM scored)
SELECT event_id, outcome, CASE WHEN outcome = 'success' THEN round(p, 6) END AS prediction,
CASE WHEN outcome = 'success' THEN CASE WHEN p < 0.3 THEN 'approve' WHEN p <= 0.7 THEN 'review' ELSE 'reject' END END AS decision FROM shape""",
)
def stream_decisions(spark, sf):
    """What needs no state: shape, values, score and decision of every request."""
    source, chain = _events(spark, sf), request_chain(spark, sf)
    scored = lambda session: chained.score_shaped(requests(source(session)), chain).select(
        F.col("request_id").alias("event_id"), "outcome", "prediction", "decision"
    )
    return jobs.drain(spark, scored, "append", "decisions")


@query(
    "request_volume",
    """SELECT date_trunc('hour', ts) AS window_start, count(*) AS requests, round(count(*) / 3600.0::DOUBLE, 6) AS per_second FROM events GROUP BY 1""",
)
def request_volume(spark, sf):
    source = _timed_events(spark, sf)
    volume = jobs.drain(spark, lambda session: jobs.request_rate(source(session), "event_at", "1 hour", 3600), "update", "volume", ["window_start"])
    return rounded(volume).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "request_volume_sliding",
    """WITH w AS (SELECT date_trunc('hour', ts) - (INTERVAL 1 HOUR) * unnest([0, 1]) AS window_start FROM events)
SELECT window_start, count(*) AS requests, round(count(*) / 7200.0::DOUBLE, 6) AS per_second FROM w GROUP BY 1""",
)
def request_volume_sliding(spark, sf):
    source = _timed_events(spark, sf)
    rate = lambda session: jobs.request_rate(source(session), "event_at", "2 hours", 7200, "1 hour")
    volume = jobs.drain(spark, rate, "update", "sliding", ["window_start"])
    return rounded(volume).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    "error_rate",
    """SELECT date_trunc('hour', ts) AS window_start, count(*) AS requests, count(*) FILTER (WHERE event_type = 'error') AS errors,
round(count(*) FILTER (WHERE event_type = 'error') / CAST(count(*) AS DOUBLE), 6) AS error_rate FROM events GROUP BY 1""",
)
def error_rate(spark, sf):
    source = _timed_events(spark, sf)
    counted = lambda session: jobs.window_counts(source(session), "event_at", "1 hour", error=F.col("event_type") == "error")
    return rounded(jobs.drain(spark, counted, "update", "errors", ["window_start"])).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


def _quantile_sql() -> str:
    rows = ", ".join(f"({i}, {0.0 if i == 0 else BOUNDS[i - 1]}::DOUBLE, {b}::DOUBLE)" for i, b in enumerate(BOUNDS))
    picks = ", ".join(
        f"""round(coalesce((SELECT lo + (hi - lo) * ({q} * n - prev) / (cum - prev) FROM c WHERE c.w = t.w AND cum >= {q}::DOUBLE * n ORDER BY i LIMIT 1), {BOUNDS[-1]}::DOUBLE), 6) AS {name}"""
        for q, name in ((0.5, "p50"), (0.95, "p95"))
    )
    return f"""WITH b(i, lo, hi) AS (VALUES {rows}),
e AS (SELECT CAST(ts AS DATE) AS w, value FROM events), t AS (SELECT w, count(*) AS n FROM e GROUP BY w),
c AS (SELECT w, i, lo, hi, count(*) FILTER (WHERE value <= hi) AS cum, count(*) FILTER (WHERE value <= CASE WHEN i = 0 THEN -1 ELSE lo END) AS prev FROM e, b GROUP BY w, i, lo, hi)
SELECT CAST(w AS TIMESTAMP) AS window_start, {picks} FROM t"""


@query("latency_quantiles", _quantile_sql())
def latency_quantiles(spark, sf):
    """Cells are counted as a stream, quantiles read from the result table."""
    from ..operators.metrics import quantiles_from_cells

    source = _timed_events(spark, sf)
    counted = lambda session: jobs.latency_cells(source(session), "event_at", "value", "1 day", BOUNDS)
    cells = jobs.drain(spark, counted, "update", "latency", ["window_start", "cell"])
    return rounded(quantiles_from_cells(cells, BOUNDS, (0.5, 0.95), ["window_start"])).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


@query(
    "stream_psi_by_day",
    f"""WITH {EVENT_SIDES}, {EVENT_DAILY} SELECT grp AS event_day, feature, round(psi, 6) AS psi FROM psi""",
)
def stream_psi_by_day(spark, sf):
    ref, _ = views.event_sides(spark, sf)
    edges = drift.numeric_edges(ref, EVENT_FEATURES.numeric)
    source = _timed_events(spark, sf)
    split = F.lit(views.EVENT_SPLIT).cast("timestamp_ntz")
    counted = lambda session: jobs.stream_psi_frequencies(
        source(session).where(F.col("ts") >= split), EVENT_FEATURES, edges, "event_at"
    )
    current = jobs.drain(spark, counted, "update", "psi", ["event_day", "feature", "bucket", "category"])
    return rounded(drift.psi_from_frequencies(drift.frequency_table(ref, EVENT_FEATURES, edges), current, ["event_day"]))


CHECKED = """
t AS ({train}), i AS ({serve}),
j AS (SELECT t.feature, t.mean AS train_mean, i.mean AS inference_mean, abs(i.mean - t.mean) / CASE WHEN t.std = 0 THEN 1 ELSE t.std END AS stds,
      abs(i.mean - t.mean) / CASE WHEN t.mean = 0 THEN 1 ELSE abs(t.mean) END AS rel FROM t JOIN i ON i.feature = t.feature)
"""


@query(
    "stream_feature_check",
    f"""WITH {EVENT_SIDES}, {CHECKED.format(train=_stats_sql('ref', ('value', 'user_id'), ('event_type',)), serve=_stats_sql('events', ('value', 'user_id'), ('event_type',)))}
SELECT feature, CASE WHEN train_mean IS NOT NULL AND (stds > 3.0 OR rel > 0.01) THEN 'mean_shift' END AS reason, round(train_mean, 4) AS train_mean,
round(inference_mean, 4) AS inference_mean, round(stds, 4) AS stds, round(rel, 4) AS rel FROM j""",
)
def stream_feature_check(spark, sf):
    """Running statistics of all events against those of the first half; a tight tolerance so that something fails."""
    columns = ["value", "user_id", "event_type"]
    ref, _ = views.event_sides(spark, sf)
    source = _events(spark, sf)
    running = jobs.drain(spark, lambda session: jobs.running_feature_stats(source(session), columns), "update", "stats", ["feature"])
    training = feature_stats.feature_stats(ref, columns)
    compared = feature_stats.compare_stats(training, running, relative_tolerance=0.01, failures_only=False)
    return rounded(compared.select("feature", "reason", "train_mean", "inference_mean", "stds", "rel"), 4)


@query(
    "stream_counters",
    f"""WITH RECURSIVE {OUTCOME_CTE} SELECT 'outcome' AS counter, outcome AS label, count(*) AS n FROM req GROUP BY outcome
UNION ALL SELECT 'decision', tier, count(*) FROM req WHERE outcome = 'success' GROUP BY tier""",
)
def stream_counters(spark, sf):
    """Counters over the log that the request stream writes."""
    source = _events(spark, sf)
    log = materialise(chained.stream_requests(spark, lambda session: requests(source(session)), request_chain(spark, sf)), "log")
    folder = log.inputFiles()[0].rsplit("/", 1)[0]
    counted = lambda session: jobs.running_counters(jobs.read_stream(session, folder, "*.parquet", log.schema), ["outcome", "decision"])
    return jobs.drain(spark, counted, "update", "counters", ["counter", "label"])


# One step per request: accepted times of the last day are carried along.
RATE_SQL = """
WITH RECURSIVE e AS (SELECT event_id, user_id, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT event_id, user_id, us, rn, true AS accepted, [us] AS held FROM e WHERE rn = 1
  UNION ALL
  SELECT event_id, user_id, us, rn, len(f) < 3, CASE WHEN len(f) < 3 THEN list_append(f, us) ELSE f END FROM (
    SELECT e.event_id, e.user_id, e.us, e.rn, list_filter(r.held, lambda x: x > e.us - 86400000000) AS f
    FROM r JOIN e ON e.user_id = r.user_id AND e.rn = r.rn + 1))
SELECT event_id, user_id, accepted FROM r
"""


@query("rate_limit", RATE_SQL)
def rate_limit(spark, sf):
    """At most three requests a day and client, decided one after the other."""
    events = views.events(spark, sf).select("event_id", "user_id", "ts")
    return batch_rate_limit(events, "user_id", "ts", "event_id", 86400, 3).select("event_id", "user_id", "accepted")


@query("stream_rate_limit", RATE_SQL)
def stream_rate_limit_query(spark, sf):
    """The same decisions from a stream with state per client."""
    source = _events(spark, sf)
    decided = lambda session: stream_rate_limit(source(session), "user_id", "ts", "event_id", 86400, 3)
    out = jobs.drain(spark, decided, "append", "rate")
    return out.select(F.col("key").alias("event_id"), F.col("client").alias("user_id"), "accepted")
