"""Tables written as files in the shared folder and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import log_analytics
from ..session import fresh_path
from ..sources import logs
from ..sources.text import read_lines, read_scores
from . import views
from .registry import query
from .views import APP_CTES, LINES_CTE, LOG_CTE

LINE_LIMITS = (0, 100, 500)


def _written_log(spark, sf) -> str:
    log = views.prediction_log(spark, sf)
    entries = log_analytics.log_entries(
        log, "request_id", "timestamp", F.col("input_hash"), "prediction", "decision", "latency_ms", "client_id", 2
    )
    path = fresh_path(spark, "log")
    logs.append_log(entries, path)
    return path


@query(
    "log_round_trip",
    f"""WITH {LOG_CTE} SELECT CAST(client_id AS VARCHAR) AS client_id, decision, 2 AS features_count, input_hash,
round(latency_ms, 2) AS latency_ms, model_version, round(prediction, 6) AS prediction, CAST(request_id AS VARCHAR) AS request_id,
strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp" FROM log""",
)
def log_round_trip(spark, sf):
    """All fields of the log, appended as JSON lines and read again."""
    return logs.read_log(spark, _written_log(spark, sf))


@query(
    "log_line_limit",
    f"""SELECT CAST(m AS INTEGER) AS max_lines, CASE WHEN m = 0 THEN count(*) ELSE least(count(*), m) END AS n_rows
FROM events, (VALUES {", ".join(f"({n})" for n in LINE_LIMITS)}) t(m) GROUP BY m""",
)
def log_line_limit(spark, sf):
    """Records read under a limit of lines; none and 0 mean all."""
    path = _written_log(spark, sf)

    def counted(limit: int) -> DataFrame:
        rows = logs.read_log(spark, path, limit).agg(F.count(F.lit(1)).alias("n_rows"))
        return rows.select(F.lit(limit).alias("max_lines"), "n_rows")

    return reduce(DataFrame.unionByName, map(counted, LINE_LIMITS))


@query("score_file", "SELECT round(value / (value + 50.0::DOUBLE), 9) AS score FROM events")
def score_file(spark, sf):
    """Scores in one folder, written one to a line or as arrays over several lines, and read again."""
    path = fresh_path(spark, "scores")
    rows = views.events(spark, sf).select("event_id", (F.col("value") / (F.col("value") + 50.0)).alias("score"))
    rows.where("event_id % 2 = 0").select(F.col("score").cast("string")).write.text(f"{path}/lines")
    arrays = rows.where("event_id % 2 = 1").groupBy(F.floor(F.col("event_id") / 1000).alias("part")).agg(F.to_json(F.collect_list("score")).alias("value"))
    arrays.select("part", F.replace("value", F.lit(","), F.lit(",\n  "))).write.partitionBy("part").text(f"{path}/arrays")
    return read_scores(spark, path).select(F.round("score", 9).alias("score"))


@query(
    "token_file_scan",
    f"""WITH {APP_CTES}, {LINES_CTE}
SELECT status, row_number() OVER (PARTITION BY status ORDER BY app_id) AS line_no, value FROM lines JOIN app USING (app_id)""",
)
def token_file_scan(spark, sf):
    """Rows of tokens written to one file for each status, and read as numbered lines."""
    path = fresh_path(spark, "token-lines")
    status = views.applications(spark, sf, lines=False, customer=False).select("app_id", "status")
    lines = views.app_lines(spark, sf).join(status, "app_id")
    lines.repartition("status").sortWithinPartitions("status", "app_id").select("status", "value").write.partitionBy("status").text(path)
    found = read_lines(spark, path)
    return found.select(F.regexp_extract("file", "status=([^/]*)", 1).alias("status"), "line_no", "value")
