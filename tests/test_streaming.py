"""Streams give what batch gives, over several micro-batches."""

import datetime
import os
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorewatch.operators import drift, log_analytics
from scorewatch.operators.contract import Contract, Field
from scorewatch.session import fresh_path
from scorewatch.streaming import jobs, requests as chained
from scorewatch.streaming.rate_limit import rate_limit, stream_rate_limit

SCHEMA = "key bigint, client bigint, ts timestamp_ntz, value double, kind string"


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(8)
    gaps = rng.exponential(20, 1500)
    at = np.datetime64("2024-01-01T00:00:00", "us") + (np.cumsum(gaps) * 1e6).astype("timedelta64[us]")
    # A third and more of all requests come from one client.
    clients = rng.choice([1, 2, 3, 4], 1500, p=[0.6, 0.2, 0.15, 0.05])
    rows = [(i, int(c), t.astype(object), float(rng.random()), str(rng.choice(["a", "b"]))) for i, (c, t) in enumerate(zip(clients, at))]
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.fixture(scope="module")
def folder(table, tmp_path_factory):
    """The table as several files, in time order."""
    df, _ = table
    base = tmp_path_factory.mktemp("stream")
    for i in range(3):
        df.where((F.col("key") >= i * 500) & (F.col("key") < (i + 1) * 500)).coalesce(1).write.mode("append").parquet(str(base))
    return str(base)


def source(folder, schema):
    return lambda session: jobs.read_stream(session, folder, "*.parquet", schema, files_per_batch=1)


def timed(folder, schema, tolerance="1 hour"):
    return lambda session: jobs.timed(source(folder, schema)(session), "ts", tolerance)


def brute(rows, window, limit):
    held, verdict = defaultdict(list), {}
    for key, client, ts, *_ in sorted(rows, key=lambda r: (r[2], r[0])):
        held[client] = [t for t in held[client] if (ts - t).total_seconds() < window]
        verdict[key] = len(held[client]) < limit
        if verdict[key]:
            held[client].append(ts)
    return verdict


@pytest.mark.parametrize("window,limit", [(60, 1), (60, 3), (300, 4), (5, 2), (3600, 60)])
def test_rate_limit_is_sequential(table, window, limit):
    df, rows = table
    got = {r["key"]: r["accepted"] for r in rate_limit(df.repartition(4), "client", "ts", "key", window, limit).collect()}
    assert got == brute(rows, window, limit)


def test_rate_limit_stream_keeps_state_between_batches(spark, table, folder):
    df, rows = table
    out = jobs.drain(spark, lambda s: stream_rate_limit(source(folder, df.schema)(s), "client", "ts", "key", 300, 4), "append", "rate")
    assert {r["key"]: r["accepted"] for r in out.collect()} == brute(rows, 300, 4)


def test_windows(spark, table, folder):
    df, _ = table
    error = F.col("kind") == "b"
    counted = lambda s: jobs.window_counts(timed(folder, df.schema)(s), "event_at", "1 hour", error=error)
    stream = jobs.drain(spark, counted, "update", "w", ["window_start"])
    batch = jobs.window_counts(jobs.timed(df, "ts", "1 hour"), "event_at", "1 hour", error=error)
    assert stream.exceptAll(batch).count() == 0 and batch.exceptAll(stream).count() == 0
    sliding = jobs.window_counts(df, "ts", "2 hours", "1 hour")
    assert sliding.agg(F.sum("requests")).first()[0] == 3000


def test_daily_psi(spark, table, folder):
    df, _ = table
    features = drift.Features(("value",), ("kind",))
    ref = df.where("key < 700")
    edges = drift.numeric_edges(ref, ["value"])
    current = jobs.drain(spark, lambda s: jobs.stream_psi_frequencies(timed(folder, df.schema)(s), features, edges, "event_at"), "update", "psi", ["event_day", "feature", "bucket", "category"])
    stream = drift.psi_from_frequencies(drift.frequency_table(ref, features, edges), current, ["event_day"])
    batch = drift.psi(ref, df.withColumn("event_day", F.col("ts").cast("date")), features, ["event_day"], edges=edges)
    a, b = ({(r["event_day"], r["feature"]): round(r["psi"], 9) for r in x.collect()} for x in (stream, batch))
    assert a == b and len(a) == 2


def test_counters_and_statistics(spark, table, folder):
    df, _ = table
    stream = jobs.drain(spark, lambda s: jobs.running_counters(source(folder, df.schema)(s), ["kind"]), "update", "c", ["counter", "label"])
    batch = log_analytics.outcome_counters(df, ["kind"])
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))
    stats = jobs.drain(spark, lambda s: jobs.running_feature_stats(source(folder, df.schema)(s), ["value", "kind"]), "update", "s", ["feature"])
    assert {r["feature"]: r["rows"] for r in stats.collect()} == {"value": 1500, "kind": 1500}


def test_append_stream_scores_every_request(spark, table, folder):
    df, _ = table
    flags = {"malformed": F.col("kind") == "b"}
    out = jobs.drain(spark, lambda s: jobs.score_requests(source(folder, df.schema)(s), F.col("value"), flags).select("key", "outcome", "prediction", "decision"), "append", "d")
    assert out.count() == 1500
    assert out.where("outcome = 'malformed' and (prediction is not null or decision is not null)").count() == 0


def test_late_counter_emits_closed_days(spark, table, folder):
    df, _ = table
    out = jobs.drain(spark, lambda s: jobs.late_counter(source(folder, df.schema)(s), "ts", "1 minute"), "append", "late")
    assert set(out.columns) == {"day", "rows"}


def test_model_scores_a_stream_as_it_scores_a_table(spark, table, folder):
    from scorewatch.operators import model as M

    df, _ = table
    labelled = df.withColumn("label", (F.col("value") + F.when(F.col("kind") == "b", 0.3).otherwise(0.0) > 0.6).cast("int"))
    fitted = M.fit_model(labelled, ["kind"], ["value"], "label")
    none = {"malformed": F.lit(False)}
    out = jobs.drain(spark, lambda s: jobs.score_with_model(source(folder, df.schema)(s), fitted, none).select("key", "prediction", "decision"), "append", "m")
    batch = jobs.score_with_model(df, fitted, none).select("key", "prediction", "decision")
    assert out.exceptAll(batch).count() == 0 and out.count() == 1500


def test_every_request_gets_a_verdict(spark, tmp_path):
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    files = [[(1, "a", at(0)), (2, "a", at(400)), (3, None, at(5))], [(4, "a", at(10)), (5, None, at(6)), (6, "b", None)], [(7, "a", at(401)), (8, None, at(7))]]
    schema = "key bigint, client string, ts timestamp_ntz"
    whole = spark.createDataFrame([r for f in files for r in f], schema)
    batch = {r["key"]: r["accepted"] for r in rate_limit(whole, "client", "ts", "key", 300, 2).collect()}
    assert batch == {1: True, 2: True, 3: True, 4: True, 5: True, 6: False, 7: True, 8: False}
    for i, rows in enumerate(files):
        (tmp_path / "in").mkdir(exist_ok=True)
        path = str(tmp_path / "in" / f"{i}.parquet")
        pd.DataFrame(rows, columns=["key", "client", "ts"]).to_parquet(path, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + 60 * i,) * 2)
    stream = lambda s: stream_rate_limit(jobs.read_stream(s, str(tmp_path / "in"), "*.parquet", schema, 1), "client", "ts", "key", 300, 2)
    got = {r["key"]: (r["accepted"], r["late"]) for r in jobs.drain(spark, stream, "append", "verdicts").collect()}
    assert got == {1: (True, False), 2: (True, False), 3: (True, False), 4: (True, True), 5: (True, False), 6: (False, False), 7: (False, False), 8: (False, False)}


def test_size_of_arrow_batches_decides_nothing(spark, tmp_path):
    at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
    rows = [(i, "ab"[i % 3 == 0], at(i * 7919 % 4001)) for i in range(300)]
    schema = "key bigint, client string, ts timestamp_ntz"
    batch = {r["key"]: (r["accepted"], False) for r in rate_limit(spark.createDataFrame(rows, schema), "client", "ts", "key", 300, 4).collect()}
    (tmp_path / "in").mkdir()
    pd.DataFrame(rows, columns=["key", "client", "ts"]).to_parquet(str(tmp_path / "in" / "0.parquet"), coerce_timestamps="us")

    def stream(session):
        session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        return stream_rate_limit(jobs.read_stream(session, str(tmp_path / "in"), "*.parquet", schema, 1), "client", "ts", "key", 300, 4)

    got = {r["key"]: (r["accepted"], r["late"]) for r in jobs.drain(spark, stream, "append", "sizes").collect()}
    assert got == batch


def minutes(rows, per_file, base):
    """Files of ``per_file`` rows each: (key, client, minute, value)."""
    base.mkdir(exist_ok=True)
    for i in range(0, len(rows), per_file):
        path = str(base / f"{i:06d}.parquet")
        at = datetime.datetime(2024, 1, 1)
        frame = pd.DataFrame([(k, c, at + datetime.timedelta(minutes=m), v) for k, c, m, v in rows[i:i + per_file]], columns=["key", "client", "ts", "value"])
        frame.to_parquet(path, coerce_timestamps="us")
        os.utime(path, (1_700_000_000 + 60 * i,) * 2)
    return str(base)


MINUTES = "key bigint, client string, ts timestamp_ntz, value double"


def hourly(folder, tolerance="10 minutes"):
    return lambda s: jobs.window_counts(jobs.timed(jobs.read_stream(s, folder, "*.parquet", MINUTES, 1), "ts", tolerance), "event_at", "1 hour")


def counts(df):
    return {(r["window_start"].hour, r["requests"]) for r in df.collect()}


def test_windows_behind_the_watermark_leave_the_state_but_not_the_table(spark, tmp_path):
    folder = minutes([(i, "a", 7 * i, 1.0) for i in range(160)], 20, tmp_path / "in")
    session = jobs.stream_session(spark)
    stream, path = hourly(folder)(session), fresh_path(session, "kept")
    progress = jobs.run_update(stream, path, fresh_path(session, "kept-checkpoint"), ["window_start"])
    held = [p["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert max(held) < 6 and sum(p["stateOperators"][0]["numRowsRemoved"] for p in progress) >= 15
    wanted = {}
    for i in range(160):
        wanted[7 * i // 60] = wanted.get(7 * i // 60, 0) + 1
    assert counts(jobs.latest(spark, path, stream.schema, ["window_start"])) == set(wanted.items())


def test_rows_behind_the_watermark_are_counted_not_added(spark, tmp_path):
    folder = minutes([(0, "a", 0, 1.0), (1, "a", 500, 1.0), (2, "a", 505, 1.0), (3, "a", 10, 1.0)], 1, tmp_path / "in")
    session = jobs.stream_session(spark)
    stream, path = hourly(folder)(session), fresh_path(session, "late")
    progress = jobs.run_update(stream, path, fresh_path(session, "late-checkpoint"), ["window_start"])
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 1
    assert counts(jobs.latest(spark, path, stream.schema, ["window_start"])) == {(0, 1), (8, 2)}


@pytest.mark.parametrize("fold_every", [1, 2, 3])
def test_a_killed_batch_is_repeated_without_loss(spark, tmp_path, monkeypatch, fold_every):
    folder = minutes([(i, "a", 13 * i, 1.0) for i in range(70)], 10, tmp_path / "in")
    session = jobs.stream_session(spark)
    path, checkpoint = fresh_path(session, "killed"), fresh_path(session, "killed-checkpoint")
    real, calls = jobs.batches, []

    def dies(spark, at):
        calls.append(at)
        if len(calls) == 3:
            raise RuntimeError("killed")
        return real(spark, at)

    monkeypatch.setattr(jobs, "batches", dies)
    with pytest.raises(Exception, match="killed"):
        jobs.run_update(hourly(folder)(session), path, checkpoint, ["window_start"], fold_every)
    monkeypatch.setattr(jobs, "batches", real)
    stream = hourly(folder)(session)
    jobs.run_update(stream, path, checkpoint, ["window_start"], fold_every)
    wanted = {}
    for i in range(70):
        wanted[13 * i // 60] = wanted.get(13 * i // 60, 0) + 1
    assert counts(jobs.latest(spark, path, stream.schema, ["window_start"])) == set(wanted.items())
    assert len(real(spark, f"{path}/changes")) <= 2 * fold_every + 1


def limited(folder, window, limit, pause=0.0):
    def stream(session):
        rows = jobs.read_stream(session, folder, "*.parquet", MINUTES, 1)
        if pause:
            import time

            slow = F.udf(lambda k: time.sleep(pause) or k, "bigint")
            rows = rows.withColumn("key", slow("key"))
        return stream_rate_limit(rows, "client", "ts", "key", window, limit)

    return stream


def test_verdicts_do_not_depend_on_the_pace_of_processing(spark, tmp_path):
    """Batches further apart than the window, requests not."""
    rows = [(0, "a", 0, 0.0), (1, "b", 0.002, 0.0), (2, "c", 0.004, 0.0), (3, "b", 0.006, 0.0), (4, "a", 0.0083, 0.0), (5, "c", 0.0085, 0.0)]
    folder = minutes(rows, 1, tmp_path / "in")
    table = spark.createDataFrame([(k, c, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m), v) for k, c, m, v in rows], MINUTES)
    batch = {r["key"]: (r["accepted"], False) for r in rate_limit(table, "client", "ts", "key", 1, 1).collect()}
    out = jobs.drain(spark, limited(folder, 1, 1, pause=1.2), "append", "pace")
    assert {r["key"]: (r["accepted"], r["late"]) for r in out.collect()} == batch
    assert [v for v, _ in batch.values()].count(False) == 3


def test_clients_are_forgotten_by_the_times_of_others(spark, tmp_path):
    folder = minutes([(i, f"client {i // 2}", i, 0.0) for i in range(60)], 6, tmp_path / "in")
    session = jobs.stream_session(spark)
    path, checkpoint = fresh_path(session, "forget"), fresh_path(session, "forget-checkpoint")
    query = limited(folder, 120, 1)(session).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) < 12
    assert {r["accepted"] for r in spark.read.parquet(path).where("key % 2 = 0").collect()} == {True}


def test_clients_of_a_bucket_are_decided_in_one_call(spark, tmp_path, monkeypatch):
    """State rows and calls go with the buckets, whatever the number of clients; each client is decided and forgotten on its own."""
    monkeypatch.setattr("scorewatch.streaming.rate_limit.BUCKETS", 2, raising=False)
    rng = np.random.default_rng(6)
    rows = [(i, None if c == 0 else f"client {c}", i // 3, 0.0) for i, c in enumerate(rng.integers(0, 50, 900))]
    folder = minutes(rows, 300, tmp_path / "in")
    session = jobs.stream_session(spark)
    path, checkpoint = fresh_path(session, "buckets"), fresh_path(session, "buckets-checkpoint")
    query = limited(folder, 3600, 2)(session).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 3
    wanted = brute([(k, c, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m)) for k, c, m, _ in rows], 3600, 2)
    assert {r["key"]: r["accepted"] for r in spark.read.parquet(path).collect()} == wanted and len({*wanted.values()}) == 2


REQUESTS = Contract("requests", (Field("kind", "categorical", ("x", "y")), Field("amount", "integer"), Field("client", "integer")))


def chain(**changes):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import SQLTransformer

    statement = "SELECT *, 1D / (1D + EXP(-(amount - 50) / 20D)) AS prob_bad FROM __THIS__"
    wanted = {
        "contract": REQUESTS, "model": PipelineModel(stages=[SQLTransformer(statement=statement)]), "training": {"amount": (50.0, 25.0)},
        "ranges": {"amount": (0, 100)}, "window_seconds": 600, "limit": 4, "relative_tolerance": 0.1,
    }
    return chained.Chain(**{**wanted, **changes})


def payloads(n=240):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        kind, amount = rng.choice(["x", "y", "z"], p=[0.5, 0.4, 0.1]), int(rng.integers(0, 104))
        text = f'{{"kind": "{kind}", "amount": {amount}, "client": 1}}' if rng.random() > 0.1 else None if rng.random() < 0.3 else '{"kind": "x"'
        rows.append((i, [None, "a", "a", "b"][int(rng.integers(0, 4))], i // 2, text, float(rng.choice([0.1, 3.0], p=[0.9, 0.1]))))
    return rows


def verdicts(rows, chain):
    """The chain, request by request."""
    import json

    held, n, total, out = defaultdict(list), 0, 0, {}
    for key, client, minute, text, elapsed in rows:
        try:
            given = json.loads(text)
        except (TypeError, ValueError):
            given = {}
        if not 0 <= given.get("amount", -1) <= 100:
            out[key] = ("malformed", None)
            continue
        if chain.model is None:
            out[key] = ("no_model", None)
            continue
        held[client] = [m for m in held[client] if minute - m < chain.window_seconds / 60]
        if len(held[client]) >= chain.limit:
            out[key] = ("rate_limited", None)
            continue
        held[client].append(minute)
        if given["kind"] == "z":
            out[key] = ("validation_error", None)
            continue
        n, total = n + 1, total + given["amount"]
        if abs(total / n - 50) / 50 > chain.relative_tolerance:
            out[key] = ("feature_mismatch", None)
        elif elapsed > chain.time_limit_seconds:
            out[key] = ("timeout", None)
        else:
            out[key] = ("success", round(1 / (1 + np.exp(-(given["amount"] - 50) / 20)), 6))
    return out


CHAIN_ROWS = "request_id bigint, client string, ts timestamp_ntz, payload string, elapsed double"


def request_rows(rows):
    return [(k, c, datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=m), t, e) for k, c, m, t, e in rows]


def request_files(rows, per_file, base):
    base.mkdir()
    for i in range(0, len(rows), per_file):
        frame = pd.DataFrame(request_rows(rows)[i:i + per_file], columns=["request_id", "client", "ts", "payload", "elapsed"])
        frame.to_parquet(str(base / f"{i:06d}.parquet"), coerce_timestamps="us")
        os.utime(str(base / f"{i:06d}.parquet"), (1_700_000_000 + 60 * i,) * 2)
    return str(base)


def settled(df):
    return {r["request_id"]: (r["outcome"], r["prediction"]) for r in df.collect()}


def test_running_sums_do_not_depend_on_cells(spark, monkeypatch):
    monkeypatch.setattr("scorewatch.operators.ordered.ROWS_PER_CELL", 15)
    rows = payloads()
    table = spark.createDataFrame(request_rows(rows), CHAIN_ROWS).repartition(5)
    assert settled(chained.settle_table(table, chain())) == verdicts(rows, chain())


def test_request_chain_over_a_table(spark):
    rows = payloads()
    table = spark.createDataFrame(request_rows(rows), CHAIN_ROWS).repartition(5)
    wanted = verdicts(rows, chain())
    assert {o for o, _ in wanted.values()} == {"malformed", "rate_limited", "validation_error", "feature_mismatch", "timeout", "success"}
    found = chained.settle_table(table, chain())
    assert settled(found) == wanted
    assert settled(chained.settle_table(table, chain(model=None))) == verdicts(rows, chain(model=None))
    records = chained.log_records(found)
    assert records.count() == sum(o == "success" for o, _ in wanted.values())
    assert records.where("features_count <> 3 or input_hash is null or decision is null").count() == 0
    empty = table.where("false")
    assert settled(chained.settle_table(empty, chain())) == {}
    untimed = chained.settle_table(table.drop("elapsed"), chain())
    assert untimed.where("outcome = 'timeout'").count() == 0


def test_request_chain_as_a_stream_survives_a_killed_batch(spark, tmp_path, monkeypatch):
    rows = payloads()
    folder = request_files(rows, 60, tmp_path / "in")
    session = jobs.stream_session(spark)
    out = fresh_path(session, "chain")
    stream = lambda: jobs.read_stream(session, folder, "*.parquet", CHAIN_ROWS, 1)
    real, calls = chained.settle, []

    def dies(*args):
        found = real(*args)
        calls.append(1)
        if len(calls) == 3:
            found[0].write.mode("overwrite").parquet(f"{out}/log/batch=2")
            raise RuntimeError("killed")
        return found

    monkeypatch.setattr(chained, "settle", dies)
    with pytest.raises(Exception, match="killed"):
        chained.run_requests(stream(), chain(), out)
    monkeypatch.setattr(chained, "settle", real)
    chained.run_requests(stream(), chain(), out)
    log = chained.read_requests(spark, out)
    assert log.count() == len(rows) and settled(log) == verdicts(rows, chain())


def test_request_chain_goes_on_where_it_ended(spark, tmp_path):
    rows = payloads()
    folder = request_files(rows[:120], 60, tmp_path / "in")
    session = jobs.stream_session(spark)
    out = fresh_path(session, "resumed")
    chained.run_requests(jobs.read_stream(session, folder, "*.parquet", CHAIN_ROWS), chain(), out)
    for name in os.listdir(request_files(rows[120:], 60, tmp_path / "more")):
        os.rename(str(tmp_path / "more" / name), f"{folder}/later-{name}")
    chained.run_requests(jobs.read_stream(session, folder, "*.parquet", CHAIN_ROWS), chain(), out)
    assert settled(chained.read_requests(spark, out)) == verdicts(rows, chain())
