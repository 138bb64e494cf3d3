"""Prediction logs, their analysis, reports and the serving check."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorewatch.functions.decisions import decide, request_outcome
from scorewatch.operators import feature_stats, log_analytics
from scorewatch.sources import logs, reports


@pytest.fixture(scope="module")
def log(spark):
    rng = np.random.default_rng(9)
    scores = rng.random(200)
    rows = [(f"h{int(i % 60)}", "v1" if i < 150 else "v2", float(s), float(rng.gamma(2, 10)), "approve" if s < 0.3 else "review" if s <= 0.7 else "reject")
            for i, s in enumerate(scores)]
    schema = "input_hash string, model_version string, prediction double, latency_ms double, decision string"
    return spark.createDataFrame(rows, schema), pd.DataFrame(rows, columns=["input_hash", "model_version", "prediction", "latency_ms", "decision"])


def test_decision_bounds(spark):
    df = spark.createDataFrame([(x,) for x in (0.29999, 0.3, 0.7, 0.70001)], "p double")
    assert [r[0] for r in df.select(decide(F.col("p"))).collect()] == ["approve", "review", "review", "reject"]


def test_outcome_order(spark):
    flags = ["timeout", "feature_mismatch", "validation_error", "rate_limited", "no_model", "malformed"]
    rows = [tuple(i <= k for i in range(6)) for k in range(6)] + [(False,) * 6, (None,) * 6]
    df = spark.createDataFrame(rows, ", ".join(f"{f} boolean" for f in flags))
    got = [r[0] for r in df.select(request_outcome({f: F.col(f) for f in flags})).collect()]
    assert got == [*flags, "success", "success"]


def test_analysis_equals_pandas(log):
    df, pdf = log
    r = log_analytics.analyse_log(df).first()
    assert r["total_requests"] == 200 and r["unique_inputs"] == 60 and r["model_versions"] == ["v1", "v2"]
    assert sum(n for _, n in r["decisions"]) == 200 and [d for d, _ in r["decisions"]] == sorted(d for d, _ in r["decisions"])
    for column, prefix in (("prediction", "prediction_{}"), ("latency_ms", "latency_{}_ms")):
        for q in (0.5, 0.95, 0.99):
            assert r[prefix.format(f"p{round(q * 100)}")] == pytest.approx(pdf[column].quantile(q), abs=1e-12)
    assert r["prediction_std"] == pytest.approx(pdf["prediction"].std())


def test_analysis_of_empty_log(log):
    assert log_analytics.analyse_log(log[0].limit(0)).first()["total_requests"] == 0


def test_business_figures(log):
    df, pdf = log
    r = log_analytics.business_metrics(df).first()
    n = len(pdf)
    a, v = pdf[pdf.decision == "approve"].prediction, pdf[pdf.decision == "review"].prediction
    la, lr = a.sum() * 1000 / n, v.mean() * 0.5 * 1000 * len(v) / n
    ra, rr = len(a) * 50 * 1.15, len(v) * 50 * 0.8
    assert r["approval_expected_loss_usd"] == pytest.approx(la, abs=0.006)
    assert r["review_expected_loss_usd"] == pytest.approx(lr, abs=0.006)
    assert r["net_profit_usd"] == pytest.approx(ra + rr - la - lr, abs=0.006)
    assert r["expected_loss_per_request_as_reported_usd"] == pytest.approx((la + lr) / n, abs=0.006)
    assert r["prediction_p95"] == pytest.approx(pdf.prediction.quantile(0.95), abs=1e-4)
    assert log_analytics.business_metrics(df.limit(0)).count() == 0


def test_log_round_trip_and_corrupt_lines(spark, tmp_path):
    path = str(tmp_path / "log")
    assert logs.read_log(spark, path).count() == 0
    base = spark.createDataFrame([(1, 0.12345678, 3.14159)], "id bigint, s double, l double").withColumn("ts", F.to_timestamp(F.lit("2024-01-02 03:04:05.000006")))
    base = base.withColumn("d", decide(F.col("s")))
    entries = log_analytics.log_entries(base, "id", "ts", F.lit("hash"), "s", "d", "l", None, 20)
    logs.append_log(entries, path)
    logs.append_log(entries, path)
    raw = [r[0] for r in spark.read.text(path).collect()]
    assert len(raw) == 2 and list(json.loads(raw[0])) == sorted(json.loads(raw[0]))
    assert json.loads(raw[0])["timestamp"] == "2024-01-02T03:04:05.000006Z" and json.loads(raw[0])["client_id"] is None
    (tmp_path / "log" / "part-x.json").write_text('{"broken\n[1,2]\n\n' + raw[0] + "\n")
    got = logs.read_log(spark, path).collect()
    assert len(got) == 3 and {(r["prediction"], r["latency_ms"], r["features_count"]) for r in got} == {(0.123457, 3.14, 20)}


def test_line_limit_counts_before_parsing(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('bad\n{"request_id": "1"}\n{"request_id": "2"}\n')
    assert [r["request_id"] for r in logs.read_log(spark, str(path), limit=2).collect()] == ["1"]
    assert logs.read_log(spark, str(path), limit=0).count() == 2


def test_samples_fail_on_corrupt_lines(spark, tmp_path):
    path = tmp_path / "samples.jsonl"
    path.write_text('{"a": 1}\n\n{"a": 2}\n')
    assert logs.read_samples(spark, str(path), "a bigint").count() == 2
    path2 = tmp_path / "broken.jsonl"
    path2.write_text('{"a": 1}\n{"a"\n')
    with pytest.raises(Exception):
        logs.read_samples(spark, str(path2), "a bigint").collect()


def test_monitoring_events_append(spark, tmp_path):
    path = str(tmp_path / "events")
    logs.append_events(spark.createDataFrame([("ALERT", "x")], "kind string, message string"), path)
    assert spark.read.schema(logs.EVENT_SCHEMA).json(path).first()["kind"] == "ALERT"


def test_replays_and_load(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",)], "input_hash string")
    assert [tuple(r) for r in log_analytics.replayed_inputs(df).collect()] == [("a", 2)]
    load = spark.createDataFrame([(200, None, 10.0), (503, "down", 30.0)], "status int, error string, ms double")
    assert tuple(log_analytics.load_summary(load, "status", "error", "ms").first()) == (2, 1, 1, 20.0)


# ---- feature statistics ------------------------------------------------------


def stats(spark, rows, schema, numeric=None):
    df = spark.createDataFrame(rows, schema)
    return feature_stats.feature_stats(df, df.columns, numeric)


def test_statistics_and_report_round_trip(spark, tmp_path):
    rows = [(1.0, "b"), (3.0, "a"), (None, None), (float("nan"), "c")]
    got = stats(spark, rows, "x double, c string")
    by = {r["feature"]: r for r in got.collect()}
    assert by["x"]["mean"] == 2.0 and by["x"]["std"] == pytest.approx(2**0.5) and by["x"]["missing_pct"] == 0.5
    assert (by["c"]["min_str"], by["c"]["max_str"], by["c"]["missing_pct"], by["c"]["mean"]) == ("a", "c", 0.25, None)
    path = str(tmp_path / "stats")
    with pytest.raises(FileNotFoundError):
        reports.read_training_stats(spark, path)
    reports.write_report(got, path)
    assert reports.read_training_stats(spark, path).count() == 2


def test_compare_rules(spark):
    train = stats(spark, [(10.0, 5.0, 0.0, "a", 1.0), (12.0, 5.0, 0.0, "a", 1.0)], "shift double, const double, zero double, cat string, gone double")
    serve = stats(spark, [(20.0, 6.0, 0.2, None, 7.0)], "shift double, const double, zero double, cat string, extra double")
    got = {r["feature"]: r for r in feature_stats.compare_stats(train, serve).collect()}
    assert set(got) == {"shift", "cat", "gone"}
    assert got["shift"]["reason"] == "mean_shift" and got["cat"]["reason"] == "missing_pct_change" and got["gone"]["reason"] == "missing_feature"
    messages = {r["feature"]: r["message"] for r in feature_stats.failure_messages(feature_stats.compare_stats(train, serve)).collect()}
    assert messages == {
        "shift": "FEATURE_MISMATCH: shift mean deviation 82% REQUEST_REJECTED",
        "gone": "FEATURE_MISMATCH: gone missing in inference batch REQUEST_REJECTED",
    }


def test_check_needs_enough_samples(spark):
    train = stats(spark, [(10.0,), (12.0,)], "x double")
    samples = spark.createDataFrame([(99.0,), (98.0,)], "x double")
    assert feature_stats.feature_check(train, samples, ["x"]).count() == 1
    assert feature_stats.feature_check(train, samples, ["x"], min_samples=3).count() == 0
    assert feature_stats.feature_check(train, samples.limit(0), ["x"]).count() == 0
