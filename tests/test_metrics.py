"""Score quality against brute force."""

import numpy as np
import pytest

from scorewatch.functions import fixed
from scorewatch.functions.buckets import unit_edges
from scorewatch.operators import metrics, ordered


def brute_auc(scores, labels):
    pos, neg = scores[labels == 1], scores[labels == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    scores = np.round(rng.random(800), 2)
    labels = (rng.random(800) < scores).astype(int)
    groups = rng.choice(["a", "b", "c"], 800, p=[0.7, 0.2, 0.1])
    df = spark.createDataFrame([(str(g), float(s), int(y)) for g, s, y in zip(groups, scores, labels)], "g string, p double, y int")
    return df, groups, scores, labels


@pytest.mark.parametrize("rows_per_cell", [1_000_000, 60])
def test_auc_with_ties_and_groups(scored, monkeypatch, rows_per_cell):
    monkeypatch.setattr(ordered, "ROWS_PER_CELL", rows_per_cell)
    df, groups, scores, labels = scored
    assert metrics.roc_auc(df, "p", "y").collect()[0]["roc_auc"] == pytest.approx(brute_auc(scores, labels), abs=1e-12)
    for row in metrics.roc_auc(df, "p", "y", ["g"]).collect():
        pick = groups == row["g"]
        assert row["roc_auc"] == pytest.approx(brute_auc(scores[pick], labels[pick]), abs=1e-12)


def test_auc_turned_round_adds_to_one(scored):
    df, *_ = scored
    turned = df.selectExpr("-p as p", "y")
    both = [metrics.roc_auc(x, "p", "y").collect()[0][0] for x in (df, turned)]
    assert sum(both) == pytest.approx(1.0, abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.9, 1)], "p double, y int")
    assert metrics.roc_auc(df, "p", "y").collect()[0]["roc_auc"] is None


def test_calibration_edges_are_half_open_but_the_last(spark):
    edges = unit_edges(10)
    assert edges[3] == 0.30000000000000004 and edges[7] == 0.7000000000000001
    df = spark.createDataFrame([(x, 1) for x in (0.0, 0.3, edges[3], 0.7, 1.0, 1.5, -0.1)], "p double, y int")
    bins = {r["bin"]: r["rows"] for r in metrics.calibration_bins(df, "p", "y").collect()}
    assert bins == {0: 1, 2: 1, 3: 1, 6: 1, 9: 1}


def test_gap_is_the_largest_and_zero_without_rows(spark):
    df = spark.createDataFrame([(0.05, 0), (0.95, 0), (0.95, 1)], "p double, y int")
    assert metrics.calibration_gap(df, "p", "y").collect()[0][0] == pytest.approx(0.45)
    assert metrics.calibration_gap(df.limit(0), "p", "y").collect()[0][0] == 0.0


def test_summary_of_empty_batch(spark):
    df = spark.createDataFrame([], "p double")
    assert tuple(metrics.summarise_batch(df, "p").collect()[0]) == (0.0, 0.0, 0.0)


def test_compare_scores(spark):
    rows = [(0.9, 0.2, 1), (0.6, 0.5, 1), (0.2, 0.6, 0), (0.5, 0.1, 0)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    got = metrics.compare_scores(df, "a", "b", "y").collect()[0]
    assert got["clean_accuracy"] == 1.0 and got["clean_precision"] == 1.0 and got["clean_recall"] == 1.0
    assert got["noisy_accuracy"] == 0.25 and got["noisy_precision"] == 0.0 and got["noisy_recall"] == 0.0
    assert got["noisy_auc"] == 0.5 and got["delta_auc"] == 0.5


def test_histogram_is_cumulative(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.005, 0.01, 0.3, 7.0)], "v double")
    rows = {r["le"]: r["cumulative"] for r in metrics.cumulative_histogram(df, "v", fixed.LATENCY_BOUNDS).collect()}
    assert rows["0.01"] == 3 and rows["0.25"] == 3 and rows["0.5"] == 4 and rows["5.0"] == 4 and rows["+Inf"] == 5


def test_histogram_quantile_interpolates_and_stops_at_the_last_bound(spark):
    df = spark.createDataFrame([(x,) for x in (0.3, 0.4, 0.4, 0.6)], "v double")
    got = metrics.histogram_quantiles(df, "v", fixed.LATENCY_BOUNDS, (0.5, 0.95)).collect()[0]
    assert got["p50"] == pytest.approx(0.25 + 0.25 * 2 / 3)
    assert got["p95"] == pytest.approx(0.5 + 0.5 * 0.8)
    high = spark.createDataFrame([(9.0,)], "v double")
    assert metrics.histogram_quantiles(high, "v", fixed.LATENCY_BOUNDS, (0.5,)).collect()[0]["p50"] == 5.0


def test_groups_of_null_keys_stay(spark):
    rows = [(None, 0.9, 1), (None, 0.2, 0), ("a", 0.4, 1), ("a", 0.6, 0)]
    df = spark.createDataFrame(rows, "g string, score double, label int")
    got = {r.g: r.roc_auc for r in metrics.evaluate_scores(df, "score", "label", ["g"]).collect()}
    assert got == {None: 1.0, "a": 0.0}
    assert metrics.classification_metrics(df, ["score"], "label", ["g"]).count() == 2


def test_metrics_come_from_one_exchange_of_the_rows(spark):
    df = spark.createDataFrame([(i % 7 / 10, i % 3 / 10, i % 2) for i in range(200)], "a double, b double, y int")
    for found in (metrics.evaluate_scores(df, "a", "y"), metrics.classification_metrics(df, ["a", "b"], "y")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan ExistingRDD") == 1 and "Join" not in plan


def test_metrics_with_missing_scores_and_labels(spark):
    rows = [(0.9, 1, "g"), (0.2, 0, "g"), (None, 1, "g"), (0.7, None, "g"), (0.1, 1, None), (0.6, 0, None)]
    df = spark.createDataFrame(rows, "a double, y int, grp string")
    got = {(r["grp"], r["model"]): r for r in metrics.classification_metrics(df, ["a"], "y", ["grp"]).collect()}
    one, none = got["g", "a"], got[None, "a"]
    assert (one["accuracy"], one["precision"], one["recall"], one["auc"]) == (2 / 4, 1 / 2, 1 / 2, 1.0)
    assert (none["accuracy"], none["precision"], none["recall"], none["auc"]) == (0.0, 0.0, 0.0, 0.0)
    whole = metrics.evaluate_scores(df, "a", "y").first()
    assert whole["approval_rate"] == 2 / 5 and whole["roc_auc"] == 0.5
    empty = metrics.evaluate_scores(df.where("false"), "a", "y").first()
    assert empty["approval_rate"] is None and empty["roc_auc"] is None
