"""PSI and KS against plain NumPy."""

import math

import numpy as np
import pytest

from scorewatch.operators import drift, ordered
from scorewatch.plans.drift_run import drift_run

FLOOR = 1e-6


def brute_numeric(ref, cur, bins=10):
    ref, cur = np.asarray(ref, float), np.asarray(cur, float)
    if not len(ref) or not len(cur) or len(np.unique(ref)) < 2:
        return 0.0
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, min(bins, len(np.unique(ref))) + 1)))

    def shares(v):
        bucket = np.where(v == edges[0], 1, np.searchsorted(edges, v, side="left"))
        bucket = bucket[(bucket >= 1) & (bucket < len(edges))]
        return None if not len(bucket) else np.bincount(bucket, minlength=len(edges))[1:] / len(bucket)

    r, c = shares(ref), shares(cur)
    if c is None:
        return 0.0
    r, c = np.where(r == 0, FLOOR, r), np.where(c == 0, FLOOR, c)
    return float(((c - r) * np.log(c / r)).sum())


def brute_categorical(ref, cur):
    total = 0.0
    for k in set(ref) | set(cur):
        r, c = ref.count(k) / len(ref) or FLOOR, cur.count(k) / len(cur) or FLOOR
        total += (c - r) * math.log(c / r)
    return total


def brute_ks(a, b):
    points = np.unique(np.concatenate([a, b]))
    return max(abs((a <= p).mean() - (b <= p).mean()) for p in points)


def column(spark, values, kind="double", name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def numeric_psi(spark, ref, cur, **options):
    got = drift.psi(column(spark, ref), column(spark, cur), drift.Features(("x",)), **options)
    return got.collect()[0]["psi"]


def test_identical_series_have_no_drift(spark):
    assert abs(numeric_psi(spark, [1.0, 2.0, 3.0, 4.0, 5.0], [1.0, 2.0, 3.0, 4.0, 5.0])) < 1e-8


def test_shift_is_seen(spark):
    rng = np.random.default_rng(1)
    ref, cur = rng.normal(0, 1, 2000).tolist(), rng.normal(3, 1, 2000).tolist()
    got = numeric_psi(spark, ref, cur)
    assert got > 0.2 and got == pytest.approx(brute_numeric(ref, cur), abs=1e-9)


@pytest.mark.parametrize(
    "ref,cur",
    [
        ([1.0, 1.0, 1.0, 2.0], [2.0, 2.0, 2.0, 1.0]),  # two edges only: nothing can show
        ([1.0, 2.0], [2.0, 2.0, 2.0]),
        ([1.0, 1.0], [5.0]),  # constant reference
        ([1.0, 2.0, 3.0], [10.0, 11.0]),  # all out of range
        ([1.0, 2.0, 3.0, 4.0], [2.0, 50.0, -7.0, 3.5]),  # some out of range
        ([0.0] * 50 + [1.0, 2.0, 3.0], [3.0, 2.0, 0.0]),
    ],
)
def test_special_cases(spark, ref, cur):
    assert numeric_psi(spark, ref, cur) == pytest.approx(brute_numeric(ref, cur), abs=1e-9)


def test_empty_sides_and_missing_values(spark):
    assert numeric_psi(spark, [1.0, 2.0], [None]) == 0.0
    assert numeric_psi(spark, [None], [1.0, 2.0]) == 0.0
    ref, cur = [1.0, None, 2.0, float("nan"), 3.0], [1.0, 1.0, None]
    assert numeric_psi(spark, ref, cur) == pytest.approx(brute_numeric([1, 2, 3], [1, 1]), abs=1e-9)


def test_open_ended_sees_what_drop_ignores(spark):
    ref, cur = [float(i) for i in range(100)], [1000.0] * 50
    assert numeric_psi(spark, ref, cur) == 0.0
    assert numeric_psi(spark, ref, cur, out_of_range="open_ended") > 1.0


def test_categorical(spark):
    ref, cur = list("aaabbc"), list("aabddd")
    got = drift.psi(column(spark, ref, "string"), column(spark, cur, "string"), drift.Features((), ("x",))).collect()
    assert got[0]["psi"] == pytest.approx(brute_categorical(ref, cur), abs=1e-9)


@pytest.mark.parametrize("rows_per_cell", [1_000_000, 50])
def test_ks(spark, monkeypatch, rows_per_cell):
    monkeypatch.setattr(ordered, "ROWS_PER_CELL", rows_per_cell)
    rng = np.random.default_rng(2)
    for a, b in [
        (rng.normal(0, 1, 200), rng.normal(0.5, 1, 200)),
        (rng.integers(0, 5, 300).astype(float), rng.integers(1, 7, 100).astype(float)),
        (np.array([1.0]), np.array([2.0])),
    ]:
        got = drift.ks_statistic(column(spark, a.tolist()), column(spark, b.tolist()), ["x"]).collect()[0]["ks"]
        assert 0.0 <= got <= 1.0 and got == pytest.approx(brute_ks(a, b), abs=1e-12)


def test_ks_of_empty_side_is_zero(spark):
    assert drift.ks_statistic(column(spark, [1.0, 2.0]), column(spark, [None]), ["x"]).collect()[0]["ks"] == 0.0


def test_psi_is_never_negative(spark):
    rng = np.random.default_rng(3)
    for _ in range(3):
        assert numeric_psi(spark, rng.normal(size=80).tolist(), rng.normal(size=15).tolist()) >= -1e-12


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(4)

    def rows(n, shift, days):
        return [
            (f"2024-01-{1 + int(rng.integers(0, days)):02d}", int(rng.integers(0, 50) + shift), str(rng.choice(list("abc"))))
            for _ in range(n)
        ]

    schema = "event_time string, age bigint, kind string"
    ref, cur = rows(300, 0, 20), rows(200, 20, 5) + [("not a day", 1, "a")]
    return spark.createDataFrame(ref, schema), spark.createDataFrame(cur, schema), ref, cur


def test_by_day_takes_the_largest_feature(spark, sides):
    reference, current, ref, cur = sides
    got = {str(r["event_day"]): r["psi"] for r in drift.psi_by_day(
        reference, current, drift.Features(("age",), ("kind",)), "event_time").collect()}
    want = {}
    for day in {c[0] for c in cur if c[0].startswith("2024")}:
        part = [c for c in cur if c[0] == day]
        want[day] = max(
            brute_numeric([r[1] for r in ref], [c[1] for c in part]),
            brute_categorical([r[2] for r in ref], [c[2] for c in part]),
        )
    assert got.keys() == want.keys()
    for day in want:
        assert got[day] == pytest.approx(want[day], abs=1e-9)


def test_trend_carries_rows_and_first_feature_on_ties(spark):
    ref = spark.createDataFrame([(1, "2024-01-01", 1.0, 1.0)] * 3, "id int, event_time string, b double, a double")
    got = drift.psi_trend(ref, ref, drift.Features(("b", "a")), "event_time").collect()
    assert [(str(r["event_time"]), r["rows"], r["max_psi"], r["max_psi_feature"]) for r in got] == [("2024-01-01", 3, 0.0, "b")]


def test_report_compares_the_time_column_only_when_asked(spark, sides):
    reference, current, *_ = sides
    features = drift.Features(("age",), ("kind",))
    with_time = {r["feature"]: r for r in drift.drift_report(reference, current, features, "event_time").collect()}
    without = {r["feature"]: r for r in drift.drift_report(reference, current, features, "event_time", include_time=False).collect()}
    assert set(with_time) == {"age", "kind", "event_time"} and set(without) == {"age", "kind"}
    assert with_time["kind"]["ks"] is None and with_time["age"]["alert"]


def test_full_run(spark, sides):
    reference, current, *_ = sides
    registry = spark.createDataFrame(
        [("2024-01-02", 1, "approved/a", True), ("2024-01-04", 2, "approved/b", True), ("2024-01-04", 3, "candidate/c", False)],
        "decided_on string, seq bigint, artifact string, approved boolean",
    ).selectExpr("cast(decided_on as date) decided_on", "seq", "artifact", "approved")
    run = drift_run(reference, current, drift.Features(("age",), ("kind",)), "event_time", registry=registry)
    head = run.run.collect()[0]
    assert head["breach"] and head["prediction_psi"] is None
    alerts = {str(r["event_day"]) for r in run.alerts.collect()}
    actions = {str(r["event_day"]): (r["status"], r["active_model"]) for r in run.actions.collect()}
    assert alerts == set(actions)
    assert actions["2024-01-01"] == ("no_approved_model", None)
    assert actions["2024-01-03"] == ("rolled_back", "approved/a")
    assert actions["2024-01-05"] == ("rolled_back", "approved/b")
    kinds = [r["kind"] for r in run.events.orderBy("seq").collect()]
    assert kinds[0] == "METRIC" and kinds[-2:] == ["BREACH", "ALERT"] and kinds.count("TEMPORAL_PSI") == 5


@pytest.mark.parametrize("per_cell", [1_000_000, 40])
def test_report_and_trend_from_one_cube(spark, monkeypatch, per_cell):
    monkeypatch.setattr("scorewatch.operators.ordered.ROWS_PER_CELL", per_cell)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(900):
        x = None if i % 31 == 0 else float("nan") if i % 37 == 0 else float(rng.normal(0.2 if i > 500 else 0, 1))
        rows.append((x, int(rng.integers(0, 6)), [None, "a", "b", "b"][int(rng.integers(0, 4))], "no date" if i % 53 == 0 else f"2024-01-{1 + i // 50:02}"))
    df = spark.createDataFrame(rows, "x double, n int, kind string, at string")
    ref, cur = df.where("at < '2024-01-09'"), df.where("NOT at < '2024-01-09'")
    features = drift.Features(("x", "n"), ("kind",))
    report, trend = drift.report_and_trend(ref, cur, features, "at")
    wanted = drift.drift_report(ref, cur, features, "at"), drift.psi_trend(ref, cur, features, "at")
    for got, want in zip((report, trend), wanted):
        assert got.columns == want.columns
        rounded = [sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r]) for r in t.collect()) for t in (got, want)]
        assert rounded[0] == rounded[1] and len(rounded[0]) >= 4
    report, trend = drift.report_and_trend(ref, cur.where("false"), features, "at")
    assert trend.count() == 0 and report.count() == drift.drift_report(ref, cur.where("false"), features, "at").count()
