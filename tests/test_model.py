"""Models against NumPy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorewatch.operators import features, isotonic, model as M, table_model
from scorewatch.operators.contract import Contract, Field
from scorewatch.plans import noise, training
from scorewatch.sources.models import load_active_model, load_model, save_model
from scorewatch.operators.governance import RegistryError

CONTRACT = Contract(
    "loans",
    (
        Field("event_time", "timestamp"), Field("kind", "categorical", ("a", "b", "c")), Field("age", "integer"),
        Field("amount", "integer"), Field("risk", "target", ("1", "2")),
    ),
    target="risk",
)


def raw(n=400, seed=11):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = str(rng.choice(["a", "b", "c"], p=[0.5, 0.3, 0.2]))
        age, amount = int(rng.integers(18, 80)), int(rng.integers(100, 9000))
        z = 0.04 * (age - 45) + (1.0 if kind == "c" else 0.0) + 0.0002 * (amount - 4000)
        risk = 2 if rng.random() < 1 / (1 + np.exp(-z)) else 1
        day = dt.date(2020, 1, 1) + dt.timedelta(days=i % 50)
        rows.append((i, str(day), kind if i % 17 else None, age if i % 13 else None, amount, risk))
    return rows


SCHEMA = "id bigint, event_time string, kind string, age bigint, amount bigint, risk int"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(raw(), SCHEMA).repartition(3)


def design(data):
    kinds = [r[2] for r in data]
    known = [k for k in kinds if k]
    mode = min(set(known), key=lambda k: (-known.count(k), k))
    kinds = [k or mode for k in kinds]
    ages = np.array([np.nan if r[3] is None else r[3] for r in data], float)
    ages = np.where(np.isnan(ages), np.nanmedian(ages), ages)
    amounts = np.array([r[4] for r in data], float)
    scale = lambda v: (v - v.mean()) / v.std()
    x = np.column_stack([*[[float(k == c) for k in kinds] for c in "abc"], scale(ages), scale(amounts)])
    return x, np.array([r[5] == 2 for r in data], float)


def optimum(x, y, strength, penalise):
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    ridge = np.ones(x1.shape[1])
    ridge[-1] = 1.0 if penalise else 0.0
    beta = np.zeros(x1.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x1 @ beta))
        g = ridge * beta + strength * x1.T @ (w * (p - y))
        h = np.diag(ridge) + strength * (x1.T * (w * p * (1 - p))) @ x1
        beta -= np.linalg.solve(h, g)
    return 1 / (1 + np.exp(-x1 @ beta))


@pytest.mark.parametrize("intercept", ["penalised", "free"])
def test_scores_equal_the_optimum(rows, intercept):
    data = raw()
    x, y = design(data)
    labelled = rows.withColumn("label", (F.col("risk") == 2).cast("int"))
    fitted = M.fit_model(labelled, CONTRACT.categorical, CONTRACT.numeric, "label", intercept)
    got = {r["id"]: r[M.SCORE] for r in M.score(fitted, labelled).select("id", M.SCORE).collect()}
    want = optimum(x, y, 0.01, intercept == "penalised")
    assert max(abs(got[d[0]] - w) for d, w in zip(data, want)) < 1e-6


def test_table_model_equals_the_optimum(spark, rows, tmp_path, monkeypatch):
    """Sparse rows, stripes and groups of the gradient change nothing; saved and read again it scores the same."""
    data = raw()
    x, y = design(data)
    labelled = rows.withColumn("label", (F.col("risk") == 2).cast("int")).withColumn("weight", F.lit("own")).withColumn("number", F.lit(1))
    want = optimum(x, y, 0.01, True)
    for stripe, most in ((1 << 16, 1 << 18), (2, 1)):
        monkeypatch.setattr(table_model, "STRIPE", stripe)
        monkeypatch.setattr(table_model, "BROADCAST_ROWS", most)
        fitted = table_model.fit_table_model(labelled, CONTRACT.categorical, CONTRACT.numeric, "label")
        scored = fitted.score(labelled)
        assert scored.columns == [*labelled.columns, M.SCORE]
        got = {r["id"]: r[M.SCORE] for r in scored.select("id", M.SCORE).collect()}
        assert len(got) == len(data) and max(abs(got[d[0]] - w) for d, w in zip(data, want)) < 1e-7
        fitted.save(str(tmp_path / f"m{stripe}"))
        again = {r["id"]: r[M.SCORE] for r in table_model.TableModel.load(spark, str(tmp_path / f"m{stripe}")).score(labelled).collect()}
        assert again == got
    new = spark.createDataFrame([("zzz", 40, 1000), ("a", None, None), (None, 40, 1000)], "kind string, age bigint, amount bigint")
    assert all(0 < r[M.SCORE] < 1 for r in fitted.score(new).collect())


def test_plan_of_a_table_model_does_not_grow_with_categories(spark):
    def plan(n):
        df = spark.range(4 * n).select(F.concat(F.lit("c"), (F.col("id") % n).cast("string")).alias("kind"), (F.col("id") % 3 == 0).cast("int").alias("label"))
        fitted = table_model.fit_table_model(df, ["kind"], [], "label", max_iterations=500)
        assert fitted.weights.count() == n
        return len(fitted.score(df)._jdf.queryExecution().optimizedPlan().toString())

    few, many = plan(10), plan(20_000)
    assert many < 1.2 * few


def test_table_model_counts_equal_rows(spark, monkeypatch):
    """Equal rows, null categories and labels included, are one row of the fit each."""
    rng, real, seen = np.random.default_rng(4), table_model.gradient, []
    data = [(f"k{int(k)}" if k else None, int(rng.random() < (k % 7 + 1) / 9)) for k in rng.integers(0, 40, 40_000)]
    df = spark.createDataFrame([*data, *[("k1", None)] * 9000, ("only", None)], "kind string, label int").repartition(5)

    def counted(rows, beta, n):
        seen.append(rows.count())
        return real(rows, beta, n)

    monkeypatch.setattr(table_model, "gradient", counted)
    monkeypatch.setattr(table_model, "STRIPE", 16)
    fitted = table_model.fit_table_model(df, ["kind"], [], "label")
    assert set(seen) == {80} and len(seen) <= 16 and fitted.fills == {"kind": "k1"}
    kinds = [k or "k1" for k, _ in data]
    x = np.column_stack([[float(k == c) for k in kinds] for c in sorted({*kinds})])
    want = dict(zip(kinds, optimum(x, np.array([y for _, y in data], float), 0.01, True)))
    got = {r["kind"]: r[M.SCORE] for r in fitted.score(df.select("kind").distinct()).collect()}
    assert len(got) == 41 and got[None] == got["k1"] and max(abs(got[k] - p) for k, p in want.items()) < 1e-7


def test_table_model_scores_a_stream(spark, tmp_path):
    from scorewatch.streaming import jobs

    df = spark.createDataFrame([(i, "xyz"[i % 3], float(i % 7), int(i % 5 == 0 or i % 3 == 2)) for i in range(300)], "id long, kind string, n double, label int")
    df.write.parquet(str(tmp_path / "in"))
    fitted = table_model.fit_table_model(df, ["kind"], ["n"], "label")
    out = jobs.drain(spark, lambda s: fitted.score(jobs.read_stream(s, str(tmp_path / "in"), "*.parquet", df.schema)).select("id", M.SCORE), "append", "table-model")
    batch = fitted.score(df).select("id", M.SCORE)
    assert out.exceptAll(batch).count() == 0 and out.count() == 300


def test_rows_are_numbered_in_order(spark):
    from scorewatch.operators.ordered import numbered

    values = np.random.default_rng(1).permutation(500)
    out, n = numbered(spark.createDataFrame([(int(v), str(v)) for v in values], "a long, b string").repartition(7), ["a"], "place")
    assert n == 500 and all(r["place"] == r["a"] for r in out.collect())
    none, n = numbered(spark.createDataFrame([], "a long"), ["a"], "place")
    assert n == 0 and none.count() == 0 and none.columns == ["a", "place"]


def test_unknown_category_scores_like_none_and_same_row_twice(spark, rows):
    labelled = rows.withColumn("label", (F.col("risk") == 2).cast("int"))
    fitted = M.fit_model(labelled, CONTRACT.categorical, CONTRACT.numeric, "label")
    new = spark.createDataFrame([("zzz", 40, 1000), ("a", 40, 1000), ("a", 40, 1000), ("a", None, None)], "kind string, age bigint, amount bigint")
    got = [r[M.SCORE] for r in M.score(fitted, new).collect()]
    assert all(0 < g < 1 for g in got) and got[1] == got[2] != got[0]


def brute_isotonic(x, y):
    """Pool adjacent violators over distinct scores, weights are their rows."""
    points = sorted(set(x))
    blocks = [[np.mean([b for a, b in zip(x, y) if a == p]), sum(a == p for a in x), [p]] for p in points]
    done = []
    for b in blocks:
        done.append(b)
        while len(done) > 1 and done[-2][0] >= done[-1][0]:
            v2, w2, p2 = done.pop()
            v1, w1, p1 = done.pop()
            done.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, p1 + p2])
    return {p: v for v, _, ps in done for p in ps}


def test_isotonic_equals_pooling(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.random(120), 2)
    y = (rng.random(120) < x).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "p double, y int")
    fitted = M.fit_calibrator(df, "p", "y")
    got = {r["p"]: r["calibrated"] for r in fitted.transform(df).collect()}
    want = brute_isotonic(x.tolist(), y.tolist())
    assert max(abs(got[p] - want[p]) for p in want) < 1e-9
    outside = fitted.transform(spark.createDataFrame([(-5.0,), (5.0,)], "p double")).collect()
    assert outside[0]["calibrated"] == pytest.approx(want[min(want)]) and outside[1]["calibrated"] == pytest.approx(want[max(want)])


def pools(x, y):
    sums = {}
    for a, b in zip(x, y):
        s, w = sums.get(a, (0, 0))
        sums[a] = (s + b, w + 1)
    lows = sorted(sums)
    return isotonic.pool(lows, lows, [sums[a][0] for a in lows], [sums[a][1] for a in lows])


SHAPES = {
    "rising": lambda rng, x: rng.random(len(x)) < x,
    "falling": lambda rng, x: rng.random(len(x)) < 1 - x,
    "noise": lambda rng, x: rng.random(len(x)) < 0.5,
    "wave": lambda rng, x: rng.random(len(x)) < 0.5 + 0.4 * np.sin(20 * x) + 0.1 * x,
    "exact": lambda rng, x: x > 0.5,
    "one hot score": lambda rng, x: (rng.random(len(x)) < x) & (x > 0.2),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_steps_equal_pooling_whatever_the_cells(spark, shape):
    rng = np.random.default_rng(5)
    x = np.round(rng.random(4000), 4)
    if shape == "one hot score":
        x[rng.random(4000) < 0.4] = 0.7
    y = SHAPES[shape](rng, x).astype(int)
    odd_rows = [(None, 1, 1), (0.5, None, 2), (float("nan"), 1, 3)]
    df = spark.createDataFrame([(float(a), int(b), 0) for a, b in zip(x, y)] + odd_rows, "p double, y int, lo int").repartition(5)
    lo, hi, s, w = pools(x.tolist(), y.tolist())
    steps = isotonic.isotonic_steps(df, "p", "y", rows_per_cell=97)
    got = sorted((r["lo"], r["hi"], round(r["value"], 9), r["weight"]) for r in steps.collect())
    assert got == [(a, b, round(t / n, 9), n) for a, b, t, n in zip(lo, hi, s, w)]
    asked = sorted({*x.tolist(), -1.0, 2.0, *rng.random(300).tolist()})
    table = spark.createDataFrame([(a, 1) for a in asked] * 2 + [(None, 1)], "p double, x int")
    found = isotonic.apply_steps(table, "p", steps, "value", rows_per_cell=61).collect()
    want = dict(zip(asked, np.interp(asked, [v for pair in zip(lo, hi) for v in pair], [t / n for t, n in zip(s, w) for _ in range(2)])))
    assert len(found) == 2 * len(asked) + 1 and all(r["value"] is None if r["p"] is None else abs(r["value"] - want[r["p"]]) < 1e-9 for r in found)


def test_steps_of_few_rows(spark):
    df = spark.createDataFrame([], "p double, y int")
    assert isotonic.isotonic_steps(df, "p", "y").count() == 0
    one = spark.createDataFrame([(0.3, 1)], "p double, y int")
    assert [tuple(r) for r in isotonic.isotonic_steps(one, "p", "y").collect()] == [(0.3, 0.3, 1.0, 1.0)]
    with pytest.raises(ValueError, match="2 steps"):
        M.fit_calibrator(spark.createDataFrame([(0.3, 0), (0.4, 1)], "p double, y int"), "p", "y", most_steps=1)


@pytest.fixture(scope="module")
def run(rows):
    return training.train(rows, CONTRACT, "event_time")


def test_training_run(run):
    report = {r["split"]: r["rows"] for r in run.split_report.collect()}
    assert sum(report.values()) == 400 and set(report) == {"train", "calibration", "test"}
    meta = run.metadata.first()
    assert 0.5 < meta["roc_auc"] <= 1 and meta["rows"] == 400 and meta["model_version"] == "v1"
    assert {r["feature"] for r in run.training_stats.collect()} == {"kind", "age", "amount"}
    assert {r["target"]: r["target_rows"] for r in run.summary.collect()}.keys() == {1, 2}


def test_calibrated_model_saves_and_resolves(spark, run, tmp_path):
    final, report = training.calibrate(run.model, run.table)
    row = report.first()
    assert row["brier_score_after"] <= row["brier_score_before"] and row["calibration_gap_after"] < 1e-9
    assert (M.model_kind(run.model), M.model_kind(final)) == ("base", "calibrated")
    with pytest.raises(TypeError):
        M.model_kind(object())
    save_model(final, str(tmp_path / "models/approved/m1"))
    again = load_model(str(tmp_path / "models/approved/m1"))
    a, b = (M.score(m, run.table).orderBy("id").select(M.SCORE).collect() for m in (final, again))
    assert a == b
    registry = str(tmp_path / "registry")
    with pytest.raises(RegistryError):
        load_active_model(spark, registry, str(tmp_path / "models"))
    spark.createDataFrame([(1, "approved/m1", True), (2, "candidate/m2", False)], "seq bigint, artifact string, approved boolean").write.parquet(registry)
    assert M.model_kind(load_active_model(spark, registry, str(tmp_path / "models"))) == "calibrated"


def test_evaluate_on_test_part(run):
    row = training.evaluate(run.model, run.table).first()
    assert 0 <= row["approval_rate"] <= 1 and row["decision_threshold"] == 0.3


def test_noise_run(rows):
    out = noise.noise_robustness(rows, CONTRACT, "event_time", "id", fraction=0.2)
    meta, comparison = out.metadata.first(), out.comparison.first()
    assert meta["num_flipped"] == int(meta["total_labels"] * 0.2)
    assert 0 <= comparison["noisy_auc"] <= 1


def test_preprocessing(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 3.0), ("y", None), ("x", 10.0), (None, 3.0)], "c string, n double")
    assert {r["feature"]: r["fill"] for r in features.modes(df, ["c"]).collect()} == {"c": "x"}
    assert features.medians(df, ["n"]) == {"n": 3.0}
    scales = features.fit_scales(df.withColumn("k", F.lit(4.0)), ["n", "k"])
    values = np.array([1, 3, 10, 3.0])
    assert scales["n"].mean == pytest.approx(values.mean()) and scales["n"].std == pytest.approx(values.std())
    assert scales["k"].std == 1.0
    hot = df.select(*features.one_hot_columns("c", ["x", "y"])).collect()
    assert [tuple(r) for r in hot] == [(1, 0), (0, 1), (0, 1), (1, 0), (0, 0)]


def test_number_of_categories_is_free_unless_bounded(spark):
    df = spark.range(30).select(F.concat(F.lit("c"), "id").alias("kind"), F.lit("x").alias("other"))
    counts = features.category_counts(df, ["kind", "other"])
    assert len(counts["kind"]) == 30 and counts["other"] == {"x": 30}
    assert features.category_counts(df, ["kind", "other"], 30) == counts
    with pytest.raises(ValueError, match="kind has 30 values"):
        features.category_counts(df, ["kind", "other"], 29)


def test_batch_score_covers_every_application(spark, sf):
    from scorewatch.catalog import QUERIES, views

    scored = QUERIES["batch_score"](spark, sf).cache()
    apps = views.applications(spark, sf).select("app_id")
    assert scored.count() == apps.count() and scored.select("app_id").exceptAll(apps).count() == 0
    assert {r["split"] for r in scored.select("split").distinct().collect()} == {"train", "calibration", "test"}
    assert scored.where("prediction IS NULL OR decision IS NULL").count() == 0
