"""Exact order statistics, with cells small enough that every path runs."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from scorewatch.operators import ordered


def frame(spark, columns):
    size = max(len(v) for v in columns.values())
    rows = [tuple((float(v[i]) if i < len(v) and v[i] is not None else None) for v in columns.values()) for i in range(size)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))


def numpy_edges(values, bins):
    steps = min(bins, len(np.unique(values)))
    if steps < 2:
        return []
    return list(np.unique(np.quantile(values, np.linspace(0, 1, steps + 1))))


@pytest.fixture(scope="module")
def columns():
    rng = np.random.default_rng(7)
    hot = np.where(rng.random(3000) < 0.4, 5.0, rng.normal(0, 100, 3000))
    return {
        "normal": rng.normal(0, 1, 3000),
        "few": rng.integers(0, 4, 3000).astype(float),
        "hot": hot,
        "tight": 1.0 + rng.random(3000) * 1e-9,
        "constant": np.full(3000, 2.0),
    }


@pytest.mark.parametrize("rows_per_cell", [None, 300])
def test_edges_equal_numpy(spark, columns, rows_per_cell):
    got = ordered.quantile_edges(frame(spark, columns).repartition(5), list(columns), 10, rows_per_cell)
    for name, values in columns.items():
        assert got[name] == numpy_edges(values, 10), name


@pytest.mark.parametrize("rows_per_cell", [None, 200])
def test_order_statistics_count_rows_below(spark, columns, rows_per_cell):
    ranks = [0, 1, 777, 1500, 2998, 2999]
    got = ordered.order_statistics(frame(spark, columns), {c: ranks for c in columns}, None, rows_per_cell)
    for name, values in columns.items():
        ordered_values = np.sort(values)
        for rank in ranks:
            assert got[name][rank].value == ordered_values[rank]
            assert got[name][rank].below == int((values < ordered_values[rank]).sum())


def test_missing_values_are_left_out(spark):
    df = frame(spark, {"x": [1.0, None, float("nan"), 3.0], "empty": [None, None, None, None]})
    got = ordered.exact_quantiles(df, {"x": (0.0, 0.5, 1.0), "empty": (0.5,)})
    assert got == {"x": [1.0, 2.0, 3.0], "empty": [None]}


def test_cells_never_fall_along_the_column(spark, columns):
    df = frame(spark, {"x": columns["hot"]})
    cuts = ordered.sketch_columns(df, ["x"], 100)["x"].cuts
    assert len(cuts) > 5
    rows = ordered.with_cell(df, "x", cuts).orderBy("x").collect()
    cells = [r["cell"] for r in rows]
    assert cells == sorted(cells) and cells[0] == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=40), st.integers(2, 12))
def test_edges_of_small_integers(spark, values, bins):
    assert ordered.quantile_edges(frame(spark, {"x": values}), ["x"], bins)["x"] == numpy_edges(np.array(values, float), bins)


def test_a_value_heavier_than_a_cell_between_two_cuts(spark):
    values = [1.0] * 50 + [2.0] * 1000 + [3.0] * 50 + [2.5] * 3
    marks = {"x": ordered.ColumnSketch(len(values), 1.0, 3.0, (1.0, 3.0))}
    got = ordered.order_statistics(frame(spark, {"x": values}), {"x": [0, 60, 1049, 1050, 1102]}, marks, 100)["x"]
    assert [got[r].value for r in (0, 60, 1049, 1050, 1102)] == [1.0, 2.0, 2.0, 2.5, 3.0]
    assert (got[60].below, got[60].rows) == (50, 1000)
