"""Splits in time."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import ordered, splits


def days(spark, offsets):
    base = dt.date(2020, 1, 1)
    return spark.createDataFrame([(i, str(base + dt.timedelta(days=d))) for i, d in enumerate(offsets)], "id int, day string")


@pytest.mark.parametrize("n,p1,p2", [(3, 1, 2), (4, 2, 3), (5, 3, 4), (10, 6, 8), (200, 120, 160)])
def test_cut_positions(spark, n, p1, p2):
    cut = splits.temporal_cutoffs(days(spark, list(range(n)) * 2), "day")
    base = dt.date(2020, 1, 1)
    assert (cut.t1 - base).days == p1 and (cut.t2 - base).days == p2


def test_cut_is_on_days_not_rows(spark):
    df = splits.with_split(days(spark, [0] * 50 + list(range(1, 10))), "day")
    got = {r["split"]: r["rows"] for r in splits.split_report(df, "day").collect()}
    assert got == {"train": 55, "calibration": 2, "test": 2}


def test_too_few_days_and_bad_days(spark):
    with pytest.raises(splits.SplitError):
        splits.temporal_cutoffs(days(spark, [0, 1]), "day")
    with pytest.raises(splits.SplitError):
        splits.require_dates(spark.createDataFrame([("2020-01-01",), ("x",)], "day string"), "day")


def test_splits_are_disjoint_cover_and_do_not_leak(spark):
    df = splits.with_split(days(spark, [5, 3, 9, 1, 1, 7, 2, 8, 0, 4]), "day")
    assert df.where(F.col("split").isNull()).count() == 0
    splits.require_no_leakage(df, "day")
    mixed = df.withColumn("split", F.when(F.col("id") % 2 == 0, "train").otherwise("test"))
    with pytest.raises(splits.SplitError):
        splits.require_no_leakage(mixed, "day", ("train", "test"))
    empty = df.withColumn("split", F.lit("train"))
    assert splits.leakage_check(empty, "day").first()["status"] == "failed"


def test_two_way_has_no_clamp(spark):
    cut = splits.temporal_cutoffs(days(spark, [0]), "day", two_way=True)
    assert cut.t1 == dt.date(2020, 1, 1) and cut.t2 is None


@pytest.mark.parametrize("rows_per_cell", [1_000_000, 3])
@pytest.mark.parametrize(
    "offsets,kind",
    [([0, 0, 1, 2, 2, 5, 6, 7, 8, 9], "temporal"), ([9, 8, 8, 3, 2, 1, 1, 0, 0, 0], "temporal"),
     ([0, 1, 2, 3, 4, 5, 4, 7, 8, 9], "random"), ([3], "temporal")],
)
def test_split_type(spark, monkeypatch, rows_per_cell, offsets, kind):
    monkeypatch.setattr(ordered, "ROWS_PER_CELL", rows_per_cell)
    assert splits.infer_split_type(days(spark, offsets).repartition(3), "day", "id").first()[0] == kind


@pytest.mark.parametrize("kind", ["string", "date", "timestamp_ntz"])
def test_order_keys_of_other_types(spark, request, kind):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows end in one range
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
    key = F.format_string("key %04d", "id") if kind == "string" else day.cast(kind)
    for offsets, want, late in (([*range(40)], "temporal", 0), ([*range(20), 3, *range(21, 40)], "random", 1), ([*range(40, 0, -1)], "temporal", 39)):
        df = days(spark, offsets).withColumn("key", key).repartition(3)
        assert splits.infer_split_type(df, "day", "key").first()[0] == want
        assert splits.late_rows(df, "day", "key").first()[0] == late
        cells, _ = splits._with_key_cells(df.select("key", "day"), None)
        assert cells.select("cell").distinct().count() > 1


def test_split_type_of_absent_column(spark):
    assert splits.infer_split_type(days(spark, [0]), "nothing", "id").first()[0] == "unknown"


@pytest.mark.parametrize("rows_per_cell", [1_000_000, 4])
def test_manifest_counts_late_rows(spark, monkeypatch, rows_per_cell):
    monkeypatch.setattr(ordered, "ROWS_PER_CELL", rows_per_cell)
    offsets = [0, 1, 0, 5, 4, 5, 6, 2, 9, 9, 8, 9]
    got = splits.temporal_manifest(days(spark, offsets), "day", "id").first()
    assert (got["rows"], got["calendar_days"], got["days_present"], got["missing_days"], got["late_rows"]) == (12, 10, 8, 2, 4)
    missing = sorted(str(r[0]) for r in splits.missing_days(days(spark, offsets), "day").collect())
    assert missing == ["2020-01-04", "2020-01-08"]


def test_statistics_of_single_row_split(spark):
    rows = [("train", 1.0), ("train", 3.0), ("test", 5.0)]
    got = splits.split_statistics(spark.createDataFrame(rows, "split string, x double"), ["x"]).first()
    assert got["train_mean"] == 2.0 and got["test_std"] is None and got["shift_pct"] == 0.0


def test_target_warning(spark):
    rows = [("train", 0)] * 9 + [("train", 1)] + [("test", 1), ("test", 0)]
    got = splits.split_target_rates(spark.createDataFrame(rows, "split string, y int"), "y").first()
    assert got["target_shift"] and got["train_rate"] == pytest.approx(0.1) and got["test_pct"] == pytest.approx(100 / 6)
