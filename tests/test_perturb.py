"""Damage on purpose."""

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import ordered, perturb
from scorewatch.operators.contract import Contract, Field


@pytest.fixture(scope="module")
def labels(spark):
    return spark.range(1003).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))


@pytest.mark.parametrize("rows_per_cell", [1_000_000, 40])
@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.05, 0.333, 1.0])
def test_exactly_the_wanted_number_is_picked(labels, monkeypatch, rows_per_cell, fraction):
    monkeypatch.setattr(ordered, "ROWS_PER_CELL", rows_per_cell)
    picked = perturb.pick_exactly(labels, "id", fraction)
    assert picked.where("picked").count() == int(1003 * fraction) and picked.count() == 1003


def test_ties_of_the_hash_are_broken_by_key(labels, monkeypatch):
    monkeypatch.setattr(perturb, "shuffle_key", lambda key, seed: (key % 4).cast("double"))
    got = sorted(r["id"] for r in perturb.pick_exactly(labels, "id", 0.3).where("picked").collect())
    ids = sorted(range(1003), key=lambda i: (i % 4, i))[:300]
    assert got == sorted(ids)


def test_flip_and_majority(labels):
    flipped = perturb.inject_label_noise(labels, "id", "y", 0.1)
    meta = perturb.noise_metadata(flipped, "y", fraction=0.1).first()
    assert meta["num_flipped"] == 100 == meta["num_0_to_1_flips"] + meta["num_1_to_0_flips"]
    again = perturb.inject_label_noise(labels.repartition(5), "id", "y", 0.1)
    assert flipped.exceptAll(again).count() == 0
    other = perturb.inject_label_noise(labels, "id", "y", 0.1, seed=1)
    assert flipped.exceptAll(other).count() > 0
    major = perturb.inject_label_noise(labels, "id", "y", 0.1, "majority")
    meta = perturb.noise_metadata(major, "y", kind="majority").first()
    assert meta["num_0_to_1_flips"] == 0 and meta["num_flipped"] < 100
    with pytest.raises(ValueError):
        perturb.inject_label_noise(labels, "id", "y", 0.1, "other")


def test_majority_tie_is_zero(spark):
    df = spark.createDataFrame([(1, 0), (2, 1)], "id bigint, y int")
    assert [r["noisy_label"] for r in perturb.inject_label_noise(df, "id", "y", 1.0, "majority").collect()] == [0, 0]


def test_missing_labels(labels):
    meta = perturb.missing_label_metadata(perturb.inject_missing_labels(labels, "id", "y")).first()
    assert (meta["total_labels"], meta["missing_labels"], meta["available_labels"], meta["simulated_delay_days"]) == (1003, 100, 903, 30)


def test_token_shifts(spark):
    lines = ["2020-01-01 A11 6 -3 1.5 1d x 2", "7", "3 4"]
    df = spark.createDataFrame([(line,) for line in lines], "v string")
    assert [r[0] for r in df.select(perturb.shift_tokens(F.col("v"), 2.0)).collect()] == [
        "2020-01-01 A11 8 -1.0 3.5 1d x 2", "9", "5 4"
    ]
    contract = Contract("c", (Field("a", "integer"), Field("b", "timestamp"), Field("c", "integer")))
    df = spark.createDataFrame([("1 2 -3 4",), ("1 2",), ("x 2 1.5",)], "v string")
    assert [r[0] for r in df.select(perturb.shift_contract_tokens(F.col("v"), contract, 2.9)).collect()] == [
        "3 2 -1 4", "1 2", "x 2 4.4"
    ]


def test_bad_category_hits_the_first_rows(spark):
    df = spark.range(100).select("id", F.lit("A11").alias("c"))
    bad = perturb.bad_category(df, "c", F.col("id"), 50)
    assert bad.where("c = 'A999'").count() == 50 and bad.where("c = 'A999'").agg(F.max("id")).first()[0] == 49


@pytest.mark.parametrize("fraction", [0.1, 0.5, 0.97])
def test_repeated_and_null_keys_are_picked_exactly(spark, fraction):
    df = spark.createDataFrame([(None if i % 4 == 3 else i % 4, i % 2) for i in range(1000)], "k bigint, y int")
    marked = perturb.pick_exactly(df, "k", fraction)
    assert marked.count() == 1000 and marked.where("picked").count() == int(1000 * fraction)
