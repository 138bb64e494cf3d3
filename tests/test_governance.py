"""Approvals, the active version, rollbacks."""

import pytest

from scorewatch.operators import governance as G


def candidates(spark, rows):
    return spark.createDataFrame(rows, "seq bigint, artifact string, roc_auc double, calibration_gap_after double")


def registry(spark, rows):
    return G.registry_entries(G.policy_gate(candidates(spark, rows)), "seq", "artifact")


def test_gate_includes_its_bounds(spark):
    rows = [(1, "a", 0.8, 0.1), (2, "b", 0.79999, 0.0), (3, "c", 0.95, 0.1001), (4, "d", None, 0.0)]
    got = {r["artifact"]: r["approved"] for r in G.policy_gate(candidates(spark, rows)).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": False}


def test_rejection_keeps_the_active_model(spark):
    reg = registry(spark, [(1, "m1", 0.5, 0.9), (2, "m2", 0.95, 0.02), (3, "m3", 0.1, 0.9)])
    got = [(r["artifact"], r["active_model"]) for r in G.active_model_asof(reg).orderBy("seq").collect()]
    assert got == [("candidate/m1", None), ("approved/m2", "approved/m2"), ("candidate/m3", "approved/m2")]
    assert G.rollback(reg) == {"status": "rolled_back", "active_model": "approved/m2"}


def test_rollback_takes_the_latest_and_can_step_back(spark):
    reg = registry(spark, [(1, "m1", 0.9, 0.0), (2, "m2", 0.9, 0.0)])
    assert G.rollback(reg)["active_model"] == "approved/m2"
    assert G.rollback(reg, exclude=["approved/m2"])["active_model"] == "approved/m1"


def test_nothing_approved_is_an_error(spark):
    with pytest.raises(G.RegistryError):
        G.rollback(registry(spark, [(1, "m1", 0.1, 0.9)]))


def test_registry_table_grows(spark, tmp_path):
    path = str(tmp_path / "registry")
    G.append_registry(registry(spark, [(1, "m1", 0.9, 0.0)]), path)
    G.append_registry(registry(spark, [(2, "m2", 0.1, 0.0)]), path)
    assert spark.read.parquet(path).count() == 2
    assert G.latest_approved(spark.read.parquet(path)).first()["active_model"] == "approved/m1"
