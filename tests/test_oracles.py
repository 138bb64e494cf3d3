"""Every query against its SQL."""

import glob
import os

import duckdb
import pytest

from scorewatch.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(r[i]) for i in order) for r in rows)


def no_pairwise_join(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf, name):
    df = QUERIES[name](spark, sf)
    assert no_pairwise_join(df)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    want = table([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).limit(1).count() == 1


def test_flagship_prunes_columns_and_pushes_filters(spark, sf):
    from scorewatch.catalog import views

    ref, _ = views.event_sides(spark, sf)
    plan = ref.groupBy("event_type").count()._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan" in plan or "LessThan(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan
