"""Contracts for token text and for requests."""

import json

import pytest
from pyspark.sql import functions as F

from scorewatch.operators import contract as C
from scorewatch.operators import perturb
from scorewatch.sources.text import read_lines, read_scores

DOC = {
    "dataset_name": "loans", "source_file": "loans.txt", "expected_rows": 3, "expected_columns": 4,
    "target_column": "risk", "target_encoding": {"1": "good", "2": "bad"}, "cost_matrix": {},
    "fields": [
        {"name": "event_time", "type": "timestamp"},
        {"name": "account", "type": "categorical", "allowed_values": ["A11", "A12"]},
        {"name": "age", "type": "integer"},
        {"name": "risk", "type": "target", "allowed_values": [1, 2]},
    ],
}
GOOD = ["2020-01-01 A11 67 1", "2020-01-02  A12\t22 2", " 2020-01-03 A11 -4 1 "]


@pytest.fixture
def contract(tmp_path):
    path = tmp_path / "contract.json"
    path.write_text(json.dumps(DOC))
    return C.Contract.load(path)


def lines(spark, rows):
    return spark.createDataFrame(list(enumerate(rows, 1)), "line_no bigint, value string")


def violations(spark, contract, rows):
    return [tuple(r) for r in C.contract_violations(lines(spark, rows), contract, "line_no").orderBy("row_id", "ordinal").collect()]


def test_declaration(contract, spark):
    assert contract.names == ["event_time", "account", "age", "risk"]
    assert contract.categorical == ["account"] and contract.numeric == ["age"] and contract.features == ["account", "age"]
    assert contract.fields[3].allowed == ("1", "2") and contract.extra["target_encoding"] == {"1": "good", "2": "bad"}
    schema = contract.struct()
    assert [f.dataType.simpleString() for f in schema] == ["string", "string", "bigint", "int"]
    assert schema["account"].metadata["allowed_values"] == ["A11", "A12"]
    assert contract.rules(spark).count() == 6


def test_unknown_type_is_refused():
    with pytest.raises(C.ContractError):
        C.Field("x", "number")


def test_valid_rows_load(spark, contract):
    rows = C.load_validated(lines(spark, GOOD), contract, "line_no").orderBy("line_no").collect()
    assert [tuple(r) for r in rows] == [
        (1, "2020-01-01", "A11", 67, 1), (2, "2020-01-02", "A12", 22, 2), (3, "2020-01-03", "A11", -4, 1)
    ]


def test_extra_column(spark, contract):
    bad = lines(spark, GOOD).withColumn("value", perturb.append_token(F.col("value")))
    with pytest.raises(C.ContractError, match="row 1: column_count"):
        C.load_validated(bad, contract, "line_no")


def test_unknown_category(spark, contract):
    bad = lines(spark, GOOD).withColumn("value", perturb.bad_category_token(F.col("value"), F.col("line_no") - 1, 1))
    with pytest.raises(C.ContractError, match="row 1: membership account 'A999'"):
        C.load_validated(bad, contract, "line_no")


def test_wrong_number_of_rows(spark, contract):
    with pytest.raises(C.ContractError, match="1 rows; expected 3"):
        C.load_validated(lines(spark, GOOD[:1]), contract, "line_no")


def test_all_violations_in_order(spark, contract):
    got = violations(spark, contract, ["2020 A13 x 3", "  ", "a b", "2020 A11 +5 1", "2020 A11 99999999999999999999 2", "2020 A11 1.0 2", ""])
    assert got == [
        (1, 1, "account", "membership", "A13"), (1, 2, "age", "integer", "x"), (1, 3, "risk", "membership", "3"),
        (2, -1, "", "empty_row", "  "), (3, -1, "", "column_count", "2"), (4, 2, "age", "integer", "+5"),
        (5, 2, "age", "integer", "99999999999999999999"), (6, 2, "age", "integer", "1.0"), (7, -1, "", "empty_row", ""),
    ]


def test_any_unicode_space_separates_tokens(spark, contract):
    assert violations(spark, contract, ["2020 A11 5　1"]) == []


def test_summary_and_feature_frame(spark, contract):
    rows = C.load_validated(lines(spark, GOOD), contract, "line_no")
    got = {r["target"]: r for r in C.dataset_summary(rows, contract, "abc").collect()}
    assert got[1]["target_rows"] == 2 and got[2]["target_rows"] == 1
    assert got[1]["rows"] == 3 and got[1]["columns"] == 4 and got[1]["data_hash"] == "abc"
    assert C.feature_frame(rows, contract).columns == ["account", "age"]


# ---- requests ----------------------------------------------------------------


def request(spark, contract, payload):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    df = spark.createDataFrame([(1, text)], "id int, payload string")
    return [(r["field"], r["rule"]) for r in C.validate_requests(df, "id", "payload", contract, {"age": (18, 120)}).collect()]


def test_valid_request(spark, contract):
    assert request(spark, contract, {"account": "A11", "age": 30}) == []


def test_extra_missing_and_wrong_values(spark, contract):
    assert request(spark, contract, {"account": "A11", "age": 30, "extra": "x"}) == [("extra", "extra")]
    assert request(spark, contract, {"account": "A11"}) == [("age", "missing")]
    assert request(spark, contract, {"account": "BAD", "age": 17}) == [("account", "membership"), ("age", "range")]
    assert request(spark, contract, {"account": "A12", "age": 30.5}) == [("age", "integer")]
    assert request(spark, contract, {"account": "A12", "age": 30.0}) == []
    assert request(spark, contract, "not json") == [("", "not_an_object")]


def test_request_flags_and_dropped_key(spark, contract):
    from scorewatch.functions.decisions import request_outcome, status_code

    rows = [('{"account":"A11","age":30}',), ('{"account":"A19","age":30}',), ('{"age":30}',)]
    df = spark.createDataFrame(rows, "payload string").withColumn("f", C.payload_fields(F.col("payload")))
    df = df.withColumn("v", C.request_violations("f", contract))
    flags = C.request_flags(F.col("v"))
    got = [tuple(r) for r in df.select(request_outcome(flags), status_code(flags)).collect()]
    assert got == [("success", 200), ("validation_error", 400), ("malformed", 422)]
    dropped = df.select(perturb.drop_key(F.col("payload"), "age")).first()[0]
    assert json.loads(dropped) == {"account": "A11"}


# ---- files -------------------------------------------------------------------


def test_lines_are_numbered_per_file(spark, tmp_path):
    for name, n in (("a.txt", 5000), ("b.txt", 3)):
        (tmp_path / name).write_text("".join(f"{name} {i}\n" for i in range(1, n + 1)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 5003
    assert all(r["value"] == f"{r['file'].rsplit('/', 1)[1]} {r['line_no']}" for r in rows)


def test_score_files(spark, tmp_path):
    (tmp_path / "array.json").write_text("[0.1,\n 0.5, 1]")
    (tmp_path / "lines.txt").write_text("0.1\n\n 0.5 \n1\n")
    (tmp_path / "bad.txt").write_text("0.1\nabc\n")
    for name in ("array.json", "lines.txt"):
        assert sorted(r[0] for r in read_scores(spark, str(tmp_path / name)).collect()) == [0.1, 0.5, 1.0]
    with pytest.raises(Exception):
        read_scores(spark, str(tmp_path / "bad.txt")).collect()


def test_score_files_of_both_forms(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.json").write_text("\n [0.5,\n 1e-3\n,-2.25\n]\n")
    (tmp_path / "deep" / "b.txt").write_text("0.25\n\n  7 \n")
    (tmp_path / "c.json").write_text("[ ]")
    (tmp_path / "empty").write_text("")
    (tmp_path / "_hidden").write_text("no")
    many = [i / 8 for i in range(20_000)]
    (tmp_path / "long.json").write_text("[" + ",".join(map(str, many)) + "]")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = read_scores(spark, str(tmp_path))
        assert sorted(r[0] for r in found.collect()) == sorted([0.5, 1e-3, -2.25, 0.25, 7.0, *many])
        assert found.rdd.getNumPartitions() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for i, bad in enumerate(["[1, 2", "[1 2]", "[1,,2]", "[1, x]", "[1], [2]", "1\n[2]"]):
        (tmp_path / f"bad{i}").mkdir()
        (tmp_path / f"bad{i}" / "f").write_text(bad)
        with pytest.raises(Exception):
            read_scores(spark, str(tmp_path / f"bad{i}")).collect()
