"""Tokens, lines, canonical JSON and hashes against the standard library."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from scorewatch.functions import text
from scorewatch.sources import fingerprint

TEXTS = [
    "", " ", "a b", "  a\tb \x0b c\r\n", "one two three", "​zero width stays", "x　", "a\x1fb\x85c",
    "l1\nl2\r\nl3\rl4\x0cl5 l6\x1cl7\n", "\n", "a\n\n", "trailing\r\n",
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")


def test_tokens_and_lines_match_python(texts):
    t = F.col("t")
    rows = texts.select("id", text.tokens(t).alias("a"), text.token_count(t).alias("n"), text.lines(t).alias("l"), text.is_blank(t).alias("b"), text.strip(t).alias("s"))
    for r in rows.collect():
        raw = TEXTS[r["id"]]
        assert r["a"] == raw.split() and r["n"] == len(raw.split())
        assert r["l"] == raw.splitlines()
        assert r["b"] == (not raw.strip()) and r["s"] == raw.strip()


def test_canonical_json_matches_python(spark):
    rows = [("plain", 1, 0.5), ('quo"te\\ \n\t', -3, 1e-7), ("naïve – 漢字 😀", 0, 2.0), (None, None, None)]
    df = spark.createDataFrame(rows, "b string, a bigint, c double")
    made = df.select(text.canonical_json({"b": F.col("b"), "a": F.col("a")}, {"b": True}).alias("j"))
    made = made.withColumn("h", text.input_hash(F.col("j")))
    for r, (b, a, _) in zip(made.collect(), rows):
        want = json.dumps({"b": b, "a": a}, sort_keys=True)
        assert r["j"] == want and r["h"] == hashlib.sha256(want.encode()).hexdigest()


def test_integer_text(spark):
    cases = {"1": True, "-7": True, "+1": False, "1.0": False, "": False, " 1": False, "9" * 30: False, "１": False}
    df = spark.createDataFrame([(c,) for c in cases], "t string").select("t", text.is_integer(F.col("t")).alias("ok"))
    assert {r["t"]: r["ok"] for r in df.collect()} == cases


def test_file_hash_and_fingerprint(spark, tmp_path):
    path = tmp_path / "raw.txt"
    path.write_bytes(b"some\nbytes\x00")
    assert fingerprint.file_hashes(spark, str(path)).first()["data_hash"] == hashlib.sha256(path.read_bytes()).hexdigest()
    folder = tmp_path / "some files"
    folder.mkdir()
    for name, size in (("a b%20.bin", 9_000_000), ("ü.bin", 0), ("small", 10)):
        (folder / name).write_bytes(bytes(range(250)) * (size // 250 + 1))
    want = {f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in folder.iterdir()}
    for cell_bytes in (100, fingerprint.MAX_FILE_BYTES):
        got = fingerprint.file_hashes(spark, str(folder), cell_bytes).collect()
        assert sorted(r["data_hash"] for r in got) == sorted(want.values())
    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    a = fingerprint.table_fingerprint(df).first()
    b = fingerprint.table_fingerprint(df.repartition(7)).first()
    c = fingerprint.table_fingerprint(df.withColumn("x", F.when(F.col("id") == 5, 0).otherwise(F.col("x")))).first()
    assert a == b != c
