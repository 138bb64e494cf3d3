"""Ranked search, exact duplicates and resampling against brute force and SQL; odd rows throughout."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_operators import DOCS, LONG, odd_rows

from scorewatch.llm import common, exact, ranked, resampling
from scorewatch.llm.exact import exact_groups
from scorewatch.llm.ranked import ranked_search
from scorewatch.llm.resampling import Plan, resample
from scorewatch.llm.terms import terms

ITEMS = "item_id long, text string, doc_id string, score string, rank string, query string, n string"


def items():
    rng = random.Random(9)
    words = "the of and a to in is it was for on are with as his they be at longword one 日本語のテキスト x".split()
    texts = [None, "", "?!", "the the of", "LONGWORD and one", "nowhere to be found zzz", *(" ".join(rng.choice(words) + rng.choice(["", str(rng.randint(0, 30))]) for _ in range(12)) for _ in range(8))]
    return [(i, t, "a", "b", "c", "d", "e") for i, t in enumerate(texts)] + [(4, "LONGWORD and one", *"abcde"), (None, "was is it", *"abcde")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(items(), ITEMS).repartition(2)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def no_items(spark):
    return spark.createDataFrame([], ITEMS)


def rows_of(df, *names):
    return sorted(map(repr, map(tuple, df.select(*names).collect())))


def sql(text, documents, benchmark, *names):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([r[:2] for r in documents], columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    con.register("benchmark", pd.DataFrame([r[:2] for r in benchmark], columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    return sorted(map(repr, con.execute(f"SELECT {', '.join(names)} FROM ({text.strip()})").fetchall()))


def plain_terms(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def test_terms():
    for row in odd_rows():
        assert [t.decode() for t in terms(row[1] or "")] == plain_terms(row[1])
    assert terms("A\0b\x7fÉ9_x [Z]") == [b"a", b"b", "É9".encode(), b"x", b"z"]


# ---- exact duplicates ---------------------------------------------------------------------------------------------

EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute_groups(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[re.sub("[A-Z]", lambda m: m[0].lower(), row[1] or "")].append(row[0])
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda d: -1 if d is None else d, reverse=True)
        out += [(d, ids[0], len(ids), i == 0, hashlib.sha256(text.encode()).hexdigest()) for i, d in enumerate(ids)]
    return sorted(map(repr, out))


def copies():
    """Equal texts in other case, long texts that differ in one place, İ and ſ, which lower() would change."""
    rng = random.Random(2)
    base = " ".join(f"{rng.choice('abcdefgh')}word{rng.randint(0, 999)}" for _ in range(3000))
    other = base[:9000] + "X" + base[9000:]
    rows = [(i, t) for i, t in enumerate([base, base.upper(), other, base[:-1], base + " ", other, "İ", "i̇", "ſ", "s", "S", "É", "é", base])]
    return [(*r, *[None] * 8) for r in rows]


def test_exact_groups(spark, odd, nothing):
    assert rows_of(exact_groups(odd), *EXACT) == brute_groups(odd_rows())
    more = odd_rows() + copies()
    df = spark.createDataFrame(more, DOCS).repartition(4)
    assert rows_of(exact_groups(df), *EXACT) == brute_groups(more) == sql(exact.ORACLE, more, [], *EXACT)
    assert exact_groups(nothing).count() == 0 and exact_groups(nothing).columns == list(EXACT)


@pytest.mark.parametrize("digest", [lambda c: F.length(c).cast("long"), lambda c: F.lit(7).cast("long"), lambda c: F.pmod(F.xxhash64(c), F.lit(5))])
def test_digests_that_clash_change_nothing(spark, digest):
    more = odd_rows() + copies()
    df = spark.createDataFrame(more, DOCS).repartition(3)
    assert rows_of(exact_groups(df, digest), *EXACT) == brute_groups(more)


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_hot_groups_go_by_broadcast(spark, monkeypatch, hot):
    monkeypatch.setattr(common, "HOT_GROUPS", hot)
    rows = [(i, ["same", f"own {i}", "Two"][i % 3], *[None] * 8) for i in range(90)]
    assert rows_of(exact_groups(spark.createDataFrame(rows, DOCS)), *EXACT) == brute_groups(rows)


def test_chunks_are_the_text_and_find_their_place_again(spark):
    texts = [r[1] for r in odd_rows() + copies() if r[1]] + ["y" * 10_000, "日本" * 9_000]
    rng = random.Random(4)
    prose = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(9000))
    df = spark.createDataFrame([(t,) for t in [*texts, prose, "some words before " + prose]], "text string")
    found = [r[0] for r in df.select(exact.chunks(F.col("text"))).collect()]
    assert ["".join(c) for c in found] == [*texts, prose, "some words before " + prose]
    assert all(len(c) <= exact.MOST + 4 for cut in found for c in cut)
    before, after = map(set, found[-2:])
    assert len(before & after) > 0.9 * len(before) > 30


def test_exact_groups_need_no_python(odd):
    plan = exact_groups(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# ---- resampling ---------------------------------------------------------------------------------------------------

DRAWN = ("doc_id", "n_features", "weight", "score", "rank")


def brute_resample(docs, target, plan):
    def found(text):
        words = plain_terms(text)
        runs = [" ".join(words[i:i + n]) for n in range(1, plan.longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % plan.buckets for r in runs]

    source = [(row[0], *found(row[1])) for row in docs]
    s, t = collections.Counter(), collections.Counter()
    for _, _, own in source:
        s.update(own)
    for row in target:
        t.update(found(row[1])[1])
    all_s, all_t, n = sum(s.values()), sum(t.values()), plan.buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + n) / ((s[b] + 1) * (all_t + n)))) for b in range(n)]
    rows = []
    for doc_id, words, own in source:
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{plan.seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), words))
    able = sorted((r for r in rows if r[4] >= plan.min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    k = len(able) * plan.percent // 100
    out = [(*r[:4], i + 1 if i < k else None) for i, r in enumerate(able)]
    return sorted(map(repr, out + [(*r[:4], None) for r in rows if r[4] < plan.min_words]))


@pytest.mark.parametrize("plan", [Plan(), Plan(percent=50), Plan(percent=100, min_words=0, seed="x"), Plan(longest=3, buckets=70_000, percent=40), Plan(percent=0)])
def test_resample(odd, asked, plan):
    got = resample(odd, asked, plan)
    assert got.columns == list(DRAWN) and {t for _, t in got.dtypes} == {"bigint"}
    assert rows_of(got, *DRAWN) == brute_resample(odd_rows(), items(), plan)


def test_resample_equals_sql(odd, asked):
    assert rows_of(resample(odd, asked), *DRAWN) == sql(resampling.ORACLE, odd_rows(), items(), *DRAWN)


def test_resample_without_rows(odd, asked, nothing, no_items):
    assert resample(nothing, asked).count() == 0
    assert rows_of(resample(odd, no_items), *DRAWN) == brute_resample(odd_rows(), [], Plan())


def test_weights_favour_the_target(spark):
    rng = random.Random(7)
    like, unlike = "alpha beta gamma delta".split(), "red green blue black".split()
    rows = [(i, " ".join(rng.choices(like if i % 4 == 0 else unlike, k=40)), *[None] * 8) for i in range(400)]
    target = spark.createDataFrame([(1, " ".join(like * 20), *"abcde")], ITEMS)
    drawn = [r["doc_id"] for r in resample(spark.createDataFrame(rows, DOCS), target).where("rank IS NOT NULL").collect()]
    assert len(drawn) == 40 and sum(d % 4 == 0 for d in drawn) >= 36


@pytest.mark.parametrize("pivots", [1, 3, 15])
def test_lowest_finds_every_place(spark, pivots):
    rng = random.Random(pivots)
    rows = [(rng.randint(0, 3), rng.randint(0, 2) == 0, i) for i in range(200)]
    df = spark.createDataFrame(rows, "a long, b boolean, c long").repartition(5)
    for k in (1, 2, 77, 199, 200):
        assert tuple(resampling.lowest(df, k, ["a", "b", "c"], pivots)) == sorted(rows)[k - 1]
    assert resampling.lowest(df, 201, ["a", "b", "c"], pivots) is None and resampling.lowest(df, 0, ["a"], pivots) is None


# ---- ranked search ------------------------------------------------------------------------------------------------

FOUND = ("item_id", "rank", "doc_id", "score")


def brute_search(docs, queries, top):
    each = [(row[0], collections.Counter(plain_terms(row[1]))) for row in docs]
    n_docs = sum(bool(held) for _, held in each)
    all_terms = sum(sum(held.values()) for _, held in each)
    df = collections.Counter(t for _, held in each for t in held)
    out = []
    for item_id, text, *_ in queries:
        scores = []
        for doc_id, held in each:
            n, score = sum(held.values()), 0
            for term, q in collections.Counter(plain_terms(text)).items():
                if term in held:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 25 + (25 * n * n_docs) // all_terms
                    score += q * w * ((1000000000 * held[term]) // (1000 * held[term] + 12 * m))
            if score:
                scores.append((doc_id, score))
        scores.sort(key=lambda x: (-x[1], x[0] is None, x[0] or 0))
        out += [(item_id, i + 1, *s) for i, s in enumerate(scores[:top])]
    return sorted(map(repr, out))


@pytest.mark.parametrize("top,step,shard,block", [(20, 0.5, 1 << 19, 1 << 17), (3, 0.9, 40, 1 << 17), (1, 0.01, 1, 20), (5, 0.5, 200, 40)])
def test_ranked_search(monkeypatch, odd, asked, top, step, shard, block):
    monkeypatch.setattr(ranked, "STEP", step)
    monkeypatch.setattr(ranked, "SHARD_POSTINGS", shard)
    got = ranked_search(odd, asked, top, block)
    assert got.columns == list(FOUND) and dict(got.dtypes)["rank"] == "int"
    assert rows_of(got, *FOUND) == brute_search(odd_rows(), items(), top)


def test_ranked_search_equals_sql(odd, asked):
    assert rows_of(ranked_search(odd, asked), *FOUND) == sql(ranked.ORACLE, odd_rows(), items(), *FOUND)


def test_ranked_search_without_rows(odd, asked, nothing, no_items):
    for got in (ranked_search(nothing, asked), ranked_search(odd, no_items), ranked_search(nothing, no_items)):
        assert got.count() == 0 and got.columns == list(FOUND)
    assert ranked_search(odd, asked.where("text is null or text = '?!'")).count() == 0


def lists_of(rng, n_docs, n_terms):
    out = []
    for _ in range(n_terms):
        places = rng.sample(range(n_docs), rng.randint(0, n_docs))
        adds = sorted((rng.choice([1, 2, 3, 5, 50, 51]) * rng.choice([1, 1, 10]) for _ in places), reverse=True)
        out.append((np.array(places, np.int64), np.array(adds, np.int64)))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_intervals_close_on_the_right_documents(seed):
    rng = random.Random(seed)
    n_docs, top = rng.choice([1, 5, 60]), rng.choice([1, 3, 20])
    lists = lists_of(rng, n_docs, rng.randint(0, 6))
    known = np.array(rng.choices(range(1, 80), k=rng.choice([0, 1, top])), np.int64)
    scores = np.zeros(n_docs, np.int64)
    for places, adds in lists:
        scores[places] += adds
    kth = sorted([*scores.tolist(), *known.tolist()], reverse=True)[:top]
    least = max(1, kth[-1] if len(kth) == top else 1)
    found, got, _ = ranked.resolve(lists, n_docs, top, known)
    assert {p: s for p, s in zip(found.tolist(), got.tolist()) if s >= least} == {p: int(s) for p, s in enumerate(scores) if s >= least}
    assert all(scores[p] == s for p, s in zip(found, got))


def test_reading_ends_before_the_lists_do():
    """Rare terms decide; the long lists of common ones are not read to their ends."""
    rng = random.Random(1)
    common_lists = [(np.arange(5000), np.array(sorted(rng.choices(range(1, 100), k=5000), reverse=True), np.int64)) for _ in range(3)]
    rare = (np.array(range(0, 5000, 100)), np.arange(50_000, 0, -1000))
    found, scores, read = ranked.resolve([*common_lists, rare], 5000, 3, np.zeros(0, np.int64))
    assert found.tolist() == [0, 100, 200] and read < 0.9 * 15_050
    _, _, less = ranked.resolve([*common_lists, rare], 5000, 3, np.array([60_000] * 3))
    assert less < 200


def test_pieces_are_the_terms(spark):
    for text in ("", " ", LONG, "a b " * 50, "é" * 300, "x" * 90 + " y", "日本語 " * 40):
        for size in (1, 7, 64, 1 << 22):
            assert [w for words in ranked.pieces(text, size) for w in words] == terms(text)
