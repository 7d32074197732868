"""The n-gram join, runs of words and conversations against brute force."""

import random

import llm_data as data
import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import base, catalog, jaccard, runs, turns  # noqa: F401


def near_copies(rng, text, share):
    words = text.split(" ")
    return " ".join(rng.choice(data.WORDS) if rng.random() < share else w for w in words)


def crowd(spark):
    """Groups of near copies at every distance, short rows, shared passages, ids that are null or
    stand for several texts."""
    rng = random.Random(11)
    passage, rows = data.prose(rng, 90), []
    for group in range(6):
        base_text = data.prose(rng, rng.choice([6, 30, 150]))
        for _ in range(rng.choice([2, 25, 60])):
            rows.append(near_copies(rng, base_text, rng.choice([0, 0.004, 0.01, 0.02, 0.04])))
    rows += [passage + data.prose(rng, k) for k in (1, 5, 10, 12, 20, 25, 40, 200)]
    rows += ["a b c d", "A b  c d", "a b c d e", "a b c", "", None, "x"] * 2
    rng.shuffle(rows)
    out = [(None if k % 17 == 3 else k // 2 if k % 23 == 5 else k, t) for k, t in enumerate(rows)]
    return spark.createDataFrame(out, "doc_id bigint, text string")


@pytest.mark.parametrize("make", [data.awkward, crowd])
def test_jaccard_rows_equal_brute_force(spark, make):
    docs = make(spark)
    want = data.jaccard_rows(data.collected(docs, "doc_id", "text"))
    got = jaccard.near_duplicates(docs)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_jaccard_with_small_parts_and_no_hub_rounds(spark, monkeypatch):
    docs = crowd(spark)
    want = data.jaccard_rows(data.collected(docs, "doc_id", "text"))
    monkeypatch.setattr(jaccard, "HUB_ROWS", 4)
    monkeypatch.setattr(jaccard, "PART_ROWS", 8)
    assert sorted((tuple(r) for r in jaccard.near_duplicates(docs).collect()), key=str) == want
    described = jaccard.describe(docs)
    rows = described.where("bucket is null")
    lists = jaccard.shared_lists(jaccard.prefixes(docs, jaccard.estimates(described)))
    roots = jaccard.class_links(lists, jaccard.shingle_sets(docs, rows, lists), rounds=0)
    hubs = jaccard.class_links(lists, jaccard.shingle_sets(docs, rows, lists))
    assert sorted(map(tuple, roots.collect())) == sorted(map(tuple, hubs.collect()))


def test_jaccard_lists_hold_few_tokens_of_the_same_classes(spark):
    rng = random.Random(8)
    passage = data.prose(rng, 900)
    texts = [passage + data.prose(rng, 300) for _ in range(2)] + [passage[:3000] + data.prose(rng, 700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    # A table as crowded as a large corpus makes it: all shingles look alike rare.
    lists = jaccard.shared_lists(jaccard.prefixes(docs, np.full(1 << jaccard.TABLE_BITS, jaccard.CHANCE, np.float32)))
    by_token = {}
    for r in lists.collect():
        by_token.setdefault(r["token"], set()).add(r["key"])
    alike = [frozenset(v) for v in by_token.values()]
    assert alike and max(alike.count(v) for v in set(alike)) <= jaccard.MOST_MATCHES
    assert min(map(len, alike)) > 1
    want = data.jaccard_rows(data.collected(docs, "doc_id", "text"))
    assert sorted((tuple(r) for r in jaccard.near_duplicates(docs).collect()), key=str) == want


def test_likely_keeps_all_wanted_rows_and_few_others(spark):
    rows = spark.range(-20_000, 20_000).select((F.col("id") * 3).alias("k"), F.lit("x").alias("v"))
    for n in (0, 1, 8_000):
        wanted = spark.range(-n, n).select((F.col("id") * 6).alias("q"))
        got = base.likely(rows, F.col("k"), wanted)
        held = rows.join(wanted, F.col("k") == F.col("q"), "left_semi").count()
        assert got.columns == ["k", "v"]
        assert got.join(wanted, F.col("k") == F.col("q"), "left_semi").count() == held
        assert got.count() <= held + 40_000 // 8


def test_jaccard_query_and_empty_table(spark):
    docs = spark.read.parquet(f"{data.SMALL}/documents.parquet")
    want = data.jaccard_rows(data.collected(docs, "doc_id", "text"))
    got = base.QUERIES["op11_ngram_jaccard"](spark, data.SMALL).collect()
    assert sorted((tuple(r) for r in got), key=str) == want
    assert jaccard.near_duplicates(data.empty(spark)).count() == 0


def test_matches_follow_estimated_cost():
    assert jaccard.matches(np.zeros(100, np.float32)) == 1
    assert 1 < jaccard.matches(np.full(100, jaccard.CHANCE, np.float32)) < jaccard.MOST_MATCHES
    assert jaccard.matches(np.full(100, 5000, np.float32)) == jaccard.MOST_MATCHES
    assert jaccard.matches(np.full(1, 5000, np.float32)) == 1
    rising = np.r_[np.zeros(21), np.full(79, 10_000)].astype(np.float32)
    assert jaccard.matches(rising) == 1  # a longer prefix would only add long lists


def test_transform_is_exact_both_ways():
    rng = np.random.default_rng(3)
    for n in (8, 64, 128, 4096, 1 << 13):
        for prime in runs.PRIMES:
            x = rng.integers(0, prime, (2, n)).astype(float)
            back = runs.transform(runs.transform(x.copy(), prime), prime, inverse=True)
            assert (back * pow(n, -1, prime) % prime == x).all()
    a, b = rng.integers(0, prime, (2, 128))
    cyclic = runs.transform(runs.transform(a[None] * 1.0, prime) * runs.transform(b[None] * 1.0, prime) % prime, prime, inverse=True)
    want = [sum(int(a[i]) * int(b[(k - i) % 128]) for i in range(128)) % prime for k in range(128)]
    assert (cyclic[0] * pow(128, -1, prime) % prime).tolist() == want


@pytest.mark.parametrize("top", [3, 40_000, 3_000_000])
def test_zero_mismatch_with_small_and_very_large_numbers(top):
    rng = np.random.default_rng(top)
    windows = rng.integers(1, top, (50, 64))
    blocks = windows[:, 20:36].copy()
    blocks[::2, 3] += 1
    want = [[(w[s : s + 16] == b).all() for s in range(49)] for w, b in zip(windows, blocks)]
    assert (runs.zero_mismatch(blocks, windows) == want).all()


def test_runs_equal_brute_force():
    rng = random.Random(2)
    texts = []
    for _ in range(600):
        n, letters = rng.choice([0, 1, 11, 12, 13, 30, 80, 150]), rng.choice([1, 2, 3, 12])
        w = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        texts.append(w + w if rng.random() < 0.3 else w)
    assert list(runs.texts_runs(texts)) == [data.runs_of(w) for w in texts]


def test_runs_of_long_texts(monkeypatch):
    assert runs.texts_runs([["a"] * 60_000]).__next__() == [(0, 60_000, 1)]
    block = [str(i) for i in range(20_000)]
    assert next(runs.texts_runs([["x"] + block * 3 + block[:77]])) == [(1, 60_077, 20_000)]
    monkeypatch.setattr(runs, "LONGEST", 8)
    monkeypatch.setattr(runs, "PORTION", 100)
    monkeypatch.setattr(runs, "MANY_SEEDS", 5)
    test_runs_equal_brute_force()


def test_run_rows_and_query(spark):
    without_id = spark.createDataFrame([(None, "a b " * 9)] * 2, "doc_id bigint, text string")
    docs = data.awkward(spark).unionByName(without_id, allowMissingColumns=True)
    got = runs.detect_runs(docs).collect()
    by_id = {i: data.words(t) for i, t in data.collected(docs, "doc_id", "text")}
    assert len(got) == docs.count()
    for r in got:
        w = by_id[r.doc_id]
        if len(w) < 3000:
            assert list(zip(r.run_starts, r.run_lengths, r.run_periods)) == data.runs_of(w)
        assert r.n_words == len(w)
    assert runs.detect_runs(data.empty(spark)).count() == 0
    want = sorted(data.run_row(i, t, True) for i, t in data.collected(spark.read.parquet(f"{data.SMALL}/documents.parquet"), "doc_id", "text"))
    rows = base.QUERIES["op12_periodic_runs"](spark, data.SMALL)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, rows.collect())) == want


def test_edit_costs_by_hand():
    code = lambda initial, fault=0: turns.INITIALS.index(initial) * 4 + fault

    def audit(*codes):
        costs = turns.backward(np.array(codes, int), turns.END)
        steps, state = turns.traced(costs, np.array(codes, int), 0)
        return "".join(x for x, _ in steps + turns.closing(state)), int(costs[0, 0])

    assert audit() == ("", 0)
    assert audit(code("s"), code("u"), code("a")) == ("KKK", 0)
    assert audit(code("u")) == ("KI", 2)
    assert audit(code("a")) == ("IK", 2)
    assert audit(code("s")) == ("D", 3)
    assert audit(code("u"), code("u"), code("a")) == ("KIKK", 2)
    assert audit(code("u"), code("a", 1)) == ("KDI", 5)
    assert audit(code("u", 3), code("a", 3)) == ("KK", 2)


def talks(spark):
    rng = random.Random(4)
    rows = []
    for conv in range(30):
        for turn in range(rng.choice([1, 2, 7, 40])):
            role = rng.choice(["user", "assistant"] * 3 + ["system", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn + 3, None]), role, rng.choice(["Yes.", "No", " ", "", None, f"{turn}!"])))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")] + [(77, 5, "user", "Same.")] * 40
    rows += [(99, t, rng.choice(["user", "assistant"]), f"{t}.") for t in range(1500)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("chunk", F.lit("x")).withColumn("seq", F.lit(1))


@pytest.mark.parametrize("bits", [1, 3, 8])
def test_repairs_equal_all_edits(spark, monkeypatch, bits):
    monkeypatch.setattr(turns, "CHUNK_BITS", bits)
    rows = talks(spark)
    want = data.conversation_rows(data.collected(rows, "conv_id", "turn", "role", "text"))
    got = turns.repair(turns.damaged(rows)).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r) == want[r.conv_id]


def test_repair_query_and_empty_table(spark):
    rows = spark.read.parquet(f"{data.SMALL}/conversations.parquet")
    want = data.conversation_rows(data.collected(rows, "conv_id", "turn", "role", "text"))
    got = base.QUERIES["op13_conversation_repair"](spark, data.SMALL)
    assert ", ".join(f"{c} {t}" for c, t in got.dtypes) == turns.RESULT
    assert {r.conv_id: tuple(r) for r in got.collect()} == want
    assert turns.repair(turns.damaged(rows.limit(0))).count() == 0
