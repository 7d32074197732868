import random
import string

import pytest
from conftest import rows

from encore.operators import linking


def lcs(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            best[j], last = (last + 1 if x == y else max(best[j], best[j - 1])), best[j]
    return best[-1]


def score(a, b):
    a, b = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
    return 200 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(300):
        a = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 40)))
        b = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 40)))
        assert linking.common_subsequence(a, b) == lcs(a, b)


def corrupt(rng, text):
    text = list(text)
    for _ in range(rng.randint(0, 4)):
        at = rng.randrange(len(text) + 1)
        if rng.random() < 0.5:
            text.insert(at, rng.choice(string.ascii_lowercase + " "))
        elif text:
            text.pop(min(at, len(text) - 1))
    words = "".join(text).split()
    rng.shuffle(words)
    return " ".join(words)


def flip(a):
    return a[4:] if a.startswith("the ") else f"the {a}"


def brute(pairs, targets, cut):
    index = {}
    for i, a, t, y in sorted(targets, key=lambda r: (-(r[3] if r[3] is not None else float("-inf")), r[0])):
        for k in dict.fromkeys([a, flip(a)]):
            index.setdefault(k, []).append((t, i))
    out = {}
    for a, t in set(pairs):
        found = index.get(a) or index.get(flip(a)) or []
        best = max(found, key=lambda c: score(t, c[0]), default=None)
        if best and score(t, best[0]) >= cut:
            out[a, t] = best[1]
    return out


@pytest.mark.parametrize("cut", [85, 90, 75])
@pytest.mark.parametrize("seed", [1, 2])
def test_fuzzy_equals_comparing_every_title(spark, seed, cut):
    """One artist holds most titles; near-misses, repeats and one-letter titles included."""
    rng = random.Random(seed)
    artists = ["abba"] * 6 + ["the who", "who", "the the x", "x"]
    vocabulary = ["love", "night", "aaaa", "zoo", "my", "the", "one", "o", "queen", "dancing"]
    targets, pairs = [], []
    for i in range(150):
        title = " ".join(rng.choices(vocabulary, k=rng.randint(1, 4)))
        targets.append((i, rng.choice(artists), title, rng.choice([None, float(rng.randint(0, 5))])))
    targets += [(900, "abba", "", 1.0), (901, "x", "a", 2.0)]
    for _ in range(200):
        _, a, t, _ = rng.choice(targets)
        pairs.append((rng.choice([a, flip(a), "nobody"]), corrupt(rng, t)))
    pairs += [("abba", ""), ("the x", "a"), ("x", "b")]
    got = linking.link_fuzzy(
        spark.createDataFrame(pairs, "a string, t string").repartition(5),
        spark.createDataFrame(targets, "id int, a string, t string, target double"),
        cut,
    )
    assert {(r["a"], r["t"]): r["id"] for r in got.collect()} == brute(pairs, targets, cut)


def test_prune_never_rejects_a_match(spark):
    rng = random.Random(5)
    data = []
    for _ in range(400):
        t = " ".join(rng.choices(["red", "blue", "widget", "a", "tone"], k=rng.randint(1, 4)))
        data.append((t, corrupt(rng, t)))
    df = spark.createDataFrame(data, "u string, s string")
    from pyspark.sql import functions as F

    kept = df.select("u", "s", linking.within_reach(F.col("u"), F.col("s")).alias("k")).collect()
    for r in kept:
        if (len(r.u) + len(r.s)) and 200 * lcs(r.u, r.s) / (len(r.u) + len(r.s)) >= 85:
            assert r.k


def items(spark):
    return spark.createDataFrame(
        [(1, "The Band", "Red Widget", 5.0), (2, "band", "red widget", 3.0), (3, "band", "Blue Bolt!", None),
         (4, "other", "solo", 1.0), (5, None, "x", 1.0)],
        "mbid int, artist_name string, title string, log_repeat_listens double",
    )


def corpus(spark):
    return spark.createDataFrame(
        [(10, "Widget Red", "The band", "fuzzy [x] text"), (11, "RED WIDGET", "Band", "exact"),
         (12, "blue bolt", "the  band", "via the"), (13, "red widget", "band", "later"),
         (14, "solo", "other", None), (15, "solo", "other", "s Embed")],
        "seq int, title string, artist string, lyrics string",
    )


def test_exact_prefers_lowest_target(spark):
    dup = spark.createDataFrame(
        [(1, "a", "t", 5.0), (2, "a", "t", 3.0), (3, "a", "t", 3.0)], "id int, a string, t string, target double"
    )
    assert rows(linking.exact_index(dup)) == [("a", "t", 2)]


def test_arbitration_takes_the_earliest_row(spark):
    got = rows(linking.link_texts(corpus(spark), items(spark)), "mbid")
    # Row 10 is a fuzzy hit: "widget red" scores 100 against both, and the higher target wins.
    assert got == [(1, 10, "fuzzy   text"), (2, 11, "exact"), (3, 12, "via the"), (4, 15, "s")]
    exact = rows(linking.link_texts(corpus(spark), items(spark), cut=None), "mbid")
    assert exact == [(2, 11, "exact"), (4, 15, "s")]


def test_blocking_has_no_cartesian_step(spark):
    targets = linking.target_keys(items(spark))
    plan = linking.link_fuzzy(targets.select("a", "t"), targets)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_coverage(spark):
    links = linking.link_texts(corpus(spark), items(spark))
    assert rows(linking.link_coverage(links, items(spark))) == [(4, 4, 100.0)]


def test_candidates_stay_few_for_a_large_artist(spark):
    """A fraction of all pairs of an artist's titles meet, and every pair that reaches the cut does."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("etaoinshrdlcu", k=rng.randint(2, 7))) for _ in range(80)]
    titles = sorted({" ".join(sorted(rng.choices(vocabulary, k=rng.randint(2, 5)))) for _ in range(600)})
    other = sorted({" ".join(sorted(corrupt(rng, t).split())) for t in titles})
    left = spark.createDataFrame([("x", t) for t in other], "block string, u string")
    right = spark.createDataFrame([("x", t) for t in titles], "block string, s string")
    met = linking.candidates(left, right)
    assert met.count() < 0.05 * len(titles) * len(other)
    want = {(u, s) for u in other for s in titles if score(u, s) >= 85}
    assert want <= {(r.u, r.s) for r in met.select("u", "s").distinct().collect()}
