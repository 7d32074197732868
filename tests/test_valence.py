"""Sentiment in context beside a plain loop over words."""

import random
import re

import pytest
from pyspark.sql import functions as F

from encore.operators import terms, valence

LEXICON = {"love": 3.2, "good": 1.9, "sad": -2.1, "bad": -2.5, "kind": 2.4, "so": 0.4, "no": -1.2, "mild": 0.25}


def plain(text):
    """The scores of one text, rule by rule."""
    raw = [w for w in (re.sub(r"[^\w']", "", x) for x in (text or "").split()) if w]
    low = [w.lower() for w in raw]
    loud = [w.isupper() for w in raw]
    mixed = any(loud) and not all(loud)
    scores = []
    for i, w in enumerate(low):
        v = LEXICON.get(w)
        if v is None or w in valence.STRONGER or w in valence.WEAKER:
            scores.append(0.0)
            continue
        sign = lambda: -1 if v < 0 else 1
        if loud[i] and mixed:
            v += 0.733 * sign()
        for back in (1, 2, 3):
            j = i - back
            if j < 0 or low[j] in LEXICON:
                continue
            if low[j] in valence.STRONGER or low[j] in valence.WEAKER:
                amount = 0.293 if low[j] in valence.STRONGER else -0.293
                if loud[j] and mixed:
                    amount += 0.733
                v += amount * sign() * {1: 1, 2: 0.95, 3: 0.9}[back]
            if low[j] == "never" and any(x in ("so", "this") for x in low[j + 1 : i]):
                v *= 1.5 if back == 2 else 1.25
            elif low[j] in valence.NEGATIONS or "n't" in low[j]:
                v *= -0.74
        if i and low[i - 1] == "least" and not (i > 1 and low[i - 2] in ("at", "very")):
            v *= -0.74
        scores.append(v)
    if "but" in low:
        b = low.index("but")
        scores = [v * (0.5 if i < b else 1.5 if i > b else 1) for i, v in enumerate(scores)]
    s = sum(scores)
    marks = min((text or "").count("!"), 4) * 0.292
    asks = (text or "").count("?")
    marks += 0.96 if asks > 3 else asks * 0.18 if asks > 1 else 0
    p, m = sum(v + 1 for v in scores if v > 0), sum(1 - v for v in scores if v < 0)
    z = sum(v == 0 for v in scores)
    s += marks * ((s > 0) - (s < 0))
    p, m = p + marks * (p > m), m + marks * (p < m)
    mass = p + m + z or 1
    return [s / (s * s + 15) ** 0.5, p / mass, m / mass, z / mass]


FIXED = [
    "good", "not good", "very good", "VERY good", "not very good", "never so good", "never really so good", "GOOD day",
    "GOOD", "it isn't really bad!", "at least good", "least good", "good but bad", "barely mild", "hardly very mild", "bad??", "good????",
    "good!!!!!!", "", None, "  ", "no good", "so very kind of him", "don't love it, but not SAD", "?!", "I love", "but",
]


def scored(spark, texts):
    data = spark.createDataFrame(list(enumerate(texts)), "mbid int, text string").repartition(5)
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, valence double")
    got = valence.sentiment_in_context(data, lexicon).collect()
    assert len(got) == len(texts)
    return {r[0]: list(r)[1:] for r in got}


def test_equals_a_plain_loop(spark):
    rng = random.Random(5)
    words = [*LEXICON, "very", "really", "slightly", "not", "never", "this", "least", "at", "but", "day", "can't", "the", "x"]
    texts = list(FIXED)
    for _ in range(300):
        picked = [w.upper() if rng.random() < 0.2 else w for w in rng.choices(words, k=rng.randint(1, 14))]
        texts.append(" ".join(w + rng.choice(["", "", "", "!", "?", ",", "\n"]) for w in picked))
    for i, row in scored(spark, texts).items():
        assert row == pytest.approx(plain(texts[i]), abs=6e-5), texts[i]


def test_rules_move_scores_as_they_should(spark):
    names = ["good", "very good", "VERY good", "not good", "good but bad", "bad but good", "never so good", "good!"]
    got = scored(spark, names)
    c = {n: got[i][0] for i, n in enumerate(names)}
    assert c["not good"] < 0 < c["good"] < c["very good"] < c["VERY good"]
    assert c["good but bad"] < 0 < c["bad but good"]
    assert c["never so good"] > c["good"]
    assert c["good!"] > c["good"]


def test_empty_table_and_long_text(spark):
    assert scored(spark, []) == {}
    long = "not good " * 20_000
    assert scored(spark, [long])[0] == pytest.approx(plain(long), abs=6e-5)


def test_feature_rows_take_these_scores(spark):
    data = spark.createDataFrame([(1, "not good, really"), (2, None)], "mbid int, text string")
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, valence double")
    freq = spark.createDataFrame([("good", 0.1)], "word string, freq double")
    got = terms.text_features(data, lexicon, freq, score=valence.sentiment_in_context)
    one, two = (r["sentiment_compound"] for r in got.orderBy("mbid").collect())
    assert one == pytest.approx(plain("not good, really")[0], abs=6e-5) and one < 0 and two == 0


def test_steps_run_only_after_words_that_act(spark):
    """Without such a word before it, a word's valence is taken as it is, whatever stands in the steps."""
    words = F.array(*[
        F.struct(F.lit(None).cast("string").alias("word"), F.lit(v).cast("double").alias("valence"), F.lit(False).alias("caps"),
                 F.lit(b).cast("double").alias("boost"), F.lit(False).alias("negates"), F.lit(a).alias("acts"))
        for v, b, a in [(None, 0.293, False), (2.0, None, False), (None, 0.293, True), (2.0, None, False)]
    ])
    got = spark.range(1).select(valence._weighed(words, F.lit(False)).alias("v")).first()["v"]
    assert got == [0.0, 2.0, 0.0, pytest.approx(2.0 + 0.293 * (1 + valence.NEAR[2]))]
