import random
from collections import Counter

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from encore import session
from encore.functions import non_blank_lines, word_list
from encore.operators import terms

TEXTS = [
    (1, "Love love me\nlove ME\n\nlove me\nGreat night, sad end."),
    (2, ""),
    (3, "word"),
    (4, "night night light bright sight night light bright"),
]


def texts(spark):
    return spark.createDataFrame(TEXTS, "mbid int, text string").repartition(3)


def tables(spark):
    lexicon = spark.createDataFrame([("love", 3.0), ("great", 3.1), ("sad", -2.1)], "word string, valence double")
    freq = spark.createDataFrame([("love", 0.1), ("night", 1e-5), ("light", 9e-6), ("bright", 1e-7)], "word string, freq double")
    return lexicon, freq


def test_feature_row(spark):
    got = {r["mbid"]: r for r in terms.text_features(texts(spark), *tables(spark)).collect()}
    one = got[1]
    assert (one["word_count"], one["unique_word_count"], one["type_token_ratio"]) == (8, 5, 0.625)
    assert (one["line_count"], one["avg_line_length"], one["repetitiveness"]) == (4, 2.75, 0.25)
    assert one["longest_words"] == ["great", "night", "love", "end", "sad"]
    assert one["avg_word_length"] == round((4 * 4 + 5 + 5 + 3 + 3) / 8, 3)
    assert one["top_bigrams"][0] == "love love"
    s = 4 * 3.0 + 3.1 - 2.1
    mass = 4 * 4.0 + 4.1 + 3.1 + 5
    assert one["sentiment_compound"] == round(s / (s * s + 15) ** 0.5, 4)
    assert one["sentiment_positive"] == round((4 * 4 + 4.1) / mass, 4)
    assert one["sentiment_neutral"] == round(5 / mass, 4)
    # `night` sits exactly on the threshold: not rare.
    assert (one["rare_word_count"], one["rarest_words"]) == (3, ["end", "great", "sad"])
    assert (got[4]["rare_word_count"], got[4]["rarest_words"]) == (5, ["sight", "bright", "light"])
    empty = got[2]
    assert (empty["word_count"], empty["type_token_ratio"], empty["line_count"]) == (0, 0.0, 0)
    assert empty["flesch_reading_ease"] is None and empty["sentiment_neutral"] == 0.0
    assert empty["top_bigrams"] == [] and empty["rarest_words"] == [] and empty["longest_words"] == []
    assert got[3]["top_bigrams"] == [] and got[3]["avg_word_length"] == 4.0


def test_top_lists_break_ties_by_first_use(spark):
    counts = terms.word_counts(terms.tokens(texts(spark)))
    got = {r["mbid"]: r["w"] for r in terms.top_list(counts, 3, "w").collect()}
    assert got[4] == ["night", "light", "bright"]


def test_word_counts_are_dealt_by_the_bytes_read(spark, monkeypatch):
    staged = session.stage_table(terms.tokens(texts(spark)), "dealt words")
    size = session.file_bytes(staged)
    assert size > 300 and session.file_bytes(texts(spark)) == 0
    before = rows(terms.word_counts(staged), "mbid", "word")
    monkeypatch.setattr(session, "SMALL_PART", 100)
    counts = terms.word_counts(staged)
    assert counts.rdd.getNumPartitions() == size // 100 > 4
    assert rows(counts, "mbid", "word") == before


def test_numbers_and_blank_lines_of_any_script_are_left_out(spark):
    data = spark.createDataFrame([("a1 12 \u00b2\u2075 \u0664\u0665 zz {x 9a \u00e92",), ("\u2003 \x1f\n \u00a0x\n\n",), (None,)], "t string")
    got = rows(data.select(word_list(F.col("t"), ()), non_blank_lines(F.col("t"))))
    assert got[0] == (["a1", "zz", "9a", "\u00e92"], [data.first()[0]])
    assert got[1] == ([], [" \u00a0x"]) and got[2] == (None, None)


def brute(data, targets, n, least, grams):
    ys = [y for _, y in targets if y is not None]
    hi, lo = np.percentile(ys, 75), np.percentile(ys, 25)
    high, low, where = Counter(), Counter(), dict(targets)
    for i, t in data:
        y = where.get(i)
        if y is None:
            continue
        words = grams(t.split())
        if y >= hi:
            high.update(words)
        elif y <= lo:
            low.update(words)
    top = lambda c: sorted(c, key=lambda w: (-c[w], w))[:n]
    keep = {w for w in set(top(high)) | set(top(low)) if high[w] + low[w] >= least}
    ht, lt = max(sum(high.values()), 1), max(sum(low.values()), 1)
    return {w: (high[w], low[w], high[w] / ht / (low[w] / lt + 1e-9)) for w in keep}


def test_contrast_equals_counting(spark):
    rng = random.Random(8)
    words = [f"w{c}{d}x" for c in "abcdefg" for d in "abcd"]
    data = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(60)]
    targets = [(i, None if i % 11 == 0 else float(rng.randint(0, 12))) for i in range(80)]
    t = spark.createDataFrame(data, "mbid int, text string")
    y = spark.createDataFrame(targets, "mbid int, log_repeat_listens double")
    for pairs, grams in ((False, list), (True, lambda w: [f"{a} {b}" for a, b in zip(w, w[1:])])):
        got = {
            r["word"]: (r["high_count"], r["low_count"], r["freq_ratio"])
            for r in terms.contrast(t, y, pairs, top_n=9, min_total=3).collect()
        }
        want = brute(data, targets, 9, 3, grams)
        assert got.keys() == want.keys()
        for w in want:
            assert got[w][:2] == want[w][:2] and np.isclose(got[w][2], want[w][2])


def test_extremes_and_cohorts(spark):
    c = spark.createDataFrame(
        [("a", 4, 0, 9.0), ("b", 1, 1, 1.0), ("c", 0, 7, 0.1)], "word string, high_count int, low_count int, freq_ratio double"
    )
    assert [(r["side"], r["word"]) for r in terms.extremes(c, 1).collect()] == [("high", "a"), ("low", "c")]
    assert set(rows(terms.cohort_terms(c, 2))) == {("high", "a", 4), ("high", "b", 1), ("low", "c", 7), ("low", "b", 1)}


def test_topics(spark):
    data = [(i, "cat dog pet fur " * 5 if i % 2 else "sun sea sand wave " * 5) for i in range(40)]
    t = spark.createDataFrame(data, "mbid int, text string")
    weights, words = terms.fit_topics(t, topics=2, iterations=15)
    got = weights.collect()
    assert all(abs(r["topic_0"] + r["topic_1"] - 1) < 1e-6 for r in got)
    assert all(r["dominant_topic"] == (0 if r["topic_0"] >= r["topic_1"] else 1) for r in got)
    assert words.where(F.col("topic") == 0).count() == 8
    even, odd = ({r["dominant_topic"] for r in got if r["mbid"] % 2 == k} for k in (0, 1))
    assert len(even) == len(odd) == 1 and even != odd


def test_topic_contrast_with_an_empty_topic(spark):
    w = spark.createDataFrame([(1, 0.9, 0.1, 0), (2, 0.8, 0.2, 0), (3, 0.7, 0.3, 0)], "mbid int, topic_0 double, topic_1 double, dominant_topic int")
    y = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, None)], "mbid int, log_repeat_listens double")
    got = {r["topic"]: r for r in terms.topic_contrast(w, y, 2).collect()}
    assert got[1]["n_texts"] == 0 and got[1]["mean_target"] == 0.0 and got[0]["mean_target"] == 2.0
    assert np.isclose(got[1]["weight_gap"], 0.2)


def test_doc_terms_respect_limits(spark):
    data = [(i, "common " + ("mid " if i < 4 else "") + ("rare" if i < 2 else "x")) for i in range(10)]
    t = spark.createDataFrame(data, "mbid int, text string")
    got = terms.doc_term_counts(t, size=10, min_texts=3, max_share=0.8)
    assert {r["word"] for r in got.collect()} == {"mid"}


def test_item_profile_keeps_section_words(spark):
    t = spark.createDataFrame([(1, "chorus love love"), (2, "other")], "mbid int, text string")
    got = terms.item_profile(t, 1, tables(spark)[0]).first()
    assert (got["word_count"], got["top_words"], got["top_counts"]) == (3, ["love", "chorus"], [2, 1])


def test_counts_of_words_are_not_joined_into_few_tasks(spark):
    texts = spark.createDataFrame([(i, f"word{i} again and again") for i in range(40)], "mbid bigint, text string")
    counts = terms.word_counts(terms.tokens(texts), pairs=True)
    assert counts.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
