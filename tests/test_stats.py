import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from encore.functions.tails import beta_share, gamma_tail
from encore.operators import stats


def test_tail_probabilities():
    assert math.isclose(gamma_tail(0.5, 3.841458820694124 / 2), 0.05, rel_tol=1e-9)
    assert math.isclose(gamma_tail(2.0, 9.487729036781154 / 2), 0.05, rel_tol=1e-9)
    t, k = 2.2281388519649385, 10
    assert math.isclose(beta_share(k / 2, 0.5, k / (k + t * t)), 0.05, rel_tol=1e-9)


def ranks(values):
    ordered = sorted(values)
    return [ordered.index(v) + (ordered.count(v) + 1) / 2 for v in values]


@pytest.mark.parametrize("parts", [1, 6])
def test_spearman(spark, parts):
    rng = random.Random(parts)
    data = [(float(rng.randint(0, 9)), float(rng.randint(0, 30))) for _ in range(120)]
    df = spark.createDataFrame(data + [(None, 1.0), (2.0, None)], "x double, y double").repartition(parts)
    r = stats.spearman(df, "x", "y").first()
    rho = np.corrcoef(ranks([a for a, _ in data]), ranks([b for _, b in data]))[0, 1]
    assert r["n"] == 120 and math.isclose(r["rho"], rho, rel_tol=1e-9) and 0 <= r["p_value"] <= 1
    assert stats.spearman(df.limit(20), "x", "y").count() == 0


def test_kruskal(spark):
    rng = random.Random(4)
    data = [(g, float(rng.randint(0, 12) + (g == "b"))) for g in "aaabbbbcd" for _ in range(22)]
    data += [("e", 1.0)] * 20 + [("f", 2.0)] * 3
    r = stats.kruskal_wallis(spark.createDataFrame(data, "g string, v double").repartition(5), "g", "v").first()
    used = [(g, v) for g, v in data if g in "abcd"]
    rk = ranks([v for _, v in used])
    n = len(used)
    h = 12 / (n * (n + 1)) * sum(
        sum(x for x, (k, _) in zip(rk, used) if k == g) ** 2 / sum(k == g for k, _ in used) for g in "abcd"
    ) - 3 * (n + 1)
    ties = [sum(v == x for _, x in used) for v in {v for _, v in used}]
    h /= 1 - sum(t**3 - t for t in ties) / (n**3 - n)
    assert (r["groups"], r["n"], r["freedom"]) == (4, n, 3) and math.isclose(r["h"], h, rel_tol=1e-9)
    assert math.isclose(r["p_value"], gamma_tail(1.5, h / 2), rel_tol=1e-9)
    one = spark.createDataFrame([("a", float(i)) for i in range(50)], "g string, v double")
    assert stats.kruskal_wallis(one, "g", "v").count() == 0


def test_constant_and_perfect_columns(spark):
    df = spark.range(60).select(
        F.col("id").cast("double").alias("x"), F.lit(1.0).alias("c"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"),
    )
    assert rows(stats.spearman(df, "x", "x")) == [(60, 1.0, 0.0)]
    assert rows(stats.spearman(df, "x", "c")) == [(60, None, None)]
    assert rows(stats.kruskal_wallis(df, "g", "c").select("h", "p_value")) == [(None, None)]
    assert stats.correlations(df, [("x", "c")]).first()["n"] == 60
    assert stats.linear_trend(df, ["c"], "x").first()["n"] == 60
    none = stats.share_at_or_below(df.limit(1), "x", df.where("x < 0"), "x", "s")
    assert none.first()["s"] is None


def test_histogram_keeps_empty_bins_and_the_top_edge(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0, 1, 9, 10]] + [(None,)], "v double")
    assert [r["n"] for r in stats.histogram(df, "v", 10).collect()] == [2, 1, 0, 0, 0, 0, 0, 0, 0, 2]
    flat = spark.createDataFrame([(5.0,)] * 3, "v double")
    got = stats.histogram(flat, "v", 4).collect()
    assert sum(r["n"] for r in got) == 3 and got[0]["bin_start"] == 4.5


def test_winsorize_skips_null_and_absent_columns(spark):
    df = spark.createDataFrame([(float(v), None) for v in range(101)] + [(None, None)], "v double, w double")
    got = stats.winsorize(df, ["v", "w", "zzz"]).agg(F.min("v"), F.max("v"), F.count("v"), F.count("w")).first()
    assert tuple(got) == (1.0, 99.0, 101, 0)


def test_label_is_strict(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 3]], "repeat_listens int")
    assert [r["is_high_replay"] for r in stats.high_label(df).collect()] == [0, 0, 0, 0]


def test_correlations_pairwise_and_listwise(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 1.0, 5.0), (3.0, 5.0, 1.0), (4.0, 4.0, 2.0)], "a double, b double, c double")
    pair = {(r["a"], r["b"]): (r["n"], r["r"]) for r in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    whole = {(r["a"], r["b"]): r["n"] for r in stats.correlation_matrix(df, ["a", "b", "c"], listwise=True).collect()}
    assert pair["a", "b"][0] == 4 and pair["a", "c"][0] == 3 and set(whole.values()) == {3}
    assert math.isclose(pair["a", "b"][1], np.corrcoef([1, 2, 3, 4], [2, 1, 5, 4])[0, 1], abs_tol=1e-6)


def test_box_summary(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]], "genre string, log_repeat_listens double")
    assert rows(stats.box_summary(df)) == [("a", 5, 2.0, 3.0, 4.0, 1.0, 4.0, 1)]


def test_share_at_or_below_answers_unseen_points(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 4.0, None]], "y double")
    points = spark.createDataFrame([(1, 0.5), (2, 2.0), (3, 3.0), (4, 9.0), (5, None)], "i int, p double")
    got = dict(rows(stats.share_at_or_below(points, "p", df, "y", "s").select("i", "s")))
    assert got == {1: 0.0, 2: 75.0, 3: 75.0, 4: 100.0, 5: None}


def test_guard(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "v int")
    assert stats.guarded(df, ["v"], 2).count() == 2 and stats.guarded(df, ["v"], 3).count() == 0


def test_correlations_in_blocks(spark, monkeypatch):
    """Blocks of two columns, several partitions, missing values of both kinds, far-off means."""
    monkeypatch.setattr(stats, "_BLOCK", 2)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5)) + [0, 1e6, -5, 3, 0]
    x[:, 3] += x[:, 0]
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 4] = 7.0
    frame = pd.DataFrame(x, columns=list("abcde"))
    cells = [[None if np.isnan(v) and i % 2 else float(v) for v in r] for i, r in enumerate(x)]
    df = spark.createDataFrame(cells, "a double, b double, c double, d double, e double").repartition(7)
    want = frame.corr()
    for r in stats.correlation_matrix(df, list("abcde")).collect():
        assert r.n == (frame[r.a].notna() & frame[r.b].notna()).sum()
        assert r.r is None if "e" in (r.a, r.b) else r.r == pytest.approx(want.loc[r.a, r.b], abs=1e-6)
    assert [r.n for r in stats.correlation_matrix(df.limit(0), ["a", "b"]).collect()] == [0]
