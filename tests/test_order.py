import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from encore.operators import order


def frame(spark, data, schema, parts):
    return spark.createDataFrame(data, schema).repartition(parts)


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("ranges", [1, 8, 1024])
def test_group_quantiles_equal_numpy(spark, parts, ranges):
    rng = random.Random(parts)
    data = [(rng.choice("aaab"), rng.choice([None, rng.randint(0, 20), rng.random() * 1e6])) for _ in range(400)]
    data = [(g, None if v is None else float(v)) for g, v in data] + [(None, 3.0), (None, 4.0)]
    shares = [0.0, 0.01, 0.25, 0.5, 0.975, 1.0]
    df = frame(spark, data, "g string, v double", parts)
    got = {r["g"]: r for r in order.group_quantiles(df, "v", shares, ["g"], ranges=ranges).collect()}
    for g in ("a", "b", None):
        values = [v for k, v in data if k == g and v is not None]
        assert got[g]["n"] == len(values)
        assert np.allclose(got[g]["q"], np.percentile(values, [100 * p for p in shares]))


def test_nearest_and_closing_ranks(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)], "v double")
    near = order.group_quantiles(df, "v", [0.01, 0.5, 0.99], method="nearest").first()["q"]
    assert near == [1.0, 6.0, 10.0]  # ranks 0.09, 4.5 (rounds up), 8.91
    closing = order.group_quantiles(df, "v", [0.05, 0.2, 1.0], method="closing").first()["q"]
    assert closing == [None, 2.0, 10.0]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert order.group_quantiles(df, "v", [0.5]).count() == 0
    assert rows(df.withColumn("q", order.scalar_quantile(df, "v", 0.5))) == [(None, None)]


@pytest.mark.parametrize("parts", [1, 7])
def test_value_ranks_with_one_hot_value(spark, parts):
    values = [0.0] * 40 + [float(v) for v in range(-5, 15)] + [1e9, -1e9]
    df = frame(spark, [(v,) for v in values], "v double", parts)
    got = {r["v"]: r for r in order.value_ranks(df, "v", ranges=6).collect()}
    ordered = sorted(values)
    for v, r in got.items():
        assert r["n"] == ordered.count(v)
        assert r["below"] == sum(x < v for x in values)
        places = [i + 1 for i, x in enumerate(ordered) if x == v]
        assert r["avg_rank"] == sum(places) / len(places)


def test_quartiles_keep_ties_together(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 1, 1, 1, 2, 3, 4, 5])] + [(99, None)], "i int, v double")
    labels = dict(rows(order.with_quartile(df, "v").select("i", "quartile")))
    assert {labels[i] for i in range(4)} == {"Q1 (Low)"}
    assert labels[7] == "Q4 (High)" and labels[99] is None


def test_codes_follow_byte_order_and_fill(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("Z", 4)], "c string, i int")
    got = rows(order.with_codes(df, ["c"], filler="Unknown").select("i", "c", "c_enc"), "i")
    assert got == [(1, "b", 3), (2, "a", 2), (3, "Unknown", 0), (4, "Z", 1)]


def test_keep_first_keeps_null_fields(spark):
    df = spark.createDataFrame([("k", 2, "late"), ("k", 1, None)], "k string, s int, v string")
    assert rows(order.keep_first(df, ["k"], [F.col("s")])) == [("k", 1, None)]
    assert rows(order.keep_last(df, ["k"], [F.col("s")])) == [("k", 2, "late")]


def test_fixed_sample_ignores_partitioning(spark):
    df = spark.range(500)
    one = set(rows(order.fixed_sample(df.repartition(1), "id", 50)))
    many = set(rows(order.fixed_sample(df.repartition(9), "id", 50)))
    assert one == many and len(one) == 50
    assert order.fixed_sample(df.limit(3), "id", 50).count() == 3


def test_no_row_level_single_partition(spark):
    """Quantiles and ranks must not sort rows in one task or go through Python."""
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.rand(1).alias("v"))
    plan = order.group_quantiles(df, "v", [0.5], ["g"])._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Python" not in plan
    limited = order.top_per_group(df, ["g"], 2, F.col("v"))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in limited and "Partial" in limited
