"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.session import stage_table

ROUNDS = 60


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v, m): m is the least of u and all its v. Minima combine before the shuffle; the join
    back is one that Spark splits where a u has very many rows."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least")).select(
        F.col("u").alias("k"), F.least("u", "least").alias("m")
    )
    return pairs.join(least, F.col("u") == F.col("k")).select("u", "v", "m")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = _least(down)
    return stars.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        stars.select("u", F.col("m").alias("v"))
    )


def components(links: DataFrame) -> DataFrame:
    """(u, v) for every linked u but the least of its component: v is that least one.

    Each round is written to the shared folder, so lineage stays short and a lost executor costs
    one round. Links of a node to itself are ignored.
    """
    links = links.where("u <> v")
    before = None
    for _ in range(ROUNDS):
        links = stage_table(_small_star(_large_star(links)).where("u <> v").distinct(), "stars")
        state = links.agg(
            F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x"), F.sum(F.xxhash64("v", "u") % 65536).alias("s")
        ).first()
        if state == before:
            return links
        before = state
    raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
