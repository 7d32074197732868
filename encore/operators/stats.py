"""Statistics over whole tables, each in a fixed number of distributed passes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.config import RAW_TARGET, TARGET
from encore.functions import clip_keep_null
from encore.functions.tails import chi_square_tail, t_two_sided
from encore.operators.order import (
    column_quantiles,
    group_quantiles,
    scalar_quantile,
    value_ranks,
    with_quartile,
)
from encore.operators.profile import existing
from encore.session import stage_table


def winsorize(
    df: DataFrame,
    columns: Sequence[str],
    low: float = 0.01,
    high: float = 0.99,
    method: str = "nearest",
) -> DataFrame:
    """Clip each column to its own quantiles; all bounds come from the same passes."""
    columns = existing(columns, df.columns)
    found = column_quantiles(df, columns, [low, high], method=method)
    bounds = (
        found.agg(*[F.max(F.when(F.col("column") == c, F.col("q"))).alias(c) for c in columns])
        .select(F.struct(*columns))
        .scalar()
    )
    b = F.col("_bounds")
    clipped = {c: clip_keep_null(F.col(c).cast("double"), b[c][0], b[c][1]) for c in columns}
    return df.withColumn("_bounds", bounds).withColumns(clipped).drop("_bounds")


def high_label(
    df: DataFrame, raw: str = RAW_TARGET, share: float = 0.75, out: str = "is_high_replay"
) -> DataFrame:
    """1 where the raw target is strictly above its linear quantile."""
    return df.withColumn(out, (F.col(raw) > scalar_quantile(df, raw, share)).cast("byte"))


def histogram(
    df: DataFrame, value: str, bins: int = 80, clip_share: float | None = None
) -> DataFrame:
    """Equal-width bins between the extremes, last bin closed, empty bins kept.

    ``clip_share`` first clamps to [0, that quantile].
    """
    rows = df.select(F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    if clip_share is not None:
        top = scalar_quantile(df.select(F.col(value).cast("double").alias("_x")), "_x", clip_share)
        rows = rows.select(F.greatest(F.lit(0.0), F.least(F.col("_x"), top)).alias("_x"))
    span = rows.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    edge = span.select(
        F.struct(
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    ).scalar()
    low, width = F.col("_e.lo"), F.col("_e.hi") - F.col("_e.lo")
    slot = F.least(F.floor((F.col("_x") - low) * F.lit(bins) / width), F.lit(bins - 1))
    counts = (
        rows.withColumn("_e", edge)
        .groupBy(slot.cast("int").alias("bin"))
        .agg(F.count("*").alias("_n"))
    )
    return (
        df.sparkSession.range(bins)
        .select(F.col("id").cast("int").alias("bin"), edge.alias("_e"))
        .join(counts, "bin", "left")
        .select(
            "bin",
            (low + F.col("bin") * (width / F.lit(bins))).alias("bin_start"),
            F.coalesce("_n", F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def _pearson(x: Column, y: Column) -> Column:
    """Pearson r of complete pairs; null for a constant column, where ``corr`` fails in ANSI
    mode."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


#: Columns of a block of cross-products.
_BLOCK = 64


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int = 6) -> DataFrame:
    """``(a, b, n, r)`` for each pair over its own complete rows; NaN counts as missing.

    Two scans: the columns' means, then for each task the cross-products of centred columns, as
    matrix products of blocks with their masks. A task gives one row per pair, however many it read.
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    place = {c: k for k, c in enumerate(names)}
    cells = [F.nullif(F.col(c).try_cast("double"), F.lit(float("nan"))) for c in names]
    rows = df.select(*[x.alias(f"c{k}") for k, x in enumerate(cells)])
    means = rows.agg(*[F.avg(c) for c in rows.columns]).first()  # one number a column
    centre = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    at = [(place[a], place[b]) for a, b in pairs]
    blocks = sorted({(i // _BLOCK, j // _BLOCK) for i, j in at})
    size = _BLOCK

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            here = ~np.isnan(values)
            x = np.where(here, values - centre, 0.0)
            m = here.astype(float)
            for p, q in blocks:
                a, b = slice(p * size, (p + 1) * size), slice(q * size, (q + 1) * size)
                xa, ma, xb, mb = x[:, a].T, m[:, a].T, x[:, b], m[:, b]
                found = np.stack([
                    ma @ mb, xa @ mb, ma @ xb, (xa * xa) @ mb, ma @ (xb * xb), xa @ xb
                ])
                total[p, q] = total[p, q] + found if (p, q) in total else found
        if total:
            out = np.array([total[i // size, j // size][:, i % size, j % size] for i, j in at]).T
            columns = [pa.array(np.arange(len(at), dtype=np.int32)), *map(pa.array, out)]
            yield pa.RecordBatch.from_arrays(columns, ["pair", "n", "x", "y", "xx", "yy", "xy"])

    found = (
        rows.mapInArrow(
            products, "pair int, n double, x double, y double, xx double, yy double, xy double"
        )
        .groupBy("pair")
        .agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    )
    n = F.col("n")
    spread_x = F.col("xx") - F.try_divide(F.col("x") * F.col("x"), n)
    spread_y = F.col("yy") - F.try_divide(F.col("y") * F.col("y"), n)
    # What rounding leaves of a constant column is no spread.
    least = F.lit(1e-12)
    spread_x = F.when(spread_x > least * F.col("xx"), spread_x)
    spread_y = F.when(spread_y > least * F.col("yy"), spread_y)
    both = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), n)
    r = F.try_divide(both, F.sqrt(spread_x * spread_y))
    wanted = df.sparkSession.createDataFrame(
        [(k, a, b) for k, (a, b) in enumerate(pairs)], "pair int, a string, b string"
    )
    # One row a pair.
    return wanted.join(F.broadcast(found), "pair", "left").select(
        "a", "b", F.coalesce(n.cast("bigint"), F.lit(0)).alias("n"), F.round(r, digits).alias("r")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str], listwise: bool = False) -> DataFrame:
    """Lower triangle of the Pearson matrix; ``listwise`` first drops incomplete rows."""
    columns = existing(columns, df.columns)
    rows = df.na.drop(subset=columns) if listwise else df
    return correlations(rows, list(combinations(columns, 2)))


def target_correlations(df: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    return correlations(df, [(f, target) for f in features]).select(
        F.col("a").alias("feature"), "n", "r"
    )


def linear_trend(df: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    """Least-squares line and Pearson r of the target on each feature, over all rows."""
    y = F.col(target).cast("double")

    def line(f: str) -> Column:
        a, b = F.col(f).cast("double"), y
        x, z = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
        slope = F.try_divide(F.covar_pop(a, b), F.var_pop(x))
        return F.struct(
            F.lit(f).alias("feature"),
            F.round(slope, 6).alias("slope"),
            F.round(F.avg(z) - slope * F.avg(x), 6).alias("intercept"),
            F.round(_pearson(x, z), 6).alias("r"),
            F.count_if(a.isNotNull() & b.isNotNull()).alias("n"),
        )

    one = df.agg(*[line(f).alias(f"_{i}") for i, f in enumerate(features)])
    return one.select(F.inline(F.array(*[f"_{i}" for i in range(len(features))])))


def kruskal_wallis(
    df: DataFrame,
    group: str = "genre",
    value: str = TARGET,
    top: int = 5,
    more_than: int = 20,
) -> DataFrame:
    """Tie-corrected H over the ``top`` largest groups holding more than ``more_than`` values.

    One row, or none when fewer than two groups qualify.
    """
    # `top` group names: a handful of rows.
    largest = (
        df.groupBy(group)
        .agg(F.count("*").alias("_n"))
        .orderBy(F.desc("_n"), F.asc_nulls_last(group))
        .limit(top)
        .select(F.col(group).alias("_g"))
    )
    pairs = (
        df.join(F.broadcast(largest), F.col(group).eqNullSafe(F.col("_g")), "left_semi")
        .where(F.col(value).isNotNull())
        .groupBy(group, value)
        .agg(F.count("*").alias("_w"))
    )
    sizes = pairs.groupBy(group).agg(F.sum("_w").alias("_size")).where(F.col("_size") > more_than)
    pairs = pairs.join(
        F.broadcast(sizes.withColumnRenamed(group, "_g")),
        F.col(group).eqNullSafe(F.col("_g")),
    ).select(group, value, "_w", "_size")
    pairs = stage_table(pairs, "group-values")
    ranks = value_ranks(pairs, value, weight="_w")
    tie = ranks.agg(
        F.sum(F.col("n").cast("double") * F.col("n") * F.col("n") - F.col("n")).alias("x")
    ).scalar()
    sums = (
        pairs.join(ranks.select(F.col(value).alias("_v"), "avg_rank"), F.col(value) == F.col("_v"))
        .groupBy(group, "_size")
        .agg(F.sum(F.col("_w") * F.col("avg_rank")).alias("_r"))
    )
    n = F.col("n").cast("double")
    return (
        sums.agg(
            F.count("*").alias("groups"),
            F.sum("_size").alias("n"),
            F.sum(F.col("_r") * F.col("_r") / F.col("_size")).alias("_s"),
        )
        .where(F.col("groups") >= 2)
        .withColumn(
            "h",
            # Null when every value is the same.
            F.try_divide(
                F.lit(12.0) / (n * (n + 1)) * F.col("_s") - 3 * (n + 1),
                F.lit(1.0) - tie / (n * n * n - n),
            ),
        )
        .select(
            "groups",
            "n",
            (F.col("groups") - 1).alias("freedom"),
            "h",
            F.when(
                F.col("h").isNotNull(),
                chi_square_tail("h", (F.col("groups") - 1).cast("double")),
            ).alias("p_value"),
        )
    )


def spearman(
    df: DataFrame, x: str = "duration_sec", y: str = TARGET, more_than: int = 20
) -> DataFrame:
    """Rank correlation over complete rows with its two-sided p-value; no row when too few.

    Ranks join to the distinct (x, y) pairs, so repeated values travel once.
    """
    pairs = stage_table(
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(x).alias("_x"), F.col(y).alias("_y"))
        .agg(F.count("*").alias("_w")),
        "value-pairs",
    )
    rx = value_ranks(pairs, "_x", weight="_w").select("_x", F.col("avg_rank").alias("_rx"))
    ry = value_ranks(pairs, "_y", weight="_w").select("_y", F.col("avg_rank").alias("_ry"))
    total = pairs.agg(F.sum("_w").alias("n")).scalar()
    dx = F.col("_rx") - (total + 1) / 2
    dy = F.col("_ry") - (total + 1) / 2
    w = F.col("_w")
    one = (
        pairs.join(rx, "_x")
        .join(ry, "_y")
        .agg(
            F.sum(w).alias("n"),
            # Null for a constant column.
            F.try_divide(
                F.sum(w * dx * dy), F.sqrt(F.sum(w * dx * dx) * F.sum(w * dy * dy))
            ).alias("rho"),
        )
        .where(F.col("n") > more_than)
    )
    rest = 1 - F.col("rho") * F.col("rho")
    t = F.col("rho") * F.sqrt(F.try_divide(F.col("n") - 2, F.when(rest > 0, rest)))
    p = F.when(t.isNotNull(), t_two_sided(t, (F.col("n") - 2).cast("double"))).when(
        F.col("rho").isNotNull(), F.lit(0.0)
    )
    return one.select("n", "rho", p.alias("p_value"))


def box_summary(df: DataFrame, group: str = "genre", value: str = TARGET) -> DataFrame:
    """Quartiles, 1.5-IQR whiskers and outlier counts per group."""
    rows = df.where(F.col(value).isNotNull()).select(group, F.col(value).alias("_v"))
    q = F.col("q")
    boxes = group_quantiles(rows, "_v", [0.25, 0.5, 0.75], [group]).select(
        F.col(group).alias("_g"),
        "n",
        q[0].alias("q1"),
        q[1].alias("median"),
        q[2].alias("q3"),
        (q[0] - 1.5 * (q[2] - q[0])).alias("_low"),
        (q[2] + 1.5 * (q[2] - q[0])).alias("_high"),
    )
    # One row a group, of measured size: rows are exchanged only if these don't fit a broadcast.
    boxes = stage_table(boxes, "boxes")
    v = F.col("_v")
    inside = v.between(F.col("_low"), F.col("_high"))
    return (
        rows.join(boxes, F.col(group).eqNullSafe(F.col("_g")))
        .groupBy(group, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, v)).alias("whisker_low"),
            F.max(F.when(inside, v)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .orderBy(F.desc("median"), F.asc_nulls_last(group))
    )


def quartile_distribution(df: DataFrame, value: str, target: str = TARGET) -> DataFrame:
    """Quartiles of ``value`` inside each quartile of the target."""
    rows = with_quartile(df.na.drop(subset=[value, target]), target)
    q = F.col("q")
    return (
        group_quantiles(rows, value, [0.25, 0.5, 0.75], ["quartile"])
        .select("quartile", "n", q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"))
        .orderBy("quartile")
    )


def share_at_or_below(points: DataFrame, point: str, df: DataFrame, value: str, out: str):
    """Add to each point the percent of ``value`` at or below it.

    Points enter the ranking with weight zero, so one cumulative count answers all of them.
    """
    marks = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("double").alias("_x"))
        .agg(F.count("*").alias("_w"))
        .unionByName(
            points.where(F.col(point).isNotNull())
            .select(F.col(point).cast("double").alias("_x"), F.lit(0).cast("bigint").alias("_w"))
            .distinct()
        )
    )
    total = df.agg(F.count(value).alias("x")).scalar()
    ranks = value_ranks(marks, "_x", weight="_w").select(
        "_x", F.try_divide(F.lit(100.0) * (F.col("below") + F.col("n")), total).alias(out)
    )
    return points.join(ranks, F.col(point).cast("double") == F.col("_x"), "left").drop("_x")


def guarded(df: DataFrame, columns: Sequence[str], at_least: int) -> DataFrame:
    """Rows complete in ``columns``, or no rows at all when there are fewer than ``at_least``."""
    rows = df.na.drop(subset=list(columns))
    enough = rows.agg(F.count("*").alias("x")).scalar()
    return rows.where(enough >= at_least)
