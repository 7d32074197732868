"""Exact order statistics that never bring a whole group into one task.

Built-in exact ``percentile`` keeps every distinct value of a group in one buffer, and ``rank()``
without a partition sorts the table in one task. Here the value axis is first cut into
equal-depth ranges (bounds from Spark's own sketch; they only steer balance, never the answer).
Counts per (group, range) are tiny and combine map-side, so

* a quantile needs only the one or two ranges that hold its rank, and
* a rank is the count of all lower ranges plus a running count inside the value's range.

The bounds are literals in the plan: a recomputed task sees the same ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from encore.config import ORDER_RANGES, QUARTILE_LABELS
from encore.session import stage_table

_BEFORE = (W.unboundedPreceding, -1)
_PROBE = "_range_probe"


def with_value_range(
    df: DataFrame, value: str, out: str, ranges: int = ORDER_RANGES
) -> DataFrame:
    """Add ``out``: the ordinal of the equal-depth range holding ``value`` (monotone in it)."""
    probe = df.select(F.col(value).cast("double").alias(_PROBE))
    found = None
    if ranges > 1:
        # Written as one text: a thousand separate literal calls would cost more than the scan.
        shares = F.expr("array(" + ", ".join(f"{i / ranges!r}D" for i in range(1, ranges)) + ")")
        # One row of at most `ranges` numbers comes back.
        found = probe.agg(F.percentile_approx(_PROBE, shares, F.lit(2 * ranges))).first()[0]
    inner = sorted({b for b in found or () if b == b and abs(b) != float("inf")})
    if not inner:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *inner, float("inf")]
    cutter = Bucketizer(splits=splits, inputCol=_PROBE, outputCol=out, handleInvalid="keep")
    cut = cutter.transform(df.withColumn(_PROBE, F.col(value).cast("double"))).drop(_PROBE)
    return cut.withColumn(out, F.col(out).cast("int"))


def _same_group(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def group_quantiles(
    df: DataFrame,
    value: str,
    shares: Sequence[float],
    by: Sequence[str] = (),
    out: str = "q",
    method: str = "linear",
    ranges: int = ORDER_RANGES,
    few: bool = False,
) -> DataFrame:
    """Exact quantiles per group: columns ``by``, ``n`` (non-null values) and array ``out``.

    ``linear`` interpolates between neighbours, ``nearest`` takes the closest rank, ``closing``
    the last of the first floor(share * n) values (null when that is none; a group without any
    is left out), and ``approx`` uses Spark's sketch in one pass. With no ``by`` the result is
    one row (none when empty). ``few`` says that the groups are a fixed, small number.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    if method == "approx":
        wanted = F.array(*[F.lit(float(p)) for p in shares])
        sketch = F.percentile_approx(F.col("_v").cast("double"), wanted, F.lit(10_000))
        return rows.groupBy(*by).agg(F.count("*").alias("n"), sketch.alias(out))

    rows = with_value_range(rows, "_v", "_r", ranges)
    counts = rows.groupBy(*by, "_r").agg(F.count("*").alias("_c"))
    whole = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    placed = counts.select(
        *by,
        "_r",
        "_c",
        F.coalesce(F.sum("_c").over(whole.orderBy("_r").rowsBetween(*_BEFORE)), F.lit(0)).alias(
            "_below"
        ),
        F.sum("_c").over(whole).alias("n"),
    )

    def ranks(p: float) -> list[Column]:
        position = (F.col("n") - 1) * F.lit(float(p))
        if method == "nearest":
            return [F.round(position).cast("bigint")]
        if method == "closing":
            return [F.floor(F.col("n") * F.lit(float(p))).cast("bigint") - 1]
        return [F.floor(position).cast("bigint"), F.ceil(position).cast("bigint")]

    every_rank = [r for p in shares for r in ranks(p)]
    hit = reduce(
        lambda a, b: a | b,
        [(F.col("_below") <= r) & (r < F.col("_below") + F.col("_c")) for r in every_rank],
    )
    wanted = placed.where(hit).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)],
        F.col("_r").alias("_kr"),
        "_below",
        "n",
    )
    # A group has two wanted ranges a share at most. Without groups that is a bounded few rows;
    # with them, staging lets Spark plan the join from their measured size.
    wanted = stage_table(wanted, "wanted") if by and not few else F.broadcast(wanted)
    same = F.col("_r") == F.col("_kr")
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    values = (
        rows.join(wanted, same).groupBy(*by, "_r", "_below", "n", "_v").agg(F.count("*").alias("_c"))
    )
    inside = W.partitionBy(*by, "_r").orderBy("_v")
    low = F.col("_below") + F.coalesce(F.sum("_c").over(inside.rowsBetween(*_BEFORE)), F.lit(0))
    spans = values.withColumn("_lo", low).withColumn("_hi", F.col("_lo") + F.col("_c"))

    def at(rank: Column) -> Column:
        return F.max(
            F.when((F.col("_lo") <= rank) & (rank < F.col("_hi")), F.col("_v").cast("double"))
        )

    found = spans.groupBy(*by, "n").agg(
        *[at(r).alias(f"_p{i}_{j}") for i, p in enumerate(shares) for j, r in enumerate(ranks(p))]
    )

    def answer(i: int, p: float) -> Column:
        if method != "linear":
            return F.col(f"_p{i}_0")
        position = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"_p{i}_0"), F.col(f"_p{i}_1")
        return low + (high - low) * (position - F.floor(position))

    return found.select(*by, "n", F.array(*[answer(i, p) for i, p in enumerate(shares)]).alias(out))


def group_median(df: DataFrame, value: str, by: Sequence[str], out: str, **kw) -> DataFrame:
    """Columns ``by`` and ``out``."""
    found = group_quantiles(df, value, [0.5], by, "_q", **kw)
    return found.select(*by, F.col("_q")[0].alias(out))


def column_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], out: str = "q", **kw
) -> DataFrame:
    """Quantiles of several columns in the same passes: ``column``, ``n``, ``out``."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "_value"
    )
    return group_quantiles(long, "_value", shares, ["column"], out, few=True, **kw)


def scalar_quantile(df: DataFrame, value: str, share: float, **kw) -> Column:
    """One exact quantile as a scalar subquery: usable in any expression, no join."""
    return group_quantiles(df, value, [share], **kw).select(F.col("q")[0]).scalar()


def value_ranks(
    df: DataFrame, value: str, weight: str | None = None, ranges: int = ORDER_RANGES, **extra: Column
) -> DataFrame:
    """One row per distinct non-null value with ``n`` (rows or summed weight), ``below`` (how
    many rank lower), ``avg_rank`` (mean 1-based rank of its ties) and the ``extra`` aggregates.

    The distinct values are staged, so ``df`` itself is computed once.
    """
    size = F.sum(weight) if weight else F.count("*")
    distinct = (
        df.where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(size.cast("bigint").alias("n"), *[agg.alias(name) for name, agg in extra.items()])
    )
    distinct = with_value_range(stage_table(distinct, "values"), value, "_r", ranges)
    per_range = distinct.groupBy("_r").agg(F.sum("n").alias("_c"))
    ahead = W.partitionBy(F.lit(0)).orderBy("_r").rowsBetween(*_BEFORE)
    offsets = per_range.select("_r", F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_ahead"))
    inside = W.partitionBy("_r").orderBy(value).rowsBetween(*_BEFORE)
    placed = distinct.withColumn("_in", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    # At most `ranges` offset rows exist, whatever the input size.
    return (
        placed.join(F.broadcast(offsets), "_r")
        .withColumn("below", F.col("_ahead") + F.col("_in"))
        .withColumn("avg_rank", F.col("below") + (F.col("n") + 1) / 2)
        .select(value, "n", "below", "avg_rank", *extra)
    )


def quartile_label(value: Column, cuts: Column) -> Column:
    """Right-closed quartile label from an array of the three inner cuts; ties stay together."""
    return (
        F.when(value.isNull() | cuts.isNull(), F.lit(None).cast("string"))
        .when(value <= cuts[0], F.lit(QUARTILE_LABELS[0]))
        .when(value <= cuts[1], F.lit(QUARTILE_LABELS[1]))
        .when(value <= cuts[2], F.lit(QUARTILE_LABELS[2]))
        .otherwise(F.lit(QUARTILE_LABELS[3]))
    )


def with_quartile(df: DataFrame, value: str, out: str = "quartile") -> DataFrame:
    """Label each row with the quartile of ``value`` over the whole frame."""
    cuts = group_quantiles(df, value, [0.25, 0.5, 0.75]).select("q").scalar()
    return df.withColumn(out, quartile_label(F.col(value), cuts))


def with_codes(
    df: DataFrame, columns: Sequence[str], suffix: str = "_enc", filler: str | None = None
) -> DataFrame:
    """Add a 0-based code per column: the value's place among its sorted distinct values.

    All level lists come from one pass and are staged, so Spark picks each join from their
    measured size. Levels are dealt by range and numbered within their part, with the parts'
    sizes added, so no column's levels meet in one task.
    """
    if filler is not None:
        df = df.withColumns(
            {c: F.coalesce(F.col(c).cast("string"), F.lit(filler)) for c in columns}
        )
    levels = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "_column", "_level")
        .where(F.col("_level").isNotNull())
        .distinct()
    )
    # Written with their part, which a recomputed task therefore can't change.
    dealt = levels.repartitionByRange("_column", "_level").withColumn("_part", F.spark_partition_id())
    dealt = stage_table(dealt, "level-parts")
    before = W.partitionBy("_column").orderBy("_part").rowsBetween(*_BEFORE)
    sizes = dealt.groupBy("_column", "_part").agg(F.count("*").alias("_c"))
    offsets = sizes.select(
        F.col("_column").alias("_oc"),
        F.col("_part").alias("_op"),
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_ahead"),
    )
    inside = W.partitionBy("_column", "_part").orderBy("_level")
    # As many offsets as shuffle partitions hold parts of columns.
    levels = dealt.withColumn("_in", F.row_number().over(inside) - 1).join(
        F.broadcast(offsets), (F.col("_column") == F.col("_oc")) & (F.col("_part") == F.col("_op"))
    )
    levels = stage_table(
        levels.select("_column", "_level", (F.col("_ahead") + F.col("_in")).alias("_code")), "levels"
    )
    for c in columns:
        codes = levels.where(F.col("_column") == c).select(
            F.col("_level").alias(f"_{c}"), F.col("_code").cast("int").alias(f"{c}{suffix}")
        )
        df = df.join(codes, F.col(c).cast("string") == F.col(f"_{c}"), "left").drop(f"_{c}")
    return df


def keep_first(
    df: DataFrame, key: Sequence[str], order: Sequence[Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the first by ``order``. Combines map-side, so hot keys stay cheap."""
    return _keep(df, key, order, columns, F.min_by)


def keep_last(
    df: DataFrame, key: Sequence[str], order: Sequence[Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the last by ``order``."""
    return _keep(df, key, order, columns, F.max_by)


def _keep(df, key, order, columns, pick) -> DataFrame:
    """``order`` should decide alone; remaining ties are open."""
    key = list(key)
    rest = [c for c in (columns or df.columns) if c not in key]
    kept = df.groupBy(*key).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return kept.select(*key, *[F.col("_row")[c].alias(c) for c in rest])


def running_total(
    df: DataFrame, order: str, value: str, out: str, by: Sequence[str] = ()
) -> DataFrame:
    """Cumulative sum along ``order``, meant for small per-component tables."""
    part = W.partitionBy(*by) if by else W.partitionBy(F.lit(0))
    frame = part.orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(frame))


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Ordered prefix; plans as one bounded heap per task."""
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, by: Sequence[str], n: int, *order: Column, out: str = "rank"):
    """First ``n`` rows per group. Each task trims to ``n`` per group before the shuffle."""
    place = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn(out, place).where(F.col(out) <= n)


def fixed_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Repeatable sample without replacement of min(n, rows), the same on any partitioning."""
    mixed = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(mixed, F.col(key)).limit(n)
