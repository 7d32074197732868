"""Grouped reports over the processed table. Column names default to that table's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.config import (
    DURATION_BIN_LABELS,
    DURATION_EDGES,
    DURATION_LABELS,
    RAW_TARGET,
    TARGET,
    UNKNOWN,
)
from encore.functions import bin_label
from encore.operators.order import group_median
from encore.session import stage_table


def _mean(column: str | Column, digits: int) -> Column:
    return F.round(F.avg(column), digits)


def category_summary(
    df: DataFrame, category: str = "genre", raw: str = RAW_TARGET, log: str = TARGET
) -> DataFrame:
    """Size, mean, exact median and mean log target per category, best median first."""
    sums = df.groupBy(category).agg(
        F.count("*").alias("n_tracks"),
        _mean(raw, 1).alias("avg_repeats"),
        _mean(log, 3).alias("avg_log_repeats"),
    )
    medians = group_median(df, raw, [category], "median_repeats").withColumn(
        "median_repeats", F.round("median_repeats", 1)
    )
    medians = medians.withColumnRenamed(category, "_key")
    return (
        sums.join(medians, F.col(category).eqNullSafe(F.col("_key")), "left")
        .select(category, "n_tracks", "avg_repeats", "median_repeats", "avg_log_repeats")
        .orderBy(F.desc_nulls_last("median_repeats"), F.asc_nulls_last(category))
    )


def period_trend(df: DataFrame, period: str = "release_decade", log: str = TARGET) -> DataFrame:
    return (
        df.where(F.col(period).isNotNull())
        .groupBy(period)
        .agg(
            F.count("*").alias("n_tracks"),
            _mean(log, 3).alias("avg_log_repeats"),
            F.round(F.stddev_samp(log), 3).alias("std_log_repeats"),
        )
        .orderBy(period)
    )


def top_entities(
    df: DataFrame,
    entity: str = "artist_name",
    raw: str = RAW_TARGET,
    min_rows: int = 5,
    limit: int = 25,
) -> DataFrame:
    return (
        df.where(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(
            F.count("*").alias("n_tracks"),
            _mean(raw, 1).alias("avg_repeats"),
            F.max(raw).alias("peak_repeats"),
        )
        .where(F.col("n_tracks") >= min_rows)
        .orderBy(F.desc("avg_repeats"), entity)
        .limit(limit)
    )


def segment_breakdown(
    df: DataFrame,
    segment: str = "artist_country",
    log: str = TARGET,
    min_rows: int = 30,
    limit: int = 30,
) -> DataFrame:
    return (
        df.where(F.col(segment).isNotNull() & (F.col(segment) != UNKNOWN))
        .groupBy(segment)
        .agg(F.count("*").alias("n_tracks"), _mean(log, 3).alias("avg_log_repeats"))
        .where(F.col("n_tracks") >= min_rows)
        .orderBy(F.desc("avg_log_repeats"), segment)
        .limit(limit)
    )


def bucket_rollup(
    df: DataFrame,
    value: str = "duration_sec",
    log: str = TARGET,
    edges: Sequence[float] = DURATION_EDGES,
    labels: Sequence[str] = DURATION_LABELS,
    out: str = "duration_bucket",
) -> DataFrame:
    """[a, b) buckets; a value on an edge opens the next bucket."""
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(bin_label(F.col(value), edges, labels, "left").alias(out))
        .agg(F.count("*").alias("n_tracks"), _mean(log, 3).alias("avg_log_repeats"))
        .orderBy(out)
    )


def overlap_rollup(df: DataFrame, matches: str = "genre_match_count", log: str = TARGET):
    return (
        df.groupBy(matches)
        .agg(F.count("*").alias("n_tracks"), _mean(log, 3).alias("avg_log_repeats"))
        .orderBy(matches)
    )


def coverage_scalar(df: DataFrame, flag: str = "has_audio_features", log: str = TARGET):
    on = F.col(flag) == 1
    off = F.col(flag) == 0
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(on).alias("with_audio_features"),
        F.round(F.lit(100.0) * F.avg(flag), 2).alias("pct_with_audio_features"),
        _mean(F.when(on, F.col(log)), 3).alias("avg_log_replays_with_audio"),
        _mean(F.when(off, F.col(log)), 3).alias("avg_log_replays_without_audio"),
    )


def coverage_by_category(
    df: DataFrame, category: str = "genre", flag: str = "has_audio_features"
) -> DataFrame:
    return (
        df.groupBy(category)
        .agg(
            F.count("*").alias("n_tracks"),
            F.count_if(F.col(flag) == 1).alias("with_audio_features"),
            F.round(F.lit(100.0) * F.avg(flag), 2).alias("pct_with_audio_features"),
        )
        .orderBy(F.desc("pct_with_audio_features"), F.desc("n_tracks"), category)
    )


# Published report names and the roll-up behind each.
REPORTS = {
    "genre_summary": category_summary,
    "decade_trend": period_trend,
    "top_artists": top_entities,
    "country_breakdown": segment_breakdown,
    "duration_buckets": bucket_rollup,
    "genre_overlap": overlap_rollup,
    "audio_coverage": coverage_scalar,
    "audio_by_genre": coverage_by_category,
}


def run_reports(tracks: DataFrame) -> dict[str, DataFrame]:
    """All eight roll-ups over one processed table."""
    return {name: report(tracks) for name, report in REPORTS.items()}


def report_sizes(reports: dict[str, DataFrame]) -> DataFrame:
    """``(section, rows)``: how many rows each report holds."""
    sizes = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("section"), "rows")
        for name, frame in reports.items()
    ]
    total = sizes[0]
    for frame in sizes[1:]:
        total = total.unionByName(frame)
    return total


def median_by_category(
    df: DataFrame, category: str = "genre", value: str = RAW_TARGET, out: str = "median_repeats"
) -> DataFrame:
    return group_median(df, value, [category], out).orderBy(
        F.desc_nulls_last(out), F.asc_nulls_last(category)
    )


def trend_band(df: DataFrame, period: str = "release_decade", log: str = TARGET) -> DataFrame:
    """Median per period with a one-deviation band; a lone row gets a zero-width band."""
    rows = df.where(F.col(period).isNotNull())
    spread = rows.groupBy(period).agg(
        F.coalesce(F.stddev_samp(log), F.lit(0.0)).alias("std_log_replays")
    )
    medians = group_median(rows, log, [period], "median_log_replays")
    return (
        medians.join(spread, period)
        .select(
            period,
            "median_log_replays",
            "std_log_replays",
            (F.col("median_log_replays") - F.col("std_log_replays")).alias("band_low"),
            (F.col("median_log_replays") + F.col("std_log_replays")).alias("band_high"),
        )
        .orderBy(period)
    )


def bucket_medians(
    df: DataFrame,
    value: str = "duration_sec",
    log: str = TARGET,
    edges: Sequence[float] = DURATION_EDGES,
    labels: Sequence[str] = DURATION_BIN_LABELS,
) -> DataFrame:
    """(a, b] bins in edge order with the median target of each."""
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("duration_bin"))
    rows = df.where(F.col(value).isNotNull()).select(
        bin_label(F.col(value), edges, labels, "right").alias("duration_bin"), log
    )
    return (
        group_median(rows, log, ["duration_bin"], "median_log_replays")
        .withColumn("bin_order", place.cast("int"))
        .select("bin_order", "duration_bin", "median_log_replays")
        .orderBy("bin_order")
    )


def top_groups(df: DataFrame, group: str = "genre", limit: int = 12, out: str = "tracks"):
    return (
        df.groupBy(group)
        .agg(F.count("*").alias(out))
        .orderBy(F.desc(out), F.asc_nulls_last(group))
        .limit(limit)
    )


def drill_down(
    df: DataFrame,
    groups: Sequence[str],
    low: int,
    high: int,
    group: str = "genre",
    period: str = "release_decade",
) -> DataFrame:
    """Rows of the chosen groups inside an inclusive period range; null periods drop out."""
    return df.where(
        F.col(group).isin(list(groups))
        & F.col(period).isNotNull()
        & F.col(period).between(low, high)
    )


def trend_by_group(
    df: DataFrame, period: str = "release_decade", group: str = "genre", log: str = TARGET
) -> DataFrame:
    return group_median(df, log, [period, group], "median_log_replays").orderBy(period, group)


def leaderboard(
    df: DataFrame, entity: str = "artist_name", log: str = TARGET, limit: int = 15
) -> DataFrame:
    return (
        df.where(F.col(entity).isNotNull())
        .groupBy(entity)
        .agg(F.count("*").alias("tracks"), F.round(F.avg(log), 6).alias("avg_log_replays"))
        .orderBy(F.desc("avg_log_replays"), entity)
        .limit(limit)
    )


def profile_by(df: DataFrame, group: str, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean of several columns per group."""
    return df.groupBy(group).agg(*[_mean(c, digits).alias(c) for c in columns]).orderBy(group)


def item_vs_group(
    df: DataFrame, key: str = "mbid", group: str = "genre", log: str = TARGET
) -> DataFrame:
    """Each row beside the median of its group and the gap between the two."""
    medians = group_median(df, log, [group], "group_median").withColumnRenamed(group, "_g")
    medians = stage_table(medians, "group-medians")  # of measured size when the join is planned
    return df.join(medians, F.col(group).eqNullSafe(F.col("_g")), "left").select(
        key, group, log, "group_median", (F.col(log) - F.col("group_median")).alias("gap")
    )


def catalog(df: DataFrame, limit: int = 10_000, key: str = "mbid", log: str = TARGET) -> DataFrame:
    """The search list: best rows that have both names, with a display label."""
    return (
        df.na.drop(subset=["title", "artist_name"])
        .orderBy(F.desc_nulls_last(log), key)
        .limit(limit)
        .withColumn("label", F.concat_ws(" — ", "title", "artist_name"))
    )


def search_catalog(listed: DataFrame, text: str) -> DataFrame:
    """Type-ahead: labels containing the typed text, ignoring case."""
    return listed.where(F.contains(F.lower("label"), F.lower(F.lit(text))))


def find_item(
    df: DataFrame, key_value, title: str, artist: str, key: str = "mbid"
) -> DataFrame:
    """The row with this id, else the first row with this title and artist."""
    by_id = df.where(F.col(key) == F.lit(key_value)).withColumn("_pref", F.lit(0))
    by_name = df.where(
        (F.col("title") == F.lit(title)) & (F.col("artist_name") == F.lit(artist))
    ).withColumn("_pref", F.lit(1))
    return by_id.unionByName(by_name).orderBy("_pref", key).limit(1).drop("_pref")


def best_row(df: DataFrame, metric: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(metric), *ties).limit(1)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str):
    return df.unpivot(list(ids), list(values), name, value)


def pivot_fixed(
    df: DataFrame, row: str, column: str, value: str, columns: Sequence[str], rows: Sequence[str]
) -> DataFrame:
    """Long to wide with a given row order; a listed row without data stays, all null."""
    spark = df.sparkSession
    order = spark.createDataFrame(
        [(i, r) for i, r in enumerate(rows)], f"row_order int, {row} string"
    )
    wide = df.groupBy(row).pivot(column, list(columns)).agg(F.first(value))
    return order.join(wide, row, "left").select("row_order", row, *columns).orderBy("row_order")
