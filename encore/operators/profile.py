"""Whole-table descriptions: nulls, coverage, option lists, defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.config import AUDIO_SIGNALS, RAW_TARGET, TARGET, UNKNOWN
from encore.functions import lenient
from encore.operators.order import column_quantiles, group_quantiles


def existing(wanted: Sequence[str], available: Sequence[str]) -> list[str]:
    """Wanted columns that exist, in wanted order, each once."""
    have = set(available)
    return [c for c in dict.fromkeys(wanted) if c in have]


def observed_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, observed)``: non-null values per column, all in one pass."""
    columns = existing(columns, df.columns)
    one = df.agg(*[F.count(c).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "observed")


def observed_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns holding at least one value (reads one tiny aggregate row)."""
    columns = existing(columns, df.columns)
    if not columns:
        return []
    row = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] > 0]


def missingness(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Nulls per column, most incomplete first."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    long = counts.unpivot(["_rows"], df.columns, "column", "nulls")
    share = F.round(F.lit(100.0) * F.col("nulls") / F.greatest(F.col("_rows"), F.lit(1)), 2)
    out = long.select("column", "nulls", share.alias("pct_missing")).orderBy(
        F.desc("pct_missing"), "column"
    )
    return out if limit is None else out.limit(limit)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent; an empty whole counts as one."""
    return F.round(F.lit(100.0) * part / F.greatest(whole, F.lit(1)), digits)


def _distinct_with_null(column: str) -> Column:
    return F.count_distinct(column) + F.coalesce(
        F.max(F.when(F.col(column).isNull(), 1)), F.lit(0)
    ).cast("bigint")


def dataset_summary(
    df: DataFrame,
    key: str = "mbid",
    entity: str = "artist_name",
    category: str = "genre",
    flag: str = "has_audio_features",
    signals: Sequence[str] = AUDIO_SIGNALS,
) -> DataFrame:
    """One row describing the processed table: size, uniqueness, medians, coverage, nulls."""
    complete = F.lit(True)
    for c in signals:
        complete = complete & F.col(c).isNotNull()
    # Distinct counts run as their own aggregates: several distincts in one aggregate would
    # multiply every input row.
    base = df.agg(
        F.count("*").alias("row_count"),
        F.sort_array(F.collect_set(category)).alias("genres"),
        F.coalesce(F.sum(F.col(flag).cast("bigint")), F.lit(0)).alias(
            "rows_with_any_audio_features"
        ),
        F.count_if(complete).alias("rows_with_complete_audio_features"),
        F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).alias(
            "null_counts"
        ),
    )
    entities = df.agg(_distinct_with_null(entity).alias("x")).scalar()
    keys = df.agg(_distinct_with_null(key).alias("x")).scalar()
    middles = column_quantiles(df, [RAW_TARGET, TARGET], [0.5])

    def middle(c: str) -> Column:
        return middles.where(F.col("column") == c).select(F.col("q")[0]).scalar()

    n = F.col("row_count")
    return base.select(
        n,
        F.lit(len(df.columns)).alias("column_count"),
        entities.alias("unique_artists"),
        keys.alias("unique_tracks"),
        "genres",
        middle(RAW_TARGET).alias("median_repeat_listens"),
        middle(TARGET).alias("median_log_repeat_listens"),
        "rows_with_any_audio_features",
        "rows_with_complete_audio_features",
        percent(F.col("rows_with_any_audio_features"), n).alias("audio_feature_coverage_pct"),
        percent(F.col("rows_with_complete_audio_features"), n).alias(
            "complete_audio_feature_coverage_pct"
        ),
        "null_counts",
    )


def collection_summary(
    raw: DataFrame, popularity: DataFrame, audio: DataFrame, key: str = "mbid", tag: str = "genre"
) -> DataFrame:
    """One row of collection volumes plus ``(genre, n)`` pairs per tag."""
    usable = F.nullif(F.col(key).cast("string"), F.lit(""))
    tags = (
        raw.groupBy(F.coalesce(F.nullif(F.col(tag), F.lit("")), F.lit(UNKNOWN)).alias("genre"))
        .agg(F.count("*").alias("n"))
        .agg(F.sort_array(F.collect_list(F.struct("genre", "n"))).alias("x"))
        .scalar()
    )
    pop_rows = popularity.agg(F.count("*").alias("x")).scalar()
    audio_rows = audio.agg(F.count("*").alias("x")).scalar()
    base = raw.agg(
        F.count("*").alias("musicbrainz_rows"), F.count_distinct(usable).alias("unique_recordings")
    ).select(
        "*", pop_rows.alias("listenbrainz_rows"), audio_rows.alias("acousticbrainz_rows")
    )
    return base.select(
        "*",
        percent(F.col("listenbrainz_rows"), F.col("unique_recordings")).alias(
            "listenbrainz_coverage_pct"
        ),
        percent(F.col("acousticbrainz_rows"), F.col("listenbrainz_rows")).alias(
            "acousticbrainz_coverage_pct"
        ),
        tags.alias("genre_counts"),
    )


def option_list(df: DataFrame, column: str, fallback: str = UNKNOWN) -> DataFrame:
    """Distinct non-empty values in order; the fallback alone when there is none."""
    spark = df.sparkSession
    if column not in df.columns:
        return spark.createDataFrame([(fallback,)], "value string")
    values = (
        df.where(F.col(column).isNotNull() & (F.col(column) != ""))
        .select(F.col(column).alias("value"))
        .distinct()
    )
    found = values.agg(F.count("*").alias("x")).scalar()
    lone = spark.createDataFrame([(fallback,)], "value string").where(found == 0)
    return values.unionByName(lone).orderBy("value")


def median_default(df: DataFrame, column: str, fallback: float, out: str = "value") -> DataFrame:
    """One row: the median of the parsable values, or the fallback."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([(float(fallback),)], f"{out} double")
    numbers = df.select(lenient(column, "double").alias("_x"))
    found = group_quantiles(numbers, "_x", [0.5])
    # Aggregating keeps one row even when nothing was parsable.
    return found.agg(F.coalesce(F.max(F.col("q")[0]), F.lit(float(fallback))).alias(out))


def range_bounds(df: DataFrame, period: str, fallback_low: int, fallback_high: int) -> DataFrame:
    """Lowest and highest period, the sorted distinct periods, with fall-backs when empty."""
    return df.agg(
        F.coalesce(F.min(period), F.lit(fallback_low)).alias("low"),
        F.coalesce(F.max(period), F.lit(fallback_high)).alias("high"),
        F.sort_array(F.collect_set(period)).alias("periods"),
    )


def coverage(df: DataFrame, flag: str = "has_audio_features") -> DataFrame:
    return df.agg(F.coalesce(F.avg(F.col(flag).cast("double")), F.lit(0.0)).alias("coverage"))
