"""Steps that turn raw records into the processed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.config import AUDIO_LABELS, AUDIO_SIGNALS, DEFAULT_FEATURES, RAW_TARGET, TARGET, UNKNOWN
from encore.config import FeatureConfig
from encore.functions import clip_keep_null, gate_range, lenient, null_column

# What a record is known by, in the output's order (fixed values).
FIRST_ATTRIBUTES = (
    "title",
    "duration_ms",
    "disambiguation",
    "release_type",
    "release_year",
    "artist_name",
    "artist_type",
    "artist_country",
    "artist_begin",
)


def collapse_records(
    raw: DataFrame,
    key: str = "mbid",
    tag: str = "genre",
    seq: str = "ingest_seq",
    attributes: Sequence[str] = FIRST_ATTRIBUTES,
) -> DataFrame:
    """One row per id: attributes of the earliest record (nulls included) and its distinct tags.

    Only the earliest struct and the distinct tags survive map-side, so a heavily repeated id
    never piles up in one task.
    """
    tags = F.col("_tags")
    return (
        raw.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.min_by(F.struct(*attributes), F.col(seq)).alias("_first"),
            F.sort_array(F.collect_set(tag)).alias("_tags"),
        )
        .select(
            key,
            *[F.col("_first")[c].alias(c) for c in attributes],
            F.coalesce(F.get(tags, F.lit(0)), F.lit(UNKNOWN)).alias("genre"),
            F.array_join(tags, " | ").alias("genre_tags_text"),
            F.size(tags).alias("genre_match_count"),
        )
    )


def with_audio(df: DataFrame, audio: DataFrame | None, key: str = "mbid") -> DataFrame:
    """Left join the optional enrichment; without one its columns are typed nulls."""
    if audio is None:
        return df.withColumns(
            {
                **{c: null_column("double") for c in AUDIO_SIGNALS},
                **{c: null_column("string") for c in AUDIO_LABELS},
            }
        )
    joined = df.join(audio, key, "left")
    return joined.withColumns({c: lenient(c, "double") for c in AUDIO_SIGNALS if c in joined.columns})


def with_target(
    df: DataFrame, total: str = "total_listen_count", users: str = "total_user_count"
) -> DataFrame:
    """Repeat count and its log; rows without a non-negative count drop out."""
    return (
        df.withColumn(RAW_TARGET, F.col(total) - F.col(users))
        .where(F.col(RAW_TARGET).isNotNull() & (F.col(RAW_TARGET) >= 0))
        .withColumn(TARGET, F.log1p(F.col(RAW_TARGET).cast("double")))
    )


def with_dates(df: DataFrame, cfg: FeatureConfig = DEFAULT_FEATURES) -> DataFrame:
    """Typed, gated years and the ages derived from them."""
    typed = df.withColumns(
        {
            "duration_ms": lenient("duration_ms", "double"),
            "release_year": gate_range(lenient("release_year", "int"), cfg.first_year, cfg.as_of_year),
            "artist_begin_year": lenient("artist_begin", "int"),
        }
    )
    year = F.col("release_year")
    return typed.withColumns(
        {
            "duration_sec": clip_keep_null(F.col("duration_ms") / 1000, 0.0, 900.0),
            "release_decade": (F.floor(year / 10) * 10).cast("int"),
            "track_age": clip_keep_null(F.lit(cfg.as_of_year) - year, 0, 120).cast("int"),
            "artist_career_age": clip_keep_null(year - F.col("artist_begin_year"), 0, 80).cast("int"),
        }
    )


def presence(columns: Sequence[str] = AUDIO_SIGNALS) -> tuple[Column, Column]:
    """(1 when any column is present else 0, how many are missing)."""
    missing = sum((F.col(c).isNull().cast("int") for c in columns[1:]), F.col(columns[0]).isNull().cast("int"))
    return (missing < len(columns)).cast("byte"), missing


def with_interactions(df: DataFrame) -> DataFrame:
    """Presence flags and the two products: one treats missing as zero, the other keeps null."""
    flag, missing = presence()
    zero = F.lit(0)
    return df.withColumns(
        {
            "has_audio_features": flag,
            "audio_feature_missing_count": missing,
            "career_x_duration_min": F.coalesce("artist_career_age", zero)
            * F.coalesce("duration_sec", F.lit(0.0))
            / 60,
            "tempo_x_dance": F.col("tempo") * F.col("danceability"),
        }
    )


# Column order of the processed table (fixed values).
CANONICAL_ORDER = (
    "mbid", "title", "artist_name", "genre", "genre_tags_text", "genre_match_count",
    "release_type", "release_year", "release_decade", "artist_type", "artist_country",
    "artist_begin_year", "artist_career_age", "track_age", "duration_ms", "duration_sec",
    "tempo", "danceability", "loudness", "dynamic_complexity", "key", "key_scale",
    "has_audio_features", "audio_feature_missing_count", "career_x_duration_min",
    "tempo_x_dance", "total_listen_count", "total_user_count", RAW_TARGET, TARGET,
)


def canonical(df: DataFrame, cfg: FeatureConfig = DEFAULT_FEATURES) -> DataFrame:
    """Known columns first, then encodings, then whatever is left."""
    codes = [f"{c}_enc" for c in cfg.all_categorical]
    head = [c for c in (*CANONICAL_ORDER, *codes) if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])
