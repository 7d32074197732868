"""Landed service responses to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions import fill_unknown, year_prefix


def _known(value: Column) -> Column:
    return fill_unknown(F.nullif(value, F.lit("")))


def flatten_recordings(payloads: DataFrame, tag: str = "genre", *keep: str) -> DataFrame:
    """One row per recording: its first release and first credited artist, with defaults.

    ``payloads`` follows ``RECORDING_PAYLOAD`` plus the search ``tag`` and any ``keep`` columns.
    A missing comment reads as empty text.
    """
    release = F.get(F.col("releases"), F.lit(0))
    artist = F.get(F.col("`artist-credit`"), F.lit(0))["artist"]
    return payloads.select(
        F.col("id").alias("mbid"),
        "title",
        F.col("length").alias("duration_ms"),
        F.col(tag).alias("genre"),
        F.coalesce("disambiguation", F.lit("")).alias("disambiguation"),
        _known(release["release-group"]["primary-type"]).alias("release_type"),
        year_prefix(release["date"]).alias("release_year"),
        artist["name"].alias("artist_name"),
        _known(artist["type"]).alias("artist_type"),
        _known(artist["country"]).alias("artist_country"),
        year_prefix(artist["life-span"]["begin"]).alias("artist_begin"),
        *keep,
    )


def flatten_popularity(responses: DataFrame, seq: str) -> DataFrame:
    """``(mbid, total_listen_count, total_user_count, seq, pos)`` of the usable items."""
    bare = F.array(F.struct("recording_mbid", "total_listen_count", "total_user_count"))
    items = (
        F.when(F.size("payload") > 0, F.col("payload"))
        .when(F.size("data") > 0, F.col("data"))
        .otherwise(bare)
    )
    return (
        responses.select(F.col(seq).alias("seq"), F.posexplode(items).alias("pos", "i"))
        .select(
            F.col("i.recording_mbid").alias("mbid"),
            F.col("i.total_listen_count").alias("total_listen_count"),
            F.col("i.total_user_count").alias("total_user_count"),
            "seq",
            "pos",
        )
        .where(
            F.col("mbid").isNotNull()
            & (F.col("mbid") != "")
            & F.col("total_listen_count").isNotNull()
            & F.col("total_user_count").isNotNull()
        )
    )


def last_popularity(responses: DataFrame, seq: str) -> DataFrame:
    """One row per id; the latest response wins."""
    counts = F.struct("total_listen_count", "total_user_count")
    return (
        flatten_popularity(responses, seq)
        .groupBy("mbid")
        .agg(F.max_by(counts, F.struct("seq", "pos")).alias("c"))
        .select("mbid", "c.total_listen_count", "c.total_user_count")
    )


def flatten_audio(payloads: DataFrame, key: str = "mbid") -> DataFrame:
    """Six flat audio columns per payload."""
    return payloads.select(
        key,
        F.col("rhythm.bpm").alias("tempo"),
        F.col("rhythm.danceability").alias("danceability"),
        F.col("tonal.key_key").alias("key"),
        F.col("tonal.key_scale").alias("key_scale"),
        F.col("lowlevel.average_loudness").alias("loudness"),
        F.col("lowlevel.dynamic_complexity").alias("dynamic_complexity"),
    )
