"""Summaries of whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import query, table, tracks
from encore.learning.metrics import class_balance as balance
from encore.operators import profile
from encore.operators.stats import high_label

T = ("tracks",)
_COLUMNS = (
    "mbid", "title", "artist_name", "genre", "genre_match_count", "release_type",
    "artist_country", "artist_type", "duration_sec", "release_year", "tempo", "danceability",
    "loudness", "dynamic_complexity", "total_listen_count", "total_user_count",
    "release_decade", "track_age", "has_audio_features", "key", "repeat_listens",
    "log_repeat_listens",
)


def _flat_summary(df, nulls):
    return df.select(
        *[c for c in df.columns if c not in ("genres", "null_counts")],
        F.array_join("genres", ",").alias("genres"),
        *[F.col("null_counts")[c].alias(f"null_{c}") for c in nulls],
    )


@query(
    "dataset_summary",
    f"""SELECT COUNT(*) AS row_count, CAST({len(_COLUMNS)} AS INT) AS column_count,
        COUNT(DISTINCT artist_name) + MAX(CASE WHEN artist_name IS NULL THEN 1 ELSE 0 END)
            AS unique_artists,
        COUNT(DISTINCT mbid) AS unique_tracks,
        array_to_string(list_sort(list(DISTINCT genre)), ',') AS genres,
        MEDIAN(repeat_listens) AS median_repeat_listens,
        ROUND(MEDIAN(log_repeat_listens), 6) AS median_log_repeat_listens,
        CAST(SUM(has_audio_features) AS BIGINT) AS rows_with_any_audio_features,
        COUNT(*) FILTER (tempo IS NOT NULL AND danceability IS NOT NULL AND loudness IS NOT NULL
            AND dynamic_complexity IS NOT NULL) AS rows_with_complete_audio_features,
        ROUND(100.0 * SUM(has_audio_features) / COUNT(*), 2) AS audio_feature_coverage_pct,
        ROUND(100.0 * COUNT(*) FILTER (tempo IS NOT NULL AND danceability IS NOT NULL
            AND loudness IS NOT NULL AND dynamic_complexity IS NOT NULL) / COUNT(*), 2)
            AS complete_audio_feature_coverage_pct,
        COUNT(*) - COUNT(release_year) AS null_release_year,
        COUNT(*) - COUNT(tempo) AS null_tempo, COUNT(*) - COUNT(key) AS null_key
    FROM tracks""",
    T,
)
def dataset_summary(spark, sf):
    out = profile.dataset_summary(tracks(spark, sf).select(*_COLUMNS))
    return _flat_summary(out, ["release_year", "tempo", "key"]).withColumn(
        "median_log_repeat_listens", F.round("median_log_repeat_listens", 6)
    )


@query(
    "collection_summary",
    """WITH raw AS (SELECT user_id AS mbid, event_type AS genre FROM events),
    pop AS (SELECT user_id FROM events GROUP BY user_id HAVING MAX(value) > 25),
    aud AS (SELECT user_id FROM events GROUP BY user_id HAVING MAX(value) > 33)
    SELECT (SELECT COUNT(*) FROM raw) AS musicbrainz_rows,
        (SELECT COUNT(DISTINCT mbid) FROM raw) AS unique_recordings,
        (SELECT COUNT(*) FROM pop) AS listenbrainz_rows,
        (SELECT COUNT(*) FROM aud) AS acousticbrainz_rows,
        ROUND(100.0 * (SELECT COUNT(*) FROM pop) / GREATEST((SELECT COUNT(DISTINCT mbid) FROM raw), 1), 2)
            AS listenbrainz_coverage_pct,
        ROUND(100.0 * (SELECT COUNT(*) FROM aud) / GREATEST((SELECT COUNT(*) FROM pop), 1), 2)
            AS acousticbrainz_coverage_pct,
        (SELECT string_agg(genre || '=' || n, ',' ORDER BY genre)
            FROM (SELECT genre, COUNT(*) AS n FROM raw GROUP BY genre)) AS genre_counts""",
)
def collection_summary(spark, sf):
    events = table(spark, sf, "events")
    raw = events.select(F.col("user_id").alias("mbid"), F.col("event_type").alias("genre"))
    most = events.groupBy("user_id").agg(F.max("value").alias("most"))
    pop = most.where(F.col("most") > 25)
    audio = most.where(F.col("most") > 33)
    pairs = F.transform(
        "genre_counts", lambda g: F.concat_ws("=", g["genre"], g["n"].cast("string"))
    )
    return profile.collection_summary(raw, pop, audio).withColumn(
        "genre_counts", F.array_join(pairs, ",")
    )


@query(
    "missingness",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls, "
        f"ROUND(100.0 * (COUNT(*) - COUNT({c})) / GREATEST(COUNT(*), 1), 2) AS pct_missing FROM tracks"
        for c in _COLUMNS
    )
    + ") ORDER BY pct_missing DESC, \"column\" LIMIT 20",
    T,
)
def missingness(spark, sf):
    return profile.missingness(tracks(spark, sf).select(*_COLUMNS), 20)


@query(
    "median_default",
    """SELECT COALESCE(MEDIAN(TRY_CAST(CASE WHEN p_size > 40 THEN p_name
        ELSE CAST(p_size AS VARCHAR) END AS DOUBLE)), 120.0) AS value FROM part""",
)
def median_default(spark, sf):
    mixed = F.when(F.col("p_size") > 40, F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    return profile.median_default(table(spark, sf, "part").select(mixed.alias("x")), "x", 120.0)


@query(
    "range_bounds",
    """SELECT CAST(COALESCE(MIN(release_decade), 1950) AS INT) AS low,
        CAST(COALESCE(MAX(release_decade), 2020) AS INT) AS high,
        (SELECT string_agg(CAST(d AS VARCHAR), ',' ORDER BY d) FROM
            (SELECT DISTINCT release_decade AS d FROM tracks WHERE release_decade IS NOT NULL))
            AS periods FROM tracks""",
    T,
)
def range_bounds(spark, sf):
    out = profile.range_bounds(tracks(spark, sf), "release_decade", 1950, 2020)
    return out.withColumn("periods", F.array_join(F.col("periods").cast("array<string>"), ","))


@query(
    "class_balance",
    """SELECT CASE WHEN repeat_listens > c THEN 1 ELSE 0 END AS is_high_replay, COUNT(*) AS n
    FROM tracks, (SELECT quantile_cont(repeat_listens, 0.75) AS c FROM tracks) GROUP BY 1""",
    T,
)
def class_balance(spark, sf):
    labelled = high_label(tracks(spark, sf)).withColumn(
        "is_high_replay", F.col("is_high_replay").cast("int")
    )
    return balance(labelled, "is_high_replay")
