"""Scoring profiles and items, and the report rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import query, tracks
from encore.catalog.learning import _CAT, _GUESS_SQL, _NUM, _framed, _guessed
from encore.catalog.statistics import KRUSKAL_SQL, SPEARMAN_SQL
from encore.config import FeatureConfig
from encore.learning import models
from encore.plans import report, scoring

T = ("tracks",)
_CFG = FeatureConfig(as_of_year=2025)


def _profiles(spark, sf):
    """One profile per item: what its own figures would look like typed into a form."""
    return tracks(spark, sf).select(
        "mbid", "genre", "release_type", "artist_country",
        F.coalesce("duration_sec", F.lit(200.0)).alias("duration_sec"), "release_year",
        (F.col("genre_match_count") * 5).alias("artist_career_age"), "genre_match_count",
        "tempo", "danceability", "loudness", "dynamic_complexity",
        (F.col("tempo") > 100).alias("use_audio"),
    ).withColumn("use_audio", F.coalesce("use_audio", F.lit(False)))


@query(
    "profile_features",
    """SELECT mbid, CAST(release_year // 10 * 10 AS DOUBLE) AS release_decade,
        CAST(2025 - release_year AS DOUBLE) AS track_age,
        CASE WHEN tempo > 100 THEN 1.0 ELSE 0.0 END::DOUBLE AS has_audio_features,
        CASE WHEN tempo > 100 THEN 0.0 ELSE 4.0 END::DOUBLE AS audio_feature_missing_count,
        ROUND(genre_match_count * 5 * COALESCE(duration_sec, 200.0) / 60, 6)
            AS career_x_duration_min,
        CASE WHEN tempo > 100 THEN tempo END AS tempo,
        ROUND(COALESCE(CASE WHEN tempo > 100 THEN tempo * danceability END, 0.0), 6)
            AS tempo_x_dance
    FROM tracks""",
    T,
)
def profile_features(spark, sf):
    out = scoring.complete_profiles(_profiles(spark, sf), cfg=_CFG)
    return out.select(
        "mbid", "release_decade", "track_age", "has_audio_features",
        "audio_feature_missing_count",
        F.round("career_x_duration_min", 6).alias("career_x_duration_min"), "tempo",
        F.round("tempo_x_dance", 6).alias("tempo_x_dance"),
    )


@query("score_profiles")
def score_profiles(spark, sf):
    frame = _framed(spark, sf)
    model = models.line_up(_NUM, _CAT)["Ridge"].fit(frame.where(~F.col("is_test")))
    out = scoring.score_profiles(model, _profiles(spark, sf), tracks(spark, sf))
    return out.select(
        "mbid", "genre", "prediction", "predicted_repeats", "percentile", "category_median"
    )


@query(
    "score_items",
    f"""WITH {_GUESS_SQL}, m AS (SELECT genre AS gg, MEDIAN(log_repeat_listens) AS m FROM tracks
        GROUP BY genre),
    p AS (SELECT *, ROUND(guess, 6) AS prediction FROM g)
    SELECT mbid, prediction, ROUND(prediction - log_repeat_listens, 6) AS residual,
        CASE WHEN prediction - log_repeat_listens > 0 THEN 'above' ELSE 'below' END AS direction,
        ROUND(GREATEST(EXP(prediction) - 1, 0), 3) AS predicted_repeats,
        ROUND(m, 6) AS category_median,
        ROUND(100.0 * (SELECT COUNT(*) FROM tracks t WHERE t.log_repeat_listens <= p.prediction)
            / (SELECT COUNT(*) FROM tracks), 6) AS percentile
    FROM p JOIN m ON genre = gg""",
    T,
)
def score_items(spark, sf):
    scored = _guessed(spark, sf).withColumn("prediction", F.round("guess", 6))
    out = scoring.score_items(scored, tracks(spark, sf))
    return out.select(
        "mbid",
        "prediction",
        F.round("residual", 6).alias("residual"),
        "direction",
        F.round("predicted_repeats", 3).alias("predicted_repeats"),
        F.round("category_median", 6).alias("category_median"),
        F.round("percentile", 6).alias("percentile"),
    )


@query(
    "report_rows",
    f"""WITH k AS ({KRUSKAL_SQL}), s AS ({SPEARMAN_SQL})
    SELECT 'dataset' AS section, 0 AS ord, 'rows' AS key, CAST(COUNT(*) AS VARCHAR) AS value
        FROM tracks
    UNION ALL SELECT 'dataset', 1, 'columns', '22'
    UNION ALL SELECT 'dataset', 2, 'target', 'log_repeat_listens from repeat_listens'
    UNION ALL SELECT 'dataset', 3, 'rows_with_audio',
        CAST(SUM(has_audio_features)::BIGINT AS VARCHAR) FROM tracks
    UNION ALL SELECT 'dataset', 4, 'audio_pct',
        printf('%.1f', 100.0 * SUM(has_audio_features) / COUNT(*)) FROM tracks
    UNION ALL SELECT 'median repeats', CAST(ROW_NUMBER() OVER (ORDER BY m DESC, genre) AS INT),
        genre, CAST(m AS VARCHAR)
        FROM (SELECT genre, MEDIAN(repeat_listens) AS m FROM tracks GROUP BY genre)
    UNION ALL SELECT 'kruskal-wallis', 0, 'groups', CAST(groups AS VARCHAR) FROM k
    UNION ALL SELECT 'kruskal-wallis', 1, 'n', CAST(n AS VARCHAR) FROM k
    UNION ALL SELECT 'kruskal-wallis', 2, 'freedom', CAST(freedom AS VARCHAR) FROM k
    UNION ALL SELECT 'kruskal-wallis', 3, 'h', printf('%.4f', h) FROM k
    UNION ALL SELECT 'kruskal-wallis', 4, 'p_value', printf('%.4f', p_value) FROM k
    UNION ALL SELECT 'spearman', 0, 'n', CAST(n AS VARCHAR) FROM s
    UNION ALL SELECT 'spearman', 1, 'rho', printf('%.4f', rho) FROM s
    UNION ALL SELECT 'spearman', 2, 'p_value', printf('%.4f', p_value) FROM s""",
    T,
)
def report_rows(spark, sf):
    rows = report.eda_report(tracks(spark, sf))
    # The engines print doubles differently.
    real = F.col("key").isin("h", "rho", "p_value")
    return rows.withColumn(
        "value",
        F.when(real, F.format_string("%.4f", F.col("value").try_cast("double"))).otherwise(
            F.col("value")
        ),
    )
