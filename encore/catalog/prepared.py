"""The whole processed table, built end to end from raw records."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import query, table
from encore.config import FeatureConfig
from encore.plans.processed import build_processed

# Raw records: one per order line, so an item shows up under several tags.
_HEARD = "l_returnflag = 'R' AND l_quantity >= 48"
_RAW = f"""raw AS (SELECT CAST(l_partkey AS VARCHAR) AS mbid,
        l_orderkey * 10 + l_linenumber AS ingest_seq, l_linestatus || l_returnflag AS genre,
        p_name AS title, p_brand AS artist_name, p_size * 20000 AS duration_ms,
        CAST(year(l_shipdate) AS VARCHAR) AS release_year,
        CASE WHEN l_linenumber <> 2 THEN p_type END AS release_type
    FROM lineitem JOIN part ON l_partkey = p_partkey),
    pop AS (SELECT CAST(l_partkey AS VARCHAR) AS mbid, CAST(SUM(l_quantity) AS BIGINT) AS listens,
        COUNT(*) AS users FROM lineitem GROUP BY l_partkey),
    aud AS (SELECT CAST(l_partkey AS VARCHAR) AS mbid, ROUND(AVG(CASE WHEN {_HEARD}
            THEN l_discount END), 6) AS tempo, ROUND(AVG(CASE WHEN {_HEARD} THEN l_tax END), 6)
            AS danceability FROM lineitem GROUP BY l_partkey)"""


@query(
    "processed_table",
    f"""WITH {_RAW},
    f AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY mbid ORDER BY ingest_seq) AS r
        FROM raw) WHERE r = 1),
    g AS (SELECT mbid, list_sort(list(DISTINCT genre)) AS tags FROM raw GROUP BY mbid),
    b AS (SELECT f.mbid, f.title, f.artist_name, g.tags[1] AS genre,
            CAST(len(g.tags) AS INT) AS genre_match_count,
            COALESCE(f.release_type, 'Unknown') AS release_type,
            CAST(f.release_year AS INT) AS release_year,
            GREATEST(0.0, LEAST(900.0, f.duration_ms / 1000)) AS dur, aud.tempo, aud.danceability,
            pop.listens - pop.users AS repeat_listens
        FROM f JOIN g USING (mbid) JOIN pop USING (mbid) LEFT JOIN aud USING (mbid)
        WHERE pop.listens - pop.users >= 0),
    w AS (SELECT list_sort(list(dur)) AS d, list_sort(list(tempo) FILTER (tempo IS NOT NULL)) AS t,
            quantile_cont(repeat_listens, 0.75) AS c FROM b)
    SELECT mbid, title, artist_name, genre, genre_match_count, release_type, release_year,
        CAST(release_year // 10 * 10 AS INT) AS release_decade,
        CAST(2025 - release_year AS INT) AS track_age,
        ROUND(GREATEST(d[1 + CAST(ROUND((len(d) - 1) * 0.01) AS BIGINT)],
            LEAST(d[1 + CAST(ROUND((len(d) - 1) * 0.99) AS BIGINT)], dur)), 6) AS duration_sec,
        CASE WHEN tempo IS NOT NULL THEN
            ROUND(GREATEST(t[1 + CAST(ROUND((len(t) - 1) * 0.01) AS BIGINT)],
                LEAST(t[1 + CAST(ROUND((len(t) - 1) * 0.99) AS BIGINT)], tempo)), 6) END AS tempo,
        ROUND(tempo * danceability, 6) AS tempo_x_dance,
        CASE WHEN tempo IS NULL THEN 0 ELSE 1 END AS has_audio_features,
        CAST(CASE WHEN tempo IS NULL THEN 4 ELSE 2 END AS INT) AS audio_feature_missing_count,
        repeat_listens,
        CAST(DENSE_RANK() OVER (ORDER BY genre) - 1 AS INT) AS genre_enc,
        CAST(DENSE_RANK() OVER (ORDER BY release_type) - 1 AS INT) AS release_type_enc,
        CASE WHEN repeat_listens > c THEN 1 ELSE 0 END AS is_high_replay
    FROM b, w""",
)
def processed_table(spark, sf):
    line, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    key = F.col("l_partkey").cast("string").alias("mbid")
    none = F.lit(None).cast("string")
    raw = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        key,
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ingest_seq"),
        F.concat("l_linestatus", "l_returnflag").alias("genre"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("artist_name"),
        (F.col("p_size") * 20000).cast("bigint").alias("duration_ms"),
        F.date_format("l_shipdate", "yyyy").alias("release_year"),
        F.when(F.col("l_linenumber") != 2, F.col("p_type")).alias("release_type"),
        none.alias("disambiguation"),
        none.alias("artist_type"),
        none.alias("artist_country"),
        none.alias("artist_begin"),
    )
    popularity = line.groupBy(key).agg(
        F.sum("l_quantity").cast("bigint").alias("total_listen_count"),
        F.count("*").alias("total_user_count"),
    )
    heard = F.expr(_HEARD)
    audio = line.groupBy(key).agg(
        F.round(F.avg(F.when(heard, F.col("l_discount"))), 6).alias("tempo"),
        F.round(F.avg(F.when(heard, F.col("l_tax"))), 6).alias("danceability"),
        F.lit(None).cast("double").alias("loudness"),
        F.lit(None).cast("double").alias("dynamic_complexity"),
        F.lit(None).cast("string").alias("key"),
        F.lit(None).cast("string").alias("key_scale"),
    )
    out = build_processed(raw, popularity, audio, FeatureConfig(as_of_year=2025))
    keep = [
        "mbid", "title", "artist_name", "genre", "genre_match_count", "release_type",
        "release_year", "release_decade", "track_age", "duration_sec", "tempo", "tempo_x_dance",
        "has_audio_features", "audio_feature_missing_count", "repeat_listens", "genre_enc",
        "release_type_enc", "is_high_replay",
    ]
    rounded = {c: F.round(c, 6) for c in ("duration_sec", "tempo", "tempo_x_dance")}
    flags = {c: F.col(c).cast("int") for c in ("has_audio_features", "is_high_replay")}
    return out.select(*keep).withColumns({**rounded, **flags})
