"""Scans, landed payloads and the processed table built from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import SCHEMAS, query, table
from encore.session import scratch_path
from encore.sources import (
    attribute_rows,
    flatten_audio,
    flatten_recordings,
    last_popularity,
    read_corpus_csv,
    read_table,
    write_csv,
)
from encore.sources.schemas import (
    AUDIO_PAYLOAD,
    POPULARITY,
    POPULARITY_RESPONSE,
    RECORDING_PAYLOAD,
)


@query("scan_table", "SELECT * FROM part")
def scan_table(spark, sf):
    return read_table(spark, f"{sf}/part.parquet", SCHEMAS["part"])


@query("scan_pruned", "SELECT p_partkey, p_name, p_brand FROM part")
def scan_pruned(spark, sf):
    return read_table(
        spark, f"{sf}/part.parquet", SCHEMAS["part"], ["p_partkey", "p_name", "p_brand"]
    )


@query(
    "corpus_scan",
    """SELECT source AS title, lang AS artist, text AS lyrics FROM documents
    LEFT JOIN labels USING (doc_id) WHERE toxic IS DISTINCT FROM 1""",
)
def corpus_scan(spark, sf):
    """The documents landed as CSV (texts with line breaks, some without an artist), read back."""
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    path = scratch_path(spark, "corpus")
    artist = F.when(F.coalesce("toxic", F.lit(0)) != 1, F.col("lang"))
    write_csv(
        rows.select(F.col("source").alias("title"), artist.alias("artist"), F.col("text").alias("lyrics")),
        path,
    )
    return read_corpus_csv(spark, path)


def _payloads(spark, sf):
    """Orders and their customers as nested recording payloads, through JSON text."""
    orders, customers = table(spark, sf, "orders"), table(spark, sf, "customer")
    done = F.col("o_orderstatus") == "F"
    releases = F.when(done, F.array()).otherwise(
        F.array(
            F.struct(
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                F.struct(
                    F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias(
                        "primary-type"
                    )
                ).alias("release-group"),
            )
        )
    )
    artist = F.struct(
        F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("type"),
        F.when(F.col("c_nationkey") > 4, F.col("c_nationkey").cast("string")).alias("country"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM").alias("begin")).alias("life-span"),
    )
    body = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.floor("o_totalprice").alias("length"),
        releases.alias("releases"),
        F.array(F.struct(artist.alias("artist"))).alias("artist-credit"),
    )
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.to_json(body).alias("body"), F.col("o_orderstatus").alias("genre"), F.col("o_orderkey").alias("seq")
    )


@query(
    "flatten_payload",
    """SELECT CAST(o_orderkey AS VARCHAR) AS mbid, o_orderpriority AS title,
        CAST(FLOOR(o_totalprice) AS BIGINT) AS duration_ms, o_orderstatus AS genre,
        '' AS disambiguation,
        CASE WHEN o_orderstatus = 'F' OR o_orderpriority = '5-LOW' THEN 'Unknown'
            ELSE o_orderpriority END AS release_type,
        CASE WHEN o_orderstatus <> 'F' THEN CAST(year(o_orderdate) AS VARCHAR) END AS release_year,
        c_name AS artist_name,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'Unknown' ELSE c_mktsegment END AS artist_type,
        CASE WHEN c_nationkey > 4 THEN CAST(c_nationkey AS VARCHAR) ELSE 'Unknown' END
            AS artist_country,
        CAST(year(o_orderdate) AS VARCHAR) AS artist_begin
    FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def flatten_payload(spark, sf):
    parsed = _payloads(spark, sf).select(F.from_json("body", RECORDING_PAYLOAD).alias("p"), "genre")
    return flatten_recordings(parsed.select("p.*", "genre"))


@query(
    "flatten_audio",
    """SELECT event_id AS mbid, value AS tempo, CASE WHEN event_type <> 'error' THEN value / 2 END
        AS danceability, event_type AS key, CAST(NULL AS VARCHAR) AS key_scale,
        CAST(NULL AS DOUBLE) AS loudness, CAST(json_extract(props, '$.k') AS DOUBLE)
        AS dynamic_complexity FROM events""",
)
def flatten_audio_query(spark, sf):
    k = F.get_json_object("props", "$.k").cast("double")
    dance = F.when(F.col("event_type") != "error", F.col("value") / 2)
    body = F.struct(
        F.struct(F.col("value").alias("bpm"), dance.alias("danceability")).alias("rhythm"),
        F.struct(F.col("event_type").alias("key_key")).alias("tonal"),
        F.struct(k.alias("dynamic_complexity")).alias("lowlevel"),
    )
    parsed = table(spark, sf, "events").select(
        F.col("event_id").alias("mbid"), F.from_json(F.to_json(body), AUDIO_PAYLOAD).alias("p")
    )
    return flatten_audio(parsed.select("mbid", "p.*"))


@query(
    "popularity_last_wins",
    """SELECT mbid, total_listen_count, total_user_count FROM (
        SELECT CAST(user_id AS VARCHAR) AS mbid, CAST(json_extract(props, '$.k') AS BIGINT) + 100
                AS total_listen_count, event_id % 50 AS total_user_count,
            ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r
        FROM events WHERE event_type <> 'error') WHERE r = 1""",
)
def popularity_last_wins(spark, sf):
    """Events as popularity responses: items under `payload`, under `data`, or bare."""
    k = F.get_json_object("props", "$.k").cast("bigint") + 100
    item = F.struct(
        F.col("user_id").cast("string").alias("recording_mbid"),
        F.when(F.col("event_type") != "error", k).alias("total_listen_count"),
        (F.col("event_id") % 50).alias("total_user_count"),
    )
    body = (
        F.when(F.col("event_type") == "click", F.to_json(F.struct(F.array(item).alias("payload"))))
        .when(F.col("event_type") == "view", F.to_json(F.struct(F.array(item).alias("data"))))
        .otherwise(F.to_json(item))
    )
    responses = table(spark, sf, "events").select(
        F.from_json(body, POPULARITY_RESPONSE).alias("p"), F.col("event_id").alias("seq")
    )
    return last_popularity(responses.select("p.*", "seq"), "seq")


@query(
    "empty_typed",
    """SELECT CAST(p_partkey AS VARCHAR) AS mbid, CAST(NULL AS BIGINT) AS total_listen_count,
        CAST(NULL AS BIGINT) AS total_user_count FROM part""",
)
def empty_typed(spark, sf):
    """A missing source still joins: every row keeps null counts."""
    nothing = attribute_rows(spark, None, POPULARITY)
    parts = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("mbid"))
    return parts.join(nothing, "mbid", "left")


@query(
    "csv_round_trip",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
)
def csv_round_trip(spark, sf):
    path = scratch_path(spark, "customers")
    cols = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    write_csv(table(spark, sf, "customer").select(*cols), path)
    return read_table(
        spark, path, "c_custkey bigint, c_name string, c_acctbal double, c_mktsegment string",
        fmt="csv",
    )
