"""Joins, keep-one rules, encodings and look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import docs, query, raw_items, table, texts, tracks
from encore.catalog.cells import WORDS_SQL
from encore.functions import word_list
from encore.operators import order
from encore.operators.prepare import collapse_records, with_audio, with_target
from encore.plans.texts import features_with_target, three_way
from encore.streaming.ingest import covered_ids, pending_ids

T = ("tracks",)
# Counts and signals of an item come from some of its lines only, and are null where it has none.
_COUNTED = "l_returnflag <> 'N'"
_HEARD = "l_returnflag = 'R' AND l_quantity >= 48"
_POP_SQL = f"""SELECT l_partkey AS mbid,
        CAST(SUM(CASE WHEN {_COUNTED} THEN l_quantity END) AS BIGINT) AS total_listen_count,
        SUM(CASE WHEN {_COUNTED} THEN 1 END) AS total_user_count
    FROM lineitem GROUP BY l_partkey"""
_AUDIO_SQL = f"""SELECT l_partkey AS mbid, ROUND(AVG(CASE WHEN {_HEARD} THEN l_discount END), 6) AS tempo,
        MAX(CASE WHEN {_HEARD} THEN l_tax END) AS loudness
    FROM lineitem GROUP BY l_partkey"""


def _popularity(spark, sf):
    counted = F.expr(_COUNTED)
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("mbid"))
        .agg(
            F.sum(F.when(counted, F.col("l_quantity"))).cast("bigint").alias("total_listen_count"),
            F.sum(F.when(counted, F.lit(1))).alias("total_user_count"),
        )
    )


def _audio(spark, sf):
    heard = F.expr(_HEARD)
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("mbid"))
        .agg(
            F.round(F.avg(F.when(heard, F.col("l_discount"))), 6).alias("tempo"),
            F.max(F.when(heard, F.col("l_tax"))).alias("loudness"),
        )
    )


def _parts(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("mbid"), "p_name")


@query(
    "left_join_popularity",
    f"""SELECT p_partkey AS mbid, p_name,
        CAST(total_listen_count - total_user_count AS BIGINT) AS repeat_listens
    FROM part LEFT JOIN ({_POP_SQL}) ON p_partkey = mbid
    WHERE total_listen_count - total_user_count >= 0""",
)
def left_join_popularity(spark, sf):
    joined = _parts(spark, sf).join(_popularity(spark, sf), "mbid", "left")
    return with_target(joined).select("mbid", "p_name", "repeat_listens")


@query(
    "left_join_enrichment",
    f"""SELECT p_partkey AS mbid, p_name, tempo, loudness
    FROM part LEFT JOIN ({_AUDIO_SQL}) ON p_partkey = mbid""",
)
def left_join_enrichment(spark, sf):
    return with_audio(_parts(spark, sf), _audio(spark, sf))


@query(
    "features_target_join",
    f"""SELECT d.doc_id AS mbid, d.word_count, t.quality AS target, t.n_turns
    FROM (SELECT doc_id, len({WORDS_SQL}) AS word_count FROM documents) d
    LEFT JOIN (SELECT doc_id, quality, n_turns FROM (
            SELECT doc_id, quality, toxic AS n_turns, ROW_NUMBER() OVER
                (PARTITION BY doc_id ORDER BY quality) AS r
            FROM labels) WHERE r = 1) t ON d.doc_id = t.doc_id""",
)
def features_target_join(spark, sf):
    features = texts(spark, sf).select(
        "mbid", F.size(word_list(F.col("text"))).cast("bigint").alias("word_count")
    )
    items = table(spark, sf, "labels").select(
        F.col("doc_id").alias("mbid"), F.col("quality").alias("target"), F.col("toxic").alias("n_turns")
    )
    return features_with_target(features, items, target="target", extra=("n_turns",))


@query(
    "three_way_features",
    f"""SELECT d.doc_id AS mbid, len({WORDS_SQL}) AS word_count, l.toxic AS topic_0, d.lang,
        ROUND(LN(1 + CAST(d.n_chars AS DOUBLE)), 9) AS log_repeat_listens
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.n_chars IS NOT NULL""",
)
def three_way_features(spark, sf):
    features = texts(spark, sf).select(
        "mbid", F.size(word_list(F.col("text"))).cast("bigint").alias("word_count")
    )
    topics = table(spark, sf, "labels").select(
        F.col("doc_id").alias("mbid"), F.col("toxic").alias("topic_0")
    )
    items = docs(spark, sf).select("mbid", "lang", "log_repeat_listens")
    return three_way(features, topics, items).withColumn(
        "log_repeat_listens", F.round("log_repeat_listens", 9)
    )


@query(
    "dim_lookup",
    """SELECT c_custkey, COALESCE(n_name, 'Unknown') AS nation, COALESCE(r_name, 'Unknown') AS region
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def dim_lookup(spark, sf):
    # nation and region have a fixed number of rows at every scale.
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    unknown = F.lit("Unknown")
    return (
        table(spark, sf, "customer")
        .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            "c_custkey",
            F.coalesce("n_name", unknown).alias("nation"),
            F.coalesce("r_name", unknown).alias("region"),
        )
    )


@query(
    "resume_anti_semi",
    """SELECT 'pending' AS kind, mbid FROM (SELECT DISTINCT user_id AS mbid FROM events)
        WHERE mbid NOT IN (SELECT user_id FROM events WHERE value > 35)
    UNION ALL
    SELECT 'covered', mbid FROM (SELECT DISTINCT user_id AS mbid FROM events)
        WHERE mbid IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 30)""",
)
def resume_anti_semi(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("user_id", "mbid")
    pending = pending_ids(events, events.where(F.col("value") > 35))
    covered = covered_ids(
        events, events.where((F.col("event_type") == "purchase") & (F.col("value") > 30))
    )
    return pending.select(F.lit("pending").alias("kind"), "mbid").unionByName(
        covered.select(F.lit("covered").alias("kind"), "mbid")
    )


@query(
    "entity_collapse",
    """SELECT f.mbid, f.attr, f.note, t.tags[1] AS genre, array_to_string(t.tags, ' | ')
        AS genre_tags_text, CAST(len(t.tags) AS INT) AS genre_match_count
    FROM (SELECT mbid, attr, note FROM (SELECT *, ROW_NUMBER() OVER
            (PARTITION BY mbid ORDER BY ingest_seq) AS r FROM raw_items) WHERE r = 1) f
    JOIN (SELECT mbid, list_sort(list(DISTINCT genre)) AS tags FROM raw_items GROUP BY mbid) t
        ON f.mbid = t.mbid""",
    ("raw_items",),
)
def entity_collapse(spark, sf):
    return collapse_records(raw_items(spark, sf), attributes=("attr", "note"))


@query(
    "keep_first",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, ROW_NUMBER() OVER
        (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1""",
)
def keep_first(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value")
    return order.keep_first(rows, ["user_id"], [F.col("event_id")])


@query(
    "keep_last",
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, ROW_NUMBER() OVER
        (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS r FROM events) WHERE r = 1""",
)
def keep_last(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return order.keep_last(rows, ["user_id", "event_type"], [F.col("event_id")])


@query(
    "ordered_distinct",
    "SELECT user_id, MIN(event_id) AS first_seen FROM events GROUP BY user_id",
)
def ordered_distinct(spark, sf):
    return (
        table(spark, sf, "events")
        .groupBy("user_id")
        .agg(F.min("event_id").alias("first_seen"))
        .orderBy("first_seen")
    )


@query(
    "quartile_label",
    """SELECT mbid, CASE WHEN log_repeat_listens <= q[1] THEN 'Q1 (Low)'
        WHEN log_repeat_listens <= q[2] THEN 'Q2' WHEN log_repeat_listens <= q[3] THEN 'Q3'
        ELSE 'Q4 (High)' END AS quartile
    FROM tracks, (SELECT quantile_cont(log_repeat_listens, [0.25, 0.5, 0.75]) AS q FROM tracks)""",
    T,
)
def quartile_label(spark, sf):
    return order.with_quartile(tracks(spark, sf), "log_repeat_listens").select("mbid", "quartile")


@query(
    "label_encode",
    """WITH f AS (SELECT mbid, genre, COALESCE(release_type, 'Unknown') AS release_type,
        COALESCE(artist_country, 'Unknown') AS artist_country FROM tracks)
    SELECT *, CAST(DENSE_RANK() OVER (ORDER BY genre) - 1 AS INT) AS genre_enc,
        CAST(DENSE_RANK() OVER (ORDER BY release_type) - 1 AS INT) AS release_type_enc,
        CAST(DENSE_RANK() OVER (ORDER BY artist_country) - 1 AS INT) AS artist_country_enc FROM f""",
    T,
)
def label_encode(spark, sf):
    cols = ["genre", "release_type", "artist_country"]
    return order.with_codes(tracks(spark, sf).select("mbid", *cols), cols, filler="Unknown")


@query(
    "avg_rank",
    """SELECT mbid, RANK() OVER (ORDER BY repeat_listens)
        + (COUNT(*) OVER (PARTITION BY repeat_listens) - 1) / 2.0 AS avg_rank FROM tracks""",
    T,
)
def avg_rank(spark, sf):
    rows = tracks(spark, sf).select("mbid", "repeat_listens")
    ranks = order.value_ranks(rows, "repeat_listens").select("repeat_listens", "avg_rank")
    return rows.join(ranks, "repeat_listens").select("mbid", "avg_rank")
