"""Value-level operators: coercion, gating, text keys, derived numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import link_corpus, query, table, tracks
from encore.config import ASCII_PUNCTUATION, CORPUS_STOP_WORDS
from encore.functions import (
    adjacent_pairs,
    clean_text,
    clip_keep_null,
    compact_number,
    fill_unknown,
    flip_the,
    gate_range,
    lenient,
    match_key,
    minutes_seconds,
    model_slug,
    year_prefix,
)
from encore.operators.prepare import with_audio, with_dates, with_interactions, with_target
from encore.operators.profile import observed_counts
from encore.operators.stats import guarded
from encore.operators.terms import tokens
from encore.plans.scoring import back_transform

T = ("tracks",)
PUNCT_SQL = "'" + ASCII_PUNCTUATION.replace("'", "''") + "'"


def words_sql(stop_words) -> str:
    """Words of column `text` as a DuckDB list."""
    stops = ", ".join(f"'{w}'" for w in sorted(set(stop_words)) if "'" not in w)
    return f"""list_filter(
    regexp_split_to_array(translate(lower(text), {PUNCT_SQL}, ''), '\\s+'),
    lambda w: length(w) > 1 AND w NOT IN ({stops}) AND NOT regexp_full_match(w, '\\pN+'))"""


WORDS_SQL = words_sql(CORPUS_STOP_WORDS)


@query(
    "repeat_target",
    """SELECT k AS mbid, total - users AS repeat_listens,
        ROUND(LN(1 + CAST(total - users AS DOUBLE)), 9) AS log_repeat_listens
    FROM (SELECT o_custkey AS k, CAST(FLOOR(SUM(o_totalprice) / 100000) AS BIGINT) AS total,
            COUNT(*) AS users FROM orders GROUP BY o_custkey)
    WHERE total - users >= 0""",
)
def repeat_target(spark, sf):
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("mbid")).agg(
        F.floor(F.sum("o_totalprice") / 100000).cast("bigint").alias("total"),
        F.count("*").alias("users"),
    )
    return with_target(counts, "total", "users").select(
        "mbid", "repeat_listens", F.round("log_repeat_listens", 9).alias("log_repeat_listens")
    )


@query(
    "lenient_cast",
    """SELECT p_partkey, TRY_CAST(substr(p_brand, 7, 2) AS INT) AS as_int,
        TRY_CAST(p_brand AS INT) AS bad_int,
        TRY_CAST(CASE WHEN p_size > 25 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS DOUBLE)
            AS as_double
    FROM part""",
)
def lenient_cast(spark, sf):
    size = F.when(F.col("p_size") > 25, F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    return table(spark, sf, "part").select(
        "p_partkey",
        lenient(F.substring("p_brand", 7, 2), "int").alias("as_int"),
        lenient("p_brand", "int").alias("bad_int"),
        lenient(size, "double").alias("as_double"),
    )


@query(
    "range_gate",
    """SELECT p_partkey, CASE WHEN y BETWEEN 1900 AND 2025 THEN y END AS release_year
    FROM (SELECT p_partkey, CAST(1880 + p_size * 4 AS INT) AS y FROM part)""",
)
def range_gate(spark, sf):
    year = (F.lit(1880) + F.col("p_size") * 4).cast("int")
    return table(spark, sf, "part").select(
        "p_partkey", gate_range(year, 1900, 2025).alias("release_year")
    )


@query(
    "clip_null_safe",
    """SELECT mbid, CASE WHEN duration_sec IS NOT NULL
        THEN GREATEST(60.0, LEAST(400.0, duration_sec)) END AS clipped FROM tracks""",
    T,
)
def clip_null_safe(spark, sf):
    return tracks(spark, sf).select(
        "mbid", clip_keep_null(F.col("duration_sec"), 60.0, 400.0).alias("clipped")
    )


@query(
    "fill_unknown",
    """SELECT mbid, COALESCE(artist_country, 'Unknown') AS artist_country,
        COALESCE(release_type, 'Unknown') AS release_type FROM tracks""",
    T,
)
def fill_unknown_query(spark, sf):
    return tracks(spark, sf).select(
        "mbid", *[fill_unknown(F.col(c)).alias(c) for c in ("artist_country", "release_type")]
    )


@query(
    "optional_source_absent",
    """SELECT mbid, genre, CAST(NULL AS DOUBLE) AS tempo, CAST(NULL AS DOUBLE) AS danceability,
        CAST(NULL AS DOUBLE) AS loudness, CAST(NULL AS DOUBLE) AS dynamic_complexity,
        CAST(NULL AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS key_scale FROM tracks""",
    T,
)
def optional_source_absent(spark, sf):
    return with_audio(tracks(spark, sf).select("mbid", "genre"), None)


_OBSERVED = ("tempo", "loudness", "key", "release_year", "duration_sec", "artist_country")


@query(
    "observed_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT({c}) AS observed FROM tracks" for c in _OBSERVED
    ),
    T,
)
def observed_columns(spark, sf):
    return observed_counts(tracks(spark, sf), [*_OBSERVED, "tempo", "absent_column"])


@query(
    "drop_null_subset",
    """SELECT mbid, tempo, loudness, release_year FROM tracks
    WHERE tempo IS NOT NULL AND loudness IS NOT NULL AND release_year IS NOT NULL""",
    T,
)
def drop_null_subset(spark, sf):
    cols = ["tempo", "loudness", "release_year"]
    return tracks(spark, sf).select("mbid", *cols).na.drop(subset=cols)


@query(
    "slug",
    """SELECT DISTINCT p_name || ' (' || p_type || ') - x' AS name,
        replace(replace(replace(replace(lower(p_name || ' (' || p_type || ') - x'),
            ' ', '_'), '(', ''), ')', ''), '-', '_') AS slug FROM part""",
)
def slug(spark, sf):
    name = F.concat("p_name", F.lit(" ("), "p_type", F.lit(") - x"))
    return table(spark, sf, "part").select(name.alias("name"), model_slug(name).alias("slug")).distinct()


@query(
    "guarded_subset",
    """WITH s AS (SELECT mbid, tempo, danceability FROM tracks
        WHERE tempo IS NOT NULL AND danceability IS NOT NULL)
    SELECT * FROM s WHERE (SELECT COUNT(*) FROM s) >= 500""",
    T,
)
def guarded_subset(spark, sf):
    rows = tracks(spark, sf).select("mbid", "tempo", "danceability")
    return guarded(rows, ["tempo", "danceability"], 500)


@query(
    "normalize_key",
    f"""SELECT seq, trim(regexp_replace(translate(lower(artist), {PUNCT_SQL}, ''), '\\s+', ' ', 'g'))
        AS artist_key,
        trim(regexp_replace(translate(lower(title), {PUNCT_SQL}, ''), '\\s+', ' ', 'g')) AS title_key
    FROM link_corpus""",
    ("link_corpus",),
)
def normalize_key(spark, sf):
    return link_corpus(spark, sf).select(
        "seq",
        match_key(F.col("artist")).alias("artist_key"),
        match_key(F.col("title")).alias("title_key"),
    )


_MARKED = "'[Verse ' || source || '] ' || text || ' 12 Contributors x' || chr(10) || 'ok Embed '"


@query(
    "clean_text",
    f"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            regexp_replace({_MARKED}, '\\[[^\\n]*?\\]', ' ', 'g'),
            '\\d+\\s+contributors?[^\\n]*', ' ', 'gi'),
            'you might also like[^\\n]*', ' ', 'gi'),
            'embed\\s*$', ' ', 'gi'), '^\\s+|\\s+$', '', 'g') AS text FROM documents""",
)
def clean_text_query(spark, sf):
    marked = F.concat(
        F.lit("[Verse "), "source", F.lit("] "), "text", F.lit(" 12 Contributors x\nok Embed ")
    )
    return table(spark, sf, "documents").select("doc_id", clean_text(marked).alias("text"))


@query(
    "tokenize",
    f"SELECT doc_id, array_to_string({WORDS_SQL}, ' ') AS words FROM documents",
)
def tokenize(spark, sf):
    return tokens(table(spark, sf, "documents"), "doc_id").select(
        "doc_id", F.array_join("words", " ").alias("words")
    )


@query(
    "bigrams",
    f"""WITH w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents)
    SELECT doc_id, i AS pos, w[i] || ' ' || w[i + 1] AS pair
    FROM (SELECT doc_id, w, CAST(unnest(range(1, len(w))) AS INT) AS i FROM w)""",
)
def bigrams(spark, sf):
    return tokens(table(spark, sf, "documents"), "doc_id").select(
        "doc_id", F.posexplode(adjacent_pairs(F.col("words"))).alias("pos", "pair")
    ).select("doc_id", (F.col("pos") + 1).alias("pos"), "pair")


@query(
    "flip_the",
    """SELECT seq, a, CASE WHEN a LIKE 'the %' THEN substr(a, 5) ELSE 'the ' || a END AS flipped
    FROM (SELECT seq, lower(artist) AS a FROM link_corpus)""",
    ("link_corpus",),
)
def flip_the_query(spark, sf):
    return link_corpus(spark, sf).select("seq", F.lower("artist").alias("a")).withColumn(
        "flipped", flip_the(F.col("a"))
    )


@query(
    "year_prefix",
    """SELECT o_orderkey, NULLIF(substr(CASE WHEN o_orderstatus = 'P' THEN ''
        ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END, 1, 4), '') AS release_year FROM orders""",
)
def year_prefix_query(spark, sf):
    text = F.when(F.col("o_orderstatus") == "P", "").otherwise(
        F.col("o_orderdate").cast("date").cast("string")
    )
    return table(spark, sf, "orders").select("o_orderkey", year_prefix(text).alias("release_year"))


@query(
    "format_compact",
    """SELECT o_orderkey, CASE WHEN v >= 1000000 THEN printf('%.1fM', v / 1000000.0)
            WHEN v >= 1000 THEN printf('%.1fK', v / 1000.0)
            ELSE CAST(v AS VARCHAR) END AS compact,
        CAST(s // 60 AS VARCHAR) || ':' || lpad(CAST(s % 60 AS VARCHAR), 2, '0') AS length
    FROM (SELECT o_orderkey, CAST(FLOOR(o_totalprice) AS BIGINT) * (o_orderkey % 9) AS v,
            CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS s FROM orders)""",
)
def format_compact(spark, sf):
    whole = F.floor("o_totalprice").cast("bigint") * (F.col("o_orderkey") % 9)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        compact_number(whole).alias("compact"),
        minutes_seconds(F.floor(F.col("o_totalprice") / 1000).cast("double")).alias("length"),
    )


def _raw_dates(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("mbid"),
        F.when(F.col("o_orderstatus") == "P", "n/a")
        .otherwise(F.floor(F.col("o_totalprice") * 4).cast("string"))
        .alias("duration_ms"),
        F.date_format("o_orderdate", "yyyy").alias("release_year"),
        F.when(F.col("o_orderpriority") == "1-URGENT", None)
        .otherwise((F.lit(1890) + F.col("o_custkey") % 110).cast("string"))
        .alias("artist_begin"),
    )


@query(
    "feature_dates",
    """WITH r AS (SELECT o_orderkey AS mbid,
            TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'n/a'
                ELSE CAST(CAST(FLOOR(o_totalprice * 4) AS BIGINT) AS VARCHAR) END AS DOUBLE) AS ms,
            CAST(year(o_orderdate) AS INT) AS y,
            CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(1890 + o_custkey % 110 AS INT) END AS b
          FROM orders)
    SELECT mbid, CASE WHEN ms IS NOT NULL THEN GREATEST(0.0, LEAST(900.0, ms / 1000)) END
            AS duration_sec,
        y AS release_year, CAST(y // 10 * 10 AS INT) AS release_decade,
        CAST(GREATEST(0, LEAST(120, 2025 - y)) AS INT) AS track_age,
        CASE WHEN b IS NOT NULL THEN CAST(GREATEST(0, LEAST(80, y - b)) AS INT) END
            AS artist_career_age
    FROM r""",
)
def feature_dates(spark, sf):
    return with_dates(_raw_dates(spark, sf)).select(
        "mbid", "duration_sec", "release_year", "release_decade", "track_age", "artist_career_age"
    )


def _flagged(spark, sf):
    rows = tracks(spark, sf).withColumn(
        "artist_career_age", F.when(F.col("release_year").isNotNull(), F.col("genre_match_count"))
    )
    return with_interactions(rows)


@query(
    "presence_flags",
    """SELECT mbid, CASE WHEN COALESCE(tempo, danceability, loudness, dynamic_complexity) IS NOT NULL
            THEN 1 ELSE 0 END AS has_audio_features,
        (tempo IS NULL)::INT + (danceability IS NULL)::INT + (loudness IS NULL)::INT
            + (dynamic_complexity IS NULL)::INT AS audio_feature_missing_count
    FROM tracks""",
    T,
)
def presence_flags(spark, sf):
    return _flagged(spark, sf).select(
        "mbid",
        F.col("has_audio_features").cast("int").alias("has_audio_features"),
        "audio_feature_missing_count",
    )


@query(
    "interactions",
    """SELECT mbid, ROUND(CASE WHEN release_year IS NULL THEN 0 ELSE genre_match_count END
            * COALESCE(duration_sec, 0.0) / 60, 6) AS career_x_duration_min,
        ROUND(tempo * danceability, 6) AS tempo_x_dance FROM tracks""",
    T,
)
def interactions(spark, sf):
    return _flagged(spark, sf).select(
        "mbid",
        F.round("career_x_duration_min", 6).alias("career_x_duration_min"),
        F.round("tempo_x_dance", 6).alias("tempo_x_dance"),
    )


@query(
    "back_transform",
    """SELECT mbid, ROUND(GREATEST(EXP(log_repeat_listens - 6.5) - 1, 0), 6) AS repeats
    FROM tracks""",
    T,
)
def back_transform_query(spark, sf):
    guess = F.col("log_repeat_listens") - 6.5
    return tracks(spark, sf).select("mbid", F.round(back_transform(guess), 6).alias("repeats"))


@query(
    "array_ops",
    """SELECT mbid, COALESCE(tags[1], 'Unknown') AS genre, array_to_string(tags, ' | ') AS tags_text,
        CAST(len(tags) AS INT) AS n_tags
    FROM (SELECT user_id AS mbid, COALESCE(list_sort(list(DISTINCT event_type)
            FILTER (WHERE value > 20)), []) AS tags FROM events GROUP BY user_id)""",
)
def array_ops(spark, sf):
    tags = F.col("tags")
    return (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("mbid"))
        .agg(
            F.sort_array(
                F.collect_set(F.when(F.col("value") > 20, F.col("event_type")))
            ).alias("tags")
        )
        .select(
            "mbid",
            fill_unknown(F.get(tags, F.lit(0))).alias("genre"),
            F.array_join(tags, " | ").alias("tags_text"),
            F.size(tags).alias("n_tags"),
        )
    )


@query(
    "json_extract",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k, 'none' AS missing
    FROM events""",
)
def json_extract(spark, sf):
    parsed = F.from_json("props", "k int, absent string")
    return table(spark, sf, "events").select(
        "event_id", parsed["k"].alias("k"), F.coalesce(parsed["absent"], F.lit("none")).alias("missing")
    )
