"""Linking the corpus to items."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import link_corpus, query, table, tracks
from encore.catalog.cells import PUNCT_SQL
from encore.functions import match_key
from encore.operators import linking

_V = ("tracks", "link_corpus")


def _key(c):
    return f"trim(regexp_replace(translate(lower({c}), {PUNCT_SQL}, ''), '\\s+', ' ', 'g'))"


_EXACT = f"""WITH x AS (SELECT a, t, mbid FROM (SELECT {_key('artist_name')} AS a,
        {_key('title')} AS t, mbid, ROW_NUMBER() OVER (PARTITION BY {_key('artist_name')},
        {_key('title')} ORDER BY log_repeat_listens NULLS FIRST, mbid) AS r FROM tracks
        WHERE mbid IS NOT NULL AND title IS NOT NULL AND artist_name IS NOT NULL) WHERE r = 1),
    k AS (SELECT seq, {_key('artist')} AS a, {_key('title')} AS t, lyrics FROM link_corpus
        WHERE artist IS NOT NULL AND title IS NOT NULL AND lyrics IS NOT NULL)"""


@query("link_exact", f"{_EXACT} SELECT seq, mbid AS id FROM k JOIN x USING (a, t)", _V)
def link_exact(spark, sf):
    targets = linking.target_keys(tracks(spark, sf))
    return linking.link_exact(linking.corpus_keys(link_corpus(spark, sf)), targets)


def _sorted_sql(t):
    return f"array_to_string(list_sort(list_filter(string_split({t}, ' '), lambda w: w <> '')), ' ')"


def _ratio_sql(a, b):
    """Similarity by the longest common subsequence: a fold over the letters of ``b`` whose state
    has a bit for each letter of ``a`` (up to 126 letters), 0 where the subsequence grew."""
    full = f"((1::HUGEINT << len({a})::INT) - 1)"
    places = f"""list_sum(list_transform(range(len({a})), lambda i: CASE WHEN {a}[i + 1] = c
        THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END))::HUGEINT"""
    row = f"""list_reduce(list_prepend({full}, list_transform(string_split({b}, ''), lambda c: {places})),
        lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full})"""
    return f"""CASE WHEN len({a}) + len({b}) = 0 THEN 100.0::DOUBLE
        WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE
        ELSE 200.0::DOUBLE * (len({a}) - bit_count({row})) / (len({a}) + len({b})) END"""


# Every title of the artist is compared, or of the artist's other name where there is none.
_FUZZY = f"""{_EXACT},
    item AS (SELECT mbid, {_key('artist_name')} AS a, {_sorted_sql(_key('title'))} AS s,
        log_repeat_listens AS y FROM tracks
        WHERE mbid IS NOT NULL AND title IS NOT NULL AND artist_name IS NOT NULL),
    named AS (SELECT a AS block, * EXCLUDE (a) FROM item UNION ALL
        SELECT CASE WHEN a LIKE 'the %' THEN substr(a, 5) ELSE 'the ' || a END, * EXCLUDE (a) FROM item),
    missed AS (SELECT DISTINCT a, t FROM k WHERE NOT EXISTS
        (SELECT 1 FROM x WHERE x.a = k.a AND x.t = k.t)),
    probe AS (SELECT a, t, {_sorted_sql('t')} AS u, CASE WHEN a IN (SELECT block FROM named) THEN a
        WHEN a LIKE 'the %' THEN substr(a, 5) ELSE 'the ' || a END AS block FROM missed),
    scored AS (SELECT a, t, mbid, y, {_ratio_sql('u', 's')} AS score
        FROM probe JOIN named USING (block)),
    near AS (SELECT a, t, mbid AS id, score FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY a, t
        ORDER BY score DESC, y DESC NULLS LAST, mbid) AS r FROM scored WHERE score >= 85) WHERE r = 1)"""

LINKED_SQL = f"""{_FUZZY}, hit AS (SELECT seq, mbid FROM k JOIN x USING (a, t) UNION ALL
        SELECT seq, id FROM k JOIN near USING (a, t)),
    w AS (SELECT mbid, MIN(seq) AS seq FROM hit GROUP BY mbid)
    SELECT mbid, w.seq, lyrics AS text FROM w JOIN k ON w.seq = k.seq"""


@query("link_fuzzy", f"{_FUZZY} SELECT a, t, id, score FROM near", _V)
def link_fuzzy(spark, sf):
    targets = linking.target_keys(tracks(spark, sf))
    keys = linking.corpus_keys(link_corpus(spark, sf))
    missed = keys.join(linking.exact_index(targets), ["a", "t"], "left_anti")
    return linking.link_fuzzy(missed, targets)


@query(
    "link_arbitrate",
    f"""{_EXACT}, w AS (SELECT mbid, MIN(seq) AS seq FROM k JOIN x USING (a, t) GROUP BY mbid)
    SELECT mbid, w.seq, lyrics AS text FROM w JOIN k ON w.seq = k.seq""",
    _V,
)
def link_arbitrate(spark, sf):
    return linking.link_texts(link_corpus(spark, sf), tracks(spark, sf), cut=None)


@query("link_texts", LINKED_SQL, _V)
def link_texts(spark, sf):
    return linking.link_texts(link_corpus(spark, sf), tracks(spark, sf))


@query(
    "link_coverage",
    f"""{_EXACT} SELECT COUNT(DISTINCT mbid) AS matched, (SELECT COUNT(*) FROM x) AS linkable,
        ROUND(100.0 * COUNT(DISTINCT mbid) / (SELECT COUNT(*) FROM x), 4) AS pct
    FROM k JOIN x USING (a, t)""",
    _V,
)
def link_coverage(spark, sf):
    items = tracks(spark, sf)
    keys = linking.corpus_keys(link_corpus(spark, sf))
    links = linking.link_exact(keys, linking.target_keys(items)).withColumnRenamed("id", "mbid")
    return linking.link_coverage(links, items).withColumn("pct", F.round("pct", 4))


_LONGER = _sorted_sql("t || ' live'")


@query(
    "token_sort_ratio",
    f"""SELECT p_partkey, t, ROUND({_ratio_sql('u', 'v')}, 6) AS swapped_score,
        ROUND({_ratio_sql('u', 'w')}, 6) AS longer_score
    FROM (SELECT p_partkey, t, {_sorted_sql('t')} AS u,
            {_sorted_sql("array_to_string(list_reverse(string_split(t, ' ')), ' ')")} AS v, {_LONGER} AS w
        FROM (SELECT p_partkey, {_key('p_name')} AS t FROM part))""",
)
def token_sort_ratio(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", match_key(F.col("p_name")).alias("t"))
    swapped = F.concat_ws(" ", F.reverse(F.split("t", " ")))
    return parts.select(
        "p_partkey",
        "t",
        F.round(linking.title_similarity(F.col("t"), swapped), 6).alias("swapped_score"),
        F.round(
            linking.title_similarity(F.col("t"), F.concat(F.col("t"), F.lit(" live"))), 6
        ).alias("longer_score"),
    )
