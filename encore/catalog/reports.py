"""Roll-ups, top-k lists and reshapes over the processed table."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import query, table, tracks
from encore.operators import order, profile, rollups
from encore.operators.rollups import drill_down

T = ("tracks",)
# Edges and labels of the duration buckets, left-closed (fixed values).
_EDGES = """(VALUES ('0_<1.5min', 0, 90), ('1_1.5-3min', 90, 180), ('2_3-4min', 180, 240),
    ('3_4-5min', 240, 300), ('4_5-7min', 300, 420), ('5_7+min', 420, 1e18)) AS b(label, low, high)"""
_DRILL = "genre IN ('ECONOMY', 'PROMO', 'SMALL') AND release_decade BETWEEN 1950 AND 2010"


# The checks reach the same numbers in another way than the reports: means as quotients of sums,
# medians from sorted lists, deviations from moments, buckets by a range join.
_GENRE_SUMMARY = """SELECT genre, n_tracks, ROUND(total / n_tracks, 1) AS avg_repeats,
    ROUND((sorted[(n_tracks + 1) // 2] + sorted[n_tracks // 2 + 1]) / 2.0, 1) AS median_repeats,
    ROUND(logs / n_tracks, 3) AS avg_log_repeats
    FROM (SELECT genre, COUNT(*) AS n_tracks, SUM(repeat_listens) AS total,
              SUM(log_repeat_listens) AS logs, list_sort(list(repeat_listens)) AS sorted
          FROM tracks GROUP BY genre)"""
_DECADES = """SELECT release_decade, n AS n_tracks, ROUND(s / n, 3) AS avg_log_repeats,
    ROUND(CASE WHEN n > 1 THEN SQRT(GREATEST(q - s * s / n, 0) / (n - 1)) END, 3) AS std_log_repeats
    FROM (SELECT release_year // 10 * 10 AS release_decade, COUNT(*) AS n,
              SUM(log_repeat_listens) AS s, SUM(log_repeat_listens * log_repeat_listens) AS q
          FROM tracks WHERE release_year > 0 GROUP BY 1)"""
_ARTISTS = """SELECT artist_name, n_tracks, avg_repeats, peak_repeats FROM (
        SELECT artist_name, len(x) AS n_tracks, ROUND(list_sum(x) / len(x), 1) AS avg_repeats,
            CAST(list_max(x) AS BIGINT) AS peak_repeats,
            ROW_NUMBER() OVER (ORDER BY ROUND(list_sum(x) / len(x), 1) DESC, artist_name) AS place
        FROM (SELECT artist_name, list(repeat_listens) AS x FROM tracks
              GROUP BY artist_name HAVING artist_name > '')
        WHERE len(x) > 4)
    WHERE place <= 25"""
_COUNTRIES = """SELECT artist_country, n_tracks, avg_log_repeats FROM (
        SELECT artist_country, n AS n_tracks, ROUND(s / n, 3) AS avg_log_repeats,
            ROW_NUMBER() OVER (ORDER BY ROUND(s / n, 3) DESC, artist_country) AS place
        FROM (SELECT artist_country, COUNT(log_repeat_listens) AS n, SUM(log_repeat_listens) AS s
              FROM tracks WHERE coalesce(artist_country, 'Unknown') NOT IN ('Unknown') GROUP BY 1)
        WHERE n > 29)
    WHERE place <= 30"""
_BUCKETS = f"""SELECT label AS duration_bucket, COUNT(*) AS n_tracks,
    ROUND(SUM(log_repeat_listens) / COUNT(*), 3) AS avg_log_repeats
    FROM tracks JOIN {_EDGES} ON duration_sec >= low AND duration_sec < high GROUP BY label"""
_OVERLAP = """SELECT DISTINCT genre_match_count,
    COUNT(*) OVER w AS n_tracks,
    ROUND(SUM(log_repeat_listens) OVER w / COUNT(*) OVER w, 3) AS avg_log_repeats
    FROM tracks WINDOW w AS (PARTITION BY genre_match_count)"""
_COVERAGE = """SELECT w.n + o.n AS total_rows, w.n AS with_audio_features,
    ROUND(100.0 * w.n / (w.n + o.n), 2) AS pct_with_audio_features,
    ROUND(w.s / NULLIF(w.n, 0), 3) AS avg_log_replays_with_audio,
    ROUND(o.s / NULLIF(o.n, 0), 3) AS avg_log_replays_without_audio
    FROM (SELECT COUNT(*) AS n, SUM(log_repeat_listens) AS s FROM tracks WHERE tempo IS NOT NULL) w,
        (SELECT COUNT(*) AS n, SUM(log_repeat_listens) AS s FROM tracks WHERE tempo IS NULL) o"""
_AUDIO_GENRE = """SELECT t.genre, t.n AS n_tracks, COALESCE(a.n, 0) AS with_audio_features,
    ROUND(100.0 * COALESCE(a.n, 0) / t.n, 2) AS pct_with_audio_features
    FROM (SELECT genre, COUNT(*) AS n FROM tracks GROUP BY genre) t
    LEFT JOIN (SELECT genre, COUNT(*) AS n FROM tracks WHERE tempo IS NOT NULL GROUP BY genre) a
        ON t.genre IS NOT DISTINCT FROM a.genre"""

for _name, _report, _sql in (
    ("category_summary", rollups.category_summary, _GENRE_SUMMARY),
    ("period_trend", rollups.period_trend, _DECADES),
    ("top_entities", rollups.top_entities, _ARTISTS),
    ("segment_breakdown", rollups.segment_breakdown, _COUNTRIES),
    ("bucket_rollup", rollups.bucket_rollup, _BUCKETS),
    ("overlap_rollup", rollups.overlap_rollup, _OVERLAP),
    ("coverage_scalar", rollups.coverage_scalar, _COVERAGE),
    ("coverage_by_category", rollups.coverage_by_category, _AUDIO_GENRE),
):
    query(_name, _sql, T)(lambda spark, sf, report=_report: report(tracks(spark, sf)))


@query(
    "query_report",
    " UNION ALL ".join(
        f"SELECT '{name}' AS section, COUNT(*) AS rows FROM ({sql})"
        for name, sql in (
            ("genre_summary", _GENRE_SUMMARY),
            ("decade_trend", _DECADES),
            ("top_artists", _ARTISTS),
            ("country_breakdown", _COUNTRIES),
            ("duration_buckets", _BUCKETS),
            ("genre_overlap", _OVERLAP),
            ("audio_coverage", _COVERAGE),
            ("audio_by_genre", _AUDIO_GENRE),
        )
    ),
    T,
)
def query_report(spark, sf):
    return rollups.report_sizes(rollups.run_reports(tracks(spark, sf)))


@query(
    "median_by_category",
    "SELECT genre, MEDIAN(repeat_listens) AS median_repeats FROM tracks GROUP BY genre",
    T,
)
def median_by_category(spark, sf):
    return rollups.median_by_category(tracks(spark, sf))


@query(
    "trend_band",
    """SELECT release_decade, ROUND(m, 6) AS median_log_replays, ROUND(s, 6) AS std_log_replays,
        ROUND(m - s, 6) AS band_low, ROUND(m + s, 6) AS band_high
    FROM (SELECT release_decade, MEDIAN(log_repeat_listens) AS m,
            COALESCE(STDDEV(log_repeat_listens), 0.0) AS s
          FROM tracks WHERE release_decade IS NOT NULL GROUP BY release_decade)""",
    T,
)
def trend_band(spark, sf):
    band = rollups.trend_band(tracks(spark, sf))
    return band.select("release_decade", *[F.round(c, 6).alias(c) for c in band.columns[1:]])


@query(
    "bucket_right_closed",
    """WITH b AS (SELECT log_repeat_listens, CASE WHEN duration_sec <= 90 THEN 1
            WHEN duration_sec <= 180 THEN 2 WHEN duration_sec <= 240 THEN 3
            WHEN duration_sec <= 300 THEN 4 WHEN duration_sec <= 420 THEN 5 ELSE 6 END AS bin_order
          FROM tracks WHERE duration_sec IS NOT NULL)
    SELECT CAST(bin_order AS INT) AS bin_order,
        ['<1.5min', '1.5-3min', '3-4min', '4-5min', '5-7min', '7+min'][bin_order] AS duration_bin,
        ROUND(MEDIAN(log_repeat_listens), 6) AS median_log_replays FROM b GROUP BY bin_order""",
    T,
)
def bucket_right_closed(spark, sf):
    return rollups.bucket_medians(tracks(spark, sf)).withColumn(
        "median_log_replays", F.round("median_log_replays", 6)
    )


@query(
    "top_groups",
    """SELECT artist_name, COUNT(*) AS tracks FROM tracks GROUP BY artist_name
    ORDER BY tracks DESC, artist_name LIMIT 12""",
    T,
)
def top_groups(spark, sf):
    return rollups.top_groups(tracks(spark, sf), "artist_name")


def _drilled(spark, sf):
    return drill_down(tracks(spark, sf), ["ECONOMY", "PROMO", "SMALL"], 1950, 2010)


@query(
    "drilldown_filter",
    f"SELECT mbid, genre, release_decade, repeat_listens FROM tracks WHERE {_DRILL}",
    T,
)
def drilldown_filter(spark, sf):
    return _drilled(spark, sf).select("mbid", "genre", "release_decade", "repeat_listens")


@query(
    "trend_by_two_keys",
    f"""SELECT release_decade, genre, ROUND(MEDIAN(log_repeat_listens), 6) AS median_log_replays
    FROM tracks WHERE {_DRILL} GROUP BY release_decade, genre""",
    T,
)
def trend_by_two_keys(spark, sf):
    return rollups.trend_by_group(_drilled(spark, sf)).withColumn(
        "median_log_replays", F.round("median_log_replays", 6)
    )


@query(
    "leaderboard",
    f"""SELECT artist_name, COUNT(*) AS tracks, ROUND(AVG(log_repeat_listens), 6) AS avg_log_replays
    FROM tracks WHERE {_DRILL} AND artist_name IS NOT NULL GROUP BY artist_name
    ORDER BY avg_log_replays DESC, artist_name LIMIT 15""",
    T,
)
def leaderboard(spark, sf):
    return rollups.leaderboard(_drilled(spark, sf))


@query(
    "catalog_topk",
    """SELECT mbid, title, artist_name, genre, repeat_listens, title || ' — ' || artist_name AS label
    FROM tracks WHERE title IS NOT NULL AND artist_name IS NOT NULL
    ORDER BY log_repeat_listens DESC NULLS LAST, mbid LIMIT 500""",
    T,
)
def catalog_topk(spark, sf):
    cols = ["mbid", "title", "artist_name", "genre", "repeat_listens", "log_repeat_listens"]
    return rollups.catalog(tracks(spark, sf).select(*cols), 500).drop("log_repeat_listens")


@query(
    "catalog_search",
    """WITH c AS (SELECT mbid, title || ' — ' || artist_name AS label FROM tracks
        WHERE title IS NOT NULL AND artist_name IS NOT NULL
        ORDER BY log_repeat_listens DESC NULLS LAST, mbid LIMIT 500)
    SELECT mbid, label FROM c WHERE contains(lower(label), lower('Red W'))""",
    T,
)
def catalog_search(spark, sf):
    cols = ["mbid", "title", "artist_name", "log_repeat_listens"]
    listed = rollups.catalog(tracks(spark, sf).select(*cols), 500)
    return rollups.search_catalog(listed, "Red W").select("mbid", "label")


@query(
    "fixed_sample",
    """SELECT mbid, duration_sec, log_repeat_listens FROM tracks WHERE duration_sec IS NOT NULL
    ORDER BY md5(CAST(mbid AS VARCHAR) || ':42'), mbid LIMIT 800""",
    T,
)
def fixed_sample(spark, sf):
    rows = tracks(spark, sf).select("mbid", "duration_sec", "log_repeat_listens")
    return order.fixed_sample(rows.na.drop(subset=["duration_sec"]), "mbid", 800)


@query(
    "prefix_limit",
    "SELECT event_id, user_id FROM events ORDER BY event_id LIMIT 500",
)
def prefix_limit(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id")
    return order.top_rows(events, 500, F.col("event_id"))


@query(
    "best_row",
    """SELECT artist_name, ROUND(AVG(log_repeat_listens), 6) AS score FROM tracks
    GROUP BY artist_name ORDER BY score DESC, artist_name LIMIT 1""",
    T,
)
def best_row(spark, sf):
    scores = tracks(spark, sf).groupBy("artist_name").agg(
        F.round(F.avg("log_repeat_listens"), 6).alias("score")
    )
    return rollups.best_row(scores, "score", "artist_name")


_BY_TYPE = """SELECT genre, ROUND(AVG(repeat_listens), 3) AS mean_repeats,
    ROUND(STDDEV(log_repeat_listens), 6) AS std_log FROM tracks GROUP BY genre"""


def _by_type(spark, sf):
    return tracks(spark, sf).groupBy("genre").agg(
        F.round(F.avg("repeat_listens"), 3).alias("mean_repeats"),
        F.round(F.stddev_samp("log_repeat_listens"), 6).alias("std_log"),
    )


@query(
    "unpivot_metrics",
    f"""SELECT genre, 'mean_repeats' AS metric, mean_repeats AS value FROM ({_BY_TYPE})
    UNION ALL SELECT genre, 'std_log', std_log FROM ({_BY_TYPE})""",
    T,
)
def unpivot_metrics(spark, sf):
    return rollups.melt(_by_type(spark, sf), ["genre"], ["mean_repeats", "std_log"], "metric", "value")


@query(
    "pivot_metrics",
    """WITH o(row_order, genre) AS (VALUES (0, 'SMALL'), (1, 'LARGE'), (2, 'NONE SUCH'), (3, 'PROMO')),
    m AS (SELECT genre, artist_type, ROUND(AVG(log_repeat_listens), 6) AS v
          FROM tracks GROUP BY genre, artist_type)
    SELECT CAST(o.row_order AS INT) AS row_order, o.genre,
        MAX(CASE WHEN artist_type = 'Group' THEN v END) AS "Group",
        MAX(CASE WHEN artist_type = 'Person' THEN v END) AS "Person"
    FROM o LEFT JOIN m ON o.genre = m.genre GROUP BY o.row_order, o.genre""",
    T,
)
def pivot_metrics(spark, sf):
    means = tracks(spark, sf).groupBy("genre", "artist_type").agg(
        F.round(F.avg("log_repeat_listens"), 6).alias("v")
    )
    return rollups.pivot_fixed(
        means, "genre", "artist_type", "v", ["Group", "Person"],
        ["SMALL", "LARGE", "NONE SUCH", "PROMO"],
    )


@query(
    "running_sum",
    """SELECT release_decade, n, CAST(SUM(n) OVER (ORDER BY release_decade
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running
    FROM (SELECT release_decade, COUNT(*) AS n FROM tracks WHERE release_decade IS NOT NULL
          GROUP BY release_decade)""",
    T,
)
def running_sum(spark, sf):
    sizes = (
        tracks(spark, sf)
        .where(F.col("release_decade").isNotNull())
        .groupBy("release_decade")
        .agg(F.count("*").alias("n"))
    )
    return order.running_total(sizes, "release_decade", "n", "running")


@query(
    "quartile_profile",
    """WITH c AS (SELECT quantile_cont(log_repeat_listens, [0.25, 0.5, 0.75]) AS q FROM tracks)
    SELECT CASE WHEN log_repeat_listens <= q[1] THEN 'Q1 (Low)' WHEN log_repeat_listens <= q[2]
            THEN 'Q2' WHEN log_repeat_listens <= q[3] THEN 'Q3' ELSE 'Q4 (High)' END AS quartile,
        ROUND(AVG(duration_sec), 6) AS duration_sec, ROUND(AVG(tempo), 6) AS tempo,
        ROUND(AVG(track_age), 6) AS track_age
    FROM tracks, c GROUP BY 1""",
    T,
)
def quartile_profile(spark, sf):
    rows = order.with_quartile(tracks(spark, sf), "log_repeat_listens")
    return rollups.profile_by(rows, "quartile", ["duration_sec", "tempo", "track_age"])


@query(
    "option_list",
    """SELECT DISTINCT artist_country AS value FROM tracks
    WHERE artist_country IS NOT NULL AND artist_country <> ''""",
    T,
)
def option_list(spark, sf):
    return profile.option_list(tracks(spark, sf), "artist_country")


@query(
    "item_vs_group",
    """SELECT mbid, genre, ROUND(log_repeat_listens, 6) AS log_repeat_listens,
        ROUND(m, 6) AS group_median, ROUND(log_repeat_listens - m, 6) AS gap
    FROM tracks JOIN (SELECT genre AS g, MEDIAN(log_repeat_listens) AS m FROM tracks GROUP BY genre)
        ON genre = g""",
    T,
)
def item_vs_group(spark, sf):
    out = rollups.item_vs_group(tracks(spark, sf))
    return out.select("mbid", "genre", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


@query(
    "lookup_fallback",
    """SELECT mbid, title, artist_name, repeat_listens FROM (
        SELECT *, 0 AS pref FROM tracks WHERE mbid = -1
        UNION ALL SELECT *, 1 AS pref FROM tracks
            WHERE title = 'red widget' AND artist_name = 'Brand#17')
    ORDER BY pref, mbid LIMIT 1""",
    T,
)
def lookup_fallback(spark, sf):
    rows = tracks(spark, sf).select("mbid", "title", "artist_name", "repeat_listens")
    return rollups.find_item(rows, -1, "red widget", "Brand#17")
