"""Winsorising, labels, histograms, correlations, rank tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import query, tracks
from encore.operators import stats
from encore.operators.order import value_ranks

T = ("tracks",)
_NUMBERS = (
    "log_repeat_listens", "duration_sec", "release_year", "track_age", "tempo", "danceability",
    "loudness", "dynamic_complexity", "genre_match_count",
)


def _rounded(df, digits=6):
    return df.select(
        *[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def _nearest(column):
    return f"""(SELECT list_sort(list({column}) FILTER ({column} IS NOT NULL)) AS v FROM tracks)"""


_CLIPPED = ("tempo", "danceability", "duration_sec")


@query(
    "winsorize",
    "SELECT mbid, "
    + ", ".join(
        f"""CASE WHEN {c} IS NOT NULL THEN ROUND(GREATEST(
            {c}_v[1 + CAST(ROUND((len({c}_v) - 1) * 0.01) AS BIGINT)],
            LEAST({c}_v[1 + CAST(ROUND((len({c}_v) - 1) * 0.99) AS BIGINT)], {c})), 6) END AS {c}"""
        for c in _CLIPPED
    )
    + " FROM tracks, "
    + ", ".join(f"(SELECT v AS {c}_v FROM {_nearest(c)})" for c in _CLIPPED),
    T,
)
def winsorize(spark, sf):
    rows = tracks(spark, sf).select("mbid", *_CLIPPED)
    return _rounded(stats.winsorize(rows, _CLIPPED))


@query(
    "winsorize_linear",
    """SELECT mbid, CASE WHEN duration_sec IS NOT NULL
        THEN ROUND(GREATEST(q[1], LEAST(q[2], duration_sec)), 6) END AS duration_sec
    FROM tracks, (SELECT quantile_cont(duration_sec, [0.01, 0.99]) AS q FROM tracks)""",
    T,
)
def winsorize_linear(spark, sf):
    rows = tracks(spark, sf).select("mbid", "duration_sec")
    return _rounded(stats.winsorize(rows, ["duration_sec"], method="linear"))


@query(
    "high_label",
    """SELECT mbid, CASE WHEN repeat_listens > c THEN 1 ELSE 0 END AS is_high_replay
    FROM tracks, (SELECT quantile_cont(repeat_listens, 0.75) AS c FROM tracks)""",
    T,
)
def high_label(spark, sf):
    return stats.high_label(tracks(spark, sf)).select(
        "mbid", F.col("is_high_replay").cast("int").alias("is_high_replay")
    )


@query(
    "histogram",
    """WITH c AS (SELECT quantile_cont(repeat_listens, 0.995) AS top FROM tracks),
    x AS (SELECT GREATEST(0.0, LEAST(CAST(repeat_listens AS DOUBLE), top)) AS x FROM tracks, c),
    e AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM x),
    n AS (SELECT CAST(LEAST(FLOOR((x - lo) * 80 / (hi - lo)), 79) AS INT) AS bin, COUNT(*) AS n
          FROM x, e GROUP BY 1)
    SELECT CAST(r.bin AS INT) AS bin, ROUND(lo + r.bin * ((hi - lo) / 80), 6) AS bin_start,
        COALESCE(n, 0) AS n
    FROM (SELECT unnest(range(80)) AS bin) r CROSS JOIN e LEFT JOIN n ON r.bin = n.bin""",
    T,
)
def histogram(spark, sf):
    return _rounded(stats.histogram(tracks(spark, sf), "repeat_listens", 80, 0.995))


def _corr_sql(a, b, source):
    return f"""SELECT '{a}' AS a, '{b}' AS b, COUNT(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL)
        AS n, ROUND(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS r FROM {source}"""


_PAIRS = [(a, b) for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i + 1 :]]


@query(
    "corr_pairwise",
    "SELECT a, b, n, CASE WHEN isnan(r) THEN NULL ELSE r END AS r FROM ("
    + " UNION ALL ".join(_corr_sql(a, b, "tracks") for a, b in _PAIRS)
    + ")",
    T,
)
def corr_pairwise(spark, sf):
    return stats.correlation_matrix(tracks(spark, sf), _NUMBERS)


@query(
    "corr_listwise",
    "WITH c AS (SELECT * FROM tracks WHERE "
    + " AND ".join(f"{c} IS NOT NULL" for c in _NUMBERS)
    + ") SELECT a, b, n, CASE WHEN isnan(r) THEN NULL ELSE r END AS r FROM ("
    + " UNION ALL ".join(_corr_sql(a, b, "c") for a, b in _PAIRS)
    + ")",
    T,
)
def corr_listwise(spark, sf):
    return stats.correlation_matrix(tracks(spark, sf), _NUMBERS, listwise=True)


_FEATURES = ("duration_sec", "tempo", "danceability", "release_year", "genre_match_count")


@query(
    "corr_report",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, COUNT({c}) AS n,
        ROUND(corr(CAST({c} AS DOUBLE), log_repeat_listens), 6) AS r FROM tracks"""
        for c in _FEATURES
    ),
    T,
)
def corr_report(spark, sf):
    return stats.target_correlations(tracks(spark, sf), _FEATURES)


@query(
    "linear_trend",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, ROUND(regr_slope(log_repeat_listens, {c}), 6) AS slope,
        ROUND(regr_intercept(log_repeat_listens, {c}), 6) AS intercept,
        ROUND(corr(CAST({c} AS DOUBLE), log_repeat_listens), 6) AS r, COUNT({c}) AS n FROM tracks"""
        for c in _FEATURES
    ),
    T,
)
def linear_trend(spark, sf):
    return stats.linear_trend(tracks(spark, sf), _FEATURES)


def _simpson(term, top, steps=2000):
    """Integral of ``term``, in ``y``, from 0 to ``top`` by Simpson's rule."""
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1.0 WHEN i % 2 = 1 THEN 4.0 ELSE 2.0 END"
    term = term.replace("y", f"(i * {top} / {steps})")
    return f"({top} / {3 * steps} * list_sum(list_transform(range({steps + 1}), lambda i: {weight} * {term})))"


# Chi-square as the integral over the root of the statistic, where it is smooth for any freedom.
_CHI_TAIL = f"""GREATEST(0.0, 1.0 - {_simpson("pow(y, k - 2) * exp(-y * y / 2)", "sqrt(h)")}
        / pow(2.0, (k - 1) / 2.0 - 1) / exp(lgamma((k - 1) / 2.0)))"""
_T_TAIL = f"""GREATEST(0.0, 1.0 - 2 * {_simpson("pow(1 + y * y / v, -(v + 1) / 2)", "abs(t)")}
        * exp(lgamma((v + 1) / 2) - lgamma(v / 2)) / sqrt(v * pi()))"""
KRUSKAL_SQL = f"""WITH top AS (SELECT genre FROM tracks GROUP BY genre ORDER BY COUNT(*) DESC, genre LIMIT 5),
    x AS (SELECT genre, log_repeat_listens AS v FROM tracks
          WHERE genre IN (SELECT genre FROM top) AND genre IN
            (SELECT genre FROM tracks GROUP BY genre HAVING COUNT(log_repeat_listens) > 20)),
    r AS (SELECT genre, RANK() OVER (ORDER BY v) + (COUNT(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk
          FROM x),
    g AS (SELECT genre, COUNT(*) AS c, SUM(rk) AS s FROM r GROUP BY genre),
    t AS (SELECT SUM(CAST(c AS DOUBLE) * c * c - c) AS t FROM
          (SELECT COUNT(*) AS c FROM x GROUP BY v)),
    m AS (SELECT COUNT(*) AS k, CAST(SUM(c) AS DOUBLE) AS n, SUM(s * s / c) AS q FROM g),
    o AS (SELECT k, CAST(n AS BIGINT) AS n,
            (12.0 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - t / (n * n * n - n)) AS h
        FROM m, t WHERE k >= 2)
    SELECT k AS groups, n, k - 1 AS freedom, ROUND(h, 6) AS h, ROUND({_CHI_TAIL}, 6) AS p_value FROM o"""
SPEARMAN_SQL = f"""WITH x AS (SELECT duration_sec AS a, log_repeat_listens AS b FROM tracks
        WHERE duration_sec IS NOT NULL AND log_repeat_listens IS NOT NULL),
    r AS (SELECT RANK() OVER (ORDER BY a) + (COUNT(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
            RANK() OVER (ORDER BY b) + (COUNT(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM x),
    o AS (SELECT COUNT(*) AS n, CAST(COUNT(*) - 2 AS DOUBLE) AS v, corr(ra, rb) AS rho FROM r
        HAVING COUNT(*) > 20),
    z AS (SELECT *, rho * sqrt(v / (1 - rho * rho)) AS t FROM o)
    SELECT n, ROUND(rho, 6) AS rho, ROUND({_T_TAIL}, 6) AS p_value FROM z"""


@query(
    "kruskal_h",
    KRUSKAL_SQL,
    T,
)
def kruskal_h(spark, sf):
    return _rounded(stats.kruskal_wallis(tracks(spark, sf)))


@query(
    "spearman",
    SPEARMAN_SQL,
    T,
)
def spearman(spark, sf):
    return _rounded(stats.spearman(tracks(spark, sf)))


@query(
    "box_summary",
    """WITH b AS (SELECT genre AS g, COUNT(*) AS n,
            quantile_cont(log_repeat_listens, [0.25, 0.5, 0.75]) AS q FROM tracks GROUP BY genre),
    f AS (SELECT *, q[1] - 1.5 * (q[3] - q[1]) AS lo, q[3] + 1.5 * (q[3] - q[1]) AS hi FROM b)
    SELECT genre, n, ROUND(q[1], 6) AS q1, ROUND(q[2], 6) AS median, ROUND(q[3], 6) AS q3,
        ROUND(MIN(CASE WHEN log_repeat_listens BETWEEN lo AND hi THEN log_repeat_listens END), 6)
            AS whisker_low,
        ROUND(MAX(CASE WHEN log_repeat_listens BETWEEN lo AND hi THEN log_repeat_listens END), 6)
            AS whisker_high,
        COUNT(*) FILTER (NOT log_repeat_listens BETWEEN lo AND hi) AS outliers
    FROM tracks JOIN f ON genre = g GROUP BY genre, n, q""",
    T,
)
def box_summary(spark, sf):
    return _rounded(stats.box_summary(tracks(spark, sf)))


@query(
    "quartile_distribution",
    """WITH s AS (SELECT tempo, log_repeat_listens AS y FROM tracks WHERE tempo IS NOT NULL),
    c AS (SELECT quantile_cont(y, [0.25, 0.5, 0.75]) AS q FROM s),
    l AS (SELECT tempo, CASE WHEN y <= q[1] THEN 'Q1 (Low)' WHEN y <= q[2] THEN 'Q2'
            WHEN y <= q[3] THEN 'Q3' ELSE 'Q4 (High)' END AS quartile FROM s, c)
    SELECT quartile, COUNT(*) AS n, ROUND(quantile_cont(tempo, 0.25), 6) AS q1,
        ROUND(quantile_cont(tempo, 0.5), 6) AS median, ROUND(quantile_cont(tempo, 0.75), 6) AS q3
    FROM l GROUP BY quartile""",
    T,
)
def quartile_distribution(spark, sf):
    return _rounded(stats.quartile_distribution(tracks(spark, sf), "tempo"))


@query(
    "dataset_percentile",
    """SELECT mbid, ROUND(100.0 * (SELECT COUNT(*) FROM tracks t WHERE t.repeat_listens
        <= p.point) / (SELECT COUNT(*) FROM tracks), 6) AS percentile
    FROM (SELECT mbid, total_user_count * 20.5 AS point FROM tracks) p""",
    T,
)
def dataset_percentile(spark, sf):
    rows = tracks(spark, sf)
    points = rows.select("mbid", (F.col("total_user_count") * 20.5).alias("point"))
    out = stats.share_at_or_below(points, "point", rows, "repeat_listens", "percentile")
    return _rounded(out.select("mbid", "percentile"))


@query(
    "value_rank_table",
    """SELECT repeat_listens, COUNT(*) AS n,
        SUM(COUNT(*)) OVER (ORDER BY repeat_listens)::BIGINT - COUNT(*) AS below
    FROM tracks GROUP BY repeat_listens""",
    T,
)
def value_rank_table(spark, sf):
    return value_ranks(tracks(spark, sf), "repeat_listens").select("repeat_listens", "n", "below")
