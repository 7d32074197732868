"""Text features, term contrasts and topics over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import doc_targets, lexicon, query, table, texts
from encore.catalog.cells import PUNCT_SQL, WORDS_SQL, words_sql
from encore.config import PROFILE_STOP_WORDS
from encore.functions import word_list
from encore.operators import terms, valence
from encore.session import stage_table

_W = f"WITH w AS (SELECT doc_id AS mbid, text, {WORDS_SQL} AS w FROM documents)"
_COUNTS = f"""{_W}, e AS (SELECT mbid, unnest(w) AS word, unnest(range(len(w))) AS pos FROM w),
    c AS (SELECT mbid, word, COUNT(*) AS n, MIN(pos) AS p FROM e GROUP BY mbid, word)"""
_PAIR_COUNTS = f"""{_W}, e AS (SELECT mbid, w[i] || ' ' || w[i + 1] AS word, i AS pos
        FROM (SELECT mbid, w, unnest(range(1, len(w))) AS i FROM w)),
    c AS (SELECT mbid, word, COUNT(*) AS n, MIN(pos) AS p FROM e GROUP BY mbid, word)"""
_LEXICON = f"""lex AS (SELECT word, valence FROM (
        SELECT word, COUNT(*) AS n, ROUND(2.0 * AVG(quality - toxic), 3) AS valence
        FROM (SELECT doc_id, quality, toxic, unnest(list_distinct({WORDS_SQL})) AS word
              FROM documents JOIN labels USING (doc_id)) GROUP BY word)
    WHERE n >= 3 AND valence <> 0)"""
_FREQ = f"""fq AS (SELECT word, COUNT(*) / SUM(COUNT(*)) OVER () AS freq FROM (
        SELECT unnest(list_filter(regexp_split_to_array(translate(lower(text), {PUNCT_SQL}, ''),
            '\\s+'), lambda x: length(x) > 1 AND NOT regexp_full_match(x, '\\pN+'))) AS word
        FROM conversations) GROUP BY word)"""


def _tokens(spark, sf):
    return terms.tokens(texts(spark, sf))


@query(
    "lexical_features",
    f"""{_W} SELECT mbid, CAST(len(w) AS INT) AS word_count,
        CAST(len(list_distinct(w)) AS INT) AS unique_word_count,
        ROUND(len(list_distinct(w)) / GREATEST(len(w), 1), 4) AS type_token_ratio FROM w""",
)
def lexical_features(spark, sf):
    cells = terms.lexical_features(F.col("words"))
    return _tokens(spark, sf).select("mbid", *[c.alias(n) for n, c in cells.items()])


@query(
    "line_features",
    """WITH l AS (SELECT doc_id AS mbid, list_filter(string_split(text, chr(10)),
            lambda x: trim(x) <> '') AS l FROM documents)
    SELECT mbid, CAST(len(l) AS INT) AS line_count,
        ROUND(COALESCE(list_sum(list_transform(l, lambda x:
            len(list_filter(regexp_split_to_array(x, '\\s+'), lambda y: y <> '')))), 0)
            / GREATEST(len(l), 1), 2) AS avg_line_length,
        ROUND((len(l) - len(list_distinct(list_transform(l, lambda x: lower(trim(x))))))
            / GREATEST(len(l), 1), 4) AS repetitiveness FROM l""",
)
def line_features(spark, sf):
    cells = terms.line_features(F.col("lines"))
    return terms.with_parts(texts(spark, sf)).select("mbid", *[c.alias(n) for n, c in cells.items()])


@query(
    "word_length_features",
    f"""{_W} SELECT mbid, ROUND(COALESCE(list_sum(list_transform(w, lambda x: length(x))), 0)
        / GREATEST(len(w), 1), 3) AS avg_word_length FROM w""",
)
def word_length_features(spark, sf):
    cells = terms.word_length_features(F.col("words"))
    return _tokens(spark, sf).select("mbid", cells["avg_word_length"].alias("avg_word_length"))


_LONGEST = f"""{_W}, d AS (SELECT DISTINCT mbid, word FROM (SELECT mbid, unnest(w) AS word FROM w)),
    r AS (SELECT mbid, word, ROW_NUMBER() OVER (PARTITION BY mbid ORDER BY length(word) DESC, word)
        AS r FROM d)"""


@query(
    "longest_words",
    f"""{_LONGEST} SELECT mbid, string_agg(word, '; ' ORDER BY r) AS longest_words
    FROM r WHERE r <= 10 GROUP BY mbid""",
)
def longest_words(spark, sf):
    lists = _tokens(spark, sf).where(F.size("words") > 0)
    return lists.select(
        "mbid", F.array_join(terms.longest_words(F.col("words")), "; ").alias("longest_words")
    )


@query(
    "word_list_top",
    f"""{_LONGEST} SELECT word, COUNT(*) AS n FROM r WHERE r <= 10 GROUP BY word
    ORDER BY n DESC, word LIMIT 20""",
)
def word_list_top(spark, sf):
    lists = _tokens(spark, sf).select(terms.longest_words(F.col("words")).alias("longest_words"))
    return terms.list_leaders(lists, "longest_words")


@query(
    "topn_per_item",
    f"""{_COUNTS} SELECT mbid, word, n, CAST(r AS INT) AS rank FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY mbid ORDER BY n DESC, p) AS r FROM c)
    WHERE r <= 15""",
)
def topn_per_item(spark, sf):
    counts = terms.word_counts(_tokens(spark, sf))
    return terms.top_words(counts, 15).select("mbid", "word", "n", "rank")


@query(
    "top_bigrams",
    f"""{_PAIR_COUNTS} SELECT mbid, string_agg(word, '; ' ORDER BY r) AS top_bigrams FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY mbid ORDER BY n DESC, p) AS r FROM c)
    WHERE r <= 5 GROUP BY mbid""",
)
def top_bigrams(spark, sf):
    counts = terms.word_counts(_tokens(spark, sf), pairs=True)
    return terms.top_list(counts, 5, "top_bigrams").withColumn(
        "top_bigrams", F.array_join("top_bigrams", "; ")
    )


@query(
    "readability",
    """WITH x AS (SELECT doc_id AS mbid,
            NULLIF(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')), 0) AS w,
            GREATEST(len(list_filter(regexp_split_to_array(text, '[.!?]+'),
                lambda x: regexp_matches(x, '[0-9A-Za-z_]'))), 1) AS s,
            len(regexp_extract_all(lower(text), '[aeiouy]+')) AS y FROM documents)
    SELECT mbid, ROUND(206.835 - 1.015 * (w / s) - 84.6 * (y / w), 6) AS flesch_reading_ease,
        ROUND(0.39 * (w / s) + 11.8 * (y / w) - 15.59, 6) AS flesch_kincaid_grade FROM x""",
)
def readability(spark, sf):
    cells = terms.readability(F.col("shape"))
    return terms.with_parts(texts(spark, sf)).select("mbid", *[F.round(c, 6).alias(n) for n, c in cells.items()])


@query(
    "lexicon_sentiment",
    f"""WITH {_LEXICON}, t AS (SELECT doc_id AS mbid, unnest(list_filter(regexp_split_to_array(
            regexp_replace(lower(text), '[^\\pL\\pM\\pN_\\s'']', '', 'g'), '\\s+'), lambda x: x <> '')) AS word
        FROM documents),
    v AS (SELECT mbid, COALESCE(valence, 0.0) AS v FROM t LEFT JOIN lex USING (word)),
    s AS (SELECT mbid, SUM(v) AS s, SUM(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS p,
            SUM(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS m,
            COUNT(*) FILTER (v = 0) AS z FROM v GROUP BY mbid)
    SELECT mbid, ROUND(s / SQRT(s * s + 15), 4) AS sentiment_compound,
        ROUND(p / (p + m + z), 4) AS sentiment_positive,
        ROUND(m / (p + m + z), 4) AS sentiment_negative,
        ROUND(z / (p + m + z), 4) AS sentiment_neutral FROM s""",
)
def lexicon_sentiment(spark, sf):
    return terms.sentiment(texts(spark, sf), lexicon(spark, sf))


def _in(words):
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _step_sql(k, weight, never):
    """The valence after the word ``k`` before it: predecessors are read with lag."""
    so = " OR ".join(f"COALESCE(a{j} IN ('so', 'this'), FALSE)" for j in range(1, k)) or "FALSE"
    return f"""d{k} AS (SELECT *, CASE WHEN a{k} IS NULL OR v{k} IS NOT NULL THEN y{k - 1}
            WHEN a{k} = 'never' AND ({so}) THEN u{k} * {never}
            WHEN n{k} THEN u{k} * -0.74 ELSE u{k} END AS y{k}
        FROM (SELECT *, y{k - 1} + COALESCE(b{k} + CASE WHEN c{k} AND mixed THEN 0.733 ELSE 0 END, 0)
            * CASE WHEN y{k - 1} < 0 THEN -1 ELSE 1 END * {weight} AS u{k} FROM d{k - 1}))"""


_LAGS = ", ".join(f"LAG({c}, {k}) OVER o AS {n}{k}" for k in (1, 2, 3) for c, n in zip(
    ("a", "v", "caps", "b", "g"), ("a", "v", "c", "b", "n")))


@query(
    "context_sentiment",
    f"""WITH {_LEXICON}, t AS (SELECT doc_id AS mbid, text, list_filter(regexp_split_to_array(
            regexp_replace(text, '[^\\pL\\pM\\pN_\\s'']', '', 'g'), '\\s+'), lambda x: x <> '') AS w FROM documents),
    e AS (SELECT mbid, unnest(w) AS raw, unnest(range(len(w))) AS i FROM t),
    x AS (SELECT mbid, i, lower(raw) AS a, upper(raw) = raw AND lower(raw) <> raw AS caps,
            CASE WHEN lower(raw) IN {_in(valence.STRONGER)} THEN 0.293e0
                WHEN lower(raw) IN {_in(valence.WEAKER)} THEN -0.293e0 END AS b,
            lower(raw) IN {_in(valence.NEGATIONS)} OR contains(lower(raw), 'n''t') AS g FROM e),
    l AS (SELECT x.*, CAST(valence AS DOUBLE) AS v FROM x LEFT JOIN lex ON lex.word = x.a),
    k AS (SELECT mbid, MIN(i) FILTER (a = 'but') AS but, BOOL_OR(caps) AND NOT BOOL_AND(caps) AS mixed
        FROM x GROUP BY mbid),
    d0 AS (SELECT *, v + CASE WHEN caps AND mixed THEN 0.733 ELSE 0 END * CASE WHEN v < 0 THEN -1 ELSE 1 END AS y0
        FROM (SELECT l.*, {_LAGS} FROM l WINDOW o AS (PARTITION BY mbid ORDER BY i)) JOIN k USING (mbid)),
    {_step_sql(1, 1, 1)}, {_step_sql(2, 0.95, 1.5)}, {_step_sql(3, 0.9, 1.25)},
    z AS (SELECT mbid, CASE WHEN v IS NULL OR b IS NOT NULL THEN 0 ELSE y3
            * CASE WHEN a1 = 'least' AND v1 IS NULL AND NOT COALESCE(a2 IN ('at', 'very'), FALSE)
                THEN -0.74 ELSE 1 END
            * CASE WHEN i < but THEN 0.5 WHEN i > but THEN 1.5 ELSE 1 END END AS y FROM d3),
    r AS (SELECT mbid, COALESCE(SUM(y), 0) AS s, COALESCE(SUM(CASE WHEN y > 0 THEN y + 1 ELSE 0 END), 0) AS p,
            COALESCE(SUM(CASE WHEN y < 0 THEN 1 - y ELSE 0 END), 0) AS m, COUNT(*) FILTER (y = 0) AS z
        FROM t LEFT JOIN z USING (mbid) GROUP BY mbid),
    q AS (SELECT doc_id AS mbid, COALESCE(LEAST(length(text) - length(replace(text, '!', '')), 4) * 0.292e0
            + CASE WHEN n > 3 THEN 0.96 WHEN n > 1 THEN n * 0.18 ELSE 0 END, 0) AS k
        FROM (SELECT doc_id, text, length(text) - length(replace(text, '?', '')) AS n FROM documents)),
    f AS (SELECT mbid, s + SIGN(s) * k AS s, p + CASE WHEN p > m THEN k ELSE 0 END AS p,
            m + CASE WHEN p < m THEN k ELSE 0 END AS m, z FROM r JOIN q USING (mbid))
    SELECT mbid, ROUND(s / SQRT(s * s + 15), 4) AS sentiment_compound,
        ROUND(COALESCE(p / NULLIF(p + m + z, 0), 0), 4) AS sentiment_positive,
        ROUND(COALESCE(m / NULLIF(p + m + z, 0), 0), 4) AS sentiment_negative,
        ROUND(COALESCE(z / NULLIF(p + m + z, 0), 0), 4) AS sentiment_neutral FROM f""",
)
def context_sentiment(spark, sf):
    return valence.sentiment_in_context(texts(spark, sf), lexicon(spark, sf))


_RARE = f"""{_COUNTS}, {_FREQ}, x AS (SELECT mbid, word, n, COALESCE(freq, 0) AS f
    FROM c LEFT JOIN fq USING (word))"""


def _rarity(spark, sf):
    freq = terms.word_shares(table(spark, sf, "conversations"))
    return terms.rarity(terms.word_counts(_tokens(spark, sf)), freq)


@query(
    "rarity_features",
    f"""{_RARE} SELECT mbid, CAST(SUM(CASE WHEN f < 0.00001 THEN n ELSE 0 END) AS BIGINT)
            AS rare_word_count,
        ROUND(SUM(CASE WHEN f < 0.00001 THEN n ELSE 0 END) / SUM(n), 4) AS rare_word_ratio
    FROM x GROUP BY mbid""",
)
def rarity_features(spark, sf):
    return _rarity(spark, sf).drop("rarest_words")


@query(
    "rarest_words",
    f"""{_RARE}, r AS (SELECT mbid, word, ROW_NUMBER() OVER (PARTITION BY mbid ORDER BY f, word) AS r
        FROM x WHERE f < 0.00001)
    SELECT mbid, string_agg(word, '; ' ORDER BY r) AS rarest_words FROM r WHERE r <= 10
    GROUP BY mbid""",
)
def rarest_words(spark, sf):
    lists = _rarity(spark, sf).where(F.size("rarest_words") > 0)
    return lists.select("mbid", F.array_join("rarest_words", "; ").alias("rarest_words"))


@query(
    "text_means",
    f"""{_W} SELECT COUNT(*) AS n, ROUND(AVG(len(w)), 6) AS word_count,
        ROUND(AVG(ROUND(len(list_distinct(w)) / GREATEST(len(w), 1), 4)), 6) AS type_token_ratio
    FROM w""",
)
def text_means(spark, sf):
    cells = terms.lexical_features(F.col("words"))
    rows = _tokens(spark, sf).select(*[c.alias(n) for n, c in cells.items()])
    return rows.agg(
        F.count("*").alias("n"),
        *[F.round(F.avg(c), 6).alias(c) for c in ("word_count", "type_token_ratio")],
    )


@query("text_features")
def text_features(spark, sf):
    freq = terms.word_shares(table(spark, sf, "conversations"))
    return terms.text_features(texts(spark, sf), lexicon(spark, sf), freq)


def _contrast_sql(counts, top_n, least):
    return f"""{counts},
    y AS (SELECT doc_id AS mbid, LN(1 + CAST(n_chars AS DOUBLE)) AS y FROM documents),
    q AS (SELECT quantile_cont(y, [0.25, 0.75]) AS q FROM y),
    t AS (SELECT word, CAST(SUM(CASE WHEN y >= q[2] THEN n ELSE 0 END) AS BIGINT) AS high_count,
            CAST(SUM(CASE WHEN y < q[2] AND y <= q[1] THEN n ELSE 0 END) AS BIGINT) AS low_count
          FROM c JOIN y USING (mbid), q WHERE y >= q[2] OR y <= q[1] GROUP BY word),
    s AS (SELECT GREATEST(SUM(high_count), 1) AS h, GREATEST(SUM(low_count), 1) AS l FROM t),
    k AS (SELECT word FROM (SELECT word FROM t WHERE high_count > 0
                ORDER BY high_count DESC, word LIMIT {top_n})
          UNION SELECT word FROM (SELECT word FROM t WHERE low_count > 0
                ORDER BY low_count DESC, word LIMIT {top_n})),
    f AS (SELECT word, ROUND(high_count / h, 9) AS high_freq, ROUND(low_count / l, 9) AS low_freq,
            high_count, low_count, high_count / h / (low_count / l + 1e-9) AS ratio,
            high_count + low_count AS total_count
          FROM t SEMI JOIN k USING (word), s WHERE high_count + low_count >= {least})"""


_WORDS_CONTRAST = _contrast_sql(_COUNTS, 200, 5)
_CONTRAST_OUT = """word, high_freq, low_freq, high_count, low_count,
    CAST(printf('%.6g', ratio) AS DOUBLE) AS freq_ratio, total_count"""


def _tidy(df):
    return df.withColumns(
        {
            "high_freq": F.round("high_freq", 9),
            "low_freq": F.round("low_freq", 9),
            # Ratios span 1e-3 to 1e7: six significant digits.
            "freq_ratio": _six_digits(F.col("freq_ratio")),
        }
    )


def _six_digits(value):
    unit = F.pow(F.lit(10.0), F.lit(5) - F.floor(F.log10(F.abs(value))))
    digits = F.when(value == 0, F.lit(0.0)).otherwise(F.round(value * unit) / unit)
    return F.round(digits, 9)


def _contrasted(spark, sf):
    return terms.contrast(texts(spark, sf), doc_targets(spark, sf))


@query("contrast_terms", f"{_WORDS_CONTRAST} SELECT {_CONTRAST_OUT} FROM f")
def contrast_terms(spark, sf):
    return _tidy(_contrasted(spark, sf))


@query(
    "contrast_bigrams",
    f"{_contrast_sql(_PAIR_COUNTS, 150, 3)} SELECT {_CONTRAST_OUT} FROM f",
)
def contrast_bigrams(spark, sf):
    return _tidy(
        terms.contrast(texts(spark, sf), doc_targets(spark, sf), pairs=True, top_n=150, min_total=3)
    )


@query(
    "contrast_extremes",
    f"""{_WORDS_CONTRAST} (SELECT 'high' AS side, {_CONTRAST_OUT} FROM f
        ORDER BY ratio DESC, word LIMIT 20)
    UNION ALL (SELECT 'low' AS side, {_CONTRAST_OUT} FROM f ORDER BY ratio, word LIMIT 20)""",
)
def contrast_extremes(spark, sf):
    return _tidy(terms.extremes(_contrasted(spark, sf)))


@query(
    "cohort_top_terms",
    f"""{_WORDS_CONTRAST} (SELECT 'high' AS side, word, high_count AS count FROM f
        WHERE high_count > 0 ORDER BY high_count DESC, word LIMIT 80)
    UNION ALL (SELECT 'low' AS side, word, low_count AS count FROM f
        WHERE low_count > 0 ORDER BY low_count DESC, word LIMIT 80)""",
)
def cohort_top_terms(spark, sf):
    return terms.cohort_terms(_contrasted(spark, sf))


@query(
    "item_text_profile",
    f"""{_COUNTS.replace(WORDS_SQL, words_sql(PROFILE_STOP_WORDS))}
    SELECT mbid, CAST(len(w) AS INT) AS word_count, top_words FROM w JOIN (
        SELECT mbid, string_agg(word, ' ' ORDER BY r) AS top_words FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY mbid ORDER BY n DESC, p) AS r FROM c)
        WHERE r <= 15 GROUP BY mbid) USING (mbid) WHERE mbid = 11""",
)
def item_text_profile(spark, sf):
    out = terms.item_profile(texts(spark, sf), 11, lexicon(spark, sf))
    return out.select("mbid", "word_count", F.array_join("top_words", " ").alias("top_words"))


@query(
    "doc_term_counts",
    f"""{_COUNTS}, v AS (SELECT word FROM c GROUP BY word
        HAVING COUNT(*) >= 3 AND COUNT(*) <= 0.8 * (SELECT COUNT(*) FROM documents)
        ORDER BY SUM(n) DESC, word LIMIT 3000)
    SELECT mbid, word, n FROM c SEMI JOIN v USING (word)""",
)
def doc_term_counts(spark, sf):
    return terms.doc_term_counts(texts(spark, sf))


@query("lda_topics")
def lda_topics(spark, sf):
    weights, _ = terms.fit_topics(texts(spark, sf), topics=8)
    return weights


_SHARES = f"""{_W}, h AS (SELECT mbid, GREATEST(len(w), 1) AS k,
        len(list_filter(w, lambda x: length(x) <= 4)) AS a,
        len(list_filter(w, lambda x: length(x) BETWEEN 5 AND 7)) AS b,
        len(list_filter(w, lambda x: length(x) >= 8)) AS c FROM w),
    t AS (SELECT mbid, a / k AS topic_0, b / k AS topic_1, c / k AS topic_2,
        CASE WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 1 ELSE 2 END AS dominant FROM h),
    y AS (SELECT doc_id AS mbid, LN(1 + CAST(n_chars AS DOUBLE)) AS y FROM documents),
    j AS (SELECT * FROM t JOIN y USING (mbid)),
    q AS (SELECT quantile_cont(y, [0.25, 0.75]) AS q FROM j)"""


@query(
    "topic_contrast",
    f"{_SHARES} "
    + " UNION ALL ".join(
        f"""SELECT {i} AS topic, COUNT(*) FILTER (dominant = {i}) AS n_texts,
        ROUND(COALESCE(AVG(y) FILTER (dominant = {i}), 0.0), 6) AS mean_target,
        ROUND(AVG(topic_{i}) FILTER (y >= q[2]) - AVG(topic_{i}) FILTER (y <= q[1]), 6) AS weight_gap
        FROM j, q"""
        for i in range(3)
    ),
)
def topic_contrast(spark, sf):
    w = F.col("words")
    size = F.greatest(F.size(w), F.lit(1))
    shares = [
        F.size(F.filter(w, keep)) / size
        for keep in (
            lambda x: F.length(x) <= 4,
            lambda x: F.length(x).between(5, 7),
            lambda x: F.length(x) >= 8,
        )
    ]
    rows = _tokens(spark, sf).select(
        "mbid", *[s.alias(f"topic_{i}") for i, s in enumerate(shares)]
    )
    each = F.array("topic_0", "topic_1", "topic_2")
    weights = rows.withColumn(
        "dominant_topic", F.array_position(each, F.array_max(each)).cast("int") - 1
    )
    weights = stage_table(weights, "weights")
    out = terms.topic_contrast(weights, doc_targets(spark, sf), 3)
    return out.select(
        "topic", "n_texts", F.round("mean_target", 6).alias("mean_target"),
        F.round("weight_gap", 6).alias("weight_gap"),
    )
