"""Text features and term statistics over a table of ``(mbid, text)``.

Whatever needs only the text itself stays inside the row; whatever counts words across or within
texts explodes once and aggregates, so Spark combines a text's words before any shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.config import CORPUS_STOP_WORDS, PROFILE_STOP_WORDS, RARE_WORD_SHARE, TARGET
from encore.functions import adjacent_pairs, non_blank_lines, strip_whitespace, word_list
from encore.operators.order import group_quantiles, top_per_group
from encore.session import file_bytes, small_parts, stage_table

_RAW_SPLIT = r"(?U)[\s\x1c-\x1f]+"


def raw_words(text: Column) -> Column:
    return F.filter(F.split(text, _RAW_SPLIT), lambda w: w != "")


def tokens(
    texts: DataFrame, key: str = "mbid", text: str = "text", stop_words=CORPUS_STOP_WORDS
) -> DataFrame:
    """``(mbid, words)``."""
    return texts.select(key, word_list(F.col(text), stop_words).alias("words"))


def word_counts(tokenised: DataFrame, key: str = "mbid", pairs: bool = False) -> DataFrame:
    """``(mbid, word, n, first_pos)`` per distinct word (or adjacent pair) of each text.

    Word lists are dealt by text once, before they are exploded: the counts here and what is
    ranked per text afterwards share that exchange. Their number of partitions is given, so that
    none are joined by their size: a task's counts take many times the bytes of its lists. It follows
    the bytes of the files read, so that a task's counts don't grow with the input.
    """
    items = adjacent_pairs(F.col("words")) if pairs else F.col("words")
    parts = small_parts(tokenised.sparkSession, file_bytes(tokenised))
    # The outer form keeps the optimizer from testing the list, and so building it, twice.
    return (
        tokenised.select(key, "words").repartition(parts, key).select(key, F.posexplode_outer(items).alias("pos", "word"))
        .where(F.col("word").isNotNull())
        .groupBy(key, "word")
        .agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
    )


def lexical_features(words: Column) -> dict[str, Column]:
    total = F.size(words)
    unique = F.size(F.array_distinct(words))
    return {
        "word_count": total,
        "unique_word_count": unique,
        "type_token_ratio": F.round(unique / F.greatest(total, F.lit(1)), 4),
    }


def line_features(lines: Column) -> dict[str, Column]:
    """From a column of non-blank lines."""
    count = F.size(lines)
    keys = F.transform(lines, lambda x: F.lower(strip_whitespace(x)))
    repeats = count - F.size(F.array_distinct(keys))
    words = F.aggregate(lines, F.lit(0), lambda acc, x: acc + F.size(raw_words(x)))
    divisor = F.greatest(count, F.lit(1))
    return {
        "line_count": count,
        "avg_line_length": F.round(words / divisor, 2),
        "repetitiveness": F.round(repeats / divisor, 4),
    }


def longest_words(words: Column, n: int = 10) -> Column:
    """Longest distinct words, equal lengths in word order."""
    keyed = F.transform(F.array_distinct(words), lambda w: F.struct(-F.length(w), w.alias("w")))
    return F.transform(F.slice(F.sort_array(keyed), 1, n), lambda s: s["w"])


def word_length_features(words: Column) -> dict[str, Column]:
    letters = F.length(F.array_join(words, ""))
    return {
        "avg_word_length": F.round(letters / F.greatest(F.size(words), F.lit(1)), 3),
        "longest_words": longest_words(words),
    }


def text_shape(text: Column) -> Column:
    """Words, sentences and vowel groups of a text, as a struct."""
    return F.struct(
        F.size(raw_words(text)).alias("words"),
        F.size(F.filter(F.split(text, r"[.!?]+"), lambda s: s.rlike(r"\w"))).alias("sentences"),
        F.regexp_count(F.lower(text), F.lit("[aeiouy]+")).alias("syllables"),
    )


def readability(shape: Column) -> dict[str, Column]:
    """Reading ease and school grade from a ``text_shape`` column; null without words."""
    words = F.nullif(shape["words"], F.lit(0))
    per_sentence = words / F.greatest(shape["sentences"], F.lit(1))
    per_word = shape["syllables"] / words
    return {
        "flesch_reading_ease": 206.835 - 1.015 * per_sentence - 84.6 * per_word,
        "flesch_kincaid_grade": 0.39 * per_sentence + 11.8 * per_word - 15.59,
    }


def with_parts(
    texts: DataFrame, key: str = "mbid", text: str = "text", stop_words=CORPUS_STOP_WORDS
) -> DataFrame:
    """The text split once: ``words``, non-blank ``lines`` and its ``shape``. Features read these
    columns, so no split is repeated."""
    return texts.select(
        key,
        text,
        word_list(F.col(text), stop_words).alias("words"),
        non_blank_lines(F.col(text)).alias("lines"),
        text_shape(F.col(text)).alias("shape"),
    )


def sentiment(
    texts: DataFrame, lexicon: DataFrame, key: str = "mbid", text: str = "text"
) -> DataFrame:
    """Valence scores from a ``(word, valence)`` table.

    Compound is s / sqrt(s^2 + 15); the three shares weigh each scored word by its valence plus
    one and each unscored word by one.
    """
    bare = F.regexp_replace(F.lower(text), r"(?U)[^\w\s']", "")
    found = texts.select(key, F.explode_outer(raw_words(bare)).alias("word"))
    # Staged, so that Spark plans from the lexicon's measured size. Where it is small the words
    # stay in their task and combine to one row a text before the exchange.
    scored = stage_table(lexicon.select("word", "valence"), "lexicon")
    v = F.coalesce(F.col("valence"), F.lit(0.0))
    sums = (
        found.join(scored, "word", "left")
        .groupBy(key)
        .agg(
            F.sum(v).alias("s"),
            F.sum(F.when(v > 0, v + 1).otherwise(0.0)).alias("p"),
            F.sum(F.when(v < 0, 1 - v).otherwise(0.0)).alias("m"),
            F.count_if((v == 0) & F.col("word").isNotNull()).alias("z"),
        )
    )
    mass = F.nullif(F.col("p") + F.col("m") + F.col("z"), F.lit(0.0))

    def share(c: str) -> Column:
        return F.round(F.coalesce(F.col(c) / mass, F.lit(0.0)), 4)

    return sums.select(
        key,
        F.round(F.col("s") / F.sqrt(F.col("s") * F.col("s") + 15), 4).alias("sentiment_compound"),
        share("p").alias("sentiment_positive"),
        share("m").alias("sentiment_negative"),
        share("z").alias("sentiment_neutral"),
    )


def word_shares(texts: DataFrame, text: str = "text") -> DataFrame:
    """``(word, freq)``: a frequency table built from a reference corpus."""
    counts = (
        texts.select(F.explode_outer(word_list(F.col(text), ())).alias("word"))
        .where(F.col("word").isNotNull())
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    total = counts.agg(F.sum("n").alias("x")).scalar()
    return counts.select("word", (F.col("n") / total).alias("freq"))


def rarity(
    counts: DataFrame, freq: DataFrame, key: str = "mbid", below: float = RARE_WORD_SHARE, n: int = 10
) -> DataFrame:
    """Rare-word count and share of each text and its rarest words; unknown words count as 0.

    ``freq`` holds shares of one language, so at most 1 / ``below`` words are not rare: that
    bounded list is what gets broadcast. Only rare words then meet the full table.
    """
    total = freq.agg(F.sum("freq")).first()[0] or 0.0
    if total > 1.001:
        raise ValueError(f"the shares of one language can't add up to {total}")
    common = freq.where(F.col("freq") >= below).select("word", F.lit(True).alias("_common"))
    flagged = counts.join(F.broadcast(common), "word", "left")
    totals = flagged.groupBy(key).agg(
        F.sum("n").alias("_all"),
        F.sum(F.when(F.col("_common").isNull(), F.col("n")).otherwise(0)).alias("rare_word_count"),
    )
    rare = (
        flagged.where(F.col("_common").isNull())
        .join(freq.where(F.col("freq") < below), "word", "left")
        .select(key, "word", F.coalesce("freq", F.lit(0.0)).alias("_f"))
    )
    lists = (
        top_per_group(rare, [key], n, F.col("_f"), F.col("word"), out="_p")
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("_p", "word"))).alias("_l"))
        .select(key, F.col("_l.word").alias("rarest_words"))
    )
    return totals.join(lists, key, "left").select(
        key,
        "rare_word_count",
        F.round(F.col("rare_word_count") / F.greatest("_all", F.lit(1)), 4).alias(
            "rare_word_ratio"
        ),
        F.coalesce("rarest_words", F.array().cast("array<string>")).alias("rarest_words"),
    )


def top_words(counts: DataFrame, n: int, key: str = "mbid") -> DataFrame:
    """Most frequent words per text, ties by first occurrence."""
    return top_per_group(counts, [key], n, F.desc("n"), F.col("first_pos"))


def top_list(counts: DataFrame, n: int, out: str, key: str = "mbid") -> DataFrame:
    """The same as one array per text."""
    return (
        top_words(counts, n, key)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("_l"))
        .select(key, F.col("_l.word").alias(out))
    )


def text_features(
    texts: DataFrame, lexicon: DataFrame, freq: DataFrame, key: str = "mbid", text: str = "text",
    parts: DataFrame | None = None, score: Callable[..., DataFrame] = sentiment,
) -> DataFrame:
    """The full feature row per text. ``parts`` has the split texts if they are staged already;
    ``score`` is how sentiment is found, for instance ``valence.sentiment_in_context``."""
    words = F.col("words")
    if parts is None:
        parts = stage_table(with_parts(texts, key, text).drop(text), "text-parts")
    within = parts.select(
        key,
        *[
            c.alias(name)
            for name, c in {
                **lexical_features(words),
                **line_features(F.col("lines")),
                **word_length_features(words),
                **readability(F.col("shape")),
            }.items()
        ],
    )
    tokenised = parts.select(key, "words")
    pairs = top_list(word_counts(tokenised, key, pairs=True), 5, "top_bigrams", key)
    rare = rarity(word_counts(tokenised, key), freq, key)
    none = F.array().cast("array<string>")
    return (
        within.join(score(texts, lexicon, key, text), key, "left")
        .join(pairs, key, "left")
        .join(rare, key, "left")
        .withColumns(
            {
                "top_bigrams": F.coalesce("top_bigrams", none),
                "rarest_words": F.coalesce("rarest_words", none),
                "rare_word_count": F.coalesce("rare_word_count", F.lit(0)),
                "rare_word_ratio": F.coalesce("rare_word_ratio", F.lit(0.0)),
            }
        )
    )


def with_side(df: DataFrame, cuts: Column, target: str = TARGET) -> DataFrame:
    """``side``: high at or above the upper cut, else low at or below the lower, else null."""
    y = F.col(target)
    return df.withColumn(
        "side", F.when(y >= cuts[1], F.lit("high")).when(y <= cuts[0], F.lit("low"))
    )


def contrast(
    texts: DataFrame,
    targets: DataFrame,
    pairs: bool = False,
    top_n: int = 200,
    min_total: int = 5,
    key: str = "mbid",
    text: str = "text",
    target: str = TARGET,
    tokenised: DataFrame | None = None,
) -> DataFrame:
    """How word (or pair) use differs between texts of the top and bottom target quartile.
    ``tokenised`` has the texts' words if they are split already.

    Cuts come from every target, also those without a text. Candidates are each side's most
    frequent terms, ties by term.
    """
    cuts = group_quantiles(targets, target, [0.25, 0.75]).select("q").scalar()
    sided = (
        with_side(targets.select(key, target), cuts, target)
        .where(F.col("side").isNotNull())
        .select(key, "side")
    )
    words = F.col("words")
    terms = (
        (tokens(texts, key, text) if tokenised is None else tokenised.select(key, "words"))
        .join(sided, key)
        .select("side", F.explode_outer(adjacent_pairs(words) if pairs else words).alias("word"))
        .where(F.col("word").isNotNull())
    )
    counts = terms.groupBy("word").agg(
        F.count_if(F.col("side") == "high").alias("high_count"),
        F.count_if(F.col("side") == "low").alias("low_count"),
    )
    # Totals, both leader lists and the result read the counts: one pass over the corpus.
    counts = stage_table(counts, "term-counts")
    totals = (
        counts.agg(
            F.greatest(F.sum("high_count"), F.lit(1)).alias("h"),
            F.greatest(F.sum("low_count"), F.lit(1)).alias("l"),
        )
        .select(F.struct("h", "l"))
        .scalar()
    )

    def leaders(c: str) -> DataFrame:
        return counts.where(F.col(c) > 0).orderBy(F.desc(c), "word").limit(top_n).select("word")

    # At most 2 * top_n terms.
    chosen = leaders("high_count").unionByName(leaders("low_count")).distinct()
    high = F.col("high_count") / totals["h"]
    low = F.col("low_count") / totals["l"]
    return (
        counts.join(F.broadcast(chosen), "word", "left_semi")
        .select(
            "word",
            high.alias("high_freq"),
            low.alias("low_freq"),
            "high_count",
            "low_count",
            (high / (low + F.lit(1e-9))).alias("freq_ratio"),
            (F.col("high_count") + F.col("low_count")).alias("total_count"),
        )
        .where(F.col("total_count") >= min_total)
        .orderBy(F.desc("freq_ratio"), "word")
    )


def extremes(contrasted: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` terms with the largest and the smallest ratio, tagged by side."""
    top = contrasted.orderBy(F.desc("freq_ratio"), "word").limit(n)
    low = contrasted.orderBy(F.asc("freq_ratio"), "word").limit(n)
    return top.withColumn("side", F.lit("high")).unionByName(low.withColumn("side", F.lit("low")))


def cohort_terms(contrasted: DataFrame, n: int = 80) -> DataFrame:
    """Most counted terms of each side: ``(side, word, count)``."""
    sides = [
        contrasted.where(F.col(c) > 0)
        .orderBy(F.desc(c), "word")
        .limit(n)
        .select(F.lit(side).alias("side"), "word", F.col(c).alias("count"))
        for side, c in (("high", "high_count"), ("low", "low_count"))
    ]
    return sides[0].unionByName(sides[1])


def list_leaders(features: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Words appearing in most of the per-text lists."""
    return (
        features.select(F.explode(column).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(n)
    )


def vocabulary(
    counts: DataFrame, texts: int | Column, size: int = 3000, min_texts: int = 3,
    max_share: float = 0.8,
) -> DataFrame:
    """``(word, total, texts)``: the most used words that are neither too rare nor everywhere."""
    limit = (texts if isinstance(texts, Column) else F.lit(texts)) * F.lit(max_share)
    return (
        counts.groupBy("word")
        .agg(F.sum("n").alias("total"), F.count("*").alias("texts"))
        .where((F.col("texts") >= min_texts) & (F.col("texts") <= limit))
        .orderBy(F.desc("total"), "word")
        .limit(size)
    )


def doc_term_counts(
    texts: DataFrame, key: str = "mbid", text: str = "text", **limits
) -> DataFrame:
    """Sparse document-term table ``(mbid, word, n)`` over the vocabulary."""
    # The vocabulary and the result both read the counts: texts are split once.
    counts = stage_table(word_counts(tokens(texts, key, text), key).drop("first_pos"), "doc-terms")
    n = texts.agg(F.count("*").alias("x")).scalar()
    words = vocabulary(counts, n, **limits)
    # The vocabulary has at most `size` words.
    return counts.join(F.broadcast(words.select("word")), "word", "left_semi").select(
        key, "word", "n"
    )


def fit_topics(
    texts: DataFrame,
    topics: int = 8,
    vocab_size: int = 3000,
    min_texts: int = 3,
    max_share: float = 0.8,
    iterations: int = 25,
    words_per_topic: int = 15,
    key: str = "mbid",
    text: str = "text",
    seed: int = 42,
    tokenised: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Online LDA over the vocabulary of ``doc_term_counts``. Returns topic weights per text with the dominant topic, and the top words
    ``(topic, position, word, weight)``."""
    spark = texts.sparkSession
    bag = tokenised
    if bag is None:
        bag = stage_table(tokens(texts, key, text), "topic-words")
    n = bag.agg(F.count("*").alias("x")).scalar()
    chosen = vocabulary(word_counts(bag, key), n, vocab_size, min_texts, max_share)
    # At most vocab_size words. A model needs one at least.
    listed_words = [r.word for r in chosen.orderBy(F.desc("total"), "word").collect()] or [""]
    vectoriser = CountVectorizerModel.from_vocabulary(
        listed_words, inputCol="words", outputCol="features"
    )
    rows = stage_table(vectoriser.transform(bag).select(key, "features"), "topic-counts")
    model = LDA(k=topics, maxIter=iterations, optimizer="online", seed=seed).fit(rows)
    w = F.col("_w")
    weights = (
        model.transform(rows)
        .select(key, vector_to_array("topicDistribution").alias("_w"))
        .select(
            key,
            *[w[i].alias(f"topic_{i}") for i in range(topics)],
            (F.array_position(w, F.array_max(w)) - 1).cast("int").alias("dominant_topic"),
        )
    )
    vocab = spark.createDataFrame(
        list(enumerate(vectoriser.vocabulary)), "term int, word string"
    )
    listed = model.describeTopics(words_per_topic).select(
        "topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("position", "t")
    )
    words = listed.join(vocab, F.col("t.termIndices") == F.col("term")).select(
        "topic", "position", "word", F.col("t.termWeights").alias("weight")
    )
    return weights, words


def topic_contrast(
    weights: DataFrame, targets: DataFrame, topics: int, key: str = "mbid", target: str = TARGET
) -> DataFrame:
    """Per topic: texts it dominates, their mean target, and its mean weight in the top target
    quartile minus the bottom one. Cuts come from the matched texts."""
    matched = weights.join(targets.select(key, target), key).where(F.col(target).isNotNull())
    cuts = group_quantiles(matched, target, [0.25, 0.75]).select("q").scalar()
    y = F.col(target)
    # A text may sit in both quartiles when the cuts coincide, so the sides are two flags.
    flagged = matched.select(
        "*", (y >= cuts[1]).alias("_high"), (y <= cuts[0]).alias("_low")
    )
    one = flagged.agg(
        *[
            F.struct(
                F.lit(i).alias("topic"),
                F.count_if(F.col("dominant_topic") == i).alias("n_texts"),
                F.coalesce(F.avg(F.when(F.col("dominant_topic") == i, y)), F.lit(0.0)).alias(
                    "mean_target"
                ),
                (
                    F.avg(F.when(F.col("_high"), F.col(f"topic_{i}")))
                    - F.avg(F.when(F.col("_low"), F.col(f"topic_{i}")))
                ).alias("weight_gap"),
            ).alias(f"_{i}")
            for i in range(topics)
        ]
    )
    return one.select(F.inline(F.array(*[f"_{i}" for i in range(topics)]))).orderBy(
        "weight_gap", "topic"
    )


def item_profile(
    texts: DataFrame, item_key, lexicon: DataFrame, n: int = 15, key: str = "mbid",
    text: str = "text",
) -> DataFrame:
    """Features and most used words of a single text."""
    one = texts.where(F.col(key) == F.lit(item_key))
    tokenised = with_parts(one, key, text, PROFILE_STOP_WORDS)
    lists = (
        top_words(word_counts(tokenised, key), n, key)
        .groupBy(key)
        .agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("_l"))
        .select(key, F.col("_l.word").alias("top_words"), F.col("_l.n").alias("top_counts"))
    )
    cells = {
        **lexical_features(F.col("words")),
        **line_features(F.col("lines")),
        **readability(F.col("shape")),
    }
    return (
        tokenised.select(key, *[c.alias(k) for k, c in cells.items()])
        .join(sentiment(one, lexicon, key, text), key, "left")
        .join(lists, key, "left")
    )
