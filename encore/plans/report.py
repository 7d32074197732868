"""Report rows ``(section, ord, key, value)``; rendering them is up to the reader."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from encore.config import RAW_TARGET, TARGET
from encore.operators.rollups import median_by_category
from encore.operators.stats import kruskal_wallis, spearman, target_correlations
from encore.operators.terms import list_leaders


def section(df: DataFrame, name: str, order: str, key: str, value: str) -> DataFrame:
    return df.select(
        F.lit(name).alias("section"),
        F.col(order).cast("int").alias("ord"),
        F.col(key).cast("string").alias("key"),
        F.col(value).cast("string").alias("value"),
    )


def dataset_context(df: DataFrame, flag: str = "has_audio_features") -> DataFrame:
    """Rows, columns, target and coverage of the analysed table."""
    one = df.agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.col(flag).cast("bigint")), F.lit(0)).alias("a")
    )
    share = F.lit(100.0) * F.col("a") / F.greatest("rows", F.lit(1))
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("ord"), F.lit(k).alias("key"), v.cast("string").alias("value"))
            for i, (k, v) in enumerate(
                [
                    ("rows", F.col("rows")),
                    ("columns", F.lit(len(df.columns))),
                    ("target", F.lit(f"{TARGET} from {RAW_TARGET}")),
                    ("rows_with_audio", F.col("a")),
                    ("audio_pct", F.format_string("%.1f", share)),
                ]
            )
        ]
    )
    return one.select(F.lit("dataset").alias("section"), F.inline(entries))


def ranked(df: DataFrame, name: str, order: Sequence[Column], key: str, value: str) -> DataFrame:
    """A short ordered list (top words, features, models) as rows numbered from 1."""
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order))
    return section(df.withColumn("_ord", place), name, "_ord", key, value)


def facts(df: DataFrame, name: str) -> DataFrame:
    """Every column of a one-row result as ``key = value`` rows."""
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("ord"), F.lit(c).alias("key"), F.col(c).cast("string").alias("value")
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return df.select(F.lit(name).alias("section"), F.inline(entries))


def eda_report(df: DataFrame, category: str = "genre") -> DataFrame:
    """Dataset context, category medians and both rank tests."""
    medians = median_by_category(df, category)
    return union(
        dataset_context(df),
        ranked(
            medians,
            "median repeats",
            [F.desc_nulls_last("median_repeats"), F.asc_nulls_last(category)],
            category,
            "median_repeats",
        ),
        facts(kruskal_wallis(df, category), "kruskal-wallis"),
        facts(spearman(df), "spearman"),
    )


def model_report(
    results: DataFrame, importance: DataFrame, imbalance: DataFrame, pca: DataFrame
) -> DataFrame:
    """Scores of the best model, its ten strongest features, PCA size and the imbalance demo."""
    best = results.orderBy(F.desc_nulls_last("test_r2"), "model").limit(1)
    # One row: the best model's name.
    named = importance.join(F.broadcast(best.select("model")), "model")
    top = named.orderBy(F.desc("importance"), "feature").limit(10)
    kept = pca.agg(F.count("*").alias("components"), F.max("cumulative").alias("explained"))
    return union(
        facts(best.select("model", "test_r2", "test_rmse", "test_mae"), "best model"),
        ranked(top, "top features", [F.desc("importance"), F.col("feature")], "feature", "importance"),
        facts(kept, "pca"),
        ranked(imbalance, "imbalance f1", [F.col("model")], "model", "f1"),
        ranked(imbalance, "imbalance auc", [F.col("model")], "model", "roc_auc"),
    )


TEXT_MEANS = (
    "sentiment_compound", "repetitiveness", "type_token_ratio", "avg_word_length",
    "rare_word_ratio",
)
TEXT_CORRELATES = (
    "repetitiveness", "type_token_ratio", "sentiment_compound", "sentiment_positive",
    "sentiment_negative", "word_count", "avg_line_length", "avg_word_length", "rare_word_ratio",
)


def text_report(
    merged: DataFrame, words: DataFrame, pairs: DataFrame, topic_words: DataFrame
) -> DataFrame:
    """Feature means, correlations with the target, telling words and pairs, word lists, topics."""
    means = merged.agg(
        F.count("*").alias("texts"), *[F.round(F.avg(c), 3).alias(c) for c in TEXT_MEANS]
    )
    parts = [
        facts(means, "means"),
        ranked(target_correlations(merged, TEXT_CORRELATES), "correlations", [F.col("feature")], "feature", "r"),
    ]
    for name, terms in (("words", words), ("pairs", pairs)):
        for side, order in (("high", F.desc("freq_ratio")), ("low", F.asc("freq_ratio"))):
            best = terms.orderBy(order, "word").limit(10)
            parts.append(ranked(best, f"{side} {name}", [order, F.col("word")], "word", "freq_ratio"))
    for column in ("longest_words", "rarest_words"):
        leaders = list_leaders(merged, column)
        parts.append(ranked(leaders, column, [F.desc("n"), F.col("word")], "word", "n"))
    topics = topic_words.where(F.col("position") < 10).groupBy("topic").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("position", "word")))["word"], ", ").alias("w")
    )
    return union(*parts, section(topics, "topics", "topic", "topic", "w"))


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
