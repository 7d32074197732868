"""The model and text studies run as a whole, and their reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.catalog.base import lexicon, query, state_of, table, tracks
from encore.catalog.learning import _fits, _frame, _imbalance, _linear, _results
from encore.learning import models, splits
from encore.operators import order, terms
from encore.plans import report, texts
from encore.session import stage_table

# The eleven text features of the comparison, and the encoded item columns (fixed values).
TEXT_FEATURES = (
    "sentiment_compound", "sentiment_positive", "sentiment_negative", "type_token_ratio",
    "repetitiveness", "word_count", "avg_line_length", "avg_word_length", "rare_word_ratio",
    "flesch_reading_ease", "flesch_kincaid_grade",
)
CODED = ("genre", "release_type", "artist_type", "artist_country")
ITEM_NUMBERS = (
    "duration_sec", "release_year", "release_decade", "track_age", "genre_match_count",
    "has_audio_features", "tempo", "danceability", "loudness", "dynamic_complexity",
)

_STUDIES: dict[tuple, texts.TextStudy] = {}


def text_corpus(spark, sf):
    """Corpus rows with documents as their texts: each item's document under its artist and
    title, with other letter case for one in three."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("seq"), "p_brand", "p_name")
    shout = F.col("seq") % 3 == 0
    return part.join(table(spark, sf, "documents"), F.col("seq") == F.col("doc_id")).select(
        "seq",
        F.when(shout, F.upper("p_brand")).otherwise(F.col("p_brand")).alias("artist"),
        F.when(shout, F.upper("p_name")).otherwise(F.col("p_name")).alias("title"),
        F.col("text").alias("lyrics"),
    )


def _text_study(spark, sf):
    """The study, once for an application and a state of the input files."""
    names = ("part", "documents", "labels", "conversations", "lineitem", "orders")
    at = (spark.sparkContext.applicationId, *state_of(spark, sf, *names))
    if at not in _STUDIES:
        freq = terms.word_shares(table(spark, sf, "conversations"))
        _STUDIES[at] = texts.study(text_corpus(spark, sf), tracks(spark, sf), lexicon(spark, sf), freq)
    return _STUDIES[at]


@query("feature_set_ablation")
def feature_set_ablation(spark, sf):
    study = _text_study(spark, sf)
    topics = study.topic_weights.drop("dominant_topic")
    items = order.with_codes(tracks(spark, sf), CODED, filler="Unknown")
    rows = texts.three_way(study.features, topics, items)
    text = [*TEXT_FEATURES, *[c for c in topics.columns if c != "mbid"]]
    item = [*ITEM_NUMBERS, *[f"{c}_enc" for c in CODED]]
    rows = rows.select("mbid", "log_repeat_listens", *[F.col(c).cast("double").alias(c) for c in text + item])
    rows = stage_table(splits.with_holdout(rows, "mbid"), "text-frame")
    filled = {r[0] for r in _observed(rows, text + item).collect()}
    text, item = [c for c in text if c in filled], [c for c in item if c in filled]
    return models.feature_set_ablation(
        rows, {"Lyrics Only": text, "Metadata Only": item, "Lyrics + Metadata": text + item}
    )


def _observed(rows, columns):
    """Names of the columns with any value."""
    counts = rows.agg(*[F.count(c).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column", "n").where("n > 0").select("column")


@query("text_report")
def text_report(spark, sf):
    study = _text_study(spark, sf)
    return report.text_report(study.merged, study.words, study.pairs, study.topic_words)


@query("model_report")
def model_report(spark, sf):
    frame, *columns = _frame(spark, sf)
    importance = models.importance_table(_fits(spark, sf), frame, *columns)
    pca = models.pca_summary(_linear(spark, sf)[1]["PCA + Ridge"])
    return report.model_report(_results(spark, sf), importance, _imbalance(spark, sf), pca)
