"""The text study: link, tokenise, contrast, topics, features against the target."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from encore.config import TARGET
from encore.operators.linking import link_texts
from encore.operators.order import keep_first
from encore.operators.terms import contrast, fit_topics, sentiment, text_features, with_parts
from encore.session import stage_table


@dataclass
class TextStudy:
    texts: DataFrame
    features: DataFrame
    merged: DataFrame
    words: DataFrame
    pairs: DataFrame
    topic_weights: DataFrame
    topic_words: DataFrame


def features_with_target(
    features: DataFrame, items: DataFrame, key: str = "mbid", target: str = TARGET,
    extra: tuple[str, ...] = ("genre",),
) -> DataFrame:
    """Features beside the target; repeated item rows count once (the lowest target)."""
    unique = keep_first(items.select(key, target, *extra), [key], [target, *extra])
    return features.join(unique, key, "left")


def three_way(
    features: DataFrame, topics: DataFrame, items: DataFrame, key: str = "mbid",
    target: str = TARGET,
) -> DataFrame:
    """Features, topic weights where present, and item columns; rows with a target. All three
    are keyed alike, so each side is exchanged once."""
    return features.join(topics, key, "left").join(items, key).na.drop(subset=[target])


def study(
    corpus: DataFrame, items: DataFrame, lexicon: DataFrame, freq: DataFrame, topics: int = 8,
    score: Callable[..., DataFrame] = sentiment,
) -> TextStudy:
    """Everything derived from linked texts; the linked texts are staged once. ``score`` is how
    sentiment is found."""
    texts = stage_table(link_texts(corpus, items), "linked-texts").select("mbid", "text")
    # Split once; features, topics and both contrasts read the staged words.
    parts = stage_table(with_parts(texts).drop("text"), "text-parts")
    tokenised = parts.select("mbid", "words")
    features = stage_table(text_features(texts, lexicon, freq, parts=parts, score=score), "text-features")
    weights, words = fit_topics(texts, topics, tokenised=tokenised)
    return TextStudy(
        texts,
        features,
        features_with_target(features, items),
        contrast(texts, items, tokenised=tokenised),
        contrast(texts, items, pairs=True, top_n=150, min_total=3, tokenised=tokenised),
        weights,
        words,
    )
