"""Sentiment with the words around a word: negation, boosters, capitals, `but`, signs at the end.

A text's words meet the lexicon once, in one join; the rules then run inside the row, as
transforms over its list of words.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.operators.terms import raw_words
from encore.session import stage_table

# Fixed values of the published rules.
NEGATIONS = (
    "aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt neither "
    "neednt never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent without wont "
    "wouldnt rarely seldom despite"
).split()
STRONGER = (
    "absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely "
    "especially exceptionally extremely fabulously flipping flippin fricking frickin frigging friggin fully "
    "fucking greatly hella highly hugely incredibly intensely majorly more most particularly purely quite "
    "really remarkably so substantially thoroughly totally tremendously uber unbelievably unusually utterly "
    "very"
).split()
WEAKER = (
    "almost barely hardly kinda kindof less little marginally occasionally partly scarcely slightly somewhat "
    "sorta sortof"
).split()
BOOST, CAPITALS, NEGATE, LEAST = 0.293, 0.733, -0.74, -0.74
#: Words that the rules look for among those before a word.
NAMED = ("never", "so", "this", "least", "at", "very")
#: How much a booster one, two and three words before a word counts.
NEAR = (1.0, 0.95, 0.9)
#: What `never so` and `never this` make of a word that follows at once, or one word later.
NEVER_SO = (1.5, 1.25)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, EXCLAMATIONS = 0.292, 4
QUESTION, QUESTIONS, MANY_QUESTIONS = 0.18, 3, 0.96


def _boost(word: Column, stronger: Iterable[str], weaker: Iterable[str]) -> Column:
    """What a word adds to the strength of those after it: null if it is no booster."""
    return F.when(word.isin(*stronger), BOOST).when(word.isin(*weaker), -BOOST)


def _signed(value: Column) -> Column:
    return F.when(value < 0, -1.0).otherwise(1.0)


def _weighed(words: Column, mixed: Column) -> Column:
    """The valence of each word as its three predecessors leave it; 0 for words without one.

    ``words`` lists structs of word (if a rule names it), valence, caps, boost, negates and acts: whether
    the word may change those after it.
    """

    def step(i: Column):
        def run(value: Column, near: Column) -> Column:
            back = near["back"]
            before = F.get(words, i - back)
            boost = before["boost"] + F.when(before["caps"] & mixed, CAPITALS).otherwise(0.0)
            value_ = value + F.coalesce(boost, F.lit(0.0)) * _signed(value) * near["weight"]
            so = F.exists(
                F.array(F.when(back > 1, F.get(words, i - 1)["word"]), F.when(back > 2, F.get(words, i - 2)["word"])),
                lambda w: F.coalesce(w.isin("so", "this"), F.lit(False)),
            )
            turned = (
                F.when((before["word"] == "never") & so, value_ * F.when(back == 2, NEVER_SO[0]).otherwise(NEVER_SO[1]))
                .when(before["negates"], value_ * NEGATE)
                .otherwise(value_)
            )
            # Words with a valence of their own, and those before the first, change nothing.
            return F.when((i >= back) & before["valence"].isNull(), turned).otherwise(value)

        return run

    near = F.array(*[F.struct(F.lit(k + 1).alias("back"), F.lit(w).alias("weight")) for k, w in enumerate(NEAR)])

    def score(x: Column, i: Column) -> Column:
        start = x["valence"] + F.when(x["caps"] & mixed, CAPITALS).otherwise(0.0) * _signed(x["valence"])
        # Few words have one before them that acts: the others are spared the steps.
        acts = reduce(Column.__or__, [F.coalesce(F.get(words, i - k)["acts"], F.lit(False)) for k in range(1, len(NEAR) + 1)])
        value = F.when(acts, F.aggregate(near, start, step(i))).otherwise(start)
        last, second = F.get(words, i - 1), F.get(words, i - 2)
        least = (
            (i >= 1) & (last["word"] == "least") & last["valence"].isNull()
            & ~F.coalesce((i >= 2) & second["word"].isin("at", "very"), F.lit(False))
        )
        return F.when(x["valence"].isNull() | x["boost"].isNotNull(), 0.0).otherwise(
            value * F.when(least, LEAST).otherwise(1.0)
        )

    return F.transform(words, score)


def _marks(text: Column) -> Column:
    """What exclamation and question marks add to the strength of a text."""
    calls = F.least(F.regexp_count(text, F.lit("!")), F.lit(EXCLAMATIONS))
    asks = F.regexp_count(text, F.lit(r"\?"))
    return calls * EXCLAMATION + F.when(asks > QUESTIONS, MANY_QUESTIONS).when(asks > 1, asks * QUESTION).otherwise(0.0)


def sentiment_in_context(
    texts: DataFrame,
    lexicon: DataFrame,
    key: str = "mbid",
    text: str = "text",
    stronger: Iterable[str] = STRONGER,
    weaker: Iterable[str] = WEAKER,
    negations: Iterable[str] = NEGATIONS,
) -> DataFrame:
    """The four scores of ``terms.sentiment`` by the published rules for words in context.

    Words are read from the last to the third before a word with a valence, those with a valence of
    their own left out. A booster moves it by 0.293 (95 and 90 % of that from further away), more
    in capitals; a negation turns it by -0.74; `never so` strengthens it. Capitals count where not
    all words have them. Words before the first `but` count half, those after it one and a half
    times. Marks strengthen the sum and the stronger side's share. Idioms and phrases of several
    words are not known. A null or empty text scores 0 throughout. One row a key.
    """
    bare = F.regexp_replace(F.col(text), r"(?U)[^\w\s']", "")
    # Marks are counted below the explode: above it, the whole text would be read for each word.
    split = texts.select(
        key, F.coalesce(_marks(F.col(text)), F.lit(0.0)).alias("marks"), raw_words(bare).alias("words")
    )
    raw = F.col("raw")
    # The outer form, as in ``terms.word_counts``.
    found = split.select(key, "marks", F.posexplode_outer("words").alias("at", "raw")).select(
        key, "marks", "at",
        F.lower(raw).alias("word"),
        ((F.upper(raw) == raw) & (F.lower(raw) != raw)).alias("caps"),
    )
    known = stage_table(lexicon.select("word", F.col("valence").cast("double").alias("valence")), "lexicon")
    word = F.col("word")
    boost = _boost(word, stronger, weaker)
    negates = word.isin(*negations) | word.contains("n't")
    item = F.struct(
        "at", F.when(word.isin(*NAMED), word).alias("word"), "valence", "caps", boost.alias("boost"), negates.alias("negates"),
        (F.col("valence").isNull() & (boost.isNotNull() | negates | (word == "never"))).alias("acts"),
    )
    rows = (
        found.join(known, "word", "left")
        .groupBy(key)
        .agg(
            F.max("marks").alias("marks"),
            F.min(F.when(word == "but", F.col("at") + 1)).alias("but"),
            F.coalesce(F.bool_or("caps") & ~F.bool_and("caps"), F.lit(False)).alias("mixed"),
            F.sort_array(F.collect_list(F.when(word.isNotNull(), item))).alias("words"),
        )
    )
    # Bound as a variable: a column might be put in where it is used, and so sorted once a word.
    bound = F.array(F.struct("words", "mixed"))
    values = F.transform(bound, lambda r: _weighed(r["words"], r["mixed"]))[0]
    rows = rows.select(key, "marks", F.coalesce("but", F.lit(0)).alias("but"), values.alias("values"))
    but = F.col("but")
    values = F.transform(
        "values",
        lambda v, i: v * F.when((but == 0) | (i + 1 == but), 1.0).when(i + 1 < but, BEFORE_BUT).otherwise(AFTER_BUT),
    )
    rows = rows.select(key, "marks", values.alias("values"))

    def total(of) -> Column:
        return F.aggregate("values", F.lit(0.0), lambda acc, v: acc + of(v))

    rows = rows.select(
        key, "marks",
        total(lambda v: v).alias("s"),
        total(lambda v: F.when(v > 0, v + 1).otherwise(0.0)).alias("p"),
        total(lambda v: F.when(v < 0, 1 - v).otherwise(0.0)).alias("m"),
        total(lambda v: F.when(v == 0, 1.0).otherwise(0.0)).alias("z"),
    )
    s, p, m, marks = F.col("s"), F.col("p"), F.col("m"), F.col("marks")
    rows = rows.select(
        key, "z",
        (s + F.signum(s) * marks).alias("s"),
        (p + F.when(p > m, marks).otherwise(0.0)).alias("p"),
        (m + F.when(p < m, marks).otherwise(0.0)).alias("m"),
    )
    mass = F.nullif(p + m + F.col("z"), F.lit(0.0))

    def share(c: str) -> Column:
        return F.round(F.coalesce(F.col(c) / mass, F.lit(0.0)), 4)

    return rows.select(
        key,
        F.round(s / F.sqrt(s * s + 15), 4).alias("sentiment_compound"),
        share("p").alias("sentiment_positive"),
        share("m").alias("sentiment_negative"),
        share("z").alias("sentiment_neutral"),
    )
