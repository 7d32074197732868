"""Linking corpus rows to items by artist and title.

Exact links are an equi-join on normalised keys. Fuzzy links (same artist give or take a leading
"the", word-order-free title similarity at or above a cut) use a lossless key instead of comparing
every title of an artist: titles that reach the cut have a segment in common, so candidates meet on
(artist, length, edits, segment and its place). That key also splits a very large artist over many
tasks. Repeated (artist, title) keys on either side are reduced first, map-side.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.config import FUZZY_CUT, TARGET
from encore.functions import clean_text, flip_the, match_key, sorted_words
from encore.operators.order import keep_first
from encore.session import stage_table

# Ship this module's helpers with the task instead of expecting the package on every executor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine-wide bit row at a time."""
    if not a or not b:
        return 0
    full = (1 << len(a)) - 1
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(T.DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(
        [
            200.0 * common_subsequence(x, y) / (len(x) + len(y)) if x or y else 100.0
            for x, y in zip(a, b)
        ],
        dtype="float64",
    )


# Declared non-deterministic so that a filter on the score reuses it instead of scoring twice.
_similarity = _similarity.asNondeterministic()


def within_reach(a: Column, b: Column, cut: int = FUZZY_CUT) -> Column:
    """Cheap native test that never rejects a pair reaching the cut: first lengths, then edit
    distance (an insert/delete distance is at least the edit distance)."""
    total = F.length(a) + F.length(b)
    slack = F.floor(total * (100 - cut) / F.lit(100)).cast("int")
    short = F.least(F.length(a), F.length(b))
    # With a bound the distance is computed in a band and is -1 beyond it.
    bounded = F.call_function("levenshtein", a, b, slack)
    return (200 * short >= cut * total) & (bounded >= 0)


def title_similarity(a: Column, b: Column) -> Column:
    """Word-order-free similarity 0-100 of two normalised titles."""
    return _similarity(sorted_words(a), sorted_words(b))


# Two titles of lengths n and l that reach the cut are at most `_budget` single-letter insertions
# and deletions apart, so a title in one more segments than that keeps a segment whole. Take the
# first segment up to which there are no more edits than segments before it: it is whole, and there
# are exactly as many edits before it as segments, which leaves few places for it in the other title.


def _budget(n: str, l: str, cut: int) -> str:
    most = f"(({n} + {l}) * {100 - cut} div 100)"
    return f"cast({most} - abs({most} - ({n} - {l})) % 2 as int)"  # of the parity of n - l


def _lengths(l: str, cut: int) -> str:
    """Lengths of the titles that can reach the cut with one of length ``l``."""
    least = f"({l} * {cut} + {200 - cut - 1}) div {200 - cut}"
    return f"sequence(cast({least} as int), cast({l} * {200 - cut} div {cut} as int))"


def _segment(title: str, n: str, shift: str = "0") -> dict[str, str]:
    start, end = f"(_i * {n} div (_d + 1))", f"((_i + 1) * {n} div (_d + 1))"
    part = f"substring({title}, cast({start} + {shift} + 1 as int), cast({end} - {start} as int))"
    return {"start": start, "end": end, "key": f"xxhash64({n}, _d, _i, {part})"}


def index_segments(df: DataFrame, title: str, cut: int = FUZZY_CUT) -> DataFrame:
    """One row for each segment of ``title``, under each number of edits a partner may need."""
    budgets = f"array_distinct(transform({_lengths('_n', cut)}, x -> {_budget('_n', 'x', cut)}))"
    return (
        df.withColumn("_n", F.length(title))
        .withColumn("_d", F.explode(F.expr(budgets)))
        .withColumn("_i", F.explode(F.expr("sequence(0, _d)")))
        .withColumn("segment", F.expr(_segment(title, "_n")["key"]))
        .drop("_n", "_d", "_i")
    )


def probe_segments(df: DataFrame, title: str, cut: int = FUZZY_CUT) -> DataFrame:
    """One row for each place in ``title`` where a whole segment of a partner may stand."""
    at = _segment(title, "_n", "_shift")
    return (
        df.withColumn("_l", F.length(title))
        .withColumn("_n", F.explode(F.expr(_lengths("_l", cut))))
        .withColumn("_d", F.expr(_budget("_n", "_l", cut)))
        .withColumn("_i", F.explode(F.expr("sequence(0, _d)")))
        .withColumn("_shift", F.explode(F.expr("sequence(-_i, _i, 2)")))
        # What is left of the edits must make up the rest of the difference in length.
        .where("abs(_l - _n - _shift) <= _d - _i")
        .where(f"{at['start']} + _shift >= 0 AND {at['end']} + _shift <= _l")
        .withColumn("segment", F.expr(at["key"]))
        .drop("_l", "_n", "_d", "_i", "_shift")
    )


def target_keys(
    items: DataFrame,
    key: str = "mbid",
    artist: str = "artist_name",
    title: str = "title",
    target: str = TARGET,
) -> DataFrame:
    """Items with all names present, as ``(id, a, t, target)`` on normalised keys."""
    return items.na.drop(subset=[key, title, artist]).select(
        F.col(key).alias("id"),
        match_key(F.col(artist)).alias("a"),
        match_key(F.col(title)).alias("t"),
        F.col(target).alias("target"),
    )


def corpus_keys(
    corpus: DataFrame, seq: str = "seq", artist: str = "artist", title: str = "title",
    text: str = "lyrics",
) -> DataFrame:
    """Corpus rows with no null among the three columns, as ``(seq, a, t)``."""
    return corpus.na.drop(subset=[title, artist, text]).select(
        F.col(seq).alias("seq"),
        match_key(F.col(artist)).alias("a"),
        match_key(F.col(title)).alias("t"),
    )


def exact_index(targets: DataFrame) -> DataFrame:
    """One id per (a, t): the lowest target wins, nulls lowest of all, then the smallest id."""
    return keep_first(
        targets, ["a", "t"], [F.col("target").isNotNull(), F.col("target"), F.col("id")], ["id"]
    )


def _ranked(target: Column) -> Column:
    """Missing targets rank below every number."""
    return F.coalesce(target.cast("double"), F.lit(float("-inf")))


def link_exact(keys: DataFrame, targets: DataFrame) -> DataFrame:
    """``(seq, id)`` for corpus rows whose keys equal an item's."""
    return keys.join(exact_index(targets), ["a", "t"]).select("seq", "id")


def fuzzy_index(targets: DataFrame) -> DataFrame:
    """``(block, s, best)``: titles under both forms of their artist's name."""
    by_artist = targets.select(
        F.explode_outer(F.array_distinct(F.array("a", flip_the(F.col("a"))))).alias("block"),
        sorted_words(F.col("t")).alias("s"),
        "id",
        "target",
    )
    # Equal titles under one block differ only in the tie rule: keep the preferred one.
    return by_artist.groupBy("block", "s").agg(
        F.min_by(
            F.struct("id", "target"), F.struct(-_ranked(F.col("target")), F.col("id"))
        ).alias("best")
    )


def candidates(probes: DataFrame, indexed: DataFrame, cut: int = FUZZY_CUT) -> DataFrame:
    """Pairs of ``probes`` (block, u, ...) and ``indexed`` (block, s, ...) that share a segment;
    a pair comes once for each shared one."""
    return probe_segments(probes, "u", cut).join(
        index_segments(indexed, "s", cut), ["block", "segment"]
    )


def link_fuzzy(pairs: DataFrame, targets: DataFrame, cut: int = FUZZY_CUT) -> DataFrame:
    """``(a, t, id, score)``: the best item for each distinct key pair, if it reaches the cut.

    Ties go to the higher target, then the smaller id.
    """
    indexed = fuzzy_index(targets)
    blocks = stage_table(indexed.select(F.col("block").alias("_b")).distinct(), "blocks")
    named = (
        pairs.select("a", "t")
        .distinct()
        .join(blocks, F.col("a") == F.col("_b"), "left")
        .select(
            "a",
            "t",
            F.coalesce("_b", flip_the(F.col("a"))).alias("block"),
            sorted_words(F.col("t")).alias("u"),
        )
    )
    probes = named.join(blocks, F.col("block") == F.col("_b"), "left_semi")
    met = candidates(probes, indexed, cut)
    # A pair that shares several segments is scored once.
    scored = (
        met.where(within_reach(F.col("u"), F.col("s"), cut))
        .groupBy("a", "t", "u", "s")
        .agg(F.any_value("best").alias("best"))
        .select("a", "t", "best", _similarity("u", "s").alias("score"))
        .where(F.col("score") >= cut)
    )
    rank = F.struct(-F.col("score"), -_ranked(F.col("best.target")), F.col("best.id"))
    return (
        scored.groupBy("a", "t")
        .agg(F.min_by(F.struct("best", "score"), rank).alias("m"))
        .select("a", "t", F.col("m.best.id").alias("id"), F.col("m.score").alias("score"))
    )


def link_texts(
    corpus: DataFrame,
    items: DataFrame,
    cut: int | None = FUZZY_CUT,
    key: str = "mbid",
    seq: str = "seq",
    artist: str = "artist",
    title: str = "title",
    text: str = "lyrics",
    item_artist: str = "artist_name",
    item_title: str = "title",
    target: str = TARGET,
) -> DataFrame:
    """``(mbid, seq, text)``: one cleaned text per linked item.

    The earliest corpus row that reaches an item wins, whether exactly or fuzzily. Only keys and
    ordinals travel until the winners are known; texts are read once, for those rows.
    ``cut=None`` links exactly only.
    """
    targets = target_keys(items, key, item_artist, item_title, target)
    return link_targets(corpus, targets, cut, key, seq, artist, title, text)


def link_targets(
    corpus: DataFrame,
    targets: DataFrame,
    cut: int | None = FUZZY_CUT,
    key: str = "mbid",
    seq: str = "seq",
    artist: str = "artist",
    title: str = "title",
    text: str = "lyrics",
) -> DataFrame:
    """``link_texts`` to items that are normalised already."""
    distinct = corpus_keys(corpus, seq, artist, title, text).groupBy("a", "t").agg(
        F.min("seq").alias("seq")
    )
    keys = stage_table(distinct, "corpus-keys")
    index = exact_index(targets)
    hits = keys.join(index, ["a", "t"]).select("seq", "id")
    if cut is not None:
        missed = stage_table(keys.join(index, ["a", "t"], "left_anti"), "missed-keys")
        near = link_fuzzy(missed, targets, cut)
        hits = hits.unionByName(missed.join(near, ["a", "t"]).select("seq", "id"))
    winners = hits.groupBy("id").agg(F.min("seq").alias("_seq"))
    return winners.join(
        corpus.select(F.col(seq).alias("_s"), F.col(text).alias("_text")),
        F.col("_seq") == F.col("_s"),
    ).select(F.col("id").alias(key), F.col("_seq").alias("seq"), clean_text("_text").alias("text"))


def link_coverage(links: DataFrame, items: DataFrame, key: str = "mbid") -> DataFrame:
    """How many linkable key pairs found a text."""
    targets = target_keys(items, key)
    linkable = targets.select("a", "t").distinct().agg(F.count("*").alias("x")).scalar()
    return links.agg(F.count_distinct(key).alias("matched")).select(
        "matched",
        linkable.alias("linkable"),
        F.try_divide(F.lit(100.0) * F.col("matched"), linkable).alias("pct"),
    )
