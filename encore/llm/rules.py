"""Quality rules: statistics of whole texts, judged by an isolation forest.

``statistics`` counts what the rules are about. ``fit_forest`` grows isolation trees on a bounded
sample of those rows: a row that random splits part from the others after few steps is an anomaly.
``score`` adds that to every row. ``threshold`` is set on all labelled rows, counted by score, so
that nearly all rows labelled good pass; ``judge`` adds the verdict.

Defined cases. A null text has no words, and so fails the base rule, like an empty one. Repeated
rows each get a row. Without labelled rows, or on an empty table, only the base rule decides.
Ties at the threshold are kept. Columns beside the id and the text are not read.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.base import Memo, bounded, map_batches, query, table, utf8
from encore.session import stage_table

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"

#: Sizes of the forest and of the sample it is fitted on: the bounds of what the driver holds.
TREES, TREE_ROWS, SAMPLE_ROWS = 100, 256, 8_192
#: Steps between 0 and 1 at which scores are compared with the threshold: labelled rows of any
#: number come down to so many counts.
STEPS = 10_000
#: Share of rows labelled good that the threshold lets pass at least.
PASS_SHARE = 0.98
#: What short texts' mean word length is drawn to, and with the weight of how many words.
USUAL, PRIOR = 5, 100

STATS = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint"
)

_WORD = Memo(xxhash.xxh64_intdigest)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BLANK_BYTES = b" \t\n\x0b\x0c\r"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in windows of so many words that occur twice or more."""
    n = len(words)
    if n <= window:
        return 0
    if len(_WORD) > _WORD.limit:
        _WORD.clear()
    h = np.fromiter(map(_WORD.__getitem__, words), np.uint64, n)
    w = np.zeros(n - window + 1, np.uint64)
    for j in range(window):  # a polynomial over the words' hashes
        w *= _STEP
        w += h[j : n - window + 1 + j]
    order = np.argsort(w, kind="stable")
    same = w[order][1:] == w[order][:-1]
    if not same.any():
        return 0
    starts = np.zeros(len(w), bool)
    starts[order[1:][same]] = True
    starts[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def _count(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    seen: set[bytes] = set()
    again = 0
    for line in text.split(b"\n"):
        if line in seen:
            again += 1
        elif line.split(None, 1):
            seen.add(line)
    solid = text.translate(None, _BLANK_BYTES)
    chars = len(solid) if solid.isascii() else len(solid.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(words), chars, symbols, again, repeated_words(words)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of counts for each row of ``docs``."""

    def run(batch):
        counts = np.array([_count(t) for t in batch.column("body").to_pylist()], np.int64)
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return {"doc_id": batch.column("doc_id")} | dict(zip(names, counts.T))

    picked = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("body"))
    return map_batches(picked, run, STATS)


def features(cols: dict[str, np.ndarray]) -> np.ndarray:
    """The counts as rates that don't follow the length of a text. The mean word length of a short
    text is drawn towards ``USUAL`` letters, as if it held so many more words."""
    n = cols["n_words"].astype(float)
    return np.stack(
        [
            (cols["word_chars"] + USUAL * PRIOR) / (n + PRIOR),
            cols["n_symbols"] / (n + 1),
            cols["n_dup_lines"] / (n + 1),
            cols["n_repeat_words"] / (n + 1),
        ],
        1,
    )


def _path_rest(n: int) -> float:
    """Mean length of an unsuccessful search among ``n`` rows: the rest of a path that ends early."""
    return 0.0 if n < 2 else 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def grow_tree(rows: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One isolation tree as arrays: feature (-1 at a leaf), cut, children, path length at a leaf."""
    deepest = math.ceil(math.log2(max(2, len(rows))))
    feature, cut, left, right, path = [], [], [], [], []

    def add(part: np.ndarray, depth: int) -> int:
        at = len(feature)
        for a, v in ((feature, -1), (cut, 0.0), (left, at), (right, at)):
            a.append(v)
        path.append(depth + _path_rest(len(part)))
        low, high = part.min(0), part.max(0)
        open_ = np.flatnonzero(high > low)
        if depth < deepest and len(part) > 1 and len(open_):
            f = int(rng.choice(open_))
            c = float(rng.uniform(low[f], high[f]))
            down = part[:, f] <= c
            feature[at], cut[at] = f, c
            left[at] = add(part[down], depth + 1)
            right[at] = add(part[~down], depth + 1)
        return at

    add(rows, 0)
    return {"feature": np.array(feature), "cut": np.array(cut), "left": np.array(left),
            "right": np.array(right), "path": np.array(path)}


def fit_forest(rows: np.ndarray, trees: int = TREES, size: int = TREE_ROWS, seed: int = 1) -> dict:
    """Isolation trees, each on so many rows drawn without replacement."""
    rng = np.random.default_rng(seed)
    size = min(size, len(rows))
    grown = [grow_tree(rows[rng.choice(len(rows), size, False)], rng) for _ in range(trees if size else 0)]
    return {"trees": grown, "scale": max(_path_rest(size), 1e-9)}


def anomaly(forest: dict, rows: np.ndarray) -> np.ndarray:
    """2 to the power of minus the mean path length over its expectation: 1 is odd, 0 usual."""
    total = np.zeros(len(rows))
    every = np.arange(len(rows))
    for t in forest["trees"]:
        at = np.zeros(len(rows), np.int64)
        while True:
            f = t["feature"][at]
            if (f < 0).all():
                break
            low = rows[every, np.maximum(f, 0)] <= t["cut"][at]
            at = np.where(f < 0, at, np.where(low, t["left"][at], t["right"][at]))
        total += t["path"][at]
    return 2.0 ** (-total / max(1, len(forest["trees"])) / forest["scale"])


def base_failed(cols: dict[str, np.ndarray]) -> np.ndarray:
    return (cols["n_words"] < MIN_WORDS) | (
        100 * cols["n_repeat_words"] > MAX_REPEAT_PERCENT * cols["n_words"]
    )


def best_cut(good: np.ndarray, bad: np.ndarray, share: float = PASS_SHARE) -> int:
    """From counts of good (label 1) and bad rows by step of the score: the step that parts both
    best, both kinds weighing alike, among those with good rows that let the given share of good rows
    pass. The last step without good rows."""
    total, against = int(good.sum()), int(bad.sum())
    if not total:
        return STEPS
    passed = np.cumsum(good)
    cuts = np.flatnonzero((good > 0) & (passed >= math.ceil(share * total)))
    gain = passed[cuts] / total - (np.cumsum(bad)[cuts] / against if against else 0)
    return int(cuts[int(np.argmax(gain))])


def calibrate(
    forest: dict, rows: np.ndarray, labels: np.ndarray, share: float = PASS_SHARE
) -> float:
    """The best threshold for rows in memory."""
    steps = np.ceil(anomaly(forest, rows) * STEPS).astype(int)
    good, bad = (np.bincount(steps[labels == k], minlength=STEPS + 1) for k in (1, 0))
    return best_cut(good, bad, share) / STEPS


def _columns(df: DataFrame, rows: int) -> dict[str, np.ndarray]:
    """A bounded sample as columns on the driver."""
    got = bounded(df, rows, "doc_id").toPandas()
    return {c: got[c].to_numpy() for c in got}


def fit(stats: DataFrame) -> dict:
    """A forest on a sample of the rows that the base rule passes."""
    passed = stats.where(
        (F.col("n_words") >= MIN_WORDS)
        & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words"))
    )
    return fit_forest(features(_columns(passed, SAMPLE_ROWS)))


def score(stats: DataFrame, forest: dict) -> DataFrame:
    """``stats`` with base_failed and the anomaly score."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def run(batch):
        cols = {n: batch.column(n).to_numpy() for n in batch.schema.names[1:]}
        return {n: batch.column(n) for n in batch.schema.names} | {
            "base_failed": base_failed(cols), "anomaly": anomaly(shared.value, features(cols))}

    return map_batches(stats, run, STATS + ", base_failed boolean, anomaly double")


def _step():
    return F.ceil(F.col("anomaly") * STEPS).cast("int")


def threshold(scored: DataFrame, labels: DataFrame, share: float = PASS_SHARE) -> int:
    """The best cut over all labelled rows that the base rule passes: they are counted by step and
    label in Spark, and at most 2 * (STEPS + 1) counts come to the driver."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "quality").where("quality IN (0, 1)")
    counts = (
        scored.where(~F.col("base_failed"))
        .join(known.distinct(), "doc_id")
        .groupBy(_step().alias("step"), "quality")
        .agg(F.count("*").alias("n"))
    )
    by_label = np.zeros((2, STEPS + 1), np.int64)
    for r in counts.collect():
        by_label[int(r["quality"]), r["step"]] = r["n"]
    return best_cut(by_label[1], by_label[0], share)


def judge(scored: DataFrame, cut: int) -> DataFrame:
    """``scored`` with kept."""
    return scored.withColumn("kept", ~F.col("base_failed") & (_step() <= cut))


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    stats = stage_table(statistics(docs), "rule-stats")
    scored = stage_table(score(stats, fit(stats)), "rule-scores")
    return judge(scored, threshold(scored, labels))


@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return apply_rules(table(spark, sf, "documents"), table(spark, sf, "labels"))
