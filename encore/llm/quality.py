"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

A text's words give four families of n-grams, each hashed to slots: words, word pairs, word shapes
(letter case and what surrounds it) and shape pairs, where a word that repeats the one before has
a shape of its own. A slot's value is its count over the square root of the number of words.
Training sees a bounded sample of labelled rows of each class outside the held-out fold; scoring
reads whole texts and only the text.

Defined cases. A null text counts as empty and gets the score of the bias alone. Without labelled
rows of both classes every score is the share of label 1 (0.5 without any row). Repeated rows each
get a row; an id labelled twice with different labels counts in both classes. Other columns are
not read.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.base import Memo, bounded, fold, map_batches, query, sigmoid, sparse_rows, table, utf8

#: Bound of the training sample: so many labelled rows of each class.
ROWS_PER_CLASS = 2_000
SLOTS = 1 << 17
EPOCHS = 4
#: Rate, its offset, and the penalties of the leader's objective.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 0.5
HELD_OUT, FOLDS = 1, 3

_LETTERS = re.compile(r"[^\W_]+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_PLACE = np.uint64(64 - 17)


def _hash(token: bytes) -> tuple[int, int]:
    """Hashes of the bare lower-cased word and of the token's shape."""
    s = token.decode("utf-8", "replace")
    bare = _LETTERS.findall(s)
    word = " ".join(bare).lower() or s
    body = bare[0] if bare else ""
    case = (
        "9" if body.isdigit() else "x" if body.islower() else "X" if body.isupper() and len(body) > 1
        else "Xx" if body[:1].isupper() else "?" if body else "-"
    )
    around = _LETTERS.sub("w", s)[:8]
    return xxhash.xxh64_intdigest(word, 1), xxhash.xxh64_intdigest(case + "\x00" + around, 2)


def text_slots(text: bytes, memo: Memo) -> tuple[np.ndarray, int]:
    """Slots of all n-grams of the text, repeats included, and the number of words."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(0, np.int64), 0
    if len(memo) > memo.limit:
        memo.clear()
    got = np.array([memo[w] for w in words], np.uint64)
    word, shape = got[:, 0], got[:, 1].copy()
    shape[1:][word[1:] == word[:-1]] = np.uint64(7)
    grams = [word, shape]
    for family, g in enumerate((word, shape)):
        grams.append(g[:-1] * _MIX[family] + g[1:])
    keys = np.concatenate(grams) * _MIX[0]
    return (keys >> _PLACE).astype(np.int64), n


def sparse(text: bytes, memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    at, n = text_slots(text, memo)
    slots, counts = np.unique(at, return_counts=True)
    return slots, counts / np.sqrt(max(n, 1))


class Leader:
    """Follow-the-regularised-leader for the logistic loss; weights follow from sums per slot."""

    def __init__(self, slots: int = SLOTS):
        self.z, self.n = np.zeros(slots + 1), np.zeros(slots + 1)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, y: int, weight: float = 1.0) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        w = self.weights(at)
        g = weight * (sigmoid(w @ x) - y) * x
        rate = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - rate * w
        self.n[at] += g * g


def fit_weights(rows: list, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> np.ndarray:
    """Weights by slot, the bias last. Both classes weigh alike in training."""
    if not len(labels) or labels.min() == labels.max():
        share = 0.5 if not len(labels) else min(max(labels.mean(), 0.01), 0.99)
        return np.append(np.zeros(SLOTS), np.log(share / (1 - share)))
    leader, rng = Leader(), np.random.default_rng(seed)
    weight = [len(labels) / (2 * (labels == y).sum()) for y in (0, 1)]
    for _ in range(epochs):
        for i in rng.permutation(len(labels)):
            leader.update(*rows[i], labels[i], weight[labels[i]])
    return leader.weights()


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Weights from so many labelled rows of each class at most, picked by the hash of the id."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("y"))
        .where("doc_id IS NOT NULL AND y IN (0, 1)")
        .where(fold("doc_id", FOLDS) != HELD_OUT)
        .distinct()
    )
    picked = bounded(known, ROWS_PER_CLASS, "doc_id", "y")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8("text").alias("body"))

    def run(batch):
        memo = Memo(_hash)
        found = [sparse(t, memo) for t in batch.column("body").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "y": batch.column("y"),
                "at": [a for a, _ in found], "x": [v for _, v in found]}

    # Twice ROWS_PER_CLASS ids at most, so the broadcast is bounded.
    own = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "y", "body")
    got = map_batches(own, run, "doc_id bigint, y int, at array<int>, x array<float>").toArrow()
    rows, keys = sparse_rows(got, "at", "x", "doc_id", "y")
    return fit_weights(rows, np.array([y for _, y in keys], np.int64))


_MEMOS: dict[str, tuple[Memo, np.ndarray]] = {}


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    name = uuid.uuid4().hex

    def run(batch):
        if name not in _MEMOS:  # kept between the tasks of a worker
            _MEMOS.clear()
            _MEMOS[name] = Memo(_hash), shared.value
        memo, w = _MEMOS[name]
        out = []
        for text in batch.column("body").to_pylist():
            at, n = text_slots(text, memo)
            out.append(w[at].sum() / np.sqrt(max(n, 1)) + w[-1])
        return {"doc_id": batch.column("doc_id"), "score": sigmoid(np.array(out))}

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8("text").alias("body"))
    return map_batches(picked, run, "doc_id bigint, score double")


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return score(docs, train(docs, table(spark, sf, "labels"))).select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
