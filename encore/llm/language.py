"""Language identification by hierarchical discrimination.

One linear support vector machine per language family against the rest picks the family; within
it, one machine per pair of languages separates the close relatives by votes, summed margins
breaking ties. Features are hashed letter n-grams of words, bounds included, averaged over the
words of the text: a text's margin is the mean of its words' margins, so each distinct word is
scored once per worker and whole texts cost one look-up per word.

Defined cases. A null text, or one without a letter, is ``und`` with score 0. With no labelled row
every text is ``und``; with one language every text with a letter gets it, with score 1. Tied
margins go to the language that comes first in the alphabet. Repeated rows each get a row. A
language that isn't in ``FAMILIES`` is a family of its own. Other columns are not read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.base import bounded, fold, map_batches, query, ship, sigmoid, sparse_rows, table, utf8

UNKNOWN = "und"
#: Family of each language code; others stand alone.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic",
    "no": "germanic", "fr": "romance", "es": "romance", "it": "romance", "pt": "romance",
    "ca": "romance", "ro": "romance", "ru": "slavic", "uk": "slavic", "pl": "slavic",
    "cs": "slavic", "sk": "slavic", "bg": "slavic", "sr": "slavic", "hr": "slavic",
}
#: Bound of the training sample: so many texts of each language.
TEXTS_PER_LANGUAGE = 200
#: Bound of what one training text brings to the driver: its hashed features, of so many slots.
SLOT_BITS = 14
SLOTS = 1 << SLOT_BITS
EPOCHS, REGULAR = 12, 1e-4
HELD_OUT, FOLDS = 2, 4
#: Below it the pipeline takes the language for unknown: with two families and pairs, mere chance is 0.25.
MIN_SCORE = 0.3

_OTHER = regex.compile(r"[^\p{L}\n]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def token_slots(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams of one to four bytes of the tokens' words, bounds included, and the
    index of each slot's token. A token without a letter has none."""
    low = b"\n".join(tokens).decode("utf-8", "replace").lower()
    clean = _OTHER.sub(" ", low).replace(" \n", "\n").replace("\n ", "\n").strip(" ").replace("\n", " \n ")
    b = np.frombuffer(f" {clean} \n\n\n".encode(), np.uint8).astype(np.uint64)
    n = len(b) - 3
    owner = np.cumsum(b[:n] == 10)
    wide = b[:n] != 10  # still without a line end
    bare = b[:n] == 32  # still nothing but blanks
    key, slots, owners = np.zeros(n, np.uint64), [], []
    for size in range(4):
        c = b[size : size + n]
        wide = wide & (c != 10)
        bare = bare & (c == 32)
        key = key * np.uint64(257) + c + np.uint64(1)
        at = np.flatnonzero(wide & ~bare)
        slots.append(((key[at] * _MIX) >> np.uint64(64 - SLOT_BITS)).astype(np.int64))
        owners.append(owner[at])
    return np.concatenate(slots), np.concatenate(owners)


def text_features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sparse mean over words of their n-gram shares."""
    slots, owner = token_slots(text.split())
    sizes = np.bincount(owner)
    at, inverse = np.unique(slots, return_inverse=True)
    return at, np.bincount(inverse, 1.0 / sizes[owner]) / max(1, (sizes > 0).sum())


def fit_machine(rows: list, signs: np.ndarray, epochs: int = EPOCHS, seed: int = 1) -> np.ndarray:
    """Weights (bias last) of a linear machine: dual coordinate descent on the hinge loss, with
    classes weighted alike."""
    w, rng = np.zeros(SLOTS + 1), np.random.default_rng(seed)
    c = {s: 50.0 * len(rows) / (2 * max(1, (signs == s).sum())) for s in (-1.0, 1.0)}
    alpha = np.zeros(len(rows))
    norm = np.array([1.0 + (v**2).sum() for _, v in rows])
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            s = signs[i]
            slack = s * (v @ w[at] + w[-1]) - 1.0
            new = min(max(alpha[i] - slack / norm[i], 0.0), c[s])
            if new != alpha[i]:
                step = (new - alpha[i]) * s
                w[at] += step * v
                w[-1] += step
                alpha[i] = new
    return w


@dataclass
class Model:
    """Families with one machine each, and a machine for each pair of languages of a family."""

    families: list[str] = field(default_factory=list)
    members: dict[str, list[str]] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((SLOTS + 1, 0)))
    pairs: list[tuple[str, str]] = field(default_factory=list)
    scale: np.ndarray = field(default_factory=lambda: np.zeros(0))


def fit_model(rows: list[tuple[np.ndarray, np.ndarray]], langs: list[str]) -> Model:
    rows, langs = zip(*[x for x in zip(rows, langs) if len(x[0][0])]) if rows else ((), ())
    known = sorted(set(langs))
    if not known:
        return Model()
    members: dict[str, list[str]] = {}
    for lang in known:
        members.setdefault(FAMILIES.get(lang, lang), []).append(lang)
    families = sorted(members)
    pairs = [p for f in families for p in combinations(members[f], 2)]
    columns, scale = [], []

    def fit(picked: list[int], signs: list[float]) -> None:
        own = [rows[i] for i in picked]
        w = fit_machine(own, np.array(signs))
        margins = np.abs([v @ w[at] + w[-1] for at, v in own])
        columns.append(w)
        scale.append(6.0 / max(1e-9, float(np.median(margins))))

    every = range(len(rows))
    if len(families) > 1:
        for f in families:
            fit(list(every), [1.0 if langs[i] in members[f] else -1.0 for i in every])
    for a, b in pairs:
        picked = [i for i in every if langs[i] in (a, b)]
        fit(picked, [1.0 if langs[i] == a else -1.0 for i in picked])
    weights = np.stack(columns, 1) if columns else np.zeros((SLOTS + 1, 0))
    return Model(families, members, weights, pairs, np.array(scale))


def decide(model: Model, margins: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each row of margins (one column per machine)."""
    n, scaled = len(margins), margins * model.scale
    lead = len(model.families) if len(model.families) > 1 else 0
    family = scaled[:, :lead].argmax(1) if lead else np.zeros(n, int)
    chance = np.ones(n)
    if lead:
        p = sigmoid(scaled[:, :lead])
        chance = p[np.arange(n), family] / np.maximum(p.sum(1), 1e-12)
    votes = {x: np.zeros(n) for m in model.members.values() for x in m}
    sure = {x: np.ones(n) for x in votes}
    for k, (a, b) in enumerate(model.pairs, lead):
        p = sigmoid(scaled[:, k])
        votes[a] += (scaled[:, k] >= 0) + p * 1e-3
        votes[b] += (scaled[:, k] < 0) + (1 - p) * 1e-3
        sure[a], sure[b] = np.minimum(sure[a], p), np.minimum(sure[b], 1 - p)
    out, score = np.empty(n, object), np.zeros(n)
    for f, name in enumerate(model.families):
        own = np.flatnonzero(family == f)
        langs = model.members[name]
        best = np.stack([votes[x][own] for x in langs], 1).argmax(1)
        out[own] = np.array(langs, object)[best]
        score[own] = chance[own] * np.stack([sure[x][own] for x in langs], 1)[np.arange(len(own)), best]
    return list(out), score


class Scorer:
    """Margins of texts under a model, each distinct word scored once."""

    LIMIT = 400_000

    def __init__(self, model: Model):
        self.model = model
        self._empty()

    def _empty(self) -> None:
        self.place: dict[bytes, int] = {}
        self.rows = np.zeros((0, self.model.weights.shape[1]))
        self.solid = np.zeros(0, bool)

    def _learn(self, fresh: list[bytes]) -> None:
        """Score new words, all at once."""
        if len(self.place) + len(fresh) > self.LIMIT:
            self._empty()
        slots, owner = token_slots(fresh)
        sizes = np.bincount(owner, minlength=len(fresh))
        rows = np.zeros((len(fresh), self.model.weights.shape[1]))
        for k, w in enumerate(self.model.weights.T):
            rows[:, k] = np.bincount(owner, w[slots], len(fresh))
        self.place.update(zip(fresh, range(len(self.place), len(self.place) + len(fresh))))
        self.rows = np.concatenate([self.rows, rows / np.maximum(sizes, 1)[:, None]])
        self.solid = np.concatenate([self.solid, sizes > 0])

    def margins(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Whether each text has a letter, and its margins."""
        solid = np.zeros(len(texts), bool)
        out = np.tile(self.model.weights[-1], (len(texts), 1))
        for first in range(0, len(texts), 256):
            split = [t.split() for t in texts[first : first + 256]]
            every = {w for words in split for w in words}
            if fresh := [w for w in every if w not in self.place]:
                self._learn(fresh)
                if gone := [w for w in every if w not in self.place]:
                    self._learn(gone)
            for k, words in enumerate(split, first):
                at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                at = at[self.solid[at]]
                if len(at):
                    solid[k] = True
                    out[k] += self.rows[at].mean(0)
        return solid, out


_SCORERS: dict[str, Scorer] = {}


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on so many texts of each language at most, picked by the hash of the id."""
    sample = (
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"),
            F.col(lang_col).cast("string").alias("lang"),
            F.col(text_col).alias("body"),
        )
        .where("lang IS NOT NULL AND body IS NOT NULL")
        .where(fold("doc_id", FOLDS) != HELD_OUT)
    )
    # So many ids per language at most, so the broadcast is bounded.
    picked = bounded(sample.select("lang", "doc_id"), TEXTS_PER_LANGUAGE, "doc_id", "lang")
    own = sample.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id")

    def run(batch):
        found = [text_features(t) for t in batch.column("body").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "lang": batch.column("lang"),
                "at": [a for a, _ in found], "v": [v for _, v in found]}

    own = own.select("doc_id", "lang", utf8("body").alias("body"))
    got = map_batches(own, run, "doc_id bigint, lang string, at array<int>, v array<float>").toArrow()
    rows, keys = sparse_rows(got, "at", "v", "doc_id", "lang")
    return fit_model(rows, [lang for _, lang in keys])


def _predictor(model: Model, spark: SparkSession):
    """A function from a list of texts to languages and scores, for use in the workers."""
    shared = spark.sparkContext.broadcast(model)
    name = uuid.uuid4().hex

    def of(texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        scorer = _SCORERS.get(name)
        if scorer is None:  # kept between the tasks of a worker
            _SCORERS.clear()
            scorer = _SCORERS[name] = Scorer(shared.value)
        solid, margins = scorer.margins(texts)
        langs, score = decide(scorer.model, margins)
        solid &= bool(scorer.model.families)
        return [x if ok else UNKNOWN for x, ok in zip(langs, solid)], np.where(solid, score, 0.0)

    return of


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row."""
    of = _predictor(model, docs.sparkSession)

    def run(batch):
        langs, score = of(batch.column("body").to_pylist())
        return {"doc_id": batch.column("doc_id"), "lang_pred": langs, "score": score}

    picked = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), utf8(text_col).alias("body"))
    return map_batches(picked, run, "doc_id bigint, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Model, text_col: str = "text", least: float = MIN_SCORE) -> DataFrame:
    """The rows, all columns as they are, whose text has a letter and whose language is predicted
    with the least score or more."""
    of = _predictor(model, docs.sparkSession)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [(t or "").encode() for t in batch.column(at).to_pylist()]
            langs, score = of(texts)
            kept = [x != UNKNOWN and s >= least for x, s in zip(langs, score)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    ship(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return predict(docs, train(docs)).select(
        "doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
