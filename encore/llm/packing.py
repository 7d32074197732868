"""Best-fit packing of tokenised documents by large-item matching.

Documents become token ids with an end id; longer ones are cut into pieces of the capacity. What
is packed is the histogram of piece lengths, whose size is bounded by the capacity whatever the
corpus: pieces above a third of the capacity are matched greedily, the largest with the largest
that still fits beside it, two to a sequence at most; smaller ones, by falling length, go to the
sequence with the least gap that holds them. The plan says for each length which ranks go where;
pieces find their place by their rank among those of their length, which a distributed count over
hashed chunks gives. So no key's rows meet in one task, and the plan is a small broadcast.

Defined cases. A null or empty text is one piece: the end id alone. An empty table gives an empty
result. Repeated rows each get a place. Ties between pieces of one length are broken by chunk, id
and piece. Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.llm.base import map_batches, query, table, utf8
from encore.session import stage_table

CAPACITY = 4096
END_ID = 1
VOCABULARY = "word_bpe_49k.json"

#: ASCII signs but for the apostrophe, which contractions hold.
SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class WordTokens:
    """Ids of whole texts, from ids of their words.

    The vocabulary's splitter never joins what a blank parts, so a text's ids are those of its
    words in turn, and each distinct word is encoded once per worker. ASCII words are looked up in
    lower case, as the vocabulary folds case itself.
    """

    LIMIT = 1_000_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        vocabulary = self.encoder.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. Words of letters end with their only end-of-word token, so they are
        encoded as one text and cut there; the others one by one."""
        if not words:
            return []
        texts = [w.decode("utf-8", "replace") for w in words]
        plain = [k for k, t in enumerate(texts) if t.isalpha()]
        out: list[bytes] = [b""] * len(words)
        ids = np.array(self._encode(" ".join(texts[k] for k in plain)), "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(plain):
            whole, first = ids.tobytes(), 0
            for k, end in zip(plain, (4 * cuts).tolist()):
                out[k] = whole[first:end]
                first = end
            rest = set(range(len(words))) - set(plain)
        else:  # a letter whose lower case isn't one letter
            rest = range(len(words))
        for k in rest:
            out[k] = np.array(self._encode(texts[k]), "<u4").tobytes()
        return out

    def _encode(self, text: str) -> list[int]:
        return self.encoder.encode(text, add_special_tokens=False).ids

    def _learn(self, fresh: set[bytes]) -> None:
        """Encode new words. ASCII signs after letters are a token run of their own, so such words
        are put together from both; unless a letter's lower case ends with a mark, which joins them."""
        known, ends, bare = self.known, [], set()
        for w in fresh:
            head = w.rstrip(SIGNS)
            if head and len(head) < len(w) and (head.isalpha() or head.decode("utf-8", "replace").lower().isalpha()):
                tail = w[len(head) :]
                ends.append((w, head, tail))
                bare.add(head)
                bare.add(tail)
            else:
                bare.add(w)
        words = [w for w in bare if w not in known]
        known.update(zip(words, self._ids(words)))
        for w, head, tail in ends:
            known[w] = known[head] + known[tail]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, little-endian and unsigned in 32 bits."""
        out = []
        for first in range(0, len(texts), 32):
            split = [self._split(t) for t in texts[first : first + 32]]
            if len(self.known) > self.LIMIT:
                self.known = {}
            get = self.known.get
            fresh = {w for words in split for w, ids in zip(words, map(get, words)) if ids is None}
            if fresh:
                self._learn(fresh)
            out += [b"".join(map(get, words)) for words in split]
        return out

    @staticmethod
    def _split(text: bytes) -> list[bytes]:
        if b"|>" in text:  # may spell a special token, which is sought before case is folded
            return text.split()
        if text.isascii():
            return text.lower().split()
        return [w.lower() if w.isascii() else w for w in text.split()]


_TOKENS: dict[str, WordTokens] = {}


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenize(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document, with the checksum of their ids."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batch):
        if vocabulary not in _TOKENS:  # kept between the tasks of a worker
            _TOKENS[vocabulary] = WordTokens(vocabulary_path(vocabulary))
        rows = []
        bodies = _TOKENS[vocabulary].encode(batch.column("body").to_pylist())
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), bodies):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                own = ids[at : at + 4 * capacity]
                rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
        return dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), zip(*rows)))

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8("text").alias("body"))
    return map_batches(picked, run, PIECES)


class Plan:
    """Groups of like sequences: what lengths they hold, how many they are, what gap is left."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.groups: dict[int, list[tuple[tuple, int]]] = {}  # gap -> (held (length, times), count)
        self.gaps: list[int] = []

    def put(self, held: tuple, count: int) -> None:
        gap = self.capacity - sum(size * times for size, times in held)
        if gap not in self.groups:
            self.groups[gap] = []
            insort(self.gaps, gap)
        self.groups[gap].append((held, count))

    def take(self, least: int) -> tuple[tuple, int] | None:
        """A group with the least gap that is large enough."""
        k = bisect_left(self.gaps, least)
        if k == len(self.gaps):
            return None
        gap = self.gaps[k]
        out = self.groups[gap].pop()
        if not self.groups[gap]:
            del self.groups[gap], self.gaps[k]
        return out


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """Sequences for so many pieces of each length: ((length, times), ...) and how often."""
    plan = Plan(capacity)
    left = {s: c for s, c in counts.items() if c}
    large = sorted(s for s in left if 3 * s > capacity)
    while large:
        size = large[-1]
        k = bisect_left(large, capacity - size + 1) - 1
        if k < 0:
            plan.put(((size, 1),), left.pop(size))
            large.pop()
            continue
        mate = large[k]
        count = left[size] // 2 if mate == size else min(left[size], left[mate])
        if not count:  # one is left over and nothing smaller fits its size
            k -= 1
            mate = large[k] if k >= 0 else 0
            count = min(1, left.get(mate, 0))
            if not count:
                plan.put(((size, 1),), left.pop(size))
                large.pop()
                continue
        plan.put(((size, 2),) if mate == size else ((size, 1), (mate, 1)), count)
        for s in (size, mate):
            left[s] -= count
            if not left[s] and s in large:
                large.remove(s)
    for size in sorted((s for s in left if 3 * s <= capacity and left[s]), reverse=True):
        need = left[size]
        while need:
            held, bins = plan.take(size) or ((), -1)
            each = (capacity - sum(s * t for s, t in held)) // size
            full = need // each if bins < 0 else min(bins, need // each)
            if full:
                plan.put((*held, (size, each)), full)
                need -= full * each
                bins -= full if bins > 0 else 0
            elif need:
                plan.put((*held, (size, need)), 1)
                need, bins = 0, bins - 1
            if bins > 0:
                plan.put(held, bins)
    return [group for gap in plan.gaps for group in plan.groups[gap]]


def places(groups: list[tuple[tuple, int]]) -> np.ndarray:
    """Rows by length and rank: length, first rank, first sequence, pieces a sequence, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for held, count in groups:
        offset = 0
        for size, times in held:
            rows.append((size, used.get(size, 0), sequence, times, offset))
            used[size] = used.get(size, 0) + times * count
            offset += size * times
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with their rank among those of their length, from 0."""
    spark = pieces.sparkSession
    chunks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(chunks)))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("length", "chunk")
        .agg(F.count("*").alias("n"))
        .select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    own = Window.partitionBy("length", "chunk").orderBy("doc_id", "piece")
    return (
        dealt.withColumn("own", F.row_number().over(own) - 1)
        .join(bases, ["length", "chunk"])
        .withColumn("rank", F.col("own") + F.col("base"))
        .drop("own", "base", "chunk")
    )


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its offset there."""
    pieces = stage_table(tokenize(docs, vocabulary, capacity), "pieces")
    counts = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}  # capacity rows
    shared = pieces.sparkSession.sparkContext.broadcast(places(pack(counts, capacity)))

    def run(batch):
        plan = shared.value
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        starts = (plan[:, 0] << 45) | plan[:, 1]
        at = np.searchsorted(starts, (length << 45) | rank, "right") - 1
        within, times = rank - plan[at, 1], plan[at, 3]
        return {n: batch.column(n) for n in batch.schema.names} | {
            "sequence_id": plan[at, 2] + within // times,
            "offset": plan[at, 4] + within % times * length,
        }

    return map_batches(ranked(pieces), run, PIECES + ", sequence_id bigint, offset bigint")


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack_documents(table(spark, sf, "documents"))
