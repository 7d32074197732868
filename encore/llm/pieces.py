"""SentencePiece encoding to the N best segmentations, and decoding.

The lattice of a text has an edge for every piece of the vocabulary that occurs in it, weighed by
a unigram log probability that falls with the piece's rank (Zipf's law; the vocabulary's own merge
ranks aren't probabilities). A forward Viterbi pass gives for each position the best score from
the start. That score is the exact heuristic of an A-star search backward from the end, so paths
leave the queue in order of their score, and the first N are the N best.

No piece reaches over certain places (before a run of spaces; between letters and what isn't one,
unless a space lies there), which is tested when the vocabulary is read. The lattice falls
into chunks there; forward scores are kept by chunk prefix, each distinct chunk is encoded once
per worker, and the N best of a text come from its chunks of least loss.

Defined cases. A null or empty text has no ids and one segmentation of score 0. A character outside
the vocabulary becomes byte pieces, at ``BYTE_PENALTY`` each. Texts with fewer than N segmentations
return all. Which of equally scored ones come first is repeatable but otherwise open. U+2581 in a text decodes as a space, as in
SentencePiece. Repeated rows each get a row; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterable
from heapq import heappop, heappush
from itertools import product

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.base import map_batches, query, table, utf8

VOCABULARY = "piece_bpe_32k.model"
N_BEST = 4
BYTE_PENALTY = 10.0
SPACE = "▁"

#: Letters and marks part from digits, signs and the underscore.
_LETTER = r"\p{L}\p{M}"
_CHUNK = regex.compile(rf" *[{_LETTER}]++| *[^{_LETTER} ]++| +")
_MIXED = regex.compile(rf"[{_LETTER}][^{_LETTER}]|[^{_LETTER}][{_LETTER}]|{SPACE}")
#: The same below U+0300, where no marks stand and few numbers are word characters, but faster.
_FAST = re.compile(r" *[^\W\d_²³¹¼½¾]+| *(?:[^\w ]|[\d_²³¹¼½¾])+| +")
_BEYOND = re.compile("[\u0300-\U0010ffff]")
_NONE = -math.inf


class Pieces:
    """The vocabulary with its scores, and what has been encoded so far."""

    PREFIXES, CHUNKS = 1_000_000, 800_000

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = {}
        self.bytes: dict[int, int] = {}
        self.spelled: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.spelled.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.spelled.append(b"")
            else:
                plain[piece.replace(SPACE, " ")] = i
                self.spelled.append(piece.replace(SPACE, " ").encode())
                if _MIXED.search(piece.lstrip(SPACE)):
                    raise ValueError(f"piece {i} reaches over a chunk's bound: {piece!r}")
        norm = math.log(sum(1.0 / (k + 2) for k in range(len(plain))))
        by_rank = enumerate(sorted(plain.items(), key=lambda x: x[1]))
        self.score = {piece: -math.log(k + 2) - norm for k, (piece, _) in by_rank}
        self.ids = {piece: np.array([i], "<u4").tobytes() for piece, i in plain.items()}
        self.longest = max(map(len, plain))
        #: Length of the longest piece that ends with two given characters.
        self.reach: dict[str, int] = {}
        for piece in plain:
            if len(piece) > 1:
                self.reach[piece[-2:]] = max(self.reach.get(piece[-2:], 0), len(piece))
        self.byte_score = -math.log(len(plain) + 2) - norm - BYTE_PENALTY
        self._empty()

    def _empty(self) -> None:
        #: Of each prefix of a chunk: best score, second best, length of the best path's last piece.
        self.forward: dict[str, tuple[float, float, int]] = {"": (0.0, _NONE, 0)}
        self.place: dict[str, int] = {}
        self.best: list[bytes] = []
        self.scores, self.losses = array("d"), array("d")
        self.several: dict[str, list[tuple[float, bytes]]] = {}

    def _edge(self, piece: str) -> float | None:
        """Score of the piece; one character always has one."""
        found = self.score.get(piece)
        if found is None and len(piece) == 1:
            return self.byte_score * len(piece.encode())
        return found

    def _spell(self, piece: str) -> bytes:
        found = self.ids.get(piece)
        return found or np.array([self.bytes[b] for b in piece.encode()], "<u4").tobytes()

    def _forward(self, chunk: str) -> list[tuple[float, float, int]]:
        """Forward scores of all prefixes of the chunk, the empty one first."""
        # Prefixes of long chunks aren't kept: they would take the square of the chunk's length.
        known = self.forward if len(chunk) <= 64 else None
        row, n, score, reach = [self.forward[""]], len(chunk), self.score.get, self.reach.get
        while known and len(row) <= n and (found := known.get(chunk[: len(row)])) is not None:
            row.append(found)
        for end in range(len(row), n + 1):
            first, second, back = _NONE, _NONE, 1
            furthest = reach(chunk[end - 2 : end], 1) if end > 1 else 1
            for start in range(end - 1, max(end - furthest, 0) - 1, -1):
                edge = score(chunk[start:end])
                if edge is None:
                    if end - start > 1:
                        continue
                    edge = self._edge(chunk[start:end])
                a, b, _ = row[start]
                if a + edge > first:
                    second = b + edge if b + edge > first else first
                    first, back = a + edge, end - start
                elif a + edge > second:
                    second = a + edge
            row.append((first, second, back))
            if known:
                known[chunk[:end]] = row[-1]
        return row

    def _add(self, chunk: str) -> int:
        row = self._forward(chunk)
        first, second, _ = row[-1]
        parts, end, ids = [], len(chunk), self.ids.get
        while end:
            piece = chunk[end - row[end][2] : end]
            parts.append(ids(piece) or self._spell(piece))
            end -= len(piece)
        parts.reverse()
        self.best.append(b"".join(parts))
        self.scores.append(first)
        self.losses.append(first - second)
        k = self.place[chunk] = len(self.place)
        return k

    def n_best(self, chunk: str, n: int) -> list[tuple[float, bytes]]:
        """The n best segmentations of a chunk, by A-star from its end.

        The scores to go are exact, so a place is left for the k-th time on its k-th best way: it is
        expanded n times at most. Of equal scores, the one nearest to the start goes first.
        """
        row, reach, visits = self._forward(chunk), self.reach.get, [0] * (len(chunk) + 1)
        queue: list[tuple] = [(-row[-1][0], len(chunk), 0, 0.0, None)]
        out: list[tuple[float, bytes]] = []
        pushed = 0
        while queue and len(out) < n:
            _, end, _, behind, way = heappop(queue)
            if not end:
                ids = []
                while way:
                    piece, way = way
                    ids.append(self._spell(piece))
                out.append((behind, b"".join(ids)))
                continue
            if visits[end] == n:
                continue
            visits[end] += 1
            furthest = reach(chunk[end - 2 : end], 1) if end > 1 else 1
            for start in range(end - 1, max(end - furthest, 0) - 1, -1):
                piece = chunk[start:end]
                edge = self._edge(piece)
                if edge is not None:
                    pushed += 1
                    score = behind + edge
                    # Rounded, so that the order of additions doesn't part equal scores.
                    heappush(queue, (round(-(score + row[start][0]), 9), start, pushed, score, (piece, way)))
        return out

    def encode(self, text: str, n: int = N_BEST) -> list[tuple[float, bytes]]:
        """Score and ids (little-endian, unsigned 32 bits) of the n best segmentations."""
        if not text:
            return [(0.0, b"")]
        if len(self.forward) > self.PREFIXES or len(self.place) > self.CHUNKS:
            self._empty()
        text = " " + text.replace(SPACE, " ")
        chunks = (_CHUNK if _BEYOND.search(text) else _FAST).findall(text)
        get, add = self.place.get, self._add
        at = [add(c) if (k := get(c)) is None else k for c in chunks]
        best = list(map(self.best.__getitem__, at))
        places = np.array(at)
        total = float(np.frombuffer(self.scores)[places].sum())
        losses = np.frombuffer(self.losses)[places]
        # Other than the best, the n best differ from it only in the n - 1 chunks of least loss.
        near = range(len(at))
        if len(at) > n - 1:
            near = np.argpartition(losses, n - 1)[: n - 1]
        choices = []
        for k in near:
            if chunks[k] not in self.several:
                self.several[chunks[k]] = self.n_best(chunks[k], n)
            ways = self.several[chunks[k]]
            choices.append([(ways[0][0] - score, ids) for score, ids in ways])
        ranked = sorted(product(*choices), key=lambda ways: math.fsum([w[0] for w in ways]))[:n]
        out = []
        for ways in ranked:
            for k, (_, ids) in zip(near, ways):
                best[k] = ids
            out.append((total - math.fsum([w[0] for w in ways]), b"".join(best)))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_READ: dict[str, Pieces] = {}


def pieces_of(vocabulary: str) -> Pieces:
    """The vocabulary, read once per worker."""
    if vocabulary not in _READ:
        import public_tokenizers

        _READ[vocabulary] = Pieces(public_tokenizers.path(vocabulary))
    return _READ[vocabulary]


def encode_texts(docs: DataFrame, n: int = N_BEST, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and, best first, the scores and ids of the segmentations: one row each."""

    def run(batch):
        own = pieces_of(vocabulary)
        rows = [
            (doc_id, rank, score, np.frombuffer(ids, "<i4"))
            for doc_id, body in zip(batch.column("doc_id").to_pylist(), batch.column("body").to_pylist())
            for rank, (score, ids) in enumerate(own.encode(body.decode("utf-8", "replace"), n), 1)
        ]
        return dict(zip(("doc_id", "rank", "score", "ids"), zip(*rows)))

    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8("text").alias("body"))
    return map_batches(picked, run, "doc_id bigint, rank int, score double, ids array<int>")


def decode_ids(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, rank and text of each row of ids; null ids are an empty text."""

    def run(batch):
        own = pieces_of(vocabulary)
        texts = [own.decode(x or ()) for x in batch.column("ids").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "rank": batch.column("rank"), "text": texts}

    return map_batches(encoded.select("doc_id", "rank", "ids"), run, "doc_id bigint, rank int, text string")


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of the N best segmentations of every text, and whether the best decodes to it."""

    def run(batch):
        own = pieces_of(VOCABULARY)
        out = {n: [] for n in ("n_pieces", "ids_crc32", "scores", "crc32s", "round_trip")}
        for body in batch.column("body").to_pylist():
            text = body.decode("utf-8", "replace")
            ways = own.encode(text)
            best = ways[0][1]
            out["n_pieces"].append(len(best) // 4)
            out["ids_crc32"].append(zlib.crc32(best))
            out["scores"].append([score for score, _ in ways])
            out["crc32s"].append([zlib.crc32(ids) for _, ids in ways])
            out["round_trip"].append(own.decode(np.frombuffer(best, "<u4").tolist()) == text.replace(SPACE, " "))
        return {"doc_id": batch.column("doc_id")} | out

    docs = table(spark, sf, "documents")
    picked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8("text").alias("body"))
    return map_batches(
        picked,
        run,
        "doc_id bigint, n_pieces bigint, ids_crc32 bigint, scores array<double>, crc32s array<bigint>, "
        "round_trip boolean",
    )
