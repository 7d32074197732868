import random
import zlib
from collections import Counter

import llm_data as data
import numpy as np
import pytest
from pyspark.sql import functions as F

from encore.llm import base, catalog, packing, pieces  # noqa: F401


def placed(rows, capacity=4096):
    """Checks that the pieces fill their sequences without gaps; returns how many there are."""
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == [0, *np.cumsum([n for _, n in own])[:-1].tolist()]
        assert sum(n for _, n in own) <= capacity
    return len(by)


def test_packing_awkward_rows(spark):
    docs = data.awkward(spark)
    got = packing.pack_documents(docs).collect()
    want = Counter((i, *p) for i, t in data.collected(docs, "doc_id", "text") for p in data.token_pieces(t))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert placed(got) >= -(-sum(r.length for r in got) // 4096)
    assert packing.pack_documents(data.empty(spark)).count() == 0


def test_packing_query(spark):
    got = base.QUERIES["op3_best_fit_packing"](spark, data.SMALL).collect()
    docs = data.collected(spark.read.parquet(f"{data.SMALL}/documents.parquet"), "doc_id", "text")
    want = Counter((i, *p) for i, t in docs for p in data.token_pieces(t))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert placed(got) <= -(-sum(r.length for r in got) // 4096) * 1.01 + 1


@pytest.mark.parametrize("seed", range(8))
def test_pack_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 101, 300) if seed % 2 else rng.integers(30, 101, 200)
    counts = dict(Counter(sizes.tolist()))
    groups = packing.pack(counts, 100)
    held = Counter()
    for own, n in groups:
        assert n > 0 and sum(s * t for s, t in own) <= 100
        assert sum(t for s, t in own if 3 * s > 100) <= 2
        for s, t in own:
            held[s] += t * n
    assert held == Counter(counts)
    bound = max(-(-int(sizes.sum()) // 100), int((sizes > 50).sum()))
    assert sum(n for _, n in groups) <= bound * 1.2 + 1


def test_large_items_are_matched_best():
    assert sorted(packing.pack({70: 2, 40: 1, 30: 1, 60: 1}, 100)) == sorted([(((60, 1), (40, 1)), 1), (((70, 1), (30, 1)), 1), (((70, 1),), 1)])
    assert packing.pack({}, 100) == []
    assert packing.pack({50: 4}, 100) == [(((50, 2),), 2)]
    assert packing.pack({1: 250}, 100)[0][1] in (1, 2)


def test_word_tokens_equal_whole_texts():
    own = packing.WordTokens(packing.vocabulary_path(packing.VOCABULARY))
    texts = ["Don't STOP, it's 1,234.50!", "<|EndOfText|> a<|endoftext|>b", "É́ J̌ K é,", "a b c\x1cd", "'S 'll. x's", "ﬁ ΑΣ Σ.", "", " \n", "日本語。テスト 12,"]
    got = [np.frombuffer(x, "<u4").tolist() for x in own.encode([t.encode() for t in texts])]
    assert got == [own.encoder.encode(t, add_special_tokens=False).ids for t in texts]


def brute(own, text):
    """All segmentations of a text by their scores."""
    out = []

    def go(at, score, ids):
        if at == len(text):
            out.append((score, ids))
        for k in range(1, min(own.longest, len(text) - at) + 1):
            edge = own._edge(text[at : at + k])
            if edge is not None:
                go(at + k, score + edge, ids + own._spell(text[at : at + k]))

    go(0, 0.0, b"")
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("text", ["the theory", "a, b;c", "  x  y ", "Straße", "é😀\n", "...", "x" * 9, "12.5km²."])
def test_n_best_equals_all_paths(text):
    own = pieces.pieces_of(pieces.VOCABULARY)
    got, want = own.encode(text, 5), brute(own, " " + text)
    assert np.allclose([s for s, _ in got], [s for s, _ in want[:5]])
    known = {ids: s for s, ids in want}
    assert len({ids for _, ids in got}) == len(got) == min(5, len(want))
    assert all(abs(known[ids] - s) < 1e-9 for s, ids in got)


def test_piece_vocabulary():
    """Ids follow the library's own vocabulary, and decoding what it decodes."""
    import public_tokenizers
    import sentencepiece

    own = pieces.pieces_of(pieces.VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces.VOCABULARY))
    for text in ("Ab  c\n\té ﬁ x  ", "日本語 test", "", " lead"):
        ids = np.frombuffer(own.encode(text)[0][1], "<u4").tolist()
        assert own.decode(ids) == text
        assert model.decode(ids).strip() == text.strip()


def test_pieces_of_awkward_rows(spark):
    docs = data.awkward(spark)
    rows = pieces.encode_texts(docs, 2)
    texts = dict(data.collected(docs, "doc_id", "text"))
    back = pieces.decode_ids(rows).collect()
    assert all(r.text == (texts[r.doc_id] or "").replace(pieces.SPACE, " ") for r in back)
    assert {r.doc_id for r in back if r["rank"] == 1} == set(texts)
    assert pieces.encode_texts(data.empty(spark)).count() == 0


def test_piece_query(spark):
    got = base.QUERIES["op4_sentencepiece"](spark, data.SMALL).collect()
    own = pieces.pieces_of(pieces.VOCABULARY)
    texts = dict(data.collected(spark.read.parquet(f"{data.SMALL}/documents.parquet"), "doc_id", "text"))
    assert len(got) == len(texts) and all(r.round_trip for r in got)
    for r in got[:20]:
        ways = own.encode(texts[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ways[0][1]) and r.scores == [s for s, _ in ways]
        assert r.scores == sorted(r.scores, reverse=True)


def test_n_best_of_periodic_and_long_texts():
    own = pieces.pieces_of(pieces.VOCABULARY)

    def brute(chunk, n):
        best = [[0.0]]
        for end in range(1, len(chunk) + 1):
            ways = [a + e for s in range(end) if (e := own._edge(chunk[s:end])) is not None for a in best[s]]
            best.append(sorted(ways, reverse=True)[:n])
        return best[-1]

    rng = random.Random(1)
    for _ in range(80):
        chunk = rng.choice(["", " "]) + rng.choice(["a", "lol", "ab", "the", "é"]) * rng.randrange(1, 12) + rng.choice(["", "b", "é"])
        for n in (1, 4):
            got = own.n_best(chunk, n)
            assert np.allclose([s for s, _ in got], brute(chunk, n), atol=1e-7)
            assert len({ids for _, ids in got}) == len(got)
    for text in ("a" * 100_000, "a" * 1000 + "é" * 1000, "lol" * 5000, "word" * 10_000):
        ways = own.encode(text)
        assert len(ways) == pieces.N_BEST
        assert all(own.decode(np.frombuffer(ids, "<u4")) == text for _, ids in ways)


def test_word_ids_equal_the_tokenizers_on_specials():
    """Letters whose case changes length or context, marks, signs and blanks, in any order."""
    import public_tokenizers
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    own = packing.WordTokens(public_tokenizers.path("word_bpe_49k.json"))
    specials = "İıŞşßẞΣσςǅﬁﬃŉΐ́̇İÅKΩ" + "aZé12_" + ".,)('!-$" + " \t\n  　"
    rng = random.Random(9)
    texts = ["".join(rng.choice(specials) for _ in range(rng.randrange(1, 14))) for _ in range(4000)] + ["İ. İ, İ) İSTANBUL.İ"]
    got = own.encode([t.encode() for t in texts])
    wrong = [t for t, ids in zip(texts, got) if np.frombuffer(ids, "<u4").tolist() != encoder.encode(t, add_special_tokens=False).ids]
    assert not wrong, (len(wrong), wrong[:5])


def test_batches_of_long_texts_stay_small(spark):
    texts = spark.range(0, 40, 1, 1).select("id", F.repeat(F.lit("x"), 1 << 20).alias("text"))
    sizes = base.map_batches(texts, lambda b: {"n": [b.nbytes]}, "n bigint").collect()
    assert sum(r.n for r in sizes) > 40 << 20 and max(r.n for r in sizes) < 10 << 20
