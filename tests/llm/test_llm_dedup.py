import hashlib
import random

import duckdb
import llm_data as data
import numpy as np
import pytest

from encore.llm import base, catalog, components, line_dedup, simhash, suffixes  # noqa: F401


def test_lines_on_awkward_rows(spark):
    docs = data.awkward(spark)
    got = line_dedup.dedup_lines(docs).select("doc_id", "_runs_kept").collect()
    want = data.line_dedup(data.collected(docs, "doc_id", "text"))
    assert len(got) == docs.count()
    assert all(r[1] == want[r[0]] for r in got)
    kept = line_dedup.keep_lines(docs)
    assert kept.columns == docs.columns and {r["h1"] for r in kept.collect()} == {"h1"}


def test_lines_without_rows_or_ids(spark):
    docs = data.empty(spark)
    assert line_dedup.keep_lines(docs).count() == 0
    no_id = spark.createDataFrame([(None, "a line that is long enough to count")] * 3, "doc_id bigint, text string")
    assert {r[0] for r in line_dedup.keep_lines(no_id).select("text").collect()} == {no_id.first()[1]}


def test_runs_are_compacted_and_keep_owners(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for ids in ([9, 8], [7, 6], [5, 4], [3]):
        rows = [(i, k, k) for i in ids for k in range(i + 2)]
        runs.add(spark.createDataFrame(rows, "doc_id bigint, h1 bigint, h2 bigint"))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    got = {r.h1: r.owner for r in runs.repeated(3).collect()}
    assert got == {k: 9 for k in range(9)}  # keys 9 and 10 are held by two documents at most


@pytest.mark.parametrize("name", ["op1_line_dedup", "op9_exact_top_k"])
def test_queries_equal_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data.SMALL}/{t}.parquet'")
    want = con.sql(base.ORACLES[name])
    columns = sorted(want.columns)
    got = base.QUERIES[name](spark, data.SMALL)
    assert sorted(got.columns) == columns
    assert sorted(data.collected(got, *columns)) == sorted(want.select(", ".join(columns)).fetchall())


def test_fingerprints_and_components(spark):
    docs = data.awkward(spark)
    codes = {i: data.fingerprint(t) for i, t in data.collected(docs, "doc_id", "text")}
    want = data.near_components(codes)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert all(r.code % 2**64 == codes[r.doc_id] and r.component_id == want[r.doc_id] for r in got)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, c in want.items() if i == c}
    assert simhash.near_duplicates(data.empty(spark)).count() == 0


def test_one_row_of_a_component_stays(spark):
    rng = data.random.Random(8)
    a, b, c, d, e = (data.prose(rng, 200) for _ in range(5))
    rows = [(1, a), (1, a), (1, a), (None, a), (2, b), (5, b), (5, c), (5, c), (None, d), (None, d), (7, e), (7, e + " ")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, own string")
    kept = data.collected(simhash.keep_one(docs), "doc_id", "text", "own")
    got = sorted(((t.strip(), i) for i, t, _ in kept), key=str)
    assert got == sorted([(a.strip(), 1), (b.strip(), 2), (c.strip(), 5), (d.strip(), None), (e.strip(), 7)], key=str)


def test_simhash_query(spark):
    got = {r.doc_id: r for r in base.QUERIES["op2_simhash_near_dedup"](spark, data.SMALL).collect()}
    docs = spark.read.parquet(f"{data.SMALL}/documents.parquet")
    codes = {i: data.fingerprint(t) for i, t in data.collected(docs, "doc_id", "text")}
    want = data.near_components(codes)
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {
        i: (f"{c:016x}", want[i]) for i, c in codes.items()}


@pytest.mark.parametrize("node_rows", [1 << 14, 50])
def test_crowded_nodes_lose_no_link(spark, node_rows):
    """A cloud of near codes, random ones, and chains; nodes dealt over cells or not."""
    rng = np.random.default_rng(3)
    flip = lambda c, k: c ^ sum(1 << int(b) for b in rng.choice(64, k, False))
    centre = int(rng.integers(2**63))
    codes = {flip(centre, int(rng.integers(0, 6))) for _ in range(300)}
    codes |= {int(x) for x in rng.integers(0, 2**63, 100)}
    chain = int(rng.integers(2**63))
    for _ in range(40):
        codes.add(chain := flip(chain, 4))
    codes = sorted(c - 2**64 if c >= 2**63 else c for c in codes)
    table = spark.createDataFrame([(c,) for c in codes], "code bigint")
    roots = {r.u: r.v for r in components.components(simhash.links(table, node_rows)).collect()}
    unsigned = {c: c % 2**64 for c in codes}
    want = data.near_components({c: unsigned[c] for c in codes})
    assert {c: roots.get(c, c) for c in codes} == want


def test_gray_order():
    codes = np.arange(16, dtype=np.uint64)
    by_rank = codes[np.argsort(simhash.gray_rank(codes))]
    assert (np.bitwise_count(by_rank[1:] ^ by_rank[:-1]) == 1).all()


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(50)] + [(500, 500)]
    got = components.components(spark.createDataFrame(links, "u bigint, v bigint"))
    assert {(r.u, r.v) for r in got.collect()} == {(i, 0) for i in range(1, 61)} | {(100 + i, 100) for i in range(1, 50)}


@pytest.mark.parametrize("crowd, length, gram", [(512, 400, None), (1, 400, None), (512, 200, 64), (1, 40, 12)])
def test_repeated_bytes(spark, crowd, length, gram):
    docs = data.awkward(spark)
    spans = suffixes.repeated_spans(docs, crowd, length, gram).collect()
    rows = data.collected(docs, "doc_id", "text")
    hits = data.repeated_bytes([(t or "").encode() for _, t in rows], length)
    got = {r.doc_id: suffixes.runs_of(r._sfx_spans) for r in spans}
    for (i, t), hit in zip(rows, hits):
        mine = np.zeros(len(hit), bool)
        for a, b in got.get(i, ()):
            mine[a:b] = True
        assert (mine == hit).all(), i


def test_counted_strings_never_multiply(spark):
    rows = [(1, 1, i, 0, 0, b"x" * 30 + bytes([i]) + b"y" * 30) for i in range(6)]
    pieces = spark.createDataFrame(rows, "gram bigint, n bigint, doc_id bigint, _sfx_text bigint, first bigint, body binary")
    found = suffixes._counted_spans(pieces, 16)
    assert found.count() == 6 * 30  # 15 starts on each side of the one byte that differs
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftSemi" in plan and "Join Inner" not in plan


def test_a_crowded_passage_is_counted_by_blocks(spark, monkeypatch):
    rng = random.Random(4)
    passage = data.prose(rng, 60).encode()
    texts = [bytes(rng.choices(range(97, 123), k=150)) + passage + bytes(rng.choices(range(97, 123), k=150)) for _ in range(12)]
    texts += [texts[0][:200] + b"#" + texts[1][200:], texts[2][:260] + b"#" + passage[130:] + b"."]
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id bigint, text string")
    single, counted = [], suffixes._counted_spans

    def watched(pieces, length):
        single.append(counted(pieces, length))
        return single[-1]

    monkeypatch.setattr(suffixes, "_counted_spans", watched)
    spans = suffixes.repeated_spans(docs, crowd=1, length=80, gram=24).collect()
    got = {r.doc_id: suffixes.runs_of(r._sfx_spans) for r in spans}
    starts = 0
    for i, hit in enumerate(data.repeated_bytes(texts, 80)):
        mine = np.zeros(len(hit), bool)
        for a, b in got.get(i, ()):
            mine[a:b] = True
        assert (mine == hit).all(), i
        starts += int(hit.sum())
    assert 0 < single[0].count() < starts / 4  # most are settled by blocks


def test_repeats_in_the_pipeline_form(spark):
    docs = data.awkward(spark)
    out = suffixes.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    rows = data.collected(docs, "doc_id", "text")
    hits = data.repeated_bytes([(t or "").encode() for _, t in rows])
    got = dict(data.collected(out, "doc_id", "text"))
    for (i, t), hit in zip(rows, hits):
        if t is None or not hit.any():
            assert got[i] == t
        else:
            body = t.encode()
            runs = [(int(a), int(b)) for a, b in zip(np.flatnonzero(np.diff(np.r_[0, hit]) > 0), np.flatnonzero(np.diff(np.r_[hit, 0]) < 0) + 1)]
            assert got[i].encode() == suffixes.without(body, suffixes.whole_characters(body, runs))
    assert suffixes.remove_repeats(data.empty(spark)).count() == 0


def test_suffix_query(spark):
    docs = data.collected(spark.read.parquet(f"{data.SMALL}/documents.parquet"), "doc_id", "text")
    bodies = [(t or "").encode() for _, t in docs]
    want = {i: data.removal(b, h) for (i, _), b, h in zip(docs, bodies, data.repeated_bytes(bodies))}
    got = base.QUERIES["op6_suffix_array_dedup"](spark, data.SMALL).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want
    whole = {r.doc_id: r.text for r in got if not r.n_removed}
    assert all(whole[i] == (t or "") for i, t in docs if i in whole)
    with pytest.raises(ValueError):
        suffixes.repeated_spans(data.empty(spark), length=402)


def test_merged_transforms_equal_one_sort():
    rng = np.random.default_rng(1)
    bodies = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in (30, 41, 7, 30, 0, 25)] + [b"ab" * 20]
    got = suffixes.repeated_starts(bodies, length=8, block=2, shards=3)
    strings = [b[p : p + 8] for b in bodies for p in range(len(b) - 7)]
    want = [[p for p in range(len(b) - 7) if strings.count(b[p : p + 8]) > 1] for b in bodies]
    assert [g.tolist() for g in got] == want


def test_removed_runs():
    runs = suffixes.runs_of([{"from": 5, "to": 9}, {"from": 0, "to": 2}, {"from": 9, "to": 12}, {"from": 6, "to": 7}])
    assert runs == [(0, 2), (5, 12)] and suffixes.runs_of(None) == []
    assert suffixes.without(b"0123456789abcd", runs) == b"234cd"
    assert suffixes.whole_characters("aéb".encode(), [(2, 4)]) == [(3, 4)]
    assert hashlib.sha256(suffixes.without(b"", [])).hexdigest() == hashlib.sha256(b"").hexdigest()
