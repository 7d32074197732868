import llm_data as data

import corpus_pipeline
from encore.llm import base, catalog, language  # noqa: F401
from encore.session import stage_table


def test_stage_list():
    names = ["language_id", "line_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names and corpus_pipeline.ORACLE_SQL is None
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in base.QUERIES}


def expected(docs, langs):
    """The pipeline after the language stage by brute force: pieces by document."""
    docs = [(i, t) for i, t in docs if langs[i] != "und"]
    lines = data.line_dedup(docs)
    docs = [(i, "\n".join(lines[i])) for i, _ in docs]
    component = data.near_components({i: data.fingerprint(t) for i, t in docs})
    docs = [(i, t) for i, t in docs if component[i] == i]
    out = set()
    for (i, t), hit in zip(docs, data.repeated_bytes([t.encode() for _, t in docs], corpus_pipeline.PASSAGE)):
        body = t.encode()
        whole = [hit[k] for k in range(len(body))]
        for k in range(len(body)):  # a character goes only if all its bytes do
            if body[k] & 0xC0 != 0x80:
                end = k + 1
                while end < len(body) and body[end] & 0xC0 == 0x80:
                    end += 1
                if not all(hit[k:end]):
                    whole[k:end] = [False] * (end - k)
        kept = bytes(b for b, gone in zip(body, whole) if not gone).decode()
        out |= {(i, *p) for p in data.token_pieces(kept)}
    return out


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{data.SMALL}/documents.parquet")
    predicted = language.predict(docs, language.train(docs)).collect()
    langs = {r.doc_id: r.lang_pred if r.score >= language.MIN_SCORE else "und" for r in predicted}
    got = corpus_pipeline.run(spark, data.SMALL)
    want = expected(data.collected(docs, "doc_id", "text"), langs)
    assert {tuple(r)[:5] for r in got.collect()} == want


def test_stages_on_awkward_rows(spark):
    docs = data.awkward(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage_table(stage(spark, docs, data.SMALL), name)
        assert docs.columns == columns
        assert docs.where("n_chars <> char_length(text)").count() == 0
    none = data.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, data.SMALL).count() == 0


def test_repeated_rows_pass_the_pipeline_once(spark):
    rng = data.random.Random(9)
    a, b, c, d = (data.prose(rng, 200) for _ in range(4))
    rows = [(1, a), (1, a), (None, a), (2, b), (5, b), (5, c), (None, d), (None, d)]
    docs = spark.createDataFrame([(*r, "en", len(r[1])) for r in rows], "doc_id bigint, text string, lang string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage_table(stage(spark, docs, data.SMALL), name)
    got = data.collected(docs, "doc_id", "text", "n_chars")
    assert sorted(got, key=str) == sorted([(i, t, len(t)) for i, t in ((1, a), (2, b), (5, c), (None, d))], key=str)
    pieces = corpus_pipeline.pack(spark, docs, data.SMALL).collect()
    assert sorted(str(r[0]) for r in pieces) == ["1", "2", "5", "None"]
