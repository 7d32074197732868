import html
import math
import re

import llm_data as data
import numpy as np
import pyarrow.parquet as pq

from encore.llm import base, catalog, extract, language, quality, rules, search  # noqa: F401


def test_rule_statistics(spark):
    docs = data.awkward(spark)
    got = {r.doc_id: tuple(r)[1:] for r in rules.statistics(docs).collect()}
    for i, t in data.collected(docs, "doc_id", "text"):
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen, again = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                again += line in seen
                seen.add(line)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 2000 else {
            w for w, n in __import__("collections").Counter(windows).items() if n > 1}
        hit = {j for k, w in enumerate(windows) if w in twice for j in range(k, k + 8)}
        symbols = len(re.findall(r"[#*$%&|<>]", t))
        assert got[i] == (len(words), sum(map(len, words)), symbols, again, len(hit)), i


def test_rules_verdict(spark):
    docs = data.awkward(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = rules.apply_rules(docs, none).collect()
    assert len(got) == docs.count()
    for r in got:
        failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        assert r.base_failed == failed and r.kept == (not failed)
    assert rules.apply_rules(data.empty(spark), none).count() == 0


def test_isolation_forest_finds_the_odd_row():
    rng = np.random.default_rng(2)
    rows = np.r_[rng.normal(size=(500, 4)), [[9.0, 9.0, 9.0, 9.0]]]
    forest = rules.fit_forest(rows)
    scores = rules.anomaly(forest, rows)
    assert scores.argmax() == 500 and ((scores > 0) & (scores < 1)).all()
    labels = np.r_[np.ones(500, int), 0]
    cut = rules.calibrate(forest, rows, labels)
    assert (scores[:500] <= cut).mean() >= rules.PASS_SHARE and scores[500] > cut
    assert rules.calibrate(forest, rows[:0], labels[:0]) == 1.0
    assert (rules.anomaly(rules.fit_forest(rows[:0]), rows[:3]) == 1).all()


def _plain_score(forest, row):
    """Mean path by walking each tree for one row."""
    total = 0.0
    for t in forest["trees"]:
        at = 0
        while t["feature"][at] >= 0:
            at = t["left" if row[t["feature"][at]] <= t["cut"][at] else "right"][at]
        total += t["path"][at]
    return 2.0 ** (-total / len(forest["trees"]) / forest["scale"])


def _plain_path(rows, depth, deepest, row, t, at):
    """What a row's path must be where the tree was grown on ``rows``: splits part them, and a leaf
    adds the mean path among those left."""
    f = t["feature"][at]
    if f < 0:
        n = len(rows)
        assert depth == deepest or n < 2 or all(len({r[k] for r in rows}) == 1 for k in range(len(row)))
        rest = 0.0 if n < 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n
        return depth + rest
    cut = t["cut"][at]
    assert min(r[f] for r in rows) <= cut <= max(r[f] for r in rows)
    low = row[f] <= cut
    part = [r for r in rows if (r[f] <= cut) == low]
    return _plain_path(part, depth + 1, deepest, row, t, t["left" if low else "right"][at])


def test_trees_hold_the_paths_of_their_rows():
    rng = np.random.default_rng(4)
    rows = np.round(rng.normal(size=(200, 4)), 1)
    t = rules.grow_tree(rows, rng)
    plain = [tuple(r) for r in rows]
    for row in plain[::7]:
        at = 0
        while t["feature"][at] >= 0:
            at = t["left" if row[t["feature"][at]] <= t["cut"][at] else "right"][at]
        assert abs(t["path"][at] - _plain_path(plain, 0, 8, row, t, 0)) < 1e-9


def test_rules_verdict_equals_plain_python(spark):
    docs, labels = spark.read.parquet(f"{data.SMALL}/documents.parquet"), spark.read.parquet(f"{data.SMALL}/labels.parquet")
    stats = rules.statistics(docs)
    forest = rules.fit(stats)
    label = dict(data.collected(labels, "doc_id", "quality"))
    steps, failed = {}, {}
    for r in stats.collect():
        failed[r.doc_id] = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
        n = r.n_words
        row = ((r.word_chars + 500) / (n + 100), r.n_symbols / (n + 1), r.n_dup_lines / (n + 1), r.n_repeat_words / (n + 1))
        steps[r.doc_id] = math.ceil(_plain_score(forest, row) * 10_000)
    good, bad = ([steps[i] for i in steps if not failed[i] and label.get(i) == k] for k in (1, 0))
    best = max(
        (c for c in set(good) if sum(s <= c for s in good) >= 0.98 * len(good)),
        key=lambda c: (sum(s <= c for s in good) / len(good) - sum(s <= c for s in bad) / max(1, len(bad)), -c))
    got = rules.apply_rules(docs, labels).collect()
    assert len(got) == len(steps) > 50 and good and bad
    for r in got:
        assert r.base_failed == failed[r.doc_id] and r.kept == (not failed[r.doc_id] and steps[r.doc_id] <= best)


def test_all_labelled_rows_set_the_threshold(spark):
    scored = spark.range(20_000).selectExpr("id AS doc_id", "false AS base_failed", "id / 20000D AS anomaly")
    labels = scored.selectExpr("doc_id", "IF(doc_id < 15000, 1, 0) AS quality", "5 AS anomaly")
    cut = rules.threshold(scored, labels)
    # The last good row shares its step with a bad one, which weighs three times as much.
    assert cut == 7_499 and rules.judge(scored, cut).where("kept").count() == 14_999
    assert rules.threshold(scored, labels.where("quality = 0")) == rules.STEPS


def test_rules_query_keeps_good_rows(spark):
    sf = data.SMALL.replace("0.001", "0.01")
    labels = dict(data.collected(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "quality"))
    rows = [r for r in base.QUERIES["op10_quality_rules"](spark, sf).collect() if not r.base_failed]
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(good) >= 0.97 and np.mean(bad) < 0.8


def test_language_query(spark):
    sf = data.SMALL.replace("0.001", "0.01")
    langs = dict(data.collected(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "lang"))
    rows = base.QUERIES["op8_language_id"](spark, sf).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (base.crc(r.doc_id) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    docs = data.awkward(spark)
    model = language.train(docs)
    got = language.predict(docs, model).collect()
    texts = dict(data.collected(docs, "doc_id", "text"))
    assert len(got) == docs.count()
    for r in got:
        solid = any(c.isalpha() for c in texts[r.doc_id] or "")
        assert (r.lang_pred == "und") == (not solid) and (r.score == 0) == (not solid)
    kept = language.keep_known(docs, model, least=0.0)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.lang_pred != "und")
    nothing = language.train(docs.where("false"))
    assert {(r.lang_pred, r.score) for r in language.predict(docs, nothing).collect()} == {("und", 0.0)}
    assert language.predict(data.empty(spark), model).count() == 0
    one = language.train(docs.where("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in language.predict(docs, one).collect()} == {("und", 0.0), ("en", 1.0)}


def test_token_slots():
    slots, owner = language.token_slots([b"Ab", b"12", "é".encode(), b"x-y"])
    assert set(owner.tolist()) == {0, 2, 3}
    same, _ = language.token_slots([b"aB."])
    assert sorted(same) == sorted(slots[owner == 0])


def test_quality_query(spark):
    sf = data.SMALL.replace("0.001", "0.01")
    labels = dict(data.collected(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "quality"))
    rows = base.QUERIES["op5_quality_classifier"](spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (base.crc(r.doc_id) % 3 == 1) for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.95
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)


def test_quality_of_awkward_rows(spark):
    docs = data.awkward(spark)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(20)] + [(5, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    bare = quality.train(docs, labels.where("false"))
    assert {r.score for r in quality.score(docs, bare).collect()} == {0.5}
    assert quality.score(data.empty(spark), bare).count() == 0


def test_leader_learns_a_word():
    memo = base.Memo(quality._hash)
    texts = [b"fine words here", b"spam spam spam", b"more fine prose", b"buy spam now"] * 20
    rows = [quality.sparse(t, memo) for t in texts]
    w = quality.fit_weights(rows, np.array([1, 0, 1, 0] * 20))
    score = lambda t: w[quality.text_slots(t, memo)[0]].sum() + w[-1]
    assert score(b"fine") > 0 > score(b"spam")


def test_extraction_query(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{data.SMALL}/pages.parquet").collect()}
    got = base.QUERIES["op7_html_extraction"](spark, data.SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = (html.unescape(re.sub(r"<[^>]*>", "", b)) for b in re.split(r"</?(?:p|h1|br)>", article))
        assert r.text == " ".join(x for x in (" ".join(b.split()) for b in blocks) if x)
        assert r.n_chars == len(r.text)


def test_extraction_without_marks():
    """The line-block distribution alone finds the same texts."""
    for r in pq.read_table(f"{data.SMALL}/pages.parquet")["html"].to_pylist():
        bare = re.sub(r"</?(?:article|main)\b[^>]*>", "", r)
        assert "<article" in r and extract.main_text(bare) == extract.main_text(r)


def test_marked_pages_pass_through_the_distribution(monkeypatch):
    seen = []
    real = extract.keep_lines
    monkeypatch.setattr(extract, "keep_lines", lambda s, **k: seen.append((s, k)) or real(s, **k))
    page = "<p>before the text<article><p>Ok.<nav>menu</nav><p>End</article><p>after it"
    assert extract.main_text(page) == "Ok. End"
    assert seen == [([0, 3, 0, 0, 0, 3, 0], {"threshold": 1})]


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="page">
<header><h1>Site</h1></header><ul class="menu"><li><a href=/a>Home</a><li><a href=/b>News</a></ul>
<div id="cookie-notice"><div>We use cookies.</div></div>
<div class="content"><h2>Storm &amp; rain</h2><p>The first <b>para</b>graph is long enough to be
told from the rest of the page by its length alone, as any text is.<p>Short one.
<script>if (a < b) { document.write("<p>no</p>"); }</script>
<p>The last paragraph&nbsp;ends the text and is again quite long, so that the window holds.</div>
<div class="comments"><p>First! This comment is as long as a paragraph of the text, which is unusual,
but it happens now and then on pages of this kind.</p></div>
<form><p>Write to us</p></form><footer>Imprint</footer></body></html>"""


def test_extraction_of_a_page_without_article():
    assert extract.main_text(PAGE) == (
        "Storm & rain The first paragraph is long enough to be told from the rest of the page by its "
        "length alone, as any text is. Short one. The last paragraph ends the text and is again quite "
        "long, so that the window holds.")


def test_extraction_of_odd_pages(spark):
    for page, want in ((None, ""), ("", ""), ("<div", ""), ("plain text", "plain text"), ("<p>a<p>b", "a b"),
                       ("<article><p>Ok.", "Ok."), ("<script>never closed", ""), ("<!-- open", ""),
                       ("<nav>menu<article><p>x</p></article>", "x"), ("<p>" + "w " * 50_000, ("w " * 50_000).strip())):
        assert extract.main_text(page) == want, page
    rows = spark.createDataFrame([(1, None, None, "x"), (2, "u", "<p>a</p>", "y"), (2, "u", "<p>a</p>", "y")], "page_id bigint, url string, html string, text string")
    assert sorted((r.page_id, r.text, r.n_chars) for r in extract.extract(rows).collect()) == [(1, "", 0), (2, "a", 1), (2, "a", 1)]
    assert extract.extract(rows.where("false")).count() == 0


def test_extraction_keeps_all_of_an_article():
    long = "A paragraph that is long enough to be told from the rest of a page by its length alone, as any is."
    for inner, want in (
        (f"<p>{long}</p><aside>ad</aside><p>Short end.</p>", f"{long} Short end."),
        (f"<h2>Head</h2><form>f</form><p>{long}</p>", f"Head {long}"),
        ("<h2 id='Legal_status'>Law</h2><section id='related-work'><p class='notice-period'>Work</p></section>", "Law Work"),
        ("<div class='share'>s</div><section class='comments'>c</section><section id='related'>r</section><p>x", "x"),
        ("<p hidden>h<p>x</p>", "x"),
        ("<ul><li class='ad'>a<ul><li>b<li>c</ul><li>x</ul><p>y</p>", "x y"),
        ("<ul><li>x<li class='ad'>a</ul><p>y</p>", "x y"),
        ("<section><div class='ad'>a<p>b</p></section><p>y</p>", "y"),
        ("<div class='ad'><article>teaser</article></div><p>y</p>", "y"),
    ):
        assert extract.main_text(f"<body><article>{inner}</article><p>out</p></body>") == want, inner
    assert extract.main_text(f"<body><div><nav>menu</div><p>{long}</p></body>") == long


def test_surge_and_dive():
    assert extract.keep_lines([5, 0, 0, 0, 40, 50, 0, 30, 0, 0, 0, 4]) == [False] * 4 + [True] * 4 + [False] * 4
    assert extract.keep_lines([]) == [] and extract.keep_lines([0, 0]) == [False, False]


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, v string, rank string")


def brute_top(rows, every=20, k=20):
    sound = [(i, [int(np.floor(64 * float(np.float32(c)))) for c in x]) for i, x, *_ in rows
             if i is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)]
    out = []
    for i, q in sound:
        if i % every == 0:
            own = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in sound if j != i and len(x) == len(q))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(own[:k], 1)]
    return sorted(out)


def test_search_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)], "a", "b") for i in range(200)]
    rows += [(200 + i, rows[i % 3][1], "a", "b") for i in range(30)]  # ties
    rows += [(300, None, "a", "b"), (301, [1.0, None] * 3, "a", "b"), (302, [float("nan")] * 6, "a", "b"),
             (303, [float("inf")] * 6, "a", "b"), (None, [1.0] * 6, "a", "b"), (320, [1.0, 2.0], "a", "b"),
             (321, [3.0, 4.0], "a", "b"), (340, [1e9] * 6, "a", "b"), (360, [0.0] * 6, "a", "b")]
    monkeypatch.setattr(search, "BLOCK", 64)
    monkeypatch.setattr(search, "QUERY_BLOCK", 4)
    monkeypatch.setattr(search, "STEP", 8)
    got = search.top_k(vectors(spark, rows), "vec_id % 20 = 0")
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_top(rows)


def test_search_broadcasts_no_copies_of_queries(spark):
    found = search.top_k(
        spark.createDataFrame([(i, [i / 50, 1.0]) for i in range(40)], "vec_id bigint, embedding array<float>"),
        "vec_id % 20 = 0",
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan


def test_search_without_rows(spark):
    assert search.top_k(vectors(spark, []), "vec_id % 20 = 0").count() == 0
    assert search.top_k(vectors(spark, [(20, [1.0], "a", "b")]), "vec_id % 20 = 0").count() == 0
