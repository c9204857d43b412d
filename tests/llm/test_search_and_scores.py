"""Neighbour search, shingle join, extraction and the classifiers against brute force or held-out labels."""

import re

import numpy as np
import pandas as pd
import pytest

pytest.importorskip("tessera.llm")
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

from tessera.llm import ann, html_text, ngram_join, quality, toxicity  # noqa: E402
from tessera.llm.graph import components  # noqa: E402
from tessera.llm.queries import op1_nearest  # noqa: E402

SF = "/root/testdata/sf0.01"


def brute_components(rows):
    """{doc_id: (n_shingles, component)} by comparing all pairs."""
    sets, parent = {}, {}
    for i, t in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
        sets[i] = set(zip(*[w[k:] for k in range(5)], strict=False)) if len(w) >= 5 else ({tuple(w)} if w else set())
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def join_rows(spark, rows):
    frame = spark.createDataFrame([(i, t, "a") for i, t in rows], "doc_id long, text string, node string")
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(frame).collect()}


def test_join_equals_all_pairs(spark):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in rng.integers(0, 5000, 60)]
    rows = [(0, None), (1, ""), (2, " \t "), (3, "One two three"), (4, "one TWO three"), (5, "four five six")]
    for i in range(80):  # near copies of one text, some too far apart to link
        words = list(base)
        for at in rng.integers(0, 60, int(rng.integers(0, 3))):
            words[at] = f"x{rng.integers(0, 9)}"
        rows.append((10 + i, " ".join(words)))
    for i in range(60):  # small sets: runs of one line with one more word
        rows.append((200 + i, " ".join(f"s{k}" for k in range(int(rng.integers(5, 15)))) + f" t{rng.integers(0, 5)}"))
    for i in range(60):  # one common passage in otherwise different texts
        rows.append((400 + i, " ".join(base[:30]) + " " + " ".join(f"o{k}" for k in rng.integers(0, 9999, 40))))
    assert join_rows(spark, rows) == brute_components(rows)


def test_join_with_long_lists_of_ordinary_shingles(spark, monkeypatch):
    """No shingle is frequent in a batch; lists of more than two sets are moved
    by their exact counts, and the links stay those of all pairs."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 10 ** 6)
    rng = np.random.default_rng(6)
    rows = []
    for group in range(6):
        base = [f"g{group}w{k}" for k in range(40)]
        for i in range(12):
            words = list(base)
            for at in rng.integers(0, 40, int(rng.integers(0, 3))):
                words[at] = f"x{rng.integers(0, 5)}"
            rows.append((100 * group + i, " ".join(words)))
    expected = brute_components(rows)
    for longest in (1, 2, 10 ** 6):
        monkeypatch.setattr(ngram_join, "LONG_LIST", longest)
        assert join_rows(spark, rows) == expected


def test_join_of_nulls_repeats_and_nothing(spark):
    out = join_rows(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (9, "a b c d e f")])
    assert out == {1: (2, 1), None: (2, None), 9: (2, 1)}
    assert join_rows(spark, []) == {}


def test_overlap_bounds_are_exact():
    for a in range(1, 60):
        for b in range(a, 75):
            c = ngram_join.least_overlap(a, b)
            links = [i for i in range(a + 1) if 100 * i >= 80 * (a + b - i)]
            assert all(i >= c for i in links) and (not links or links[0] == c)
            if links:
                assert a - c < ngram_join.prefix_length(a) and b - c < ngram_join.prefix_length(b)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 299)]
    out = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert all(out[i] == 0 for i in range(51)) and all(out[k] == 100 for k in range(100, 160))
    assert out[300] == out[299] == 299


def test_neighbours_recall_and_exact_scores(spark):
    found = op1_nearest(spark, SF).toPandas()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas().sort_values("vec_id")
    x, ids = np.array(table.embedding.tolist(), dtype=float), table.vec_id.to_numpy()
    hits = 0
    queries = np.flatnonzero(ids % 100 == 0)
    for i in queries:
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        d[i] = np.inf
        own = found[found.query_id == ids[i]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11))
        assert np.allclose(own.score, [d[np.searchsorted(ids, v)] for v in own.vec_id], atol=0, rtol=1e-12)
        hits += len(set(own.vec_id) & set(ids[np.lexsort((ids, d))[:10]]))
    assert hits >= 0.9 * 10 * len(queries)


def test_each_candidate_is_measured_once(spark):
    """What a query meets in its leaves, over all trees, is one row per candidate:
    the rows of all leaves it visits, each once."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 8))
    forest = ann.grow_forest(x, trees=5, leaf=20)
    frame = pd.DataFrame({"vec_id": np.arange(600), "vector": list(x)})
    rows = pd.concat(ann._row_leaves(forest)(iter([frame])))
    asked = next(ann._query_leaves(forest, 30)(iter([frame.iloc[:1]])))
    met = [i for leaf, group in asked.groupby("leaf")
           for i in ann._nearest(1000)(rows[rows.leaf == leaf], group)["vec_id"]]
    every = set(rows[rows.leaf.isin(asked.leaf)].vec_id) - {0}
    assert sorted(met) == sorted(every) and 100 < len(met) < 599


def test_neighbours_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [None, 1.0]),
            (6, [1.0, 0.5]), (6, [1.0, 0.5]), (7, [1.0, float("inf")]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    rows += [(100 + k, [3.0, 3.0]) for k in range(40)]
    frame = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<float>, score double")
    out = ann.nearest_neighbours(frame, lambda i: i % 100 == 0).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in out if r.query_id == 0] == [1, 6, *range(100, 108)]
    assert [r.vec_id for r in out if r.query_id == 100] == list(range(101, 111))
    assert ann.nearest_neighbours(frame.limit(0), lambda i: i % 100 == 0).count() == 0


def auc(score, label):
    rank = score.rank()
    pos = label.sum()
    return (rank[label == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(label) - pos))


@pytest.mark.parametrize("module, label, least", [(toxicity, "toxic", 0.9), (quality, "quality", 0.98)])
def test_held_out_accuracy(spark, module, label, least):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    out = module.score_documents(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert out.score.between(0, 1).all() and auc(out.score, out[label]) > least
    assert (out.predicted == out[label]).mean() > max(out[label].mean(), 1 - out[label].mean()) + 0.05


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_scores_of_odd_rows(spark, module, label):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.1), (None, "good words here", 0.2), (3, "bad bad", 0.3),
                                  (3, "bad bad", 0.3), (4, "x" * 100_000, 0.4)], "doc_id long, text string, score double")
    for labels in ([], [(1, None), (2, 1), (3, 0), (3, 1), (None, 1)], [(1, 0), (2, 0)]):
        frame = spark.createDataFrame(labels, f"doc_id long, {label} int")
        out = module.score_documents(docs, frame).collect()
        assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert module.score_documents(docs.limit(0), frame).count() == 0


def test_machine_margins_equal_a_loop_over_pairs():
    rng = np.random.default_rng(4)
    model = toxicity.FactorizationMachine(np.arange(9), 0.3, rng.normal(size=9), rng.normal(size=(9, 5)))
    rows = [np.flatnonzero(rng.random(9) < 0.5) for _ in range(20)] + [np.zeros(0, dtype=int)]
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    found = model.margins(doc, np.concatenate(rows), len(rows))
    for terms, margin in zip(rows, found, strict=True):
        loop = 0.3 + sum(model.weights[i] for i in terms) + sum(
            model.factors[i] @ model.factors[j] for i in terms for j in terms if i < j)
        assert margin == pytest.approx(loop, abs=1e-9)


def test_bin_sums_equal_a_loop_over_bins():
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(400, 4)), 1)  # values on the edges too
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.fit_model(x, y, rounds=5, pair_rounds=8)
    assert (0, 1) in model.pairs and (((model.margins(x) > 0) == y).mean() > 0.9)
    for row, margin in zip(x[:50], model.margins(x[:50]), strict=True):
        at = lambda edges, v: sum(e <= v for e in edges)
        loop = model.base + sum(t[at(e, v)] for t, e, v in zip(model.tables, model.edges, row, strict=True))
        loop += sum(t[at(model.pair_edges[i], row[i]), at(model.pair_edges[j], row[j])]
                    for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        assert margin == pytest.approx(loop, abs=1e-9)


def test_machine_learns_a_pair_that_no_sum_can():
    rng = np.random.default_rng(2)
    rows, y = [], []
    for _ in range(800):  # toxic only when exactly both terms or neither are there
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append(np.flatnonzero([a, b, rng.random() < 0.5]))
        y.append(float(a == b))
    model = toxicity.fit_machine(rows, np.array(y), np.arange(3), epochs=150, seed=1)
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    margin = model.margins(doc, np.concatenate(rows), len(rows))
    assert ((margin > 0) == (np.array(y) > 0)).mean() > 0.95


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_model(x, y, rounds=20, pair_rounds=60, n_pairs=3)
    assert ((model.margins(x) > 0) == (y > 0)).mean() > 0.9 and (0, 1) in model.pairs


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li>Menu</li></ul></nav><!-- x --><div class="ad">Buy</div>%s<footer>&copy; us</footer></body></html>"""


def test_article_text_by_structure():
    html = PAGE % ("<article><header><h1>Title &amp; more</h1></header><p>One\n two<p>Three <b>bold</b>&#8212;x"
                   "<aside>Side</aside><div id='comments'><p>First!</div><p>Last<form><input>Go</form></article>")
    assert html_text.main_text(html_text.page_lines(html), None) == "Title & more\nOne two\nThree bold—x\nLast"
    assert html_text.page_lines("") == [] and html_text.page_lines(None) == []
    assert html_text.page_lines("a < b &lt;p&gt; <p") == [("a < b <p>", html_text.PLAIN)]


@pytest.mark.parametrize("html, text", [
    ('<div class="layout has-sidebar"><article>Body text</article><div class="sidebar">Links</div></div>', "Body text"),
    ('<div id="page" class="no-comments"><main>Main text</main></div>', "Main text"),
    ('<section class="market share">Share of the market</section>', "Share of the market"),
    ('<form id="aspnetForm"><article>In a form</article></form>', "In a form"),
    ('<article>Text</article><form>Send it</form>', "Text"),
    ('<p class="ad">Buy<div>Real text</div>', "Real text"),
    ("<p title=don't>Hello <b>it's</b> me", "Hello it's me"),
    ('<p class="x>not lost</p><p>kept</p>', "not lost\nkept"),
    ('<main><p>Text</p></main><div class="comments"><article>A comment longer than the text</article></div>', "Text"),
    ('<div class="comments">Only comments here, most of the page</div><p>Text</p>', "Text"),
    ('<div class="ad">An advert that is longer than the article</div><article>Short</article>', "Short"),
    ('<div class="promo">Buy</div><p>Plain text of a page</p>', "Plain text of a page"),
    ('<article>Teaser</article><p>A plain text that is much longer than the teaser beside it, by far</p>',
     "Teaser\nA plain text that is much longer than the teaser beside it, by far")])
def test_structure_cannot_empty_a_page(html, text):
    assert html_text.main_text(html_text.page_lines(html), None) == text


def test_odd_pages_take_linear_time(spark):
    import time
    start = time.perf_counter()
    for html in ('<p title="' * 20_000, "<p class=ad>x " * 20_000, "<div class=ad>x " * 20_000, "<b>" * 20_000 + "</i>" * 20_000,
                 "<" * 50_000, "<!--" * 20_000, "x" * 1_000_000):
        html_text.page_lines(html)
    assert time.perf_counter() - start < 6
    for other in (np.tile([1, 2], 10_000), np.tile([2, 2, 1, 3], 5_000), np.full(20_000, 1)):
        start = time.perf_counter()
        hit = html_text.shared_lines(np.tile([1, 2], 10_000).astype(np.uint64), other.astype(np.uint64))
        assert hit.sum() >= 10_000 and time.perf_counter() - start < 2
    rows = [(i, "http://h/" + "a" * 100_000 + str(i), f"<p>same</p><p>own {i}</p>") for i in range(4)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.text for r in html_text.extract_main_text(frame).collect()} == {f"own {i}" for i in range(4)}


def test_long_common_subsequences_are_halved(monkeypatch):
    monkeypatch.setattr(html_text, "LCS_BITS", 60)
    rng = np.random.default_rng(2)
    for _ in range(40):
        a, b = (rng.integers(0, 6, int(rng.integers(0, 40))).astype(np.uint64) for _ in range(2))
        longest = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                longest[i + 1, j + 1] = longest[i, j] + 1 if x == y else max(longest[i, j + 1], longest[i + 1, j])
        hit = html_text.shared_lines(a, b)
        rest = iter(b.tolist())
        assert hit.sum() == longest[-1, -1] and all(x in rest for x in a[hit].tolist())


def test_main_text_equals_a_plain_reading(spark):
    """Generated pages of one host: the result is what their generator calls the text."""
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for i in range(40):
        own = [f"Paragraph {i} {k} says something of its own" for k in range(int(rng.integers(1, 6)))]
        body = "".join(f"<p>{x.replace(' of ', ' <i>of</i>  ')}</p>" for x in own)
        body = body if i % 2 else f"<article>{body}</article>"
        html = (f"<html><head><title>x</title></head><body><nav>Home</nav><div>Site line</div>{body}<div>Since 1999</div>"
                f"<div class='comments'><p>Reader {i} writes</p></div><footer>Imprint</footer></body></html>")
        rows.append((i, f"https://host.org/{'ab'[i % 2]}/page-{i:03d}", html))
        want[i] = "\n".join(own)
    out = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == want


def test_only_text_lines_move_between_tasks(spark):
    """What the joins take in holds no HTML, and packing the lines loses none."""
    frame = spark.createDataFrame([(i, f"http://h/{i}", PAGE % f"<p>1 {i}</p>") for i in range(4)],
                                  "page_id long, url string, html string")
    plan = html_text.extract_main_text(frame)._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan[:plan.index("Join")]  # the nodes above the join
    lines = html_text.page_lines("<p>1&#10;a\u2028b&#133;c</p><article><p>2</p>&#x1c; d</article>")
    assert html_text.unpacked(html_text.packed(lines)) == lines and len(lines) == 3
    assert html_text.unpacked(html_text.packed([])) == []


def test_shared_lines_go_where_there_is_no_article(spark):
    rows = [(i, f"http://h/a/{i}", PAGE % f"<div>Welcome to the site</div><p>Story {i}</p><div>Read on</div>") for i in (1, 2)]
    rows += [(3, "http://other/x", PAGE % "<p>Alone</p>"), (4, None, None), (None, "http://h/a/3", PAGE % "<p>No id</p>"),
             (5, "http://c/1", PAGE % "<p>Copy</p>"), (6, "http://c/2", PAGE % "<p>Copy</p>"), (6, "http://c/2", "<p>Again</p>")]
    frame = spark.createDataFrame([(i, u, h, 1) for i, u, h in rows], "page_id long, url string, html string, lines int")
    out = html_text.extract_main_text(frame).collect()
    assert sorted((r.page_id or -1, r.text, r.n_chars) for r in out) == sorted([
        (1, "Story 1", 7), (2, "Story 2", 7), (3, "Alone", 5), (4, "", 0), (-1, "No id", 5), (5, "Copy", 4),
        (6, "Copy", 4), (6, "Again", 5)])
    assert html_text.extract_main_text(frame.limit(0)).count() == 0


def test_pages_with_an_article_are_differenced_too(spark):
    page = ("<div>Welcome</div><p>Intro %d</p><article><p>Story %d tells of many things at some length</p><p>%s</p>"
            "<div class='author-box'>By the editors</div></article>")
    rows = [(i, f"http://h/a/{i}", PAGE % page % (i, i, "A quote two pages have" if i < 3 else f"More {i}"))
            for i in range(1, 6)]
    rows += [(i, f"http://c/{i}", PAGE % "<article><p>Copied text</p><p>and more of it</p></article>") for i in (6, 7, 8)]
    out = html_text.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    text = {r.page_id: r.text for r in out}
    for i in range(1, 6):
        quote = "A quote two pages have" if i < 3 else f"More {i}"
        assert text[i] == f"Intro {i}\nStory {i} tells of many things at some length\n{quote}"
    assert {text[i] for i in (6, 7, 8)} == {"Copied text\nand more of it"}


def test_pages_meet_their_neighbours_in_the_host(spark, monkeypatch):
    urls = sorted([("h%d" % (i % 3), f"/{i % 7}/{i:03d}/page") for i in range(60)] + [("lone", "/a"), ("two", "/a/x"), ("two", "/b")])
    pages = [(i, f"http://{host}{path}") for i, (host, path) in enumerate(urls)]
    frame = spark.createDataFrame(pages, "page_id long, url string").orderBy(F.rand(1))
    want = {}
    for i, (host, _) in enumerate(urls):
        mates = [k for k, (other, _) in enumerate(urls) if other == host and k != i]
        want[i] = set([k for k in (i - 1, i + 1) if k in mates] if i - 1 in mates and i + 1 in mates
                      else sorted(mates, key=lambda k: abs(k - i))[:2])
    for ranges in (1, 5, 40):
        monkeypatch.setattr(html_text, "range_count", lambda n, ranges=ranges: ranges)
        near = {r.page_id: set(r.near) for r in html_text.url_neighbours(frame).collect()}
        assert near == {i: mates for i, mates in want.items() if mates}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=12))
def test_shared_lines_are_a_longest_common_subsequence(a, b):
    length = np.zeros((len(a) + 1, len(b) + 1), dtype=int)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            length[i + 1, j + 1] = length[i, j] + 1 if x == y else max(length[i, j + 1], length[i + 1, j])
    hit = html_text.shared_lines(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
    assert hit.sum() == length[-1, -1]
    rest = iter(b)
    assert all(x in rest for x, h in zip(a, hit, strict=True) if h)
