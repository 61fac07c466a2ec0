"""Nearest neighbours against brute force; main text on pages of several designs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mailsift.llm import maintext, neighbours

SMALL = "/root/testdata/sf0.001"


def _plain(ids, vectors, query, k=10):
    d = np.sqrt(((vectors - vectors[list(ids).index(query)]) ** 2).sum(1))
    near = sorted((x, i) for x, i in zip(d.tolist(), ids) if i != query)
    return near[:k]


def test_recall_and_exact_scores_over_lists(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LIST_ROWS", 100)
    monkeypatch.setattr(neighbours, "PART", 150)
    monkeypatch.setattr(neighbours, "PART_QUERIES", 7)
    rng = np.random.default_rng(0)
    centre = rng.standard_normal((8, 32)) * 2
    vectors = centre[rng.integers(8, size=2000)] + rng.standard_normal((2000, 32))
    vectors[500:900] = vectors[500]                       # a crowd of equal vectors
    ids = list(range(2000))
    df = spark.createDataFrame([(i, v.tolist(), "mine") for i, v in zip(ids, vectors)],
                               "vec_id long, embedding array<double>, rank string")
    got = neighbours.nearest_rows(df, F.col("vec_id") % 20 == 0).collect()
    hits = total = 0
    for q in ids[::20]:
        want = _plain(ids, vectors, q)
        mine = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [(m[2], m[1]) for m in mine] == sorted((m[2], m[1]) for m in mine)
        for _, i, score in mine:
            assert score == pytest.approx(np.sqrt(((vectors[i] - vectors[q]) ** 2).sum()), rel=1e-12)
        if 500 <= q < 900:                                # ties go to the smaller ids
            assert [m[1] for m in mine] == [i for i in range(500, 511) if i != q][:10]
        hits += len({m[1] for m in mine} & {i for _, i in want})
        total += 10
    assert hits / total >= 0.9


@pytest.mark.parametrize("kind", ["gaussian", "clustered"])
def test_recall_of_the_scan_with_a_small_sample(spark, kind):
    """The sample is a twentieth of the table and gives no answers; the lists must."""
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((20_000, 64))
    if kind == "clustered":
        vectors = rng.standard_normal((50, 64))[rng.integers(50, size=20_000)] * 3 + vectors * 0.5
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)],
                               "vec_id long, embedding array<double>").repartition(8)
    got = neighbours.nearest_rows(df, F.col("vec_id") % 200 == 0, sample=1_000).collect()
    hits = 0
    for q in range(0, 20_000, 200):
        d = ((vectors - vectors[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert len(got) == 1000 and hits / 1000 >= 0.95


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [None, 1.0]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]), (None, [1.0, 1.0]),
            (100, [2.0, 0.0]), (100, [2.0, 0.0]), (200, None), (8, [1e200, 1e-200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest_rows(df, F.col("vec_id") % 100 == 0).collect()
    assert {r.query_id for r in got} == {0, 100}
    assert sorted((r["rank"], r.vec_id) for r in got if r.query_id == 100) == [(1, 0), (2, 1), (3, 8)]
    assert sorted(r.vec_id for r in got if r.query_id == 0) == [1, 8, 100]
    assert neighbours.nearest_rows(df.limit(0), F.lit(True)).count() == 0
    assert neighbours.nearest_rows(df, F.lit(False)).count() == 0


@pytest.fixture(scope="module")
def forest(spark):
    return maintext.train(spark.read.parquet(f"{SMALL}/pages.parquet"))


PAGES = {
    "<article><h1>A &lt; B</h1><p>First&nbsp;one,\n  two.</p><p>Second <b>bold</b><br>line.</p></article>"
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav><footer>&copy; 2020</footer>":
    "A < B\n\nFirst one, two.\n\nSecond bold line.",
    "<body><div class='wrap has-sidebar'><div class='post-body'><h1>The title here</h1><p>A paragraph of text, "
    "with words. And more of them to read.</p><p>Second paragraph follows, also with a lot of text.</p></div>"
    "<div id='comments'><p>I think that this is wrong, and I have many words to say.</p></div></div>"
    "<div class='cookie-notice'>We use cookies to make it better, please accept.</div>"
    "<form><label>Mail</label><button>Go</button></form><div class='footer'>Copyright</div></body>":
    "The title here\n\nA paragraph of text, with words. And more of them to read.\n\n"
    "Second paragraph follows, also with a lot of text.",
    "<article><p>Body text one, two three.</p><section class='comments'><p>A reader comment goes here, "
    "long enough.</p></section><script>var t='</p>';</script><style>p{}</style></article>":
    "Body text one, two three.",
    "": "", "<nav><a>x</a></nav>": "", "<article><p>cut off &am": "cut off &am",
}


def test_pages_of_several_designs(spark, forest):
    rows = [(i, "u", h, "mine") for i, h in enumerate(PAGES)] + [(99, None, None, "")] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = maintext.main_text(df, forest=forest).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert [by[i].text for i in range(len(PAGES))] == list(PAGES.values())
    assert all(r.n_chars == len(r.text) for r in got) and by[99].text == ""


def test_labelling_has_no_contradictions(forest):
    for html in PAGES:
        page = maintext.Page(html)
        text = maintext.decode(page, forest.odds(maintext.features(page)))
        blocks = [t for t in page.text if t]
        kept = [t for t in text.split("\n\n") if t]
        assert [b for b in blocks if b in kept] == kept


def test_labelling_is_the_best_of_all_consistent_ones():
    """On small trees, against every labelling without contradictions."""
    import itertools

    rng = np.random.default_rng(4)
    for _ in range(60):
        page = maintext.Page("<div>" * 2 + "".join(
            f"<{t}>w{i}</{t}>" + ("</div><div>" if rng.random() < 0.4 else "")
            for i, t in enumerate(["p", "li", "h2", "p", "section"][:rng.integers(1, 6)])))
        odds = rng.normal(0, 3, len(page.tag))
        yes, no = -np.log1p(np.exp(-odds)), -np.log1p(np.exp(odds))
        below = [[j for j, p in enumerate(page.parent) if p == i] for i in range(len(page.tag))]

        def under(i):
            return [i] + [k for j in below[i] for k in under(j)]

        def options(i):
            leaves = frozenset(k for k in under(i) if page.tag[k] == "#text")
            out = [(yes[under(i)].sum(), leaves), (no[under(i)].sum(), frozenset())]
            if page.tag[i] != "#text":
                for some in itertools.product(*map(options, below[i])):
                    out.append((sum(s for s, _ in some) - maintext.MIXED_PRICE,
                                frozenset().union(*[k for _, k in some])))
            return out

        every = options(0)
        best = max(s for s, _ in every)
        texts = {"\n\n".join(page.text[k] for k in sorted(kept)) for s, kept in every if s > best - 1e-9}
        assert maintext.decode(page, odds) in texts


def test_a_hundred_thousand_paragraphs_take_linear_time():
    import time

    took = []
    for n in (20_000, 100_000):
        page = maintext.Page("<article>" + "<p>some words, in a row.</p>" * n + "</article>")
        t0 = time.perf_counter()
        assert len(maintext.features(page)) == 2 * n + 2
        took.append(time.perf_counter() - t0)
    assert took[1] < 12 * took[0]


def test_held_out_pages_and_nothing(spark, forest):
    """The trees, fitted on a sample, give the marked main text of every other page."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wrong = 0
    for r in maintext.main_text(pages, forest=forest).join(pages, "page_id").collect():
        page = maintext.Page(maintext.disguise(r.html, 0, 0))
        want = [t for t, y in zip(page.text, maintext.labels(page)) if t and y == 1]
        wrong += r.text != "\n\n".join(want)
    assert wrong <= 2
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert maintext.main_text(empty).count() == 0
    bare = spark.createDataFrame([(1, "u", "<p>Nothing marked, just text.</p>")],
                                 "page_id long, url string, html string")
    assert maintext.main_text(bare).first().text == "Nothing marked, just text."


def test_very_long_and_deep_pages(spark, forest):
    deep = "<div>" * 3000 + "<p>inside</p>" + "</div>" * 3000
    long = "<article>" + "<p>some words, in a row.</p>" * 5000 + "</article>"
    df = spark.createDataFrame([(1, "u", deep), (2, "u", long)],
                               "page_id long, url string, html string")
    got = {r.page_id: r.text for r in maintext.main_text(df, forest=forest).collect()}
    assert got[2].count("\n\n") == 4999 and set(got) == {1, 2}


@pytest.mark.parametrize("odd, said", [
    ("<![foo bar]>", []), ("<![ if x]>", []), ("<![]>", []), ("<![1]]>", []), ("<![if !IE]>", []),
    ("&#" + "9" * 5000 + ";", ["\ufffd"]), ("&#" + "0" * 5000 + "65;", ["A"])])
def test_text_behind_malformed_markup_is_kept(spark, forest, odd, said):
    page = maintext.Page(f"<p>one</p>{odd}<p>two</p>")
    assert [t for t in page.text if t] == ["one", *said, "two"]
    html = f"<article><p>Some words, here.</p>{odd}<p>And more words, behind it.</p></article>"
    df = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    assert maintext.main_text(df, forest=forest).first().text == "\n\n".join(
        ["Some words, here.", *said, "And more words, behind it."])
