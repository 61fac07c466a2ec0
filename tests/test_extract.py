"""Item extraction (X1-X6) on hand-written fixtures; expected rows written by hand."""

from pyspark.sql import functions as F

from mailsift.operators.extract import (
    dedupe_in_message, extract_anchors, extract_items, keep_links, page_items, parse_page,
    parsed_pages,
)


def items_of(spark, html, **options):
    df = spark.createDataFrame([(1, html)], "uid long, html string")
    return sorted(tuple(r)[1:] for r in extract_items(df, **options).collect())


ALERT = """<html><body>
<table><tr><td>
<h3><a href="https://example.org/paper1">Paper <b>One</b>: fast &amp; exact</a></h3>
<div>Authors A, B - Journal 2025</div>
<div>First abstract text&nbsp;here.</div>
</td></tr>
<tr><td><a href="https://example.org/p2">Two</a> short title skipped</td></tr>
<tr><td><p><a href="http://x.org/p3">Third paper title</a> Third paper title again and more</p></td></tr>
<tr><td><a href="/relative/link">Relative link title</a></td></tr>
<tr><td><a>No href anchor text</a></td></tr>
<tr><td><a href="https://scholar.google.com/scholar_url?x=1">Scholar redirect item</a></td></tr>
</table>
<p><a href="https://example.org/paper1">Paper <b>One</b>: fast &amp; exact</a></p>
</body></html>"""

ALERT_ITEMS = [
    (1, "PaperOne: fast & exact", "https://example.org/paper1",
     "Paper One : fast & exact Authors A, B - Journal 2025 First abstract text\u00a0here."),
    (3, "Third paper title", "http://x.org/p3", "again and more"),
    (5, "Scholar redirect item", "https://scholar.google.com/scholar_url?x=1", None),
]

SOUP = """<body>
<a href="https://e.org/c">Gamma item</a><span> Gamma   note </span>
<div><a href="https://e.org/d">Delta item</a><br></div>
<p>Intro <a href="https://e.org/e">Epsilon item</a> tail<p>Next para
<div><script>var x="<a href='https://e.org/z'>Zeta fake</a>";</script><a href="https://e.org/f">Phi item</a> after</div>
<ul><li><a href="https://e.org/g">Gee item</a><li>second</ul>
<div><a href='https://e.org/h?a=1&amp;b=2'>Eta&#39;s  item </a> x</div>
</body>"""

SOUP_ITEMS = [
    (1, "Gamma item", "https://e.org/c", "Gamma   note"),
    (2, "Delta item", "https://e.org/d", ""),
    (3, "Epsilon item", "https://e.org/e", "Intro  tail"),
    (4, "Phi item", "https://e.org/f", "after"),
    (5, "Gee item", "https://e.org/g", None),
    (6, "Eta's  item", "https://e.org/h?a=1&b=2", "x"),
]


def test_items_of_tag_soup(spark):
    assert items_of(spark, SOUP) == SOUP_ITEMS


def test_items_empty_and_dedupe_off(spark):
    assert items_of(spark, "") == [] and parse_page(None) == ([], [], None)
    assert [i[0] for i in items_of(spark, ALERT, dedupe=False)] == [1, 3, 5, 6]


def test_items_custom_predicate(spark):
    items = items_of(spark, ALERT, min_len=1, contains=(), prefixes=("/",))
    assert items == [(4, "Relative link title", "/relative/link", None)]


def test_extract_items_job_matches_single_document(spark):
    df = spark.createDataFrame([(10, ALERT), (11, SOUP), (12, None), (13, "")],
                               "uid long, html string")
    got = sorted(tuple(r) for r in extract_items(df).collect())
    want = sorted([(10, *i) for i in ALERT_ITEMS] + [(11, *i) for i in SOUP_ITEMS])
    assert got == want


WELL_FORMED = """<ul>
<li><a href="https://a.org/1">First <i>item</i></a></li>
<li><a class="x" href='https://a.org/2' target=_blank>Second &amp; more</a></li>
<li><a href=https://a.org/3>third</a></li>
<li><a name="anchor">no link here</a></li>
<li><A HREF="https://a.org/4">  Fourth&nbsp;</A></li>
<li><a href="https://a.org/1">First <i>item</i></a></li>
</ul>"""


def test_native_extract_matches_parser_on_well_formed(spark):
    df = spark.createDataFrame([(1, WELL_FORMED)], "uid long, html string")
    native = keep_links(extract_anchors(df), min_len=4, contains=(), prefixes=("http",))
    got = sorted((r.pos, r.title, r.link) for r in native.collect())
    parsed = [i[:3] for i in items_of(spark, WELL_FORMED, dedupe=False)]
    assert got == sorted(parsed)
    assert got[0] == (1, "Firstitem", "https://a.org/1")
    assert (2, "Second & more", "https://a.org/2") in got
    assert (4, "Fourth", "https://a.org/4") in got


def test_dedupe_in_message_first_wins(spark):
    df = spark.createDataFrame([(1, WELL_FORMED)], "uid long, html string")
    a = extract_anchors(df)
    d = dedupe_in_message(a).filter(F.col("title") == "Firstitem").collect()
    assert [r.pos for r in d] == [1]


def test_native_numeric_references_match_html_unescape(spark):
    import html as _html

    title = ("Li&#8211;ion &#x2019;s &#39;q&#39; &#128512; &#0; &#150; &#x1F600; &#xD800; "
             "&#1114112; &#xFDD0; &amp;#38; x")
    page = f'<p><a href="https://e.org/n">{title}</a></p>'
    df = spark.createDataFrame([(1, page)], "uid long, html string")
    got = extract_anchors(df).first().title
    assert got == _html.unescape(title).strip()
    assert got == items_of(spark, page)[0][1]


def test_title_length_boundary_and_nbsp(spark):
    page = ('<div><a href="https://e.org/3">abc</a></div>'
            '<div><a href="https://e.org/4"> abcd </a></div>'
            '<div><a href="https://e.org/4b"> ab&nbsp;</a></div>')
    got = [(t, li) for _, t, li, _ in items_of(spark, page)]
    assert got == [("abcd", "https://e.org/4")]


def test_keyword_phrase_spans_title_and_abstract(spark):
    from mailsift.operators.items import keyword_filter

    df = spark.createDataFrame([(1, "Solid", "Electrolyte study"), (2, "Solid", None),
                                (3, "x", "contains solidelectrolyte")],
                               "uid long, title string, abstract string")
    got = sorted(r.uid for r in keyword_filter(df, ["solid electrolyte"]).collect())
    assert got == [1]


ODD = ["<![ if !mso]>", "<![foo bar]>", "<![]>", "<![endif]-->", "&#" + "9" * 5000 + ";",
       "&#" + "0" * 5000 + "65;", "<!x>", "</>", "<?php a > b ?>", "&#;", "&#x110000;"]


def test_odd_markup_keeps_its_items_and_the_job(spark):
    """Markup that the standard library's parser gives up on costs neither items nor the job."""
    page = '<div><a href="https://e.org/1">Before it</a></div>{}<p><a href="https://e.org/2">After it</a></p>'
    df = spark.createDataFrame([(i, page.format(x)) for i, x in enumerate(ODD)], "uid long, html string")
    got = {}
    for r in extract_items(df).collect():
        got.setdefault(r.uid, []).append(r.title)
    assert {i: sorted(t) for i, t in got.items()} == {
        i: ["After it", "Before it"] for i in range(len(ODD))}
    assert parsed_pages(df).filter("error is not null").count() == 0
    assert parse_page("x &#" + "0" * 5000 + "65; &#" + "9" * 5000 + ";")[0] == ["x A \ufffd"]


def test_parsed_page_is_linear_in_the_page():
    """4,000 links in one block: spans of the same pieces, not 4,000 copies of the block."""
    import time

    page = "<div>" + "".join(f'<a href="https://e.org/{i}">Link number {i}</a> note {i} '
                             for i in range(4000)) + "</div>"
    t0 = time.perf_counter()
    pieces, anchors, error = parse_page(page)
    assert time.perf_counter() - t0 < 1.0 and error is None
    assert len(anchors) == 4000 and sum(map(len, pieces)) < len(page)
    assert anchors[7][1:] == (14, 15, 0, 8000, 16, 17) and pieces[14:16] == ["Link number 7", "note 7"]
    deep = "<p>" + "<span>" * 20000 + '<a href="https://e.org/x">Deep</a>' + "<div></div></span>" * 20000
    t0 = time.perf_counter()
    assert parse_page(deep)[1][0][1:3] == (0, 1) and time.perf_counter() - t0 < 2.0


def test_only_kept_anchors_get_context(spark):
    """The predicate acts before texts are put together."""
    page = "<div>" + "".join(f'<a href="/r/{i}">Relative {i}</a>' for i in range(3000)) + \
        '<a href="https://e.org/1">Kept link</a> with a note</div>'
    df = spark.createDataFrame([(1, page)], "uid long, html string")
    rows = page_items(parsed_pages(df)).collect()
    assert [(r.pos, r.title) for r in rows] == [(3001, "Kept link")]
    assert rows[0].abstract.startswith("Relative 0 Relative 1 ") and \
        rows[0].abstract.endswith("Relative 2999  with a note")


def test_text_of_quiet_elements_belongs_to_no_item(spark):
    page = ('<div><a href="https://e.org/1">Open <style>x{}</style>item</a><template>hidden '
            '<a href="https://e.org/2">Hidden item</a></template> shown</div>')
    assert items_of(spark, page) == [(1, "Openitem", "https://e.org/1", "Open item shown")]


def test_references_equal_html_unescape(spark):
    """All names with and without their semicolon, in and before other text; odd numbers."""
    import html
    from html.entities import html5

    from mailsift.operators.extract import decode_references

    texts = [f"&{n}" for n in html5] + [f"x&{n.rstrip(';')}yz" for n in html5] \
        + [f"&{n.rstrip(';')}; &amp;{n}" for n in html5] \
        + [f"&#{i};" for i in (0, 13, 65, 128, 150, 159, 0xD800, 0xFDD0, 0xFFFE, 0x10FFFF, 0x110000)] \
        + ["&", "&&", "a & b", "&;", "&#;", "&#x;", "&#65", "&#x41z", "&#65a", "?a=1&b=2&copy=3&lt=4",
           "&notit;", "&amp;lt;", "&ampamp;", "&" + "x" * 40, "no reference", "", "&unknown; &amp"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {r.k: r.d for r in df.select("k", decode_references("t").alias("d")).collect()}
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]
