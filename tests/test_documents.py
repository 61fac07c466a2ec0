"""Prompts, lists, reports and outlines on hand-built items; expected text by hand."""

import pytest

from mailsift.operators.documents import (
    build_prompts, items_panel, markdown_outline, ordered_text, render_item_list,
    report_metadata,
)

ITEMS = [("d1", 1, "First <T>", "https://a/1", None),
         ("d1", 2, "Second", "https://a/2", ""),
         ("d1", 3, "Third", "https://a/3", "Abs & <x>"),
         ("d2", 1, "Only", "https://b/1", "B")]
SCHEMA = "rep string, ordinal int, title string, link string, abstract string"


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, SCHEMA)


def test_prompt_without_keywords(items):
    rows = {r.rep: r for r in build_prompts(items, [], ["rep"]).collect()}
    p = rows["d1"].prompt
    assert "Work with every one of them." in p
    assert p.endswith("Papers:\n"
                      "1. Title: First <T>\n   Link: https://a/1\n\n"
                      "2. Title: Second\n   Link: https://a/2\n\n"
                      "3. Title: Third\n   Link: https://a/3\n   Abstract: Abs & <x>\n")
    assert rows["d1"].n_items == 3 and rows["d1"].chunk == 0


def test_prompt_with_keywords(items):
    p = build_prompts(items, [" Lithium", "", "ion"], ["rep"]).filter("rep = 'd2'").first().prompt
    assert "bear on: lithium; ion." in p
    assert p.endswith("1. Title: Only\n   Link: https://b/1\n   Abstract: B\n")


@pytest.mark.parametrize("size", [1, 2, 3])
def test_parts_join_to_the_one_document(items, size):
    for make, col in ((render_item_list, "markdown"),
                      (lambda *a, **k: items_panel(a[0], [], a[1], **k), "items_html")):
        whole = {r.rep: r[col] for r in make(items, ["rep"]).collect()}
        parts = sorted((r.rep, r.chunk, r[col])
                       for r in make(items, ["rep"], items_per_part=size).collect())
        for rep, text in whole.items():
            assert "".join(t for r, _, t in parts if r == rep) == text


def test_one_prompt_per_report_of_any_size(spark):
    big = spark.range(1, 2001).selectExpr("'r' rep", "int(id) ordinal", "concat('T', id) title",
                                          "'l' link", "string(null) abstract")
    rows = build_prompts(big, [], ["rep"]).collect()
    assert len(rows) == 1 and rows[0].n_items == 2000 and "2000. Title: T2000" in rows[0].prompt


def test_item_list(items):
    md = render_item_list(items, ["rep"], heading="# H").filter("rep = 'd2'").first().markdown
    assert md == "# H\n\n1. Only\n   Link: https://b/1\n   Abstract: B\n\n"


def test_ordered_text_ignores_input_order(items):
    shuffled = items.repartition(3)
    r = ordered_text(shuffled, ["rep"], "ordinal", "title", sep="|").filter("rep = 'd1'").first()
    assert r.text == "First <T>|Second|Third"


def test_metadata_and_panel(items):
    m = report_metadata(items, ["a", "b", "c", "d", "e", "f"], ["rep"], "2025-11-19 09:05:00")
    r = m.filter("rep = 'd1'").first()
    assert (r.total, r.keywords_preview, r.footer_keywords, r.generated_on) == (
        3, "a, b, c, d, e...", "a, b, c...", "November 19, 2025 at 09:05 AM")
    panel = items_panel(items, [], ["rep"]).filter("rep = 'd1'").first()
    assert panel.badges == '<kbd>all items</kbd>'
    assert "First &lt;T&gt;" in panel.items_html
    assert "<p>Abs & &lt;x&gt;</p>" in panel.items_html
    assert panel.items_html.count("<p>") == 1


def test_markdown_outline(spark):
    md = ("# Report\n## Selected Papers\n### 1. Paper A\ntext\n### 1. Paper A\n"
          "## Ideas ##\n### Idea: one!\n#not a heading\n")
    df = spark.createDataFrame([(7, md)], "doc long, markdown string")
    got = [tuple(r) for r in markdown_outline(df, ["doc"]).orderBy("line_no").collect()]
    assert got == [
        (7, 1, 1, "Report", "report", None),
        (7, 2, 2, "Selected Papers", "selected-papers", "Selected Papers"),
        (7, 3, 3, "1. Paper A", "1-paper-a", "Selected Papers"),
        (7, 5, 3, "1. Paper A", "1-paper-a_1", "Selected Papers"),
        (7, 6, 2, "Ideas", "ideas", "Ideas"),
        (7, 7, 3, "Idea: one!", "idea-one", "Ideas"),
    ]


def test_report_escapes_body_and_terms(spark):
    from mailsift.operators.documents import render_report

    items = spark.createDataFrame([("d1", 1, "T", "L", None)], SCHEMA)
    meta = report_metadata(items, ["a&b", "<c>"], ["rep"], "2025-11-19 09:05:00")
    body = spark.createDataFrame([("d1", 0, "x < y & z > w")], "rep string, chunk int, summary string")
    html = render_report(meta, body, ["rep"]).first().html
    assert "x &lt; y &amp; z &gt; w" in html
    assert "<dd>a&amp;b, &lt;c&gt;</dd>" in html
    assert "<dt>Total items</dt><dd>1</dd>" in html


@pytest.mark.parametrize("bound", [1, 150, 5000])
def test_parts_by_bytes_join_to_the_one_document(spark, bound):
    from mailsift.operators.documents import render_report

    items = spark.range(1, 2102).selectExpr(
        "if(id > 2050, null, 'r') rep", "int(if(id > 2050, id - 2050, id)) ordinal",
        "concat('T', repeat('\u00e9', int(id % 60))) title", "'l' link", "string(null) abstract")
    for make, col in ((lambda **k: build_prompts(items, [], ["rep"], **k), "prompt"),
                      (lambda **k: render_item_list(items, ["rep"], **k), "markdown"),
                      (lambda **k: items_panel(items, [], ["rep"], **k), "items_html")):
        whole = {r.rep: r[col] for r in make().collect()}
        parts = sorted(make(bytes_per_part=bound).collect(), key=lambda r: r.chunk)
        assert set(whole) == {"r", None} and sum(r.n_items for r in parts) == 2101
        for rep, text in whole.items():
            mine = [r[col] for r in parts if r.rep == rep]
            assert "".join(mine) == text and len(mine) > 1 - (bound == 5000)
            assert max(len(t.encode()) for t in mine[1:] or [""]) < bound + 250
    meta = report_metadata(items, [], ["rep"], "2025-11-19 09:05:00")
    body = spark.createDataFrame([("r", 0, "a"), ("r", 2, "b"), (None, 0, "a\nb")],
                                 "rep string, chunk int, summary string")
    got = sorted(render_report(meta, body, ["rep"]).collect(), key=lambda r: r.chunk)
    joined = "".join(r.html for r in got if r.rep == "r")
    assert joined.count("<!DOCTYPE") == joined.count("</html>") == 1
    assert "<div class=\"md\">a\nb</div>" in joined and joined.endswith("</html>\n")


MARKDOWN = """# Top
```
# not a heading
~~~
## nor this
```
Under
=====
text
-----
## A
~~~~ python
# code
~~~
# still code
~~~~
## A ##
``` `inline` ``` is no fence
### B
    Indented
---
> quoted
---
- item
===
Last
---
```
# open to the end
"""

OUTLINE = [(1, 1, "Top", "top", None), (7, 1, "Under", "under", None), (9, 2, "text", "text", "text"),
           (11, 2, "A", "a", "A"), (17, 2, "A", "a_1", "A"), (19, 3, "B", "b", "A"),
           (26, 2, "Last", "last", "Last")]


def _outline(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, markdown string")
    rows = markdown_outline(df, ["k"]).collect()
    return sorted((r.k, r.line_no, r.level, r.heading, r.slug, r.section) for r in rows)


@pytest.mark.parametrize("above", [0, 1, 240, 250, 255, 256, 257, 511, 700])
def test_outline_of_fences_and_underlines(spark, above):
    """Code has no headings, underlined lines are some, wherever blocks of lines begin."""
    text = "plain\n\n" * (above // 2) + "\n" * (above % 2) + MARKDOWN
    assert _outline(spark, [text, None, ""]) == [
        (0, n + above, *rest) for n, *rest in OUTLINE]


def test_fences_over_many_blocks(spark):
    code = "```\n" + "# no\n" * 900 + "```\n# yes\n"
    assert [r[1:4] for r in _outline(spark, [code * 3])] == [
        (903 * (i + 1), 1, "yes") for i in range(3)]


def test_twenty_thousand_headings_take_linear_time(spark):
    import time

    took = []
    for n in (5_000, 20_000):
        t0 = time.perf_counter()
        rows = _outline(spark, ["# Same heading\n" * n])
        took.append(time.perf_counter() - t0)
        assert len(rows) == n and rows[-1][4] == f"same-heading_{n - 1}"
    assert took[1] < 8 * took[0] + 2
