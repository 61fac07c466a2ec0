"""Items to documents: ordered text (A3), prompts (P1), lists (K2), reports (K5, K6),
Markdown outline (P3).

A report is one document, whatever its size. It can be asked for in parts (off
by default) of ``items_per_part`` items (lists and panels) or of about
``bytes_per_part`` bytes (prompts too): the parts of a report, joined in ``chunk``
order, are the one document byte for byte, the heading standing in the first
part alone. Parts by bytes are over their bound by less than one item, and
their numbers skip some where an item is larger than the bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsift.functions.params import normalise_term_list
from mailsift.functions.text import (
    badge_list, escape_html, format_generated_on, numbered_entry, preview_list, ustrip,
)

# Prompt wording: what to do, the shape of the answer, then the items.
TASK = "Below is a numbered list of papers from today's alerts."
CHOOSE = "Work only with those that bear on: {terms}. Leave the others out."
CHOOSE_ALL = "Work with every one of them."
ANSWER = (
    "Write Markdown in two parts and nothing else.",
    "",
    "# Digest",
    "One level-three section per paper, headed by its title: what was done and found (at most "
    "three sentences), one limitation the authors would admit, and the link as given.",
    "",
    "# Next steps",
    "Five experiments that these papers make possible, one paragraph each: the question, why it "
    "is open, what it needs, and what an answer would change.",
    "",
    "Papers:",
)
LIST_HEADING = "# Alert items (saved)"
PART_BYTES = 32 << 20
ITEMS_PER_BLOCK = 1000


def prompt_head(terms: Sequence[str] | None) -> str:
    terms = normalise_term_list(terms)
    choose = CHOOSE.format(terms="; ".join(terms)) if terms else CHOOSE_ALL
    return "\n".join((TASK, choose, *ANSWER))


def add_chunk(df: DataFrame, ordinal_col: str = "ordinal",
              items_per_part: int | None = None) -> DataFrame:
    """``chunk`` = 0-based block of ``items_per_part`` consecutive ordinals; 0 if not in parts."""
    if not items_per_part:
        return df.withColumn("chunk", F.lit(0))
    return df.withColumn("chunk", F.floor((F.col(ordinal_col) - 1) / items_per_part).cast("int"))


def add_chunk_by_bytes(df: DataFrame, by: Sequence[str], ordinal_col: str, size: Column,
                       bytes_per_part: int) -> DataFrame:
    """``chunk`` = the bytes of a report before the item, over ``bytes_per_part``.

    Summed inside blocks of ordinals, then over the blocks, so no task holds a report.
    """
    sized = df.withColumn("__size", size.cast("long")).withColumn(
        "__block", F.floor((F.col(ordinal_col) - 1) / ITEMS_PER_BLOCK))
    blocks = sized.groupBy(*by, "__block").agg(F.sum("__size").alias("__sum"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    of_report = before(Window.partitionBy(*by).orderBy("__block"))
    heads = blocks.select(*[F.col(b).alias(f"__of_{b}") for b in by],
                          F.col("__block").alias("__of_block"),
                          F.coalesce(F.sum("__sum").over(of_report), F.lit(0)).alias("__head"))
    in_block = before(Window.partitionBy(*by, "__block").orderBy(ordinal_col))
    placed = sized.withColumn("__inside", F.coalesce(F.sum("__size").over(in_block), F.lit(0)))
    same = F.col("__block") == F.col("__of_block")
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__of_{b}"))
    chunk = F.floor((F.col("__head") + F.col("__inside")) / bytes_per_part).cast("int")
    return placed.join(heads, same).select(*df.columns, chunk.alias("chunk"))


def ordered_text(df: DataFrame, by: Sequence[str], ordinal_col: str, text: Column | str,
                 sep: str = "\n", name: str = "text", items_per_part: int | None = None,
                 bytes_per_part: int | None = None) -> DataFrame:
    """A3: per ``by`` (+ ``chunk``), the texts joined in ordinal order.

    A later part starts with the separator, so parts join without one.
    """
    text = F.col(text) if isinstance(text, str) else text
    if bytes_per_part:
        size = F.coalesce(F.octet_length(text), F.lit(0)) + len(sep.encode())
        keyed = add_chunk_by_bytes(df, by, ordinal_col, size, bytes_per_part)
    else:
        keyed = add_chunk(df, ordinal_col, items_per_part)
    lead = F.when(F.col("chunk") > 0, sep).otherwise("")
    if items_per_part == 1 and not bytes_per_part:  # nothing to gather, so no shuffle
        return keyed.select(*by, "chunk", F.concat(lead, F.coalesce(text, F.lit(""))).alias(name),
                            F.lit(1).cast("long").alias("n_items"),
                            F.col(ordinal_col).alias("first_ordinal"))
    parts = F.array_sort(F.collect_list(F.struct(F.col(ordinal_col).alias("o"), text.alias("t"))))
    joined = F.array_join(F.transform(parts, lambda x: x["t"]), sep)
    return keyed.groupBy(*by, "chunk").agg(
        F.concat(lead, joined).alias(name),
        F.count(F.lit(1)).alias("n_items"),
        F.min(ordinal_col).alias("first_ordinal"))


def build_prompts(items: DataFrame, terms: Sequence[str] | None, by: Sequence[str],
                  ordinal_col: str = "ordinal", bytes_per_part: int | None = None) -> DataFrame:
    """One prompt per report, of any size: the head, then all numbered items.

    ``items`` must carry ``title, link, abstract`` and a per-report ordinal.
    """
    entry = numbered_entry(F.col(ordinal_col), F.col("title"), F.col("link"),
                           F.col("abstract"), title_label="Title: ", trailing_blank=False)
    body = ordered_text(items, by, ordinal_col, entry, sep="\n", name="__body",
                        bytes_per_part=bytes_per_part)
    head = F.when(F.col("chunk") == 0, prompt_head(terms) + "\n").otherwise("")
    return body.select(*by, "chunk", "n_items", F.concat(head, F.col("__body")).alias("prompt"))


def render_item_list(items: DataFrame, by: Sequence[str], ordinal_col: str = "ordinal",
                     heading: str = LIST_HEADING, items_per_part: int | None = None,
                     bytes_per_part: int | None = None) -> DataFrame:
    """K2: Markdown list of saved items (heading, numbered entries, blank lines)."""
    entry = numbered_entry(F.col(ordinal_col), F.col("title"), F.col("link"), F.col("abstract"))
    body = ordered_text(items, by, ordinal_col, entry, sep="", name="__body",
                        items_per_part=items_per_part, bytes_per_part=bytes_per_part)
    first = F.when(F.col("chunk") == 0, heading + "\n\n").otherwise("")
    return body.select(*by, "chunk", "n_items", F.concat(first, F.col("__body")).alias("markdown"))


def report_metadata(items: DataFrame, terms: Sequence[str] | None, by: Sequence[str],
                    generated_at: str) -> DataFrame:
    """K5 metadata (A1, F6, F8): per report total, term previews, generated-on stamp.

    ``generated_at`` is a parameter (``yyyy-MM-dd HH:mm:ss``), never the clock,
    so reruns are reproducible.
    """
    terms = normalise_term_list(terms)
    arr = F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")
    return items.groupBy(*by).agg(F.count(F.lit(1)).alias("total")).select(
        *by, "total",
        preview_list(arr, 5).alias("keywords_preview"),
        preview_list(arr, 3).alias("footer_keywords"),
        format_generated_on(F.to_timestamp(F.lit(generated_at))).alias("generated_on"))


def render_report(meta: DataFrame, body: DataFrame, by: Sequence[str],
                  body_col: str = "summary", title: str = "Research digest",
                  extra_keys: Sequence[str] = ("chunk",)) -> DataFrame:
    """K5 document: metadata block, escaped body text, footer (own minimal template).

    One document per report; null and empty report keys are keys like any
    other. ``extra_keys`` are the body's key columns beyond ``by``. A body in
    parts (``chunk``) gives a document in parts: what stands above the body
    text in the first, the footer in the last, later texts on a new line.
    """
    if "chunk" in extra_keys:
        parts = Window.partitionBy(*by)
        body = body.withColumn("__first", F.col("chunk") == F.min("chunk").over(parts)) \
            .withColumn("__last", F.col("chunk") == F.max("chunk").over(parts))
    else:
        body = body.withColumn("__first", F.lit(True)).withColumn("__last", F.lit(True))
    right = body.select(*[F.col(b).alias(f"__of_{b}") for b in by],
                        *[c for c in body.columns if c not in by])
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__of_{b}"))
    joined = meta.join(right, same, "inner")
    key_txt = F.concat_ws(" / ", *[F.coalesce(F.col(b).cast("string"), F.lit("")) for b in by])
    head = F.concat(
        F.lit("<!DOCTYPE html>\n<html lang=\"en\">\n<head><meta charset=\"UTF-8\"><title>"),
        F.lit(title + " - "), key_txt,
        F.lit("</title><style>body{font-family:sans-serif;max-width:60em;margin:auto}"
              ".md{white-space:pre-wrap}</style></head>\n<body>\n<h1>"), F.lit(title),
        F.lit("</h1>\n<dl><dt>Report</dt><dd>"), key_txt,
        F.lit("</dd><dt>Keywords</dt><dd>"), escape_html("keywords_preview", amp=True),
        F.lit("</dd><dt>Total items</dt><dd>"), F.col("total").cast("string"),
        F.lit("</dd></dl>\n<div class=\"md\">"))
    foot = F.concat(
        F.lit("</div>\n<footer><p>Generated on "), F.col("generated_on"),
        F.lit("</p><p>"), F.col("total").cast("string"),
        F.lit(" items in this digest; terms: "), escape_html("footer_keywords", amp=True),
        F.lit("</p></footer>\n</body>\n</html>\n"))
    html = F.concat(F.when(F.col("__first"), head).otherwise("\n"), escape_html(body_col, amp=True),
                    F.when(F.col("__last"), foot).otherwise(""))
    return joined.select(*by, *extra_keys, html.alias("html"))


def item_panel_entry(title="title", link="link", abstract="abstract") -> Column:
    """K6 per-item fragment: title and abstract ``<``/``>``-escaped, link as is."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    note = escape_html(text(abstract))
    return F.concat(
        F.lit("<article><h4><a href=\""), text(link), F.lit("\">"), escape_html(text(title)),
        F.lit("</a></h4>"),
        F.when(note != "", F.concat(F.lit("<p>"), note, F.lit("</p>"))).otherwise(F.lit("")),
        F.lit("</article>"))


def items_panel(items: DataFrame, terms: Sequence[str] | None, by: Sequence[str],
                ordinal_col: str = "ordinal", items_per_part: int | None = None,
                bytes_per_part: int | None = None) -> DataFrame:
    """K6: escaped item fragments plus keyword badges, per report."""
    terms = normalise_term_list(terms)
    arr = F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")
    body = ordered_text(items, by, ordinal_col, item_panel_entry(), sep="\n", name="items_html",
                        items_per_part=items_per_part, bytes_per_part=bytes_per_part)
    return body.select(*by, "chunk", "n_items", badge_list(arr).alias("badges"), "items_html")


# ---------------------------------------------------------------- outline

# The line forms of Markdown that bear on headings.
_HEADING_RE = r"^(#{1,6})[ \t]+(.*?)[ \t]*#*[ \t]*$"
_FENCE_RE = r"^ {0,3}(`{3,}|~{3,})(.*)$"
_UNDERLINE_RE = r"^ {0,3}(=+|-+)[ \t]*$"
_NO_TEXT_RE = r"^(?:[ \t]*$|\t| {4}| {0,3}(?:>|[-+*][ \t]|[0-9]{1,9}[.)][ \t]|\|))"
LINES_PER_BLOCK = 256


def heading_slug(text) -> Column:
    """Heading id: lower-case, drop characters other than word/space/hyphen,
    runs of spaces and hyphens -> one hyphen (ASCII word characters)."""
    t = F.lower(F.col(text) if isinstance(text, str) else text)
    t = F.regexp_replace(t, r"[^a-z0-9_\s-]", "")
    t = F.regexp_replace(F.trim(t), r"[\s-]+", "-")
    return t


def _fence_step(state: Column, line: Column) -> Column:
    """The fence after a line: '' outside code, else the mark that opened it.

    A fence is closed by its own character, at least as often, with nothing behind.
    """
    mark, rest = F.regexp_extract(line, _FENCE_RE, 1), F.regexp_extract(line, _FENCE_RE, 2)
    opens = (mark != "") & ~(mark.startswith("`") & rest.contains("`"))
    closes = (mark != "") & (F.substring(mark, 1, 1) == F.substring(state, 1, 1)) \
        & (F.length(mark) >= F.length(state)) & (F.trim(rest) == "")
    return F.when(state == "", F.when(opens, mark).otherwise("")).when(closes, "").otherwise(state)


def markdown_outline(df: DataFrame, key: Sequence[str], text_col: str = "markdown") -> DataFrame:
    """Heading lines of each Markdown document as rows.

    ``line_no`` (1-based), ``level`` (1-6), ``heading``, ``slug`` (made unique
    inside a document with ``_1``, ``_2`` ... suffixes) and ``section``, the
    nearest level-2 heading at or above the line.

    A line-state machine: fenced code has no headings, and a line of text above a
    row of ``=`` or ``-`` is one (of level 1 or 2). Lines without a fence mark do not
    move the machine, so it walks the fence lines alone; which fence holds at a
    block of lines is found by composing them, and each block is judged by
    itself. Repeats of a slug are counted over (document, slug) rows in line order,
    sections by a running last value over the document's headings. Time is linear
    in lines, but for sorting headings.
    """
    key = list(key)
    line_no = lambda i: (i + 1).cast("int")
    lines = df.select(*key, F.transform(F.split(F.col(text_col), "\n", -1), lambda x, i: F.struct(
        line_no(i).alias("line_no"), x.alias("line"))).alias("__lines"))
    # The lines at which code begins and ends: [from, to] spans, the last one open.
    marks = F.filter("__lines", lambda x: x["line"].rlike(_FENCE_RE))
    walked = F.aggregate(
        marks, F.struct(F.lit("").alias("fence"), F.array().cast("array<int>").alias("turns")),
        lambda acc, x: F.struct(
            _fence_step(acc["fence"], x["line"]).alias("fence"),
            F.when((_fence_step(acc["fence"], x["line"]) == "") == (acc["fence"] == ""), acc["turns"])
            .otherwise(F.concat(acc["turns"], F.array(x["line_no"]))).alias("turns")))
    turned = lines.withColumn("__turns", walked["turns"])
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("__lines") - 1) / LINES_PER_BLOCK)),
                         lambda b: F.struct(b.alias("b"), F.slice(
                             "__lines", (b * LINES_PER_BLOCK + 1).cast("int"),
                             F.lit(LINES_PER_BLOCK + 1)).alias("part")))
    block = turned.select(*key, "__turns", F.explode(blocks).alias("__block")) \
        .select(*key, "__turns", F.col("__block.b").alias("__b"), F.col("__block.part").alias("__part"))
    first = (F.col("__b") * LINES_PER_BLOCK + 1).cast("int")
    inside = F.size(F.filter("__turns", lambda t: t < first)) % 2 == 1
    here = F.filter("__turns", lambda t: (t >= first) & (t <= first + LINES_PER_BLOCK))
    judged = block.select(*key, "__part", inside.alias("__in"), here.alias("__here"))

    def coded(x: Column) -> Column:
        """Whether a line is code or one of the marks around it."""
        upto = F.size(F.filter("__here", lambda t: t <= x["line_no"]))
        odd = (upto + F.when(F.col("__in"), 1).otherwise(0)) % 2 == 1
        return odd | F.array_contains("__here", x["line_no"])

    def heading(x: Column, i: Column) -> Column:
        below = F.get("__part", i + 1)
        under = F.regexp_extract(F.coalesce(below["line"], F.lit("")), _UNDERLINE_RE, 1)
        hashes = F.length(F.regexp_extract(x["line"], _HEADING_RE, 1))
        text = (under != "") & ~x["line"].rlike(_NO_TEXT_RE) & ~x["line"].rlike(_UNDERLINE_RE) \
            & ~coded(below)
        level = F.when(coded(x), 0).when(hashes > 0, hashes) \
            .when(text, F.when(under.startswith("="), 1).otherwise(2)).otherwise(0)
        return F.struct(x["line_no"].alias("line_no"), level.cast("int").alias("level"), ustrip(
            F.when(hashes > 0, F.regexp_extract(x["line"], _HEADING_RE, 2)).otherwise(x["line"]))
            .alias("heading"))

    # The line after a block is only looked at, not judged.
    own = F.slice(F.transform("__part", heading), 1, LINES_PER_BLOCK)
    heads = judged.select(*key, F.inline(F.filter(own, lambda h: h["level"] > 0))) \
        .withColumn("__base", heading_slug("heading"))
    nth = F.row_number().over(Window.partitionBy(*key, "__base").orderBy("line_no")) - 1
    at = Window.partitionBy(*key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    section = F.last(F.when(F.col("level") == 2, F.col("heading")), ignorenulls=True).over(at)
    return heads.withColumn("__nth", nth).select(
        *key, "line_no", "level", "heading",
        F.when(F.col("__nth") == 0, F.col("__base")).otherwise(
            F.concat("__base", F.lit("_"), F.col("__nth").cast("string"))).alias("slug"),
        section.alias("section"))
