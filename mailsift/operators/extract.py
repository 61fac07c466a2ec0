"""Item extraction from message HTML.

Two implementations of the anchor extractor:

* ``extract_anchors`` (native): ``regexp_extract_all`` + ``inline`` of
  per-anchor structs, fully JVM-side. Exact on well-formed markup, which is
  what alert mails and the driver's pages are. Gives title and link, no
  context.
* ``extract_items`` (parser): ``parsed_pages`` runs the standard library
  ``html.parser`` with an open-element stack (implied end tags for ``p``, ``li``,
  ``td``, ``tr``; void elements; script/style text excluded), which tag soup
  needs. It returns the page's text pieces once and, for each anchor, spans of
  piece numbers: its own text, its enclosing block (X3), the next element (X5).
  Texts are put together and decided on by column expressions.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from mailsift.functions._util import as_col
from mailsift.functions.text import WS_CLASS, remove_title, ustrip
from mailsift.operators.order import first_per_key
from mailsift.session import small_batches

# The link predicate and block tags of the source tool.
DEFAULT_MIN_TITLE_LEN = 4
DEFAULT_LINK_CONTAINS = ("scholar.google",)
DEFAULT_LINK_PREFIXES = ("http",)
DEFAULT_BLOCK_TAGS = ("div", "td", "tr", "p", "li")

ANCHOR_RE = r"(?is)<a\b[^>]*>.*?</a\s*>"
_OPEN_TAG_RE = r"(?is)^(<a\b[^>]*>)"
_HREF_RE = r"""(?is)^<a\b[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_INNER_RE = r"(?is)^<a\b[^>]*>(.*)</a\s*>$"
_TAG_RE = rf"(?s){WS_CLASS}*<[^>]*>{WS_CLASS}*"
_COMMENT_RE = r"(?s)<!--.*?-->"
_HAS_HREF_RE = r"(?is)^<a\b[^>]*?\shref\s*="


# A reference as HTML reads it, the text between references, or an ampersand by itself.
_PIECE_RE = r"(?s)&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"


def _names(ended: bool) -> Column:
    """Name -> characters, one map; the names are the standard library's table, with or without
    their semicolon. Only names of the old list may stand without one."""
    from html.entities import html5

    some = {k: v for k, v in html5.items() if k.endswith(";") == ended}
    return F.from_json(F.lit(json.dumps(some)), "map<string,string>")


_SHORT_NAMES = range(6, 1, -1)  # lengths of the names that need no semicolon, longest first


def _decode_ref(piece: Column) -> Column:
    """One reference -> its characters, as ``html.unescape`` reads it; other pieces unchanged."""
    name = F.substring(piece, F.lit(2), F.length(piece))
    whole = F.when(F.endswith(piece, F.lit(";")), F.element_at(_names(True), name))
    # Not a name: the longest name it begins with, then the rest as it stands.
    begun = F.coalesce(*[F.concat(F.element_at(_names(False), F.substring(piece, 2, n)),
                                  F.substring(piece, F.lit(n + 2), F.length(piece)))
                         for n in _SHORT_NAMES])
    return F.when((F.substring(piece, 1, 1) != "&") | (F.length(piece) < 2), piece) \
        .when(F.startswith(piece, F.lit("&#")), _decode_numeric_ref(piece)) \
        .otherwise(F.coalesce(whole, begun, piece))


def _low_codepoint_table() -> Column:
    """Code points below 256 whose reference does not decode to ``chr(cp)``
    (NUL, control characters, the 128-159 remapping), derived from the
    standard library's ``html.unescape`` rather than written out."""
    import html

    pairs = [(i, html.unescape(f"&#{i};")) for i in range(256)]
    odd = [(i, ch) for i, ch in pairs if ch != chr(i)]
    return F.create_map(*[x for i, ch in odd for x in (F.lit(i), F.lit(ch))])


def _decode_numeric_ref(ref: Column) -> Column:
    """``&#NNN;`` / ``&#xHH;`` (or without the semicolon) -> its character, as ``html.unescape``."""
    body = F.regexp_extract(ref, r"&#[xX]?([0-9A-Fa-f]+);?", 1)
    is_hex = F.lower(F.substring(ref, 3, 1)) == "x"
    cp = F.when(is_hex, F.conv(body, 16, 10)).otherwise(body).try_cast("long")
    char = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    noncharacter = (((cp >= 0xFDD0) & (cp <= 0xFDEF))
                    | (F.pmod(cp, F.lit(0x10000)) >= 0xFFFE))
    return (F.when(cp.isNull() | (cp > 0x10FFFF) | ((cp >= 0xD800) & (cp <= 0xDFFF)),
                   F.lit("\ufffd"))
            .when(cp < 256, F.coalesce(F.element_at(_low_codepoint_table(), cp.cast("int")),
                                       char))
            .when(noncharacter, F.lit(""))
            .otherwise(char))


def decode_references(c) -> Column:
    """Every named and numeric character reference, as ``html.unescape`` decodes them.

    The text is cut into references and what lies between, in one pass, so nothing
    is decoded twice; texts without an ampersand are left alone.
    """
    c = as_col(c)
    pieces = F.regexp_extract_all(c, F.lit(_PIECE_RE), 0)
    return F.when(c.contains("&"), F.array_join(F.transform(pieces, _decode_ref), "")).otherwise(c)


def anchor_title(tag) -> Column:
    """Text of an anchor: text pieces each stripped, joined with no separator."""
    inner = F.regexp_extract(as_col(tag), _INNER_RE, 1)
    inner = F.regexp_replace(inner, _COMMENT_RE, "")
    return ustrip(decode_references(F.regexp_replace(inner, _TAG_RE, "")))


def anchor_href(tag) -> Column:
    """``href`` attribute value (quotes removed, entities decoded); null if absent."""
    open_tag = F.regexp_extract(as_col(tag), _OPEN_TAG_RE, 1)
    raw = F.regexp_extract(open_tag, _HREF_RE, 1)
    unq = F.regexp_replace(raw, r"""^"(.*)"$|^'(.*)'$""", "$1$2")
    return F.when(open_tag.rlike(_HAS_HREF_RE), decode_references(unq))


def extract_anchors(df: DataFrame, html_col: str = "html",
                    keep: Sequence[str] = ("uid",)) -> DataFrame:
    """X1 + X7 (native): one row per ``<a>`` with an ``href``, in document order.

    ``pos`` is the 1-based position among the message's anchors with an
    ``href`` (as in the parser path), so ``(msg order, pos)`` is the run's
    item order without any sort.
    """
    tags = F.filter(F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR_RE), 0),
                    lambda t: t.rlike(_HAS_HREF_RE))
    # Title and link are built inside the generator: a later predicate on
    # them (X2) stays above the Generate, so each regex runs once per anchor
    # instead of once in the pushed-down filter and again in the projection.
    items = F.transform(tags, lambda t, i: F.struct(
        (i + 1).cast("int").alias("pos"), anchor_title(t).alias("title"),
        anchor_href(t).alias("link")))
    return df.select(*keep, F.inline(items))


def link_predicate(title, link, min_len: int = DEFAULT_MIN_TITLE_LEN,
                   contains: Sequence[str] = DEFAULT_LINK_CONTAINS,
                   prefixes: Sequence[str] = DEFAULT_LINK_PREFIXES) -> Column:
    """X2 as a predicate: title of ``min_len``+ code points and a qualifying link."""
    title, link = as_col(title), as_col(link)
    conds = [link.contains(s) for s in contains] + [link.startswith(p) for p in prefixes]
    ok_link = F.lit(False)
    for c in conds:
        ok_link = ok_link | c
    return (F.length(title) >= F.lit(max(min_len, 1))) & ok_link


def keep_links(df: DataFrame, min_len: int = DEFAULT_MIN_TITLE_LEN,
               contains: Sequence[str] = DEFAULT_LINK_CONTAINS,
               prefixes: Sequence[str] = DEFAULT_LINK_PREFIXES,
               title_col: str = "title", link_col: str = "link") -> DataFrame:
    """Anchor predicate (case-sensitive ``contains`` OR ``startswith``)."""
    return df.filter(link_predicate(title_col, link_col, min_len, contains, prefixes))


def dedupe_in_message(df: DataFrame, msg_key: Sequence[str] = ("uid",),
                      order: Sequence = ("pos",)) -> DataFrame:
    """First ``(title, link)`` wins inside one message."""
    return first_per_key(df, [*msg_key, "title", "link"], order)


# --------------------------------------------------------------------------
# Parser path (mapInArrow)
# --------------------------------------------------------------------------

# HTML element classes used by the tree builder.
_VOID = frozenset("area base br col embed hr img input keygen link meta param source track wbr".split())
_NO_TEXT = frozenset(("script", "style", "template"))
_CLOSES_P = frozenset(
    "address article aside blockquote dd details div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table ul".split())
_P_SCOPE_STOP = frozenset("td th li div table body html blockquote button".split())


# Fixed limit: the digits a decimal reference may have (the standard library's int() limit is beyond).
_LONG_REF = re.compile(r"&#([0-9]{8,});?")


def _short_refs(html: str) -> str:
    """Decimal references of any length read as ``html.unescape`` reads short ones."""
    def short(m):
        digits = m[1].lstrip("0") or "0"
        return f"&#{digits};" if len(digits) < 8 else "\ufffd"
    return _LONG_REF.sub(short, html)


class _Node:
    """An element: the span of its text pieces, its nearest block and its next element."""
    __slots__ = ("tag", "first", "last", "block", "child", "after")

    def __init__(self, tag, first, block):
        self.tag, self.first, self.last, self.block = tag, first, None, block
        self.child = self.after = None  # last element inside so far, next element beside


class _IntervalBuilder(HTMLParser):
    """Forgiving reader: implied end tags, void elements, stray end tags ignored.

    No tree is kept. Text pieces are numbered in document order, so an element
    is a span of numbers, and every span is known when its end is read.
    """

    def __init__(self, block_tags):
        super().__init__(convert_charrefs=True)
        self.block_tags = block_tags
        self.pieces, self.anchors = [], []
        self.stack = [_Node("#root", 0, None)]
        self.open = Counter()
        self.quiet = 0  # open elements whose text does not count

    def parse_marked_section(self, i, report=1):
        """``<![...``: a section of an unknown kind is a comment, as browsers read it."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def _pop(self):
        node = self.stack.pop()
        node.last = len(self.pieces)
        self.open[node.tag] -= 1
        self.quiet -= node.tag in _NO_TEXT

    def _close_to(self, tag, stop=()):
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.stack[i].tag
            if t == tag:
                while len(self.stack) > i:
                    self._pop()
                return
            if t in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES_P:
            self._close_to("p", _P_SCOPE_STOP)
        if tag == "li":
            self._close_to("li", ("ul", "ol"))
        elif tag in ("td", "th"):
            self._close_to("td", ("tr", "table"))
            self._close_to("th", ("tr", "table"))
        elif tag == "tr":
            self._close_to("tr", ("table", "tbody", "thead", "tfoot"))
        elif tag == "a":
            self._close_to("a")
        parent = self.stack[-1]
        node = _Node(tag, len(self.pieces), parent if parent.tag in self.block_tags else parent.block)
        if parent.child is not None:
            parent.child.after = node
        parent.child = node
        href = next((v for k, v in attrs if k == "href"), False) if tag == "a" else False
        if href is not False:
            self.anchors.append((node, href or ""))
        if tag in _VOID:
            node.last = node.first
        else:
            self.stack.append(node)
            self.open[tag] += 1
            self.quiet += tag in _NO_TEXT

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.stack[-1].tag == tag:
            self._pop()

    def handle_endtag(self, tag):
        self._close_to(tag)

    def handle_data(self, data):
        text = data.strip()
        if text and not self.quiet:
            self.pieces.append(text)

    def finish(self):
        self.close()
        while self.stack:
            self._pop()


def parse_page(html: str | None, block_tags=DEFAULT_BLOCK_TAGS) -> tuple:
    """X1, X3, X5 of one document: ``(pieces, anchors, error)``.

    Pieces are the text, stripped, in document order. An anchor with an ``href`` is
    ``(link, spans)`` with the piece numbers, from and below, of its own text, its
    nearest block and the next element beside it (-1 where there is none). What is
    returned is linear in the page; only parsing happens here.
    """
    builder = _IntervalBuilder(frozenset(block_tags))
    try:
        builder.feed(_short_refs(html or ""))
        builder.finish()
    except Exception as e:  # a page must not end the job; its error is counted
        return [], [], f"{type(e).__name__}: {e}"
    span = lambda n: (-1, -1) if n is None else (n.first, n.last)
    return builder.pieces, [(link, *span(n), *span(n.block), *span(n.after))
                            for n, link in builder.anchors], None


_SPANS = ("own_from", "own_to", "block_from", "block_to", "next_from", "next_to")
_ANCHOR = StructType([StructField("link", StringType())]
                     + [StructField(n, IntegerType()) for n in _SPANS])


def parsed_pages(df: DataFrame, html_col: str = "html", keep: Sequence[str] = ("uid",),
                 block_tags: Sequence[str] = DEFAULT_BLOCK_TAGS) -> DataFrame:
    """``keep..., pieces, anchors, error`` per page with a body; narrow, linear in the page."""
    small_batches(df.sparkSession)
    keep = list(keep)
    out = StructType([df.schema[k] for k in keep] + [
        StructField("pieces", ArrayType(StringType())), StructField("anchors", ArrayType(_ANCHOR)),
        StructField("error", StringType())])
    names, tags, n = [f.name for f in out], tuple(block_tags), len(keep)
    kinds = [pa.list_(pa.string()), pa.list_(pa.struct(
        [("link", pa.string()), *[(s, pa.int32()) for s in _SPANS]])), pa.string()]
    fields = ("link", *_SPANS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [parse_page(h, tags) for h in batch.column(n).to_pylist()]
            columns = [[p[0] for p in pages], [[dict(zip(fields, a)) for a in p[1]] for p in pages],
                       [p[2] for p in pages]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], *[pa.array(c, k) for c, k in zip(columns, kinds)]], names)

    src = df.filter(F.col(html_col).isNotNull() & (F.col(html_col) != "")) \
        .select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], F.col(html_col).alias("h"))
    return src.mapInArrow(run, out)


def _joined(low: Column, high: Column, sep: str) -> Column:
    """Text of a span of pieces; null where there is no span."""
    return F.when(low >= 0, F.array_join(F.slice("pieces", low + 1, high - low), sep))


def page_items(pages: DataFrame, keep: Sequence[str] = ("uid",),
               min_len: int = DEFAULT_MIN_TITLE_LEN,
               contains: Sequence[str] = DEFAULT_LINK_CONTAINS,
               prefixes: Sequence[str] = DEFAULT_LINK_PREFIXES) -> DataFrame:
    """X2-X5, X7 over ``parsed_pages``: the kept anchors with title, link and abstract.

    The predicate acts on titles and links before any context is put together, so a
    block's text is made once for each item that has it and for no other anchor.
    """
    titled = F.transform("anchors", lambda a, i: F.struct(
        (i + 1).cast("int").alias("pos"), _joined(a["own_from"], a["own_to"], "").alias("title"),
        a["link"].alias("link"), a.alias("at")))
    kept = F.filter(titled, lambda t: link_predicate(t["title"], t["link"], min_len, contains, prefixes))

    def item(t: Column) -> Column:
        block = _joined(t["at"]["block_from"], t["at"]["block_to"], " ")
        beside = _joined(t["at"]["next_from"], t["at"]["next_to"], " ")
        return F.struct(t["pos"].alias("pos"), t["title"].alias("title"), t["link"].alias("link"),
                        F.coalesce(remove_title(block, t["title"]), beside).alias("abstract"))

    return pages.select(*keep, F.inline(F.transform(kept, item)))


def extract_items(df: DataFrame, html_col: str = "html", keep: Sequence[str] = ("uid",),
                  block_tags: Sequence[str] = DEFAULT_BLOCK_TAGS,
                  min_len: int = DEFAULT_MIN_TITLE_LEN,
                  contains: Sequence[str] = DEFAULT_LINK_CONTAINS,
                  prefixes: Sequence[str] = DEFAULT_LINK_PREFIXES,
                  dedupe: bool = True) -> DataFrame:
    """Items with an abstract, per message.

    The parser gives text pieces and spans (``parsed_pages``); the link predicate
    (X2), the title taken out of the block text (X4), the fallback to the next
    element (X5) and the dedupe inside a message (X6) are column expressions.
    Filter messages *before* calling this: predicates do not pass through Python.
    """
    keep = list(keep)
    items = page_items(parsed_pages(df, html_col, keep, block_tags), keep, min_len, contains, prefixes)
    return dedupe_in_message(items, keep) if dedupe else items
