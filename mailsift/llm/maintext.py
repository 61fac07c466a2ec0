"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded down the tree.

A page becomes a tree of block-level elements whose leaves are text blocks.
Every node gets features (depth, text and link density of its subtree, tokens
of its own and its ancestors' attributes, position among and likeness to its
siblings, ...), and boosted trees give the log odds that it is main text.
Decoding picks the best consistent labelling: all of a subtree is main text, or
none of it is, or the node is mixed and its children decide, at a price; so no
kept block lies in a rejected container by accident, nor the reverse.

The trees are trained here on a sample of at most ``TRAIN_PAGES`` pages. Their
teacher is semantic markup (article, main against nav, footer, aside, form and
telling class names). Each sampled page is also used in disguises: marked
elements become plain ones with other tokens, and its paragraphs are planted
again as comments, notices or sidebars, so that the trees learn text and token
features and not one page design.

Text in scripts, styles, templates, form controls and the head is never a
block. Character references are decoded; white space inside a block becomes
one space; blocks are joined in page order by an empty line.

Defined results: null and empty pages, and pages without main text, have empty
texts; markup that is cut off or wrongly nested is read as far as it goes;
repeated rows have equal texts; without any page to learn from, the tokens
alone decide; an empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailsift.llm._store import small_batches

TRAIN_PAGES = 200
TRAIN_CHARS = 500_000   # longer pages are read like all others, but not trained on
DISGUISES = 3
TREES, DEPTH = 12, 4
MIXED_PRICE = 1.0       # log odds that a mixed node costs
PAGES_AT_ONCE = 256

# Element kinds
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd "
                   "label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
                   "wbr nobr".split())
DROPPED = frozenset("script style head title template noscript svg math iframe object canvas select "
                    "option textarea button datalist audio video map".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("table ul ol dl div section article main body aside nav header footer form "
                  "blockquote figure html".split())
BOILER_TAGS = frozenset("nav footer aside form menu dialog fieldset address".split())
MAIN_TAGS = frozenset("article main".split())
# Attribute tokens
BOILER_TOKENS = frozenset(
    "ad ads advert adverts advertisement advertising adsense alert aside author bio banner breadcrumb "
    "breadcrumbs comment comments commentlist consent contentinfo cookie cookies copyright dialog "
    "discussion disqus disclaimer feedback foot footer form gdpr header legal links login masthead menu "
    "meta modal nav navbar navigation newsletter notice notices notification overlay pager pagination "
    "popup promo promoted promotion promotions recommended related replies reply respond response "
    "search share sharing side sidebar signup skip social sponsor sponsored subscribe subscription "
    "tagcloud tags teaser toolbar topbar trending warning widget widgets".split())
MAIN_TOKENS = frozenset("article articlebody body content entry main maincontent post story text "
                        "prose copy".split())
RELATION = frozenset("has with without no before after above below left right".split())
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
SENTENCE = re.compile(r"[.!?;:,]")
# A reference too long for int(); eight digits tell its character, if there is one.
LONG_NUMBER = re.compile(r"&#(?=[0-9]{1000})0*([0-9]{1,8})[0-9]*")

FEATURES = ("depth", "chars", "link_share", "blocks_share", "mean_block", "page_share", "stops",
            "siblings", "like_siblings", "place", "page_place", "own_boiler", "own_main",
            "up_boiler", "up_main", "is_text", "is_heading", "is_item", "in_item", "tag_boiler",
            "tag_main", "up_tag_boiler", "up_tag_main", "in_header", "sibling_chars", "digits",
            "longest", "holds_heading", "parent_link_share", "near_main")


class Page(HTMLParser):
    """Block tree of one page: parallel lists over nodes, parents before children."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.tokens, self.mark, self.text = ["#page"], [-1], [()], [None], [""]
        self.links = [0]
        self.open, self.dropped, self.in_link = [("#page", 0)], 0, 0
        self.buffer, self.linked = [], 0
        self.feed(LONG_NUMBER.sub(r"&#\1", html))
        self.close()
        self.flush()

    def parse_marked_section(self, i, report=1) -> int:
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # unknown or missing keyword: a comment up to the next ">"
            return self.parse_bogus_comment(i, report)

    def node(self, tag, tokens=(), mark=None, text="", links=0) -> int:
        self.tag.append(tag)
        self.parent.append(self.open[-1][1])
        self.tokens.append(tokens)
        self.mark.append(mark)
        self.text.append(text)
        self.links.append(links)
        return len(self.tag) - 1

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.node("#text", text=text, links=min(self.linked, len(text)))
            self.buffer, self.linked = [], 0

    def handle_starttag(self, tag, attrs) -> None:
        if tag in DROPPED:
            if tag not in VOID:
                self.flush()
                self.dropped += 1
                self.open.append((tag, self.open[-1][1]))
            return
        if tag in INLINE:
            if tag == "br":
                self.buffer.append(" ")
            elif tag == "a":
                self.in_link += 1
                self.open.append((tag, self.open[-1][1]))
            return
        self.flush()
        if tag in VOID:
            return
        if self.dropped and any(t in ("head", "title") for t, _ in self.open) and tag in HOLDS:
            self.leave("head")  # a head that was never closed ends where the body begins
        closes = CLOSES.get(tag) or ({"p"} if tag in HOLDS or tag in HEADINGS else None)
        if closes:
            self.close_upto(closes)
        tokens, mark = (), None
        if attrs:
            named = dict(attrs)
            words = " ".join(named.get(k) or "" for k in ("class", "id", "role", "itemprop"))
            found = [x.lower() for x in TOKEN.findall(words)]
            # "has-sidebar" speaks of something else than the element itself
            tokens = tuple(x for k, x in enumerate(found) if not k or found[k - 1] not in RELATION)
            mark = named.get("data-y")
        self.open.append((tag, self.node(tag, tokens, mark)))

    def close_upto(self, tags) -> None:
        """Close the nearest open element of ``tags``, unless a container comes first."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in tags:
                self.cut(i)
                return
            if self.open[i][0] in HOLDS:
                return

    def cut(self, i: int) -> None:
        for tag, _ in self.open[i:]:
            self.in_link -= tag == "a"
            self.dropped -= tag in DROPPED
        del self.open[i:]

    def leave(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] == tag:
                self.cut(i)
                return

    def handle_endtag(self, tag) -> None:
        if tag in INLINE and tag != "a":
            return
        if tag != "a":
            self.flush()
        if tag == "a" or tag in CLOSES:
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i][0] == tag:
                    self.cut(i)
                    return
                if self.open[i][0] in HOLDS:
                    return
        else:
            self.leave(tag)

    def handle_data(self, data) -> None:
        if not self.dropped:
            self.buffer.append(data)
            if self.in_link:
                self.linked += len(data)


def features(page: Page) -> np.ndarray:
    """One row of ``FEATURES`` for each node."""
    n = len(page.tag)
    parent, tag, text = page.parent, page.tag, page.text
    chars, links = [len(t) for t in text], list(page.links)
    blocks = [int(t == "#text") for t in tag]
    stops = [len(SENTENCE.findall(t)) if t else 0 for t in text]
    digits = [sum(map(t.count, "0123456789")) if t else 0 for t in text]
    longest, heading, nodes = list(chars), [t in HEADINGS for t in tag], [1] * n
    children: list[list[int]] = [[] for _ in range(n)]
    main_below, title = [t in MAIN_TAGS for t in tag], [t == "h1" for t in tag]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        blocks[p] += blocks[i]
        stops[p] += stops[i]
        digits[p] += digits[i]
        nodes[p] += nodes[i]
        longest[p] = max(longest[p], longest[i])
        heading[p] = heading[p] or heading[i]
        main_below[p] = main_below[p] or main_below[i]
        title[p] = title[p] or title[i]
        children[p].append(i)
    for c in children:
        c.reverse()
    total = max(chars[0], 1)
    rows = [None] * n
    depth, up_boiler, up_main, tag_boiler, tag_main, item, header = ([0] * n for _ in range(7))
    before, run = [0] * n, 0
    kinds: list[Counter | None] = [None] * n  # a parent's children by tag, counted once
    for i in range(n):
        before[i] = run
        run += len(text[i])
        p = parent[i]
        own_boiler = sum(t in BOILER_TOKENS for t in page.tokens[i])
        own_main = sum(t in MAIN_TOKENS for t in page.tokens[i])
        is_boiler, is_main = tag[i] in BOILER_TAGS, tag[i] in MAIN_TAGS
        if p >= 0:
            depth[i] = depth[p] + 1
            # What stands around a whole page says little about its parts.
            wide = chars[p] > 0.9 * total or main_below[p] or (title[p] and chars[p] > total / 2)
            up_boiler[i] = up_boiler[p] + (0 if wide else rows[p][11])
            up_main[i] = up_main[p] + rows[p][12]
            tag_boiler[i], tag_main[i] = tag_boiler[p] + rows[p][19], tag_main[p] + rows[p][20]
            item[i] = item[p] or tag[p] in ("li", "td", "dd", "dt")
            header[i] = header[p] or tag[p] == "header"
            row = children[p]
            if kinds[p] is None:
                kinds[p] = Counter(tag[j] for j in row)
            same = kinds[p][tag[i]]
            place = row.index(i) / len(row) if len(row) < 64 else (before[i] - before[p]) / (
                chars[p] + 1)
            mates = chars[p] - chars[i]
            around = (len(row), same / len(row), place, math.log1p(mates / max(len(row) - 1, 1)),
                      links[p] / max(chars[p], 1))
        else:
            around = (1, 1.0, 0.0, 0.0, links[i] / total)
        size = max(chars[i], 1)
        rows[i] = (depth[i], math.log1p(chars[i]), links[i] / size, blocks[i] / nodes[i],
                   math.log1p(chars[i] / max(blocks[i], 1)), chars[i] / total, 100 * stops[i] / size,
                   around[0], around[1], around[2], before[i] / total, own_boiler, own_main,
                   up_boiler[i], up_main[i], tag[i] == "#text", tag[i] in HEADINGS,
                   tag[i] in ("li", "td", "dd", "dt"), item[i], is_boiler, is_main,
                   tag_boiler[i], tag_main[i], header[i] or tag[i] == "header", around[3],
                   digits[i] / size, math.log1p(longest[i]), heading[i], around[4], main_below[i])
    return np.array(rows, np.float64)


def decode(page: Page, odds: np.ndarray) -> str:
    """Blocks of the best consistent labelling, joined in page order."""
    n = len(page.tag)
    odds = np.clip(odds, -30, 30)
    yes, no = (-np.log1p(np.exp(-odds))).tolist(), (-np.log1p(np.exp(odds))).tolist()
    mixed, leaf = [0.0] * n, [t == "#text" for t in page.tag]
    best = [0.0] * n
    for i in range(n - 1, -1, -1):
        pair = max(yes[i], no[i])
        best[i] = pair if leaf[i] else max(pair, mixed[i] - MIXED_PRICE)
        p = page.parent[i]
        if p >= 0:
            yes[p] += yes[i]
            no[p] += no[i]
            mixed[p] += best[i]
    label: list = [None] * n     # True, False, or None where the children decide
    out = []
    for i in range(n):
        p = page.parent[i]
        if p >= 0 and label[p] is not None:
            label[i] = label[p]
        elif leaf[i] or max(yes[i], no[i]) >= mixed[i] - MIXED_PRICE:
            label[i] = yes[i] > no[i]
        if leaf[i] and label[i]:
            out.append(page.text[i])
    return "\n\n".join(out)


class Forest:
    """Boosted trees as arrays; ``odds`` is the log odds of main text."""

    def __init__(self, trees: list[tuple], weights: list[float]):
        self.trees, self.weights = trees, weights

    @classmethod
    def of(cls, model) -> "Forest":
        trees = []
        for tree in model.trees:
            feature, cut, left, right, value = [], [], [], [], []

            def walk(node) -> int:
                at = len(feature)
                for column in (feature, cut, left, right, value):
                    column.append(0)
                value[at] = node.prediction()
                if node.numDescendants():
                    feature[at], cut[at] = node.split().featureIndex(), node.split().threshold()
                    left[at], right[at] = walk(node.leftChild()), walk(node.rightChild())
                else:
                    left[at] = right[at] = at
                return at

            walk(tree._call_java("rootNode"))
            trees.append(tuple(np.array(x) for x in (feature, cut, left, right, value)))
        return cls(trees, list(model.treeWeights))

    def odds(self, rows: np.ndarray) -> np.ndarray:
        if not self.trees:  # nothing to learn from: tokens and tags alone
            at = {name: rows[:, i] for i, name in enumerate(FEATURES)}
            bad = at["own_boiler"] + at["up_boiler"] + at["tag_boiler"] + at["up_tag_boiler"]
            return 2.0 - 4.0 * bad - 4.0 * at["link_share"]
        out, which = np.zeros(len(rows)), np.arange(len(rows))
        for (feature, cut, left, right, value), weight in zip(self.trees, self.weights):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = np.where(rows[which, feature[at]] <= cut[at], left[at], right[at])
            out += weight * value[at]
        return 2.0 * out  # the boosted margin is half the log odds


_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)([^>]*)>")
_PARAGRAPH = re.compile(r"<p\b[^>]*>([^<]{40,})", re.I)
PLANTED = ("comments", "comment-list", "sidebar", "widget", "notice", "cookie-banner", "newsletter",
           "related-posts", "advert", "promo", "disclaimer", "share-box", "login-form", "alert")
PLAIN = ("content", "post", "entry-content", "story-body", "main-text", "", "", "column", "inner")


def disguise(html: str, turn: int, seed: int) -> str:
    """A page with its teacher's marks (``data-y``); from turn 1 on under other names."""
    pick = np.random.default_rng(seed + turn)
    choose = lambda options: options[int(pick.integers(len(options)))]
    names: list[str] = []

    def change(m: re.Match) -> str:
        end, tag, rest = m[1], m[2].lower(), m[3]
        tokens = {x.lower() for x in TOKEN.findall(rest)} if "class" in rest or "id=" in rest else set()
        main = tag in MAIN_TAGS
        boiler = tag in BOILER_TAGS or (tag == "header" and "main" not in names) or (
            bool(tokens & BOILER_TOKENS) and tag in ("div", "section", "ul", "ol", "p"))
        if not (main or boiler or (end and tag in ("div", "section"))):
            return m[0]
        if end:
            if turn and (main or tag in BOILER_TAGS):
                return "</div>"
            return m[0]
        names.append("main" if main else "boiler")
        if not turn:
            return f'<{tag} data-y="{int(main)}"{rest}>'
        if main:
            return f'<div data-y="1" class="{choose(PLAIN)}">'
        if tag in BOILER_TAGS:
            return f'<div data-y="0" class="{choose(PLANTED + ("menu", "top-nav", "footer"))}">'
        return f'<{tag} data-y="0" class="{choose(PLANTED)}">'

    out = _TAG.sub(change, html)
    if turn:
        paragraphs = [p for p in _PARAGRAPH.findall(html) if p.strip()]
        for _ in range(2):
            if paragraphs:
                some = [choose(paragraphs) for _ in range(int(pick.integers(1, 4)))]
                shape = choose(("p", "div", "li"))
                body = "".join(f"<{shape}>{p}</{shape}>" for p in some)
                box = choose(("div", "section", "aside", "form"))
                planted = f'<{box} data-y="0" class="{choose(PLANTED)}">{body}</{box}>'
                spots = [m.end() for m in re.finditer(r"</(?:p|div|ul|h1|h2)>|<body[^>]*>", out)]
                at = choose(spots) if spots else len(out)
                out = out[:at] + planted + out[at:]
    return out


def labels(page: Page) -> list:
    """1, 0 or None (mixed or unmarked) for every node, from the marks."""
    n = len(page.tag)
    own = [None] * n
    for i in range(n):
        mark = page.mark[i]
        own[i] = int(mark) if mark in ("0", "1") else (own[page.parent[i]] if i else None)
    some = [set() for _ in range(n)]
    for i in range(n - 1, 0, -1):
        if page.tag[i] == "#text":
            some[i].add(own[i])
        some[page.parent[i]] |= some[i]
    return [next(iter(s)) if len(s) == 1 else None for s in some]


def train(pages: DataFrame, html_col: str = "html",
          train_pages: int = TRAIN_PAGES) -> Forest:
    """Fit the trees on marked nodes of at most ``train_pages`` pages, of at most ``TRAIN_CHARS``
    each, and their disguises."""
    spark = pages.sparkSession
    sample = (pages.filter(F.col(html_col).rlike("(?i)<(article|main)[ >]")
                           & (F.length(html_col) <= TRAIN_CHARS))
              .select(F.col(html_col).alias("html"), F.xxhash64(html_col).alias("h"))
              .orderBy("h").limit(train_pages).toArrow().column(0).to_pylist())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, marks = [], []
            for html in batch.column(0).to_pylist():
                for turn in range(DISGUISES + 1):
                    page = Page(disguise(html, turn, zlib.crc32(html.encode())))
                    for row, y in zip(features(page), labels(page)):
                        if y is not None:
                            out.append(row.tolist())
                            marks.append(float(y))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.float64())),
                                              pa.array(marks, pa.float64())], names=["x", "label"])

    if not sample:
        return Forest([], [])
    given = spark.createDataFrame([(h,) for h in sample], "html string").coalesce(1) \
        .mapInArrow(rows, "x array<double>, label double") \
        .select(array_to_vector("x").alias("features"), "label").persist()
    try:
        if given.select("label").distinct().count() < 2:
            return Forest([], [])
        return Forest.of(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=32,
                                       seed=7).fit(given))
    finally:
        given.unpersist()


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
              html_col: str = "html", forest: Forest | None = None) -> DataFrame:
    """``id, url, text, n_chars`` of every page; narrow, one page at a time."""
    small_batches(pages.sparkSession)
    forest = forest or train(pages, html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(at, PAGES_AT_ONCE)
                trees = [Page(h or "") for h in part.column(2).to_pylist()]
                rows = [features(t) for t in trees]
                cuts = np.cumsum([0] + [len(r) for r in rows])
                odds = forest.odds(np.concatenate(rows))
                texts = [decode(t, odds[a:b]) for t, a, b in zip(trees, cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    names=[id_col, url_col, "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.select(id_col, url_col, html_col).mapInArrow(
        run, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars long")
