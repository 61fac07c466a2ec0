"""The digest: messages -> saved items -> selected, numbered items.

Stage order follows the source tool exactly (it is not commutable):
latest N *then* sender/day filters; ordered dedupe; tail drop; the saved set
is taken *before* the keyword filter; numbering last. Building a digest runs
the jobs that write its deduplicated and its ordered items.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from mailsift.operators.extract import (
    DEFAULT_BLOCK_TAGS, DEFAULT_LINK_CONTAINS, DEFAULT_LINK_PREFIXES, DEFAULT_MIN_TITLE_LEN,
    extract_anchors, keep_links, page_items, parsed_pages,
)
from mailsift.operators.bodies import decode_bodies
from mailsift.operators.headers import (
    add_mail_date, add_sender, filter_run_day, filter_senders, header_fields,
)
from mailsift.operators.items import (
    ITEM_ORDER, dedupe_first, drop_tail, keyword_filter, number_items,
)
from mailsift.session import written
from mailsift.sources.messages import latest_n


@dataclass
class DigestParams:
    recent: int = 0                      # S2: latest N messages, 0 = all
    mailbox_by: Sequence[str] = ()       # S2 per mailbox (empty = one mailbox)
    senders: Sequence[str] | DataFrame | None = None  # H4 allow-list (None = no filter)
    today_only: bool = False             # H5
    run_date: str | None = None          # H5 day to keep
    tz: str = "UTC"                      # H5 local zone
    report_by: Sequence[str] = ("report_date",)
    extractor: str = "parser"            # "parser" (X1-X5, block abstracts) | "native" (X1 regex)
    block_tags: Sequence[str] = DEFAULT_BLOCK_TAGS
    min_len: int = DEFAULT_MIN_TITLE_LEN
    contains: Sequence[str] = DEFAULT_LINK_CONTAINS
    prefixes: Sequence[str] = DEFAULT_LINK_PREFIXES
    tail_k: int = 2                      # I2
    terms: Sequence[str] | None = field(default_factory=list)  # I3
    materialise_unique: bool = True      # write deduplicated items once (see digest_stages)
    materialise_items: bool = False      # write extracted items once, where they are counted too

    @property
    def message_keys(self) -> list[str]:
        """Columns that name a message's place: report, mailbox, uid."""
        return list(dict.fromkeys([*self.report_by, *self.mailbox_by, "uid"]))

    @property
    def item_order(self) -> list:
        """Newest message first, mailboxes one after the other, then document order."""
        boxes = [m for m in self.mailbox_by if m not in self.report_by]
        return [*[(m, True) for m in boxes], *ITEM_ORDER]


def match_messages(scanned: DataFrame, p: DigestParams) -> DataFrame:
    """Sender / run-day filters (H4, H5) on the headers alone.

    Raw RFC 822 input (a ``raw`` column) has its header block read first
    (H1-H3, JVM-side). Stateless, so it also runs per micro-batch.
    """
    matched = scanned
    if "raw" in scanned.columns:
        matched = add_mail_date(add_sender(header_fields(matched)), "date", "dt")
    if p.senders is not None:
        matched = filter_senders(matched, p.senders)
    if p.today_only:
        matched = filter_run_day(matched, p.run_date, True, p.tz)
    return matched


def message_bodies(matched: DataFrame, p: DigestParams) -> DataFrame:
    """``html`` (and, for raw input, the decode ``error``) of the matched messages."""
    return decode_bodies(matched, keep=p.message_keys) if "raw" in matched.columns else matched


def observed(df: DataFrame, health: Observation | None, **counts) -> DataFrame:
    """``df``, counted by whatever job next reads it; no job of its own."""
    return df if health is None else df.observe(health, *[c.alias(n) for n, c in counts.items()])


@dataclass
class Health:
    """A2: what the extraction's own job counts on its way (read after it has run)."""
    bodies: Observation = field(default_factory=lambda: Observation("bodies"))
    pages: Observation = field(default_factory=lambda: Observation("pages"))
    raw: bool = False
    parsed: bool = False

    def counts(self) -> dict[str, int]:
        """Messages decoded, decode errors, pages read and pages that could not be read."""
        return {**(self.bodies.get if self.raw else {}), **(self.pages.get if self.parsed else {})}


def message_items(bodies: DataFrame, p: DigestParams, health: Health | None = None) -> DataFrame:
    """Messages with ``html`` -> items ``keys..., pos, title, link, abstract``."""
    keep = p.message_keys
    if health is not None and "error" in bodies.columns:
        health.raw = True
        bodies = observed(bodies, health.bodies, decoded=F.count(F.lit(1)), decode_errors=F.count("error"))
    bodies = bodies.filter(F.col("html").isNotNull() & (F.col("html") != ""))
    if p.extractor == "native":
        items = keep_links(extract_anchors(bodies, keep=keep), p.min_len, p.contains, p.prefixes)
        return items.withColumn("abstract", F.lit(None).cast("string"))
    if p.extractor == "parser":
        pages = parsed_pages(bodies, keep=keep, block_tags=p.block_tags)
        if health is not None:
            health.parsed = True
            pages = observed(pages, health.pages, read=F.count(F.lit(1)), read_errors=F.count("error"))
        return page_items(pages, keep, p.min_len, p.contains, p.prefixes)
    raise ValueError(f"unknown extractor {p.extractor!r}")


def item_stages(items: DataFrame, p: DigestParams) -> dict[str, DataFrame]:
    """Items -> ``unique``, ``saved``, ``selected`` and ``numbered``."""
    by = list(p.report_by)
    unique = dedupe_first(items, ("title", "link"), p.item_order, by=by)
    if p.materialise_unique:
        # The tail drop reads these rows twice, and its branches are pruned
        # differently, so their shuffles would not be reused.
        unique = written(unique, "unique")
    saved = drop_tail(unique, p.item_order, p.tail_k, by=by)
    selected = keyword_filter(saved, p.terms)
    return {"unique": unique, "saved": saved, "selected": selected,
            "numbered": number_items(selected, p.item_order, by=by)}


def digest_stages(messages: DataFrame, p: DigestParams,
                  health: Health | None = None) -> dict[str, DataFrame]:
    """All intermediate tables of one digest (``scanned`` ... ``numbered``).

    ``messages`` needs ``uid``, the ``report_by`` columns and either
    ``html`` (plus ``sender`` / parsed ``dt`` for the filters) or ``raw``
    RFC 822 bytes. ``health`` takes the counts of the job that extracts the items.
    """
    scanned = latest_n(messages, p.recent, "uid", by=list(p.mailbox_by) or None)
    matched = match_messages(scanned, p)
    bodies = message_bodies(matched, p)
    items = message_items(bodies, p, health)
    if p.materialise_items:
        items = written(items, "items")
    return {"scanned": scanned, "matched": matched, "bodies": bodies, "items": items,
            **item_stages(items, p)}


def digest_columns(p: DigestParams) -> list[str]:
    return [*p.report_by, "ordinal", *[c for c in p.message_keys if c not in p.report_by],
            "pos", "title", "link", "abstract"]


def digest(messages: DataFrame, p: DigestParams) -> DataFrame:
    """Selected items, numbered per report: ``report..., ordinal, uid, pos, title, link, abstract``."""
    return digest_stages(messages, p)["numbered"].select(*digest_columns(p))
