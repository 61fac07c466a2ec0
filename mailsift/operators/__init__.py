"""DataFrame -> DataFrame operators (headers, bodies, extraction, items, documents)."""

from mailsift.operators.bodies import choose_body, drop_empty_bodies, explode_parts, wrap_plain
from mailsift.operators.documents import (
    build_prompts, items_panel, markdown_outline, ordered_text, render_item_list,
    render_report, report_metadata,
)
from mailsift.operators.extract import (
    dedupe_in_message, extract_anchors, extract_items, keep_links,
)
from mailsift.operators.headers import (
    add_mail_date, add_sender, filter_run_day, filter_senders, header_fields, parse_headers,
    project_headers, rank_messages,
)
from mailsift.operators.inference import infer
from mailsift.operators.items import (
    dedupe_first, drop_tail, keyword_filter, keyword_semi_join, number_items,
)
from mailsift.operators.metrics import funnel_counts, report_totals
from mailsift.operators.order import first_per_key, ordinal

__all__ = [
    "add_mail_date", "add_sender", "build_prompts", "choose_body", "dedupe_first",
    "dedupe_in_message", "drop_empty_bodies", "drop_tail", "explode_parts",
    "extract_anchors", "extract_items", "filter_run_day", "filter_senders",
    "first_per_key", "funnel_counts", "header_fields", "infer", "items_panel", "keep_links",
    "keyword_filter", "keyword_semi_join", "markdown_outline", "number_items",
    "ordered_text", "ordinal", "parse_headers", "project_headers", "rank_messages",
    "render_item_list", "render_report", "report_metadata", "report_totals",
    "wrap_plain",
]
