"""Query catalog: one function per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole driver tables (or data Spark derives from them);
limits appear only where the limit *is* the operator (latest-N, tail drop).
The matching DuckDB SQL lives in ``mailsift.plans.oracle``; column names
are identical on both sides.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.functions import normalise_address, normalise_terms, parse_flag
from mailsift.operators import (
    add_mail_date, build_prompts, choose_body, dedupe_first, drop_tail, explode_parts, extract_anchors,
    extract_items, filter_run_day, funnel_counts, infer, items_panel, keep_links,
    keyword_filter, keyword_semi_join, markdown_outline, number_items, parse_headers,
    project_headers, rank_messages, render_item_list, render_report, report_metadata,
    report_totals,
)
from mailsift.operators.bodies import decode_bodies, drop_empty_bodies
from mailsift.operators.documents import PART_BYTES
from mailsift.operators.extract import dedupe_in_message
from mailsift.operators.items import ITEM_ORDER
from mailsift.plans import standins as S
from mailsift.plans.digest import DigestParams, digest, digest_stages
from mailsift.operators.headers import header_fields
from mailsift.session import checkpoint_dir, shuffles_freed, spread, written
from mailsift.sinks import (
    text_file_digests, write_items_jsonl, write_reports, write_summaries, write_text_documents,
    write_text_files,
)
from mailsift.sources import latest_n, load_table, read_archive, stream_archive, write_archive

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return load_table(spark, d, name)


# ---------------------------------------------------------------- S2, S3, S4

def latest_messages(spark, d):
    ev = _t(spark, d, "events").select("event_id", "ts", "event_type")
    return latest_n(ev, 100, "event_id")


def latest_per_type(spark, d):
    ev = _t(spark, d, "events").select("event_id", "ts", "event_type")
    return latest_n(ev, 10, "event_id", by="event_type")


def latest_then_filter(spark, d):
    ev = _t(spark, d, "events").select("event_id", "ts", "event_type")
    return latest_n(ev, 100, "event_id").filter(F.col("event_type").isin("click", "purchase"))


def terms_normalised(spark, d):
    p = _t(spark, d, "part")
    raw = F.concat_ws(",", F.col("p_name"), F.concat(F.lit("  "), F.upper("p_type"), F.lit(" ")),
                      F.lit(""), F.col("p_brand"))
    terms = normalise_terms(raw)
    return p.select("p_partkey", raw.alias("raw"), F.array_join(terms, "|").alias("terms"),
                    F.size(terms).alias("n_terms"))


def flags_parsed(spark, d):
    o = _t(spark, d, "orders")
    sel = F.pmod(F.col("o_orderkey"), F.lit(6))
    raw = (F.when(sel == 0, "TRUE").when(sel == 1, " yes").when(sel == 2, "On")
           .when(sel == 3, "1").when(sel == 5, "no"))
    return o.select("o_orderkey", raw.alias("flag_raw"), parse_flag(raw).alias("flag"),
                    parse_flag(raw, default=True).alias("flag_default_true"))


# ---------------------------------------------------------------- H1-H6

def headers_projected(spark, d):
    p = _t(spark, d, "pages")
    host = S.html_host("url")
    src = p.select(
        F.col("page_id").alias("uid"),
        F.when(F.pmod("page_id", F.lit(7)) == 0, F.lit(None))
        .otherwise(F.concat(F.lit("Alerts <alerts@"), host, F.lit(">"))).alias("from"),
        F.when(F.pmod("page_id", F.lit(5)) == 0, F.lit(None))
        .otherwise(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1)).alias("subject"),
        F.when(F.pmod("page_id", F.lit(3)) == 0, F.lit(None))
        .otherwise(F.concat(F.lit("page "), F.col("page_id").cast("string"))).alias("date"))
    return project_headers(src)


def sender_normalised(spark, d):
    c = _t(spark, d, "customer")
    raw = S.from_header(F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment"))
    return c.select("c_custkey", raw.alias("from_hdr"), normalise_address(raw).alias("address"))


def _order_dates(spark, d):
    o = spread(_t(spark, d, "orders"), key="o_orderkey")
    ts0 = F.timestamp_add("SECOND", F.pmod("o_orderkey", F.lit(86400)), F.col("o_orderdate"))
    return o.select("o_orderkey", S.mail_date_header(ts0, F.col("o_orderkey")).alias("date_hdr"))


def mail_date_parsed(spark, d):
    parsed = add_mail_date(_order_dates(spark, d), "date_hdr", "dt")
    return parsed.select("o_orderkey", "date_hdr", "dt.ts", "dt.zoned", "dt.offset_min",
                         "dt.wall_date")


def _event_headers(spark, d):
    ev = spread(_t(spark, d, "events"), key="event_id")
    return ev.select("event_id", "ts", S.mail_date_header(F.col("ts"), F.col("event_id"))
                     .alias("date_hdr"))


def run_day_messages(spark, d):
    hdr = add_mail_date(_event_headers(spark, d), "date_hdr", "dt")
    return filter_run_day(hdr, "2024-01-07", True, "UTC").select("event_id", "ts", "date_hdr")


def messages_ranked(spark, d):
    ev = _t(spark, d, "events").withColumn("day", F.to_date("ts"))
    return rank_messages(ev, "event_id", by="day").select("day", "event_id", "event_type", "props",
                                                          "msg_rank")


# ---------------------------------------------------------------- B1-B4

def _conv_parts(spark, d):
    c = _t(spark, d, "conversations")
    role = F.col("role")
    return c.select(
        F.col("conv_id").alias("uid"), F.col("turn").cast("int").alias("part_no"),
        F.lit("Y").alias("multipart"),
        F.when(role == "assistant", "text/html").when(role == "user", "text/plain")
        .otherwise("application/json").alias("content_type"),
        F.col("text"))


def body_chosen(spark, d):
    bodies = choose_body(_conv_parts(spark, d))
    return bodies.filter(F.col("html") != "")


def parts_exploded(spark, d):
    raw = S.conversation_raw(_t(spark, d, "conversations"))
    with_hdr = parse_headers(raw).withColumn("sender", normalise_address(F.col("from")))
    parts = explode_parts(with_hdr, keep=("uid", "sender", "subject"))
    return parts.select("uid", "sender", "subject", "part_no", "multipart", "content_type",
                        "charset", "text")


def message_bodies(spark, d):
    raw = S.conversation_raw(_t(spark, d, "conversations"))
    return drop_empty_bodies(decode_bodies(raw)).select("uid", "html")


def _archive(spark, d):
    """The pages as alert messages in archives of the shared folder."""
    path = os.path.join(checkpoint_dir(spark), f"archive-{uuid.uuid4().hex}")
    write_archive(S.page_raw_messages(_t(spark, d, "pages")), path)
    return path


def _mail_facts(messages):
    bodies = decode_bodies(header_fields(messages), keep=("uid", "from", "subject", "date"))
    return bodies.select("uid", "from", "subject", "date", F.md5("html").alias("html_md5"))


def archive_scanned(spark, d):
    """Archives written, then read as a batch."""
    return _mail_facts(read_archive(spark, _archive(spark, d)))


def archive_streamed(spark, d):
    """The same archives as a stream, file by file."""
    path, out = _archive(spark, d), os.path.join(checkpoint_dir(spark), f"streamed-{uuid.uuid4().hex}")
    (stream_archive(spark, path, 1).writeStream.format("parquet").trigger(availableNow=True)
     .option("checkpointLocation", out + "-progress").start(out).awaitTermination())
    return _mail_facts(spark.read.schema("uid LONG, raw BINARY").parquet(out))


# ---------------------------------------------------------------- X1-X7

def _page_anchors(spark, d, min_len=4, report_by=()):
    msgs = S.page_messages(_t(spark, d, "pages"))
    a = extract_anchors(msgs, keep=[*report_by, "uid"])
    return keep_links(a, min_len=min_len, contains=(), prefixes=S.PAGE_PREFIXES)


def anchors_extracted(spark, d):
    return _page_anchors(spark, d).select("uid", "pos", "title", "link")


def anchors_parsed(spark, d):
    msgs = S.page_messages(_t(spark, d, "pages"))
    items = extract_items(msgs, keep=("uid",), contains=(), prefixes=S.PAGE_PREFIXES,
                          dedupe=False)
    return items.select("uid", "pos", "title", "link", "abstract")


def titles_removed(spark, d):
    msgs = S.page_messages(_t(spark, d, "pages"))
    items = extract_items(msgs, keep=("uid",), block_tags=("ul",), contains=(),
                          prefixes=S.PAGE_PREFIXES, dedupe=True)
    return items.select("uid", "pos", "title", "link", "abstract")


def siblings_of_lines(spark, d):
    """X5 over whole texts: an anchor and its sibling for every line, outside any block."""
    number = F.col("doc_id").cast("string")

    def item(line, i):
        at = (i + 1).cast("string")
        return F.concat(F.lit("<section><a href=\"/"), number, F.lit("/"), at, F.lit("\">item "),
                        number, F.lit(" line "), at, F.lit("</a><em>"),
                        F.regexp_replace(line, "[<>&]", " "), F.lit("</em></section>"))

    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    html = F.concat(F.lit("<body>"), F.array_join(F.transform(lines, item), ""), F.lit("</body>"))
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("uid"), html.alias("html"))
    return extract_items(docs, contains=(), prefixes=S.PAGE_PREFIXES).select(
        "uid", "pos", "title", "link", "abstract")


def items_deduped_per_message(spark, d):
    a = _page_anchors(spark, d, min_len=1)
    return dedupe_in_message(a).select("uid", "pos", "title", "link")


def items_deduped(spark, d):
    return dedupe_first(_page_anchors(spark, d)).select("uid", "pos", "title", "link")


def items_tail_dropped(spark, d):
    uniq = written(dedupe_first(_page_anchors(spark, d)))
    return drop_tail(uniq, ITEM_ORDER, 2).select("uid", "pos", "title", "link")


def items_tail_dropped_by_sender(spark, d):
    a = _page_anchors(spark, d, report_by=("sender",))
    uniq = written(dedupe_first(a, by=("sender",)))
    return drop_tail(uniq, ITEM_ORDER, 2, by=("sender",)).select(
        "sender", "uid", "pos", "title", "link")


# ---------------------------------------------------------------- I3-I5

def _docs(spark, d):
    return S.doc_items(_t(spark, d, "documents"))


def keyword_selected(spark, d):
    return keyword_filter(_docs(spark, d), S.DOC_TERMS).select("doc_id", "source", "title")


def _benchmark_terms(spark, d):
    b = _t(spark, d, "benchmark")
    return b.select(F.explode(F.regexp_extract_all("text", F.lit(r"(\p{L}{6,})"), 1)).alias("term"))


def keyword_selected_table(spark, d):
    return keyword_semi_join(_docs(spark, d), _benchmark_terms(spark, d),
                             row_key=("doc_id",)).select("doc_id", "source", "title")


def items_numbered(spark, d):
    docs = _t(spark, d, "documents")
    return number_items(docs, ["doc_id"], by=["source"]).select(
        "source", "doc_id", F.md5("text").alias("text_md5"), "ordinal")


def items_null_keys(spark, d):
    """Tail drop and numbering where report keys are null and empty, and mailboxes share uids."""
    docs = _t(spark, d, "documents")
    kind = F.pmod("doc_id", F.lit(5))
    docs = docs.select(
        F.when(kind == 0, F.lit(None)).when(kind == 1, "").otherwise(F.col("source")).alias("report"),
        F.pmod("doc_id", F.lit(4)).alias("box"), F.floor(F.col("doc_id") / 4).alias("uid"), "text")
    order = ["box", ("uid", False)]
    saved = drop_tail(docs, order, 2, by=("report",))
    return number_items(saved, order, by=["report"]).select(
        "report", "box", "uid", F.md5("text").alias("text_md5"), "ordinal")


# ---------------------------------------------------------------- A1, A2

def _sender_digest_params():
    return DigestParams(report_by=("sender",), contains=(), prefixes=S.PAGE_PREFIXES,
                        terms=list(S.PAGE_TERMS), extractor="native")


def report_totals_q(spark, d):
    msgs = S.page_messages(_t(spark, d, "pages"))
    sel = digest_stages(msgs, _sender_digest_params())["selected"]
    return report_totals(sel, ["sender"])


def stage_funnel(spark, d):
    msgs = S.page_messages(_t(spark, d, "pages"))
    st = digest_stages(msgs, replace(_sender_digest_params(), materialise_items=True))
    return funnel_counts({k: st[k] for k in ("scanned", "items", "unique", "saved", "selected")},
                         ["sender"])


# ---------------------------------------------------------------- P1, K2, K5, K6, P2, P3

def _numbered_docs(spark, d, terms=None):
    docs = _docs(spark, d)
    if terms:
        docs = keyword_filter(docs, terms)
    return number_items(docs, ["doc_id"], by=["lang"])


def prompt_text(spark, d):
    return build_prompts(_numbered_docs(spark, d), S.REPORT_TERMS, ["lang"],
                         bytes_per_part=PART_BYTES)


def item_list_text(spark, d):
    return render_item_list(_numbered_docs(spark, d), ["lang"], bytes_per_part=PART_BYTES)


def report_metadata_q(spark, d):
    sel = _numbered_docs(spark, d, S.REPORT_TERMS)
    return report_metadata(sel, S.REPORT_TERMS, ["lang"], S.GENERATED_AT)


def items_panel_q(spark, d):
    sel = _numbered_docs(spark, d, S.REPORT_TERMS)
    return items_panel(sel, S.REPORT_TERMS, ["lang"], bytes_per_part=PART_BYTES)


def summaries(spark, d):
    prompts = build_prompts(_numbered_docs(spark, d, S.REPORT_TERMS), S.REPORT_TERMS, ["lang"],
                            bytes_per_part=PART_BYTES)
    return infer(prompts, "echo", key=["lang", "chunk"])


def report_html(spark, d):
    # metadata and prompts both read the numbered selection: number it once
    sel = written(_numbered_docs(spark, d, S.REPORT_TERMS))
    meta = report_metadata(sel, S.REPORT_TERMS, ["lang"], S.GENERATED_AT)
    prompts = build_prompts(sel, S.REPORT_TERMS, ["lang"], bytes_per_part=PART_BYTES)
    summ = infer(prompts, "echo", key=["lang", "chunk"])
    return render_report(meta, summ, ["lang"])


# ---------------------------------------------------------------- K1-K4, K7, I6: written, read back

def _folder(spark, name):
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _sender_stages(spark, d, terms=()):
    p = replace(_sender_digest_params(), terms=list(terms))
    return digest_stages(S.page_messages(_t(spark, d, "pages")), p), p


def items_filed(spark, d):
    """K1: saved items as JSON lines in a folder for each sender."""
    stages, p = _sender_stages(spark, d)
    path = _folder(spark, "items")
    write_items_jsonl(number_items(stages["saved"], p.item_order, by=["sender"]), path, ["sender"])
    kind = "title string, link string, abstract string, report string"
    return spark.read.schema(kind).json(path).select("report", "title", "link", "abstract")


def lists_filed(spark, d):
    """K2: the list of saved documents as one text file for each language."""
    path = _folder(spark, "lists")
    with shuffles_freed(spark):
        parts = render_item_list(_numbered_docs(spark, d), ["lang"], items_per_part=1)
        write_text_files(parts, path, "markdown", ["lang"], order=["chunk"])
    return text_file_digests(spark, path)


def prompts_filed(spark, d):
    """K3: prompts in a folder for each language."""
    path = _folder(spark, "prompts")
    write_text_documents(prompt_text(spark, d), path, "prompt", ["lang"])
    return spark.read.parquet(path).select("lang", "chunk", "text")


def summaries_filed(spark, d):
    """K4: summaries in a folder for each language and backend."""
    path = _folder(spark, "summaries")
    write_summaries(summaries(spark, d), path, ["lang", "backend"])
    return spark.read.parquet(path).select("report", "lang", "chunk", "backend", "summary", "error")


def reports_rerun(spark, d):
    """All senders' reports, then a rerun with keywords that leaves some of them empty."""
    path, stages = _folder(spark, "reports"), _sender_stages(spark, d)[0]
    touched = written(stages["scanned"].select("sender").distinct(), "touched")
    write_reports(stages["saved"].select("sender", "uid", "pos", "title"), path, ["sender"], touched)
    stages = _sender_stages(spark, d, S.RERUN_TERMS)[0]
    write_reports(stages["selected"].select("sender", "uid", "pos", "title"), path, ["sender"], touched)
    return spark.read.parquet(path).select("report", "sender", "uid", "pos", "title")


def markdown_outline_q(spark, d):
    md = S.conversation_markdown(_t(spark, d, "conversations"))
    return markdown_outline(md, ["conv_id", "turn"])


# ---------------------------------------------------------------- flagship

def _digest_params(**kw):
    base = dict(contains=(), prefixes=S.PAGE_PREFIXES, terms=list(S.PAGE_TERMS),
                extractor="native")
    base.update(kw)
    return DigestParams(**base)


def digest_q(spark, d):
    msgs = S.page_messages(_t(spark, d, "pages"))
    return digest(msgs, _digest_params())


def digest_latest(spark, d):
    msgs = S.page_messages(_t(spark, d, "pages"))
    return digest(msgs, _digest_params(recent=100))


def digest_by_sender(spark, d):
    msgs = S.page_messages(_t(spark, d, "pages"))
    return digest(msgs, _digest_params(report_by=("sender",)))


def digest_parsed(spark, d):
    msgs = S.page_messages(_t(spark, d, "pages"))
    return digest(msgs, _digest_params(extractor="parser", block_tags=("ul",)))


def digest_raw(spark, d):
    pages = _t(spark, d, "pages")
    raw = S.page_raw_messages(pages)
    return digest(raw, _digest_params(senders=S.blog_senders(pages)))


def digest_incremental(spark, d):
    from mailsift.streaming.incremental import incremental_digest_from_table
    return incremental_digest_from_table(spark, d, _digest_params())


def digest_incremental_latest(spark, d):
    from mailsift.streaming.incremental import incremental_digest_from_table
    return incremental_digest_from_table(spark, d, _digest_params(recent=100))


QUERIES: dict[str, Query] = {
    "latest_messages": latest_messages,
    "latest_per_type": latest_per_type,
    "latest_then_filter": latest_then_filter,
    "terms_normalised": terms_normalised,
    "flags_parsed": flags_parsed,
    "headers_projected": headers_projected,
    "sender_normalised": sender_normalised,
    "mail_date_parsed": mail_date_parsed,
    "run_day_messages": run_day_messages,
    "messages_ranked": messages_ranked,
    "body_chosen": body_chosen,
    "parts_exploded": parts_exploded,
    "message_bodies": message_bodies,
    "archive_scanned": archive_scanned,
    "archive_streamed": archive_streamed,
    "anchors_extracted": anchors_extracted,
    "anchors_parsed": anchors_parsed,
    "titles_removed": titles_removed,
    "siblings_of_lines": siblings_of_lines,
    "items_deduped_per_message": items_deduped_per_message,
    "items_deduped": items_deduped,
    "items_tail_dropped": items_tail_dropped,
    "items_tail_dropped_by_sender": items_tail_dropped_by_sender,
    "keyword_selected": keyword_selected,
    "keyword_selected_table": keyword_selected_table,
    "items_numbered": items_numbered,
    "items_null_keys": items_null_keys,
    "report_totals": report_totals_q,
    "stage_funnel": stage_funnel,
    "prompt_text": prompt_text,
    "item_list_text": item_list_text,
    "report_metadata": report_metadata_q,
    "items_panel": items_panel_q,
    "summaries": summaries,
    "report_html": report_html,
    "items_filed": items_filed,
    "lists_filed": lists_filed,
    "prompts_filed": prompts_filed,
    "summaries_filed": summaries_filed,
    "reports_rerun": reports_rerun,
    "markdown_outline": markdown_outline_q,
    "digest": digest_q,
    "digest_latest": digest_latest,
    "digest_by_sender": digest_by_sender,
    "digest_parsed": digest_parsed,
    "digest_raw": digest_raw,
    "digest_incremental": digest_incremental,
    "digest_incremental_latest": digest_incremental_latest,
}
