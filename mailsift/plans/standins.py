"""Derivations that turn the driver tables into the shapes the digest consumes.

Each is a narrow projection of a real table, so work grows with the data.
Modulo expressions below only *choose a format* per row; no row is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsift.functions.text import html_host
from mailsift.session import spread

# Fixed parameters of the stand-in queries.
RUN_DATE = "2025-11-19"
GENERATED_AT = "2025-11-19 09:05:00"
PAGE_PREFIXES = ("/",)
PAGE_TERMS = ("tion", "ch", "the")
RERUN_TERMS = ("tzä", "nicht", "the,")
DOC_TERMS = ("license", "nicht", "être")
REPORT_TERMS = ("license", "nicht", "être", "the", "que", "ung")


def page_messages(pages: DataFrame) -> DataFrame:
    """pages -> messages: ``uid`` = page_id, ``sender`` = host of the url."""
    return spread(pages, key="page_id").select(
        F.col("page_id").alias("uid"), html_host("url").alias("sender"),
        F.to_date(F.lit(RUN_DATE)).alias("report_date"), "html")


def doc_items(documents: DataFrame) -> DataFrame:
    """documents -> items: title = first line, abstract = the rest (null if none)."""
    nl = F.instr(F.col("text"), "\n")
    return spread(documents, key="doc_id").select(
        "doc_id", "lang", "source",
        F.substring_index(F.col("text"), "\n", 1).alias("title"),
        F.concat(F.lit("doc://"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"))
        .alias("link"),
        F.when(nl > 0, F.expr("substring(text, instr(text, '\n') + 1)")).alias("abstract"))


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def format_ntz(ts: Column, pattern_date: str, seconds: bool = True,
               weekday: bool = False) -> Column:
    """Format a TIMESTAMP_NTZ as ``[EEE, ]<date pattern> HH:mm[:ss]`` without the session zone.

    ``date_format`` on an NTZ value goes through the session time zone, which
    moves wall times that fall into a daylight-saving gap; the date part is
    formatted from the DATE and the clock part from its fields instead.
    """
    day = F.to_date(ts)
    clock = F.concat(_two(F.hour(ts)), F.lit(":"), _two(F.minute(ts)))
    if seconds:
        clock = F.concat(clock, F.lit(":"), _two(F.second(ts)))
    text = F.concat(F.date_format(day, pattern_date), F.lit(" "), clock)
    if weekday:
        text = F.concat(F.date_format(day, "EEE"), F.lit(", "), text)
    return text


def mail_date_header(ts: Column, key: Column) -> Column:
    """A mail Date header for ``ts`` in one of eight spellings chosen by ``key % 8``."""
    sel = F.pmod(key, F.lit(8))
    full = format_ntz(ts, "d MMM yyyy", weekday=True)
    plain = format_ntz(ts, "d MMM yyyy")
    plus1 = format_ntz(F.timestamp_add("HOUR", F.lit(1), ts), "d MMM yyyy", seconds=False)
    minus530 = format_ntz(F.timestamp_add("MINUTE", F.lit(-330), ts), "d MMM yy")
    return (F.when(sel == 0, F.concat(full, F.lit(" +0000")))
            .when(sel == 1, F.concat(plus1, F.lit(" +0100")))
            .when(sel == 2, F.concat(full, F.lit(" GMT")))
            .when(sel == 3, F.concat(plain, F.lit(" -0000")))
            .when(sel == 4, plain)
            .when(sel == 5, F.concat(minus530, F.lit(" -0530")))
            .when(sel == 6, F.concat(full, F.lit(" +0000 (UTC)")))
            .otherwise(F.concat(F.lit("not a date "), key.cast("string"))))


def from_header(key: Column, name: Column, segment: Column) -> Column:
    """A From header in one of six shapes chosen by ``key % 6``."""
    sel = F.pmod(key, F.lit(6))
    k = key.cast("string")
    return (F.when(sel == 0, F.concat(name, F.lit(" <"), F.upper(segment), F.lit("."), k,
                                      F.lit("@Example.COM>")))
            .when(sel == 1, F.concat(F.lower(segment), k, F.lit("@example.com")))
            .when(sel == 2, F.concat(F.lit('"'), name, F.lit(', Jr" <x'), k,
                                     F.lit("@Mail.Example.org>")))
            .when(sel == 3, F.concat(F.lit("a"), k, F.lit("@x.com, b@y.com")))
            .when(sel == 4, F.concat(F.lit("User"), k, F.lit("@Example.com ("), name, F.lit(")")))
            .otherwise(F.lit("<>")))


def conversation_raw(conversations: DataFrame) -> DataFrame:
    """conversations -> one RFC 822 message per turn (``uid`` = conv_id * 100 + turn).

    assistant turns become base64 ``text/html``, user turns 8-bit
    ``text/plain``, other roles an ``application/json`` part.
    """
    role = F.col("role")
    ctype = (F.when(role == "assistant", F.lit("text/html"))
             .when(role == "user", F.lit("text/plain"))
             .otherwise(F.lit("application/json")))
    b64 = role == "assistant"
    head = F.concat(
        F.lit("From: Conversation "), F.col("conv_id").cast("string"),
        F.lit(" <conv"), F.col("conv_id").cast("string"), F.lit("@Example.org>\r\n"),
        F.lit("Subject: turn "), F.col("turn").cast("string"), F.lit("\r\n"),
        F.lit("MIME-Version: 1.0\r\nContent-Type: "), ctype, F.lit('; charset="utf-8"\r\n'),
        F.lit("Content-Transfer-Encoding: "), F.when(b64, F.lit("base64")).otherwise(F.lit("8bit")),
        F.lit("\r\n\r\n"))
    body = F.when(b64, F.base64(F.encode(F.col("text"), "UTF-8"))).otherwise(F.col("text"))
    return conversations.select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("uid"),
        F.encode(F.concat(head, body), "UTF-8").alias("raw"))


def page_raw_messages(pages: DataFrame) -> DataFrame:
    """pages -> RFC 822 alert messages: From the site's alerts address (upper-cased
    domain), a Date derived from the page id, base64 ``text/html`` body."""
    host = html_host("url")
    ts = F.timestamp_add("MINUTE", F.col("page_id"), F.lit("2025-11-19 00:00:00").cast("timestamp_ntz"))
    head = F.concat(
        F.lit("From: Site alerts <alerts@"), F.upper(host), F.lit(">\r\n"),
        F.lit("Subject: page "), F.col("page_id").cast("string"), F.lit("\r\n"),
        F.lit("Date: "), format_ntz(ts, "d MMM yyyy", weekday=True), F.lit(" +0000\r\n"),
        F.lit('MIME-Version: 1.0\r\nContent-Type: text/html; charset="utf-8"\r\n'),
        F.lit("Content-Transfer-Encoding: base64\r\n\r\n"))
    return pages.select(
        F.col("page_id").alias("uid"), F.to_date(F.lit(RUN_DATE)).alias("report_date"),
        F.encode(F.concat(head, F.base64(F.encode(F.col("html"), "UTF-8"))), "UTF-8")
        .alias("raw"))


def blog_senders(pages: DataFrame) -> DataFrame:
    """Allow-list table derived from pages: the alerts address of every ``blog.`` site."""
    host = html_host("url")
    return (pages.select(F.concat(F.lit("alerts@"), host).alias("address"))
            .filter(F.col("address").startswith("alerts@blog.")).distinct())


def conversation_markdown(conversations: DataFrame) -> DataFrame:
    """conversations -> a Markdown document per turn: ``## role turn N`` over ``###`` lines."""
    md = F.concat(F.lit("## "), F.col("role"), F.lit(" turn "), F.col("turn").cast("string"),
                  F.lit("\n"), F.regexp_replace(F.col("text"), r"(?m)^", "### "))
    return conversations.select("conv_id", "turn", md.alias("markdown"))
