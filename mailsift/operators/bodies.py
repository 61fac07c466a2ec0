"""Body decode and selection."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from mailsift.session import small_batches

# The plain-text wrapper (text is not escaped).
PLAIN_PREFIX = "<html><body><pre>"
PLAIN_SUFFIX = "</pre></body></html>"

PART_FIELDS = [
    StructField("part_no", IntegerType()),
    StructField("multipart", StringType()),
    StructField("content_type", StringType()),
    StructField("charset", StringType()),
    StructField("text", StringType()),
    StructField("error", StringType()),
]


def decode_parts(raw: bytes) -> list[tuple]:
    """One RFC 822 message -> its leaf parts in depth-first order.

    ``(part_no, multipart, content_type, charset, text, error)``: transfer
    encoding decoded; charset (default utf-8) decoded dropping bad bytes;
    ``text`` is null when the part has no payload. A charset that cannot be
    used, or a message that cannot be read, gives null text and an ``error``
    instead of aborting the job.
    """
    try:
        return _parts(bytes(raw))
    except Exception as e:  # one message must not end the job; its error is kept
        return [(1, "N", "", "", None, f"unreadable message: {type(e).__name__}: {e}")]


def _parts(raw: bytes) -> list[tuple]:
    import email

    msg = email.message_from_bytes(raw)
    multi = "Y" if msg.is_multipart() else "N"
    out = []
    parts = [p for p in msg.walk() if not p.is_multipart()] if msg.is_multipart() else [msg]
    for i, part in enumerate(parts, 1):
        ctype = part.get_content_type()
        charset = part.get_content_charset() or "utf-8"
        payload = part.get_payload(decode=True)
        text, err = None, None
        if payload is not None:
            try:
                text = payload.decode(charset, errors="ignore")
            except (LookupError, ValueError) as e:  # no such charset, or one for no text
                err = f"unknown charset: {e}"
        out.append((i, multi, ctype, charset, text, err))
    return out


def explode_parts(df: DataFrame, raw_col: str = "raw", keep: Sequence[str] = ("uid",)) -> DataFrame:
    """B1: one row per leaf MIME part (``mapInArrow`` over message partitions).

    Apply header filters before this: predicates do not pass through Python.
    """
    small_batches(df.sparkSession)
    keep = list(keep)
    schema = StructType([df.schema[k] for k in keep] + PART_FIELDS)
    kinds = [pa.int32(), *[pa.string()] * (len(PART_FIELDS) - 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, *part) for i, raw in enumerate(batch.column(len(keep)).to_pylist())
                     if raw is not None for part in decode_parts(raw)]
            at, *fields = zip(*found) if found else [()] * (len(PART_FIELDS) + 1)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(at, pa.int32())) for c in range(len(keep))],
                 *[pa.array(list(f), k) for f, k in zip(fields, kinds)]], schema.names)

    return _raw(df, raw_col, keep).mapInArrow(run, schema)


def _raw(df: DataFrame, raw_col: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keep)], F.col(raw_col).alias("r"))


def pick_body(parts: list[tuple]) -> str:
    """B2 + B3 for one message's ``decode_parts`` output (same rules as ``choose_body``)."""
    if not parts:
        return ""
    if parts[0][1] == "N":
        _, _, ctype, _, text, _ = parts[0]
        if not text:
            return ""
        if ctype == "text/html":
            return text
        if ctype == "text/plain":
            return PLAIN_PREFIX + text + PLAIN_SUFFIX
        return ""
    for p in parts:
        if p[2] == "text/html" and p[4] is not None:
            return p[4]
    for p in parts:
        if p[2] == "text/plain" and p[4] is not None:
            return PLAIN_PREFIX + p[4] + PLAIN_SUFFIX
    return ""


def decode_bodies(df: DataFrame, raw_col: str = "raw", keep: Sequence[str] = ("uid",)) -> DataFrame:
    """B1-B3 in one narrow pass: raw message -> ``keep..., html, error``.

    A message's parts never leave the task that decoded them, so choosing
    the body needs no shuffle and no sort (``choose_body`` is the grouped
    form for part tables that arrive separately). ``error`` is the first decode
    error among the parts, null if there is none. Rows travel in Arrow batches
    bounded by bytes.
    """
    small_batches(df.sparkSession)
    keep = list(keep)
    schema = StructType([df.schema[k] for k in keep] + [StructField("html", StringType()),
                                                        StructField("error", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html, errors = [], []
            for raw in batch.column(len(keep)).to_pylist():
                parts = [] if raw is None else decode_parts(raw)
                html.append(None if raw is None else pick_body(parts))
                errors.append(next((p[5] for p in parts if p[5]), None))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(html, pa.string()),
                 pa.array(errors, pa.string())], schema.names)

    return _raw(df, raw_col, keep).mapInArrow(run, schema)


def wrap_plain(text_col="text"):
    """Plain text as an html document around ``<pre>``, not escaped."""
    t = F.col(text_col) if isinstance(text_col, str) else text_col
    return F.concat(F.lit(PLAIN_PREFIX), t, F.lit(PLAIN_SUFFIX))


def choose_body(parts: DataFrame, key: Sequence[str] = ("uid",),
                part_col: str = "part_no", type_col: str = "content_type",
                text_col: str = "text", multipart_col: str | None = "multipart") -> DataFrame:
    """B2 + B3: one ``html`` per message from its parts.

    Multipart: the first ``text/html`` part with a payload (an empty payload
    counts and gives ``''``), else the first ``text/plain`` with a payload,
    wrapped; else ``''``. Single part: html or wrapped plain by its type;
    an empty payload or another type gives ``''``.

    One aggregate per message: ``min_by`` over a priority key, partial
    aggregation map-side, so a message with many parts never ships them all.
    Messages with no usable part keep ``''`` (conditional aggregate, no join).
    """
    key = list(key)
    ctype = F.lower(F.col(type_col))
    has_payload = F.col(text_col).isNotNull()
    single = F.lit(False) if multipart_col is None else (F.col(multipart_col) == F.lit("N"))
    prio = (F.when(single & (F.col(text_col) == ""), F.lit(None))
            .when(has_payload & (ctype == "text/html"), F.lit(0))
            .when(has_payload & (ctype == "text/plain"), F.lit(1)))
    cand = parts.select(*key, prio.alias("__prio"), F.col(part_col).alias("__part"),
                        F.col(text_col).alias("__text"))
    best = cand.groupBy(*key).agg(
        F.min_by(F.struct("__prio", "__text"),
                 F.when(F.col("__prio").isNotNull(),
                        F.struct("__prio", "__part"))).alias("__best"))
    chosen = F.col("__best.__text")
    html = (F.when(F.col("__best.__prio") == 0, chosen)
            .when(F.col("__best.__prio") == 1, wrap_plain(chosen))
            .otherwise(F.lit("")))
    return best.select(*key, F.coalesce(html, F.lit("")).alias("html"))


def drop_empty_bodies(df: DataFrame, html_col: str = "html") -> DataFrame:
    """Messages without a body produce no items."""
    return df.filter(F.col(html_col) != F.lit(""))
