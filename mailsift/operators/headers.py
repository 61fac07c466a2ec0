"""Header projection, predicates and ordering (H1, H3-H6)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from mailsift.functions.mail import (
    DATE_FIELDS, DATE_RE, date_from_fields, date_group_list, library_date, local_date,
    normalise_address,
    normalise_date_text,
)
from mailsift.operators.order import ordinal

HEADER_FIELDS = ("from", "subject", "date")


def project_headers(df: DataFrame, keep: Sequence[str] = ("uid",)) -> DataFrame:
    """H1: keep From/Subject/Date; a missing header becomes ``''``.

    A message whose header record is absent altogether (all three null) is
    skipped, like a failed header fetch.
    """
    present = [F.col(f"`{h}`").isNotNull() for h in HEADER_FIELDS]
    any_present = present[0] | present[1] | present[2]
    return df.filter(any_present).select(
        *keep, *[F.coalesce(F.col(f"`{h}`"), F.lit("")).alias(h) for h in HEADER_FIELDS])


def _header_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from email.parser import BytesHeaderParser

    parser = BytesHeaderParser()
    for pdf in batches:
        vals = {h: [] for h in HEADER_FIELDS}
        for raw in pdf["raw"]:
            if raw is None:
                for h in HEADER_FIELDS:
                    vals[h].append(None)
                continue
            msg = parser.parsebytes(bytes(raw))
            for h in HEADER_FIELDS:
                v = msg.get(h.capitalize())
                vals[h].append(None if v is None else str(v))
        out = pdf.copy()
        for h in HEADER_FIELDS:
            out[h] = vals[h]
        yield out


def parse_headers(raw_df: DataFrame) -> DataFrame:
    """Raw RFC 822 bytes -> ``from, subject, date`` columns added (header block only).

    One ``mapInPandas`` pass that parses only the header block, before any
    body is decoded; all input columns pass through so the later body job
    needs no join back to the raw table.
    """
    schema = StructType(list(raw_df.schema.fields)
                        + [StructField(h, StringType()) for h in HEADER_FIELDS])
    return raw_df.mapInPandas(_header_batches, schema)


# A leading blank line means an empty header block.
_HEADER_BLOCK_RE = r"(?s)^(?!\r?\n)(.*?)(?:\r?\n\r?\n|$)"


def header_fields(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Raw RFC 822 bytes -> ``from, subject, date`` columns, JVM-side (H1).

    The header block is everything before the first blank line; a field is
    the first ``Name:`` line in it (name case-insensitive), leading blanks
    dropped, folded continuation lines kept - the same values the standard
    library's header parser returns (``parse_headers``, checked in tests),
    without shipping the message to Python. Absent -> null.
    """
    block = F.regexp_extract(F.col(raw_col).cast("string"), _HEADER_BLOCK_RE, 1)
    cols = [F.col(f"`{c}`") for c in df.columns]
    staged = df.select(*cols, block.alias("__hdr"))
    fields = []
    for h in HEADER_FIELDS:
        pat = rf"(?im)^{h}:[ \t]*(.*(?:\r?\n[ \t].*)*)"
        found = F.col("__hdr").rlike(rf"(?im)^{h}:")
        fields.append(F.when(found, F.regexp_extract("__hdr", pat, 1)).alias(h))
    # Fields leave through a one-row generator so that sender/date filters
    # and the allow-list semi join, which Catalyst pushes below projections,
    # stop here instead of re-running the header regexes over the message.
    return staged.select(*cols, F.inline(F.array(F.struct(*fields))))


def add_sender(df: DataFrame, from_col: str = "from", name: str = "sender") -> DataFrame:
    """H3 as a column: normalised sender address."""
    return df.withColumn(name, normalise_address(F.col(f"`{from_col}`")))


def add_mail_date(df: DataFrame, date_col: str = "date", name: str = "dt") -> DataFrame:
    """H2 as a column: parsed mail date struct (null when unparseable).

    Three stages - normalised text, regex groups, typed struct - so each
    regex runs once per row.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    normalised = df.select(*cols, normalise_date_text(F.col(f"`{date_col}`")).alias("__date_s"))
    # One regex pass for the match flag, one for all groups (split once).
    staged = normalised.select(*cols, F.coalesce(F.col("__date_s").rlike(DATE_RE), F.lit(False))
                               .alias("__date_ok"), date_group_list("__date_s").alias("__date_parts"))
    # Other forms are the library's; the usual ones send it a null.
    odd = F.when(~F.col("__date_ok"), F.col(f"`{date_col}`"))
    staged = staged.select(*cols, "__date_ok", "__date_parts", library_date(odd).alias("__date_lib"))
    refs = {"ok": F.col("__date_ok")}
    refs.update({n: F.try_element_at("__date_parts", F.lit(i))
                 for i, n in enumerate(DATE_FIELDS, 1)})
    # Regex groups are plain columns (not struct fields), so Catalyst keeps
    # them computed once instead of inlining each regex at every use. The
    # parsed struct leaves through a one-row generator: a later filter on it
    # (the run-day predicate) cannot be pushed below the generator and so
    # does not re-inline the parse either.
    return staged.select(*cols, F.inline(F.array(F.struct(
        F.when(F.col("__date_ok"), date_from_fields(refs)).otherwise(F.col("__date_lib"))
        .alias(name)))))


def filter_senders(df: DataFrame, senders: Iterable[str] | DataFrame,
                   sender_col: str = "sender") -> DataFrame:
    """H4: exact membership of the normalised address in the allow-list.

    A literal list becomes an ``InSet`` predicate (pushed into the scan when
    the column is stored). A table becomes a left-semi join on the address;
    the allow-list is a configuration table, and AQE broadcasts it when its
    measured size is under the broadcast threshold.
    """
    if isinstance(senders, DataFrame):
        allow = senders.select(F.col(senders.columns[0]).alias("__addr")).distinct()
        return df.join(allow, F.col(sender_col) == F.col("__addr"), "left_semi")
    return df.filter(F.col(sender_col).isin(list(senders)))


def filter_run_day(df: DataFrame, run_date: str | None, enabled: bool = True,
                   tz: str = "UTC", dt_col: str = "dt") -> DataFrame:
    """H5: keep messages whose date falls on ``run_date`` in time zone ``tz``.

    Zoned dates are converted to ``tz`` first; naive dates keep their wall
    date; an unparseable date fails. Disabled -> no-op (null dates pass).
    ``run_date`` is always a parameter, never the clock.
    """
    if not enabled:
        return df
    return df.filter(local_date(F.col(dt_col), tz) == F.to_date(F.lit(run_date)))


def rank_messages(df: DataFrame, order_col: str = "uid", by: Sequence[str] | str | None = None,
                  name: str = "msg_rank", skew_safe: bool = True) -> DataFrame:
    """H6: newest-first ordinal per report (1 = newest message)."""
    return ordinal(df, by, [(order_col, False)], name=name, skew_safe=skew_safe)
