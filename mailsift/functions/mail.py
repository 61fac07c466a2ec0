"""Mail header scalars: date parse (H2), address normalise (H3).

The forms that mail programs write are read by column expressions (regex +
arithmetic), so header work over billions of messages stays in generated JVM
code. What is none of these forms (old date orders, routes, groups, nested
comments, quoted local parts, broken headers) goes to the standard library in
Arrow batches, so results equal the library's on every header; the other rows
send it a null.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, IntegerType, StringType, StructField,
                               StructType, TimestampNTZType)

from mailsift.functions._util import as_col

# Month names accepted in a mail date (three-letter and full).
MONTHS_SHORT = ["jan", "feb", "mar", "apr", "may", "jun",
                "jul", "aug", "sep", "oct", "nov", "dec"]
MONTHS_LONG = ["january", "february", "march", "april", "may", "june", "july",
               "august", "september", "october", "november", "december"]

# Named zones of RFC 822 and their offsets in minutes.
ZONE_NAMES = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -240, "ADT": -180,
    "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420,
}

# [weekday,] day month year hh:mm[:ss] [zone]; comments removed beforehand.
DATE_RE = _DATE_RE = (r"^(?:[A-Za-z]+,?\s+)?(\d{1,2})\s+([A-Za-z]+)\s+(\d{2,4})\s+"
            r"(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?(?:\s+([+-]\d{4}|[A-Za-z]+))?$")


def _group(s: Column, i: int) -> Column:
    return F.regexp_extract(s, _DATE_RE, i)


def normalise_date_text(c) -> Column:
    """A comment at the end removed, whitespace runs collapsed, ends trimmed."""
    s = F.regexp_replace(as_col(c), r"\s\([^()]*\)\s*$", " ")
    return F.regexp_replace(F.trim(F.regexp_replace(s, r"\s+", " ")), r"^\s+|\s+$", "")


DATE_FIELDS = ("dd", "mon", "yy", "hh", "mi", "ss", "zone")


def date_field_exprs(s) -> dict[str, Column]:
    """Regex groups of a normalised date as separate columns (plus ``ok``)."""
    s = as_col(s)
    out = {"ok": s.rlike(_DATE_RE)}
    out.update({n: _group(s, i) for i, n in enumerate(DATE_FIELDS, 1)})
    return out


def date_group_list(s) -> Column:
    """All regex groups of a normalised date in one regex pass: ``array<string>`` of 7.

    The groups hold only digits, letters and signs, so ``|`` can join them;
    rows that do not match are flagged by ``rlike`` and ignored.
    """
    joined = F.regexp_replace(as_col(s), _DATE_RE,
                              "|".join(f"${i}" for i in range(1, len(DATE_FIELDS) + 1)))
    return F.split(joined, r"\|", -1)


def date_fields(s) -> Column:
    """Regex groups of a normalised date: ``struct<ok, dd, mon, yy, hh, mi, ss, zone>``."""
    return F.struct(*[c.alias(n) for n, c in date_field_exprs(s).items()])


def date_from_fields(g) -> Column:
    """Date fields -> ``struct<ts, zoned, offset_min, wall_date>`` (see ``parse_mail_date``).

    ``g`` is a ``date_fields`` struct column or a mapping of field name to column.
    """
    if isinstance(g, dict):
        g = dict(g)
    else:
        g = {n: as_col(g)[n] for n in ("ok", *DATE_FIELDS)}
    day = g["dd"].try_cast("int")
    mon_txt = F.lower(g["mon"])
    short = F.array_position(F.array(*[F.lit(m) for m in MONTHS_SHORT]), mon_txt)
    long_ = F.array_position(F.array(*[F.lit(m) for m in MONTHS_LONG]), mon_txt)
    month = F.when(short > 0, short).when(long_ > 0, long_).cast("int")
    y_raw = g["yy"]
    y = y_raw.try_cast("int")
    year = F.when(y > 99, y).when(y > 68, y + 1900).otherwise(y + 2000)
    hour = g["hh"].try_cast("int")
    minute = g["mi"].try_cast("int")
    second = F.when(g["ss"] == "", F.lit(0)).otherwise(g["ss"].try_cast("int"))
    zone = F.upper(g["zone"])
    numeric = zone.rlike(r"^[+-]\d{4}$")
    sign = F.when(F.substring(zone, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    num_off = sign * (F.substring(zone, 2, 2).try_cast("int") * 60
                      + F.substring(zone, 4, 2).try_cast("int"))
    named = F.create_map(*[x for k, v in ZONE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    offset = (F.when(zone == "-0000", F.lit(None))
              .when(numeric, num_off)
              .otherwise(F.element_at(named, zone))).cast("int")
    wall = F.try_make_timestamp_ntz(year, month, day, hour, minute, second.cast("decimal(16,6)"))
    ts = F.when(offset.isNull(), wall).otherwise(
        F.timestamp_add("MINUTE", -offset, wall))
    valid = g["ok"] & wall.isNotNull() & (second < 60) & (F.coalesce(F.abs(offset), F.lit(0)) < 24 * 60)
    return F.when(valid, F.struct(
        ts.alias("ts"),
        offset.isNotNull().alias("zoned"),
        offset.alias("offset_min"),
        F.to_date(wall).alias("wall_date"),
    ))


_PARSED = StructType([StructField("ts", TimestampNTZType()), StructField("zoned", BooleanType()),
                      StructField("offset_min", IntegerType()), StructField("wall_date", DateType())])


def _library_date(text: str | None) -> dict | None:
    from email.utils import parsedate_to_datetime

    if not text:
        return None
    try:
        at = parsedate_to_datetime(text)
        offset = at.utcoffset()
        wall = at.replace(tzinfo=None)
        return {"ts": wall if offset is None else wall - offset, "zoned": offset is not None,
                "offset_min": None if offset is None else offset // dt.timedelta(minutes=1),
                "wall_date": wall.date()}
    except Exception:  # whatever a header holds, it is a date or it is none
        return None


def library_date(c: Column) -> Column:
    """The library's reading of a date, as the struct of ``parse_mail_date``."""
    kind = pa.struct([("ts", pa.timestamp("us")), ("zoned", pa.bool_()), ("offset_min", pa.int32()),
                      ("wall_date", pa.date32())])

    @F.arrow_udf(_PARSED)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_library_date(t) for t in batch.to_pylist()], kind)
    return of(c)


def parse_mail_date(c) -> Column:
    """H2: RFC 2822 date string -> ``struct<ts, zoned, offset_min, wall_date>``.

    * ``ts`` (TIMESTAMP_NTZ): the UTC instant when the date carries a zone,
      otherwise the wall-clock time as written (a *naive* date).
    * ``zoned``: false when the zone is missing, unknown or ``-0000``.
    * ``wall_date``: calendar date as written in the header.

    Anything that does not parse yields a null struct, never an error.
    As one expression the regex runs once per group; over large tables
    prefer ``operators.headers.add_mail_date``, which stages the work in
    three projections so every regex is evaluated once per row.
    """
    text = normalise_date_text(c)
    usual = F.coalesce(text.rlike(_DATE_RE), F.lit(False))
    return F.when(usual, date_from_fields(date_fields(text))) \
        .otherwise(library_date(F.when(~usual, as_col(c))))


def local_date(parsed, tz: str) -> Column:
    """Calendar date of a parsed mail date on a machine in time zone ``tz``.

    Zoned times are converted from UTC to ``tz``; naive times keep their own
    wall date. Null stays null.
    """
    p = as_col(parsed)
    # convert_timezone works on TIMESTAMP_NTZ values, so the result does not
    # depend on the session time zone.
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), p["ts"])
    return F.when(p["zoned"], F.to_date(local)).otherwise(p["wall_date"])


# The characters of an atom and of a plain domain; a display name of words,
# dots and quoted strings without escapes.
_ATOM = r"[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+"
_SPEC = rf"({_ATOM}(?:\.{_ATOM})*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)"
_NAME = r"""(?:[^()<>@,;:\\"\[\]\r\n]|"[^"\\()\r\n]*")*"""
_USUAL_ADDRESS = rf"^(?:[ \t]*{_SPEC}[ \t]*|{_NAME}<{_SPEC}>[ \t]*)$"


def _library_address(header: str | None) -> str | None:
    from email.utils import parseaddr

    if header is None:
        return None
    try:
        return parseaddr(header)[1].lower()
    except Exception:  # as the source tool: the header itself
        return header.lower().strip()


def normalise_address(c) -> Column:
    """H3: the single address of a From header, lower-cased; ``''`` otherwise.

    ``name <local@domain>`` and ``local@domain`` with plain names, local parts and
    domains are read here; every other header by the standard library.
    """
    raw = F.coalesce(as_col(c), F.lit(""))
    usual = raw.rlike(_USUAL_ADDRESS)
    address = F.concat(F.regexp_extract(raw, _USUAL_ADDRESS, 1), F.regexp_extract(raw, _USUAL_ADDRESS, 2))

    @F.arrow_udf(StringType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([_library_address(h) for h in batch.to_pylist()], pa.string())

    return F.when(raw == "", "").when(usual, F.lower(address)) \
        .otherwise(of(F.when(~usual & (raw != ""), raw)))
