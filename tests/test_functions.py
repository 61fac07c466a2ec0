"""Column functions against the Python standard library on hand-picked edge cases."""

import datetime as dt
from email.utils import parseaddr, parsedate_to_datetime

import pytest
from pyspark.sql import functions as F

from mailsift.functions import (
    badge_list, escape_html, format_generated_on, local_date, normalise_address,
    normalise_terms, numbered_entry, parse_flag, parse_mail_date, preview_list, remove_title,
    ustrip,
)
from mailsift.operators.headers import add_mail_date


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_ustrip_matches_python_strip(spark):
    vals = ["  a b  ", " x ", "\t\n y \r\x0b\x0c", " z　", "\x1cq\x1f",
            "\x85w\x85", "", "   ", "in side"]
    assert one_col(spark, vals, ustrip) == [v.strip() for v in vals]


ADDRESS_CASES = [
    "Name <ADDR@X.COM>", "a@b.com", '"Doe, John" <j@x.com>', "j@x.com (John)",
    "a@x.com, b@y.com", "<>", "", "John", "John Smith", "A <a@x.com> (c)", "<a@x.com>",
    " Bob   <B@Y.org> ", "x <a@b.com> <c@d.com>", '"a" b <c@d.e>', "weird@", "@x.com",
    "A B <a b@x.com>", "John (x) <j@x.com>", "foo bar@x.com", "MAIL@X.COM",
]


def test_normalise_address_matches_parseaddr(spark):
    got = one_col(spark, ADDRESS_CASES, normalise_address)
    want = [parseaddr(v)[1].lower() for v in ADDRESS_CASES]
    assert got == want


DATE_CASES = [
    "Wed, 19 Nov 2025 10:00:00 +0000", "19 Nov 2025 10:00 +0100",
    "Wed, 1 Jan 2025 10:00:00 GMT", "1 Jan 2025 23:30:00 -0000", "1 Jan 2025 10:00:00",
    "1 Jan 25 10:00:00 +0000", "1 Jan 70 10:00:00 +0000",
    "Wed, 19 Nov 2025 10:00:00 +0000 (UTC)", "Wed, 19 Nov 2025 10:00:00 EST",
    "19 Nov 2025 10:00:00 +0530", "19 Nov 2025 10:00:00 XYZ", "19  Nov  2025  10:00:00  +0100",
    "19 Nov 2025 10:00:00 UT", "19 November 2025 10:00:00 +0000", "19 nov 2025 10:00:00 +0000",
    "19 Nov 2025 1:2:3 +0000", "31 Feb 2025 10:00:00 +0000",
]
BAD_DATES = ["garbage", "", "not a date 7"]


def python_date(v):
    try:
        d = parsedate_to_datetime(v)
    except Exception:  # noqa: BLE001 - mirrors the source's safe parse
        return None
    if d.tzinfo is None:
        return (d, False, d.date())
    utc = d.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return (utc, True, d.date())


@pytest.mark.parametrize("staged", [False, True])
def test_parse_mail_date_matches_stdlib(spark, staged):
    vals = DATE_CASES + BAD_DATES
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    if staged:
        rows = add_mail_date(df, "v", "p").select("p").collect()
    else:
        rows = df.select(parse_mail_date("v").alias("p")).collect()
    got = [None if r.p is None else (r.p.ts, r.p.zoned, r.p.wall_date) for r in rows]
    assert got == [python_date(v) for v in vals]


def test_local_date_converts_zoned_only(spark):
    df = spark.createDataFrame([("1 Jan 2025 23:30:00 -0500",), ("1 Jan 2025 23:30:00",)], "v string")
    out = df.select(local_date(parse_mail_date("v"), "UTC").alias("d")).collect()
    assert [r.d for r in out] == [dt.date(2025, 1, 2), dt.date(2025, 1, 1)]
    tokyo = df.select(local_date(parse_mail_date("v"), "Asia/Tokyo").alias("d")).collect()
    assert tokyo[0].d == dt.date(2025, 1, 2)


def test_normalise_terms_like_config(spark):
    vals = ["electrolyte, Lithium ,, solid electrolyte,  ", "", " , ,", "A,a,A"]
    got = one_col(spark, vals, lambda c: F.array_join(normalise_terms(c), "|"))
    want = ["|".join(k.strip().lower() for k in v.split(",") if k.strip()) for v in vals]
    assert got == want


def test_parse_flag(spark):
    vals = ["true", "TRUE", "1", "yes", "On", " yes", "no", "0", None]
    assert one_col(spark, vals, parse_flag) == [True, True, True, True, True, False, False,
                                                 False, False]
    assert one_col(spark, [None], lambda c: parse_flag(c, default=True)) == [True]


def test_remove_title_and_escape(spark):
    df = spark.createDataFrame(
        [("A title here A title", "A title"), ("A title", "A title"), ("x <b> & y", "zz")],
        "t string, ti string")
    got = [r[0] for r in df.select(remove_title("t", "ti")).collect()]
    assert got == ["here", None, "x <b> & y"]
    esc = df.select(escape_html(F.col("t")).alias("a"), escape_html(F.col("t"), amp=True)
                    .alias("b")).collect()
    assert esc[2].a == "x &lt;b&gt; & y" and esc[2].b == "x &lt;b&gt; &amp; y"


@pytest.mark.parametrize("n_terms", [0, 3, 4, 5, 6])
def test_previews_and_badges(spark, n_terms):
    terms = [f"t{i}" for i in range(n_terms)]
    arr = F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")
    r = spark.range(1).select(preview_list(arr, 5).alias("p5"), preview_list(arr, 3).alias("p3"),
                              badge_list(arr).alias("b")).first()
    assert r.p5 == ", ".join(terms[:5]) + ("..." if n_terms > 5 else "")
    assert r.p3 == ", ".join(terms[:3]) + ("..." if n_terms > 3 else "")
    if terms:
        assert r.b == "".join(f"<kbd>{t}</kbd>" for t in terms)
    else:
        assert r.b == "<kbd>all items</kbd>"


def test_generated_on_format(spark):
    r = spark.range(1).select(format_generated_on(F.to_timestamp(F.lit("2025-11-19 21:05:00")))
                              .alias("g")).first()
    assert r.g == "November 19, 2025 at 09:05 PM"


def test_numbered_entry_null_vs_empty_abstract(spark):
    df = spark.createDataFrame([(1, "T", "L", None), (2, "T", "L", ""), (3, "T", "L", "A")],
                               "i int, t string, l string, a string")
    got = [r[0] for r in df.select(numbered_entry("i", "t", "l", "a")).collect()]
    assert got == ["1. T\n   Link: L\n\n", "2. T\n   Link: L\n\n",
                   "3. T\n   Link: L\n   Abstract: A\n\n"]


def test_local_date_ignores_session_zone(spark):
    df = spark.createDataFrame([("1 Jan 2025 23:30:00 -0500",)], "v string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = df.select(local_date(parse_mail_date("v"), "UTC").alias("d"),
                        local_date(parse_mail_date("v"), "Asia/Tokyo").alias("t")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (got.d, got.t) == (dt.date(2025, 1, 2), dt.date(2025, 1, 2))


PROBES = ["a@b.org (x (nested) y)", "Name <a@b.org>,", "<a@b.org", "Friends: a@b.org;", "<@x.org:a@b.org>",
          '"a b"@c.org', "a @ b.org", "a@[1.2.3.4]", "a@b@c.org", "x (unbalanced <a@b.org>", "a@b.org, ",
          "A.B <c@d.e>", '"q\\"uote" <a@b.org>', "Über Name <a@b.org>", "=?utf-8?q?x?= <a@b.org>",
          "Name\r\n <a@b.org>", "<a@b.org> trailing", "a@b.org\tx", "İ@b.org", "a..b@c.org", ".a@b.org"]


def _headers(rng, n):
    """Headers put together from the parts that the grammar knows."""
    parts = ["a", "Bob", "b.c", "@", "@", "x.org", "<", ">", ",", ";", ":", ".", " ", "  ", "\t", "(", ")",
             "(c)", '"', '"q r"', "\\", "[1.2]", "é", "\r\n "]
    shapes = ["{0}@{1}", "{2} <{0}@{1}>", '"{2}" <{0}@{1}>', "{0}@{1} ({2})", "{2}: {0}@{1};", "{0} @ {1}",
              "<@{1},@y.org:{0}@{1}>", "{2} <{0}@{1}", "{0}@{1}, {2}"]
    for _ in range(n):
        if rng.random() < 0.5:
            yield "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        else:
            yield rng.choice(shapes).format(rng.choice(["Ab", "x.y", '"a b"', "é"]), rng.choice(
                ["B.org", "x", "a_b.c", "[1.2.3.4]"]), rng.choice(["N M", "n.", "(c) n", "Ü", '"q"']))


def test_addresses_equal_the_library_on_generated_headers(spark):
    import random

    cases = PROBES + list(_headers(random.Random(7), 4000))
    got = one_col(spark, cases, normalise_address)
    for v, g in zip(cases, got):
        assert g == parseaddr(v)[1].lower(), repr(v)


def _dates(rng, n):
    days, months = ["Mon", "Wed,", "Friday,", "wed", ""], ["Jan", "feb", "March", "Sept", "Dec", "Foo"]
    zones = ["+0000", "-0000", "+01:00", "-0530", "GMT", "EST", "Z", "XYZ", "", "+1", "(UTC)"]
    for _ in range(n):
        d, m, y = str(rng.randint(0, 33)), rng.choice(months), rng.choice(["2026", "26", "99", "1950", "026"])
        t = rng.choice(["10:00:00", "1:2", "10.00.00", "23:59:60", "24:00:00", "7", "10:0:0"])
        z, sep = rng.choice(zones), rng.choice([" ", "  ", " "])
        yield sep.join(x for x in rng.choice([
            [rng.choice(days), d, m, y, t, z], [rng.choice(days), m, d, t, y, z], [rng.choice(days), m, d, t, z, y],
            [rng.choice(days), f"{d}-{m}-{y}", t, z], [d, m, y, t + z], [m, d + ",", y, t, z],
            [y, m, d, t], [rng.choice(days), d, m, y, t, z, "(x y)"]]) if x)


@pytest.mark.parametrize("staged", [False, True])
def test_dates_equal_the_library_on_generated_headers(spark, staged):
    import random

    vals = ["5-Jan-2026 10:00:00 +0000", "Jan 5 10:00:00 2026", "5 Jan 2026 10.00.00 +0000",
            "Mon, 5 Jan 2026 10:00:00 +01:00", "Mon, 5 Jan 2026 10:00:00 +9900"] + list(_dates(random.Random(3), 3000))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    out = add_mail_date(df, "v", "p") if staged else df.withColumn("p", parse_mail_date("v"))
    for r in out.collect():
        p = None if r.p is None else (r.p.ts, r.p.zoned, r.p.wall_date)
        try:
            want = python_date(r.v)
        except OverflowError:
            want = None
        assert p == want, repr(r.v)
