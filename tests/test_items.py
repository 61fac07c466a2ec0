"""Property checks for the order-sensitive item operators against plain Python loops.

Seeded random data with one hot key (a third of the rows) so the skew paths
are exercised.
"""

import random

import pytest
from pyspark.sql import functions as F

from mailsift.operators.headers import filter_senders
from mailsift.operators.items import (
    ITEM_ORDER, dedupe_first, drop_tail, keyword_filter, keyword_semi_join, number_items,
)
from mailsift.operators.order import ordinal
from mailsift.sources.messages import latest_n
from tests.conftest import SF_CHECK

SCHEMA = "report string, uid long, pos int, title string, link string, abstract string"


def make_items(n, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        report = "hot" if rnd.random() < 0.34 else f"r{rnd.randrange(5)}"
        uid = rnd.randrange(40)
        title = f"title {rnd.randrange(12)}"
        link = f"https://x.org/{rnd.randrange(4)}"
        abstract = rnd.choice([None, "", f"about lithium {i}", f"Solid-State cell {i}"])
        rows.append((report, uid, i, title, link, abstract))
    return rows


def py_order(r):
    return (-r[1], r[2])


def py_dedupe(rows, by_report):
    seen, out = set(), []
    for r in sorted(rows, key=py_order):
        k = (r[0] if by_report else None, r[3], r[4])
        if k not in seen:
            seen.add(k)
            out.append(r)
    return out


def py_drop_tail(rows, k, by_report):
    groups = {}
    for r in sorted(rows, key=py_order):
        groups.setdefault(r[0] if by_report else None, []).append(r)
    out = []
    for g in groups.values():
        out.extend(g[:-k] if len(g) >= k else g)
    return out


@pytest.fixture(scope="module")
def items(spark):
    rows = make_items(600)
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("by_report", [False, True])
def test_dedupe_first_equals_first_wins_loop(items, by_report):
    rows, df = items
    by = ("report",) if by_report else ()
    got = sorted(tuple(r) for r in dedupe_first(df, by=by).collect())
    assert got == sorted(py_dedupe(rows, by_report))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50])
@pytest.mark.parametrize("by_report", [False, True])
def test_drop_tail_sizes(spark, n, by_report):
    rows = make_items(n, seed=n)
    # unique order keys so "last" is well defined
    rows = [(r[0], r[1], i, *r[3:]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, SCHEMA)
    by = ("report",) if by_report else ()
    got = sorted(tuple(r) for r in drop_tail(df, ITEM_ORDER, 2, by=by).collect())
    assert got == sorted(py_drop_tail(rows, 2, by_report))


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ordinal_skew_safe_equals_row_number(items, partitions):
    rows, df = items
    got = {(r.report, r.uid, r.pos): r.ordinal
           for r in ordinal(df, ["report"], ITEM_ORDER, partitions=partitions).collect()}
    plain = {(r.report, r.uid, r.pos): r.ordinal
             for r in ordinal(df, ["report"], ITEM_ORDER, skew_safe=False).collect()}
    assert got == plain
    want = {}
    for rep in {r[0] for r in rows}:
        g = sorted((r for r in rows if r[0] == rep), key=py_order)
        want.update({(r[0], r[1], r[2]): i for i, r in enumerate(g, 1)})
    assert got == want


def test_ordinal_global_and_number_items(items):
    rows, df = items
    got = {(r.uid, r.pos): r.ordinal for r in number_items(df, ITEM_ORDER).collect()}
    want = {(r[1], r[2]): i for i, r in enumerate(sorted(rows, key=py_order), 1)}
    assert got == want


TERMS = ["lithium", "solid-state", "title 3", "e 1"]


def py_keyword(rows, terms):
    if not terms:
        return rows
    return [r for r in rows if any(t in (r[3] + " " + (r[5] or "")).lower() for t in terms)]


@pytest.mark.parametrize("terms", [[], TERMS, ["  LITHIUM ", "", "nothing-matches"]])
def test_keyword_filter_equals_loop(items, terms):
    rows, df = items
    got = sorted(tuple(r) for r in keyword_filter(df, terms).collect())
    norm = [t.strip().lower() for t in terms if t.strip()]
    assert got == sorted(py_keyword(rows, norm))


def test_keyword_semi_join_equals_filter(spark, items):
    rows, df = items
    terms_df = spark.createDataFrame([(t,) for t in TERMS + ["Lithium", " ", "\u00a0cell\u00a0", "3"]],
                                     "term string")
    key = ("report", "uid", "pos")
    got = sorted(tuple(r) for r in keyword_semi_join(df, terms_df, key).collect())
    assert got == sorted(tuple(r) for r in keyword_filter(df, TERMS + ["cell", "3"]).collect())


def test_keyword_semi_join_null_keys_and_many_terms(spark):
    df = spark.createDataFrame([(None, "Alpha beta", None), (1, "gamma", "ALPHA"), (2, "x", "")],
                               "k long, title string, abstract string")
    terms = spark.range(3000).selectExpr("concat('zz', id) AS term").union(
        spark.createDataFrame([("alpha",)], "term string"))
    assert sorted(str(r.k) for r in keyword_semi_join(df, terms, ["k"]).collect()) == ["1", "None"]


def test_keyword_candidates_are_few(spark):
    """Terms meet rows by their rarest gram: few pairs beyond the true ones, no pair lost."""
    from mailsift.operators.items import keyword_blob, keyword_candidates
    from mailsift.plans.queries import _benchmark_terms, _docs

    docs = _docs(spark, SF_CHECK)
    found = keyword_candidates(docs, _benchmark_terms(spark, SF_CHECK), ["doc_id"]).distinct()
    texts = docs.select("doc_id", keyword_blob().alias("blob"))
    true = found.join(texts, F.col("doc_id") == F.col("__of_doc_id")) \
        .filter(F.contains("blob", "term")).count()
    terms = {t.term.lower() for t in _benchmark_terms(spark, SF_CHECK).collect()}
    blobs = [r.blob for r in texts.collect()]
    assert true == sum(t in b for t in terms for b in blobs)
    assert found.count() <= 2 * true


def test_gram_set_lets_all_its_grams_through(spark):
    from mailsift.operators.items import _gram_set

    grams = spark.range(50_000).select(F.substring(F.md5(F.col("id").cast("string")), 1, 6).alias("gram"))
    widths, test = _gram_set(grams.filter("substr(gram, 1, 1) = 'a'"))
    through = grams.filter(test(F.col("gram")))
    assert widths == [6] and through.filter("substr(gram, 1, 1) = 'a'").count() == \
        grams.filter("substr(gram, 1, 1) = 'a'").count()
    assert through.count() < 10_000


def test_keyword_semi_join_empty_terms_passes_all(spark, items):
    rows, df = items
    empty = spark.createDataFrame([("  ",)], "term string")
    assert keyword_semi_join(df, empty, ["uid", "pos"]).count() == len(rows)


@pytest.mark.parametrize("partitions", [5, 16])
def test_ordinal_at_size_with_payload_null_groups_and_a_hot_group(spark, partitions):
    """Above the size where range bounds are sampled; every row carries a payload."""
    from pyspark.sql import functions as F

    n = 300_000
    df = spark.range(n).select(
        F.when(F.col("id") % 100 < 34, "hot").when(F.col("id") % 100 < 60, F.lit(None))
        .when(F.col("id") % 100 < 70, "").otherwise(F.concat(F.lit("r"), F.col("id") % 5)).alias("g"),
        F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("uid"), "id",
        F.concat(F.lit("payload "), F.md5(F.col("id").cast("string"))).alias("title"))
    order = [("uid", False), "id"]
    got = ordinal(df, ["g"], order, partitions=partitions)
    want = ordinal(df, ["g"], order, skew_safe=False)
    assert got.count() == n
    assert got.exceptAll(want).count() == 0


def test_drop_tail_null_groups_keys_and_shared_uids(spark):
    df = spark.createDataFrame([(None, i, 0) for i in range(4)] + [("", 1, 0), ("", None, 0), ("", 2, 0)],
                               "g string, uid long, pos int")
    got = sorted((str(r.g), str(r.uid)) for r in drop_tail(df, ITEM_ORDER, 2, by=("g",)).collect())
    # of the null group the two oldest go; in "" the null uid is the oldest message
    assert got == [("", "2"), ("None", "2"), ("None", "3")]
    boxes = spark.createDataFrame([(b, u, 0) for b in range(4) for u in range(4)],
                                  "box int, uid long, pos int")
    assert drop_tail(boxes, ["box", ("uid", False), "pos"], 2).count() == 14


def test_latest_n_limit_precedes_filter(spark):
    rows = [(i, "alerts@x.org" if i % 3 == 0 else "other@y.org") for i in range(30)]
    df = spark.createDataFrame(rows, "uid long, sender string")
    first_limit = filter_senders(latest_n(df, 10), ["alerts@x.org"])
    got = sorted(r.uid for r in first_limit.collect())
    assert got == [21, 24, 27]
    other = latest_n(filter_senders(df, ["alerts@x.org"]), 10)
    assert sorted(r.uid for r in other.collect()) != got
    assert latest_n(df, 0).count() == 30
    with pytest.raises(ValueError):
        latest_n(df, -1)
    per = latest_n(df, 2, by="sender").collect()
    assert sorted(r.uid for r in per) == [24, 27, 28, 29]


def test_filter_senders_table(spark):
    df = spark.createDataFrame([(1, "a@x.org"), (2, "b@x.org"), (3, "")], "uid long, sender string")
    allow = spark.createDataFrame([("a@x.org",), ("a@x.org",)], "address string")
    assert [r.uid for r in filter_senders(df, allow).collect()] == [1]


def test_results_do_not_depend_on_partitioning(spark, items):
    rows, df = items
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    a = sorted(tuple(r) for r in number_items(drop_tail(dedupe_first(df, by=("report",)),
                                                        by=("report",)), by=("report",)).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    b = sorted(tuple(r) for r in number_items(drop_tail(dedupe_first(df.repartition(7),
                                                                     by=("report",)),
                                                        by=("report",)), by=("report",)).collect())
    assert a == b


def test_latest_n_keeps_null_keys_null_safely(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "uid long, v string")
    assert sorted(r.v for r in latest_n(df, 3).collect()) == ["a", "b", "c"]
    assert sorted(r.v for r in latest_n(df, 2).collect()) == ["b", "c"]
    per = spark.createDataFrame([(None, "m", "a"), (1, "m", "b"), (5, "k", "c")],
                                "uid long, box string, v string")
    assert sorted(r.v for r in latest_n(per, 2, by="box").collect()) == ["a", "b", "c"]
