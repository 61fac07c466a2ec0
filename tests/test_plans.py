"""Plan-level checks: the physical properties the scale design relies on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from mailsift.operators.items import ITEM_ORDER, dedupe_first, drop_tail
from mailsift.operators.order import ordinal
from mailsift.plans.queries import QUERIES
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"digest_incremental",
                                                           "digest_incremental_latest"}))
def test_no_cartesian_products(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_dedupe_is_limited_map_side(spark):
    p = plan(E.queries()["items_deduped"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["anchors_extracted"](spark, SF_SMALL))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p
    p = plan(E.queries()["latest_messages"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(event_id," in p  # the N-th newest key bounds the scan


def test_limit_precedes_filter(spark):
    p = plan(E.queries()["latest_then_filter"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(" in p  # the bound of the latest N, found before the sender filter


def test_latest_n_reads_the_last_row_groups_alone(spark, tmp_path):
    from mailsift.sources import latest_n

    path = str(tmp_path / "many.parquet")
    spark.range(0, 200_000, 1, 1).select("id", F.repeat(F.lit("x"), 50).alias("body")) \
        .write.option("parquet.block.size", 64 << 10).option("parquet.page.size", 8 << 10).parquet(path)
    got = latest_n(spark.read.parquet(path), 10, "id")
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id,199990)]" in plan(got)
    assert sorted(r.id for r in got.collect()) == list(range(199_990, 200_000))
    leaf = got._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert leaf.metrics().get("numOutputRows").get().value() < 40_000


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "timestamp_ntz", "double"])
def test_latest_n_by_keys_of_any_type(spark, kind):
    from mailsift.sources import latest_n

    keys = {"bigint": "id", "string": "lpad(cast(id as string), 3, '0')", "date": "date_add('2025-01-01', cast(id as int))",
            "timestamp_ntz": "timestamp_ntz'2025-03-30 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int))",
            "double": "cast(id as double)"}
    df = spark.range(60).selectExpr(f"{keys[kind]} as k", "id").unionByName(
        spark.range(60, 62).selectExpr(f"cast(null as {kind}) as k", "id"))
    assert sorted(r.id for r in latest_n(df, 5, "k").collect()) == list(range(55, 60))
    assert latest_n(df, 61, "k").count() == 62  # equal (null) keys come together
    assert latest_n(df, 100, "k").count() == 62


def test_run_day_filter_stays_above_the_parse(spark):
    text = optimized(E.queries()["run_day_messages"](spark, SF_SMALL))
    assert text.index("Filter") < text.index("Generate")
    # the date pattern runs twice per row (match flag, all groups), never inside the filter
    assert text.count(r"(\d{2,4})") == 2


def test_hot_group_is_split_across_partitions(spark):
    rows = [("hot", i, 0) for i in range(3000)] + [(f"r{i % 7}", i, 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "report string, uid long, pos int")
    ranged = df.repartitionByRange(8, "report", F.col("uid").desc()).withColumn(
        "pid", F.spark_partition_id())
    spread = ranged.filter("report = 'hot'").select("pid").distinct().count()
    assert spread >= 4
    got = ordinal(df, ["report"], ITEM_ORDER, partitions=8).filter("report = 'hot'")
    assert sorted(r.ordinal for r in got.select("ordinal").collect()) == list(range(1, 3001))


def test_tail_drop_never_sorts_everything(spark):
    rows = [(i % 3, i, 0, f"t{i}", "l") for i in range(500)]
    df = spark.createDataFrame(rows, "g int, uid long, pos int, title string, link string")
    p = plan(drop_tail(dedupe_first(df, by=("g",)), ITEM_ORDER, 2, by=("g",)))
    assert "WindowGroupLimit" in p and "LeftAnti" in p
    p = plan(drop_tail(df, ITEM_ORDER, 2))
    assert "TakeOrderedAndProject" in p


def test_spread_only_on_request(spark):
    from mailsift.session import SPREAD_SETTING, spread

    small = spark.range(100).coalesce(1)
    assert spread(small, "id") is small
    spark.conf.set(SPREAD_SETTING, "6")
    try:
        assert spread(small, "id").select(F.spark_partition_id()).distinct().count() > 1
        stream = spark.readStream.format("rate").load()
        assert spread(stream, "value") is stream
    finally:
        spark.conf.unset(SPREAD_SETTING)


def test_outline_shuffles_headings_alone(spark):
    """Documents are cut into lines where they are read; only heading rows are sorted."""
    p = plan(E.queries()["markdown_outline"](spark, SF_SMALL))
    for part in p.split("Exchange ")[1:]:
        columns = part.split("Project [")[1].split("]\n")[0]
        assert "__part" not in columns.split(",") and "markdown" not in columns
    assert p.count("Exchange ") <= 2