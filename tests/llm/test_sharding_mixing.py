"""Sharding and mixing against their laws on small tables."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from mailsift.llm import mixing, sharding

DOCS = "doc_id long, text string, source string, size long, row string, copies int"


def _docs(spark, n=400, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        text = rnd.choice([None, "", "é b", "w " * rnd.randrange(1, 60), "x" * rnd.randrange(900)])
        source = "hot" if rnd.random() < 0.4 else rnd.choice([None, "", "a", "b", "c"])
        rows.append((i if i % 17 else None, text, source, -1, "mine", 7))
    rows += [(5, "same text", "hot", -1, "mine", 7)] * 40
    rows.append((900, "long " * 30_000, "a", -1, "mine", 7))
    return rows


def test_shards_are_contiguous_gapless_and_balanced(spark):
    rows = _docs(spark)
    df = spark.createDataFrame(rows, DOCS)
    got = sharding.shard_by_bytes(sharding.text_sizes(df), 4, rows_per_slice=50).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, *_ in rows)
    total, biggest = sum(r.size for r in got), max(r.size for r in got)
    for s in range(4):
        mine = sorted((r.slot, r.doc_id is not None, r.doc_id or 0) for r in got if r.shard == s)
        assert [m[0] for m in mine] == list(range(len(mine)))
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        assert abs(sum(r.size for r in got if r.shard == s) - total / 4) <= biggest
    order = [(r.shard, r.slot) for r in sorted(got, key=lambda r: (
        r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.shard, r.slot))]
    assert order == sorted(order)


def test_shards_balance_to_less_than_a_text(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"),
                                  F.repeat(F.lit("é"), F.col("id").cast("int") % 40).alias("text"))
    got = sharding.shard_by_bytes(sharding.text_sizes(df), 8).groupBy("shard").agg(
        F.sum("size").alias("b")).collect()
    assert max(r.b for r in got) - min(r.b for r in got) <= 2 * 81


def test_shards_of_nothing(spark):
    df = spark.createDataFrame([], DOCS)
    assert sharding.shard_by_bytes(sharding.text_sizes(df)).count() == 0


def _fill(sizes, weights, share):
    """Reshare the excess by weight until no target is above its cap."""
    names = sorted(k for k in sizes if k is not None) + [k for k in sizes if k is None]
    weight = {k: weights[i % len(weights)] for i, k in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(weight[k] for k in open_) if open_ else 0
        full = [k for k in open_ if weight[k] * level > 2 * sizes[k]]
        if not full:
            return target | {k: weight[k] * level for k in open_}
        for k in full:
            target[k] = 2.0 * sizes[k]
            left -= target[k]
            open_.remove(k)


@pytest.mark.parametrize("rows_per_slice", [20, 100_000])
def test_mix_targets_and_copies(spark, rows_per_slice):
    rows = _docs(spark)
    df = spark.createDataFrame(rows, DOCS)
    plan = mixing.plan_copies(df, rows_per_slice=rows_per_slice)
    got = plan.select("row.*", "mix_size", "source_size", "target",
                      F.col("copies").alias("times")).collect()
    assert len(got) == len(rows) and all(r.size == -1 and r.row == "mine" for r in got)
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = _fill(sizes, mixing.WEIGHTS, mixing.SHARE)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        assert mine[0].source_size == sizes[s] and mine[0].target == pytest.approx(want[s])
        taken = sum(r.times * r.mix_size for r in mine)
        assert abs(taken - want[s]) <= 2 * max(r.mix_size for r in mine)
    assert all(0 <= r.times <= 2 for r in got)
    again = mixing.plan_copies(df.repartition(7), rows_per_slice=rows_per_slice)
    assert sorted(map(str, again.select("row.doc_id", "mix_size", "copies").collect())) == sorted(
        map(str, plan.select("row.doc_id", "mix_size", "copies").collect()))
    mixed = mixing.mix_sources(df, rows_per_slice=rows_per_slice)
    assert mixed.columns == df.columns and mixed.count() == sum(r.times for r in got)


def test_mix_of_nothing_and_of_no_words(spark):
    assert mixing.mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    df = spark.createDataFrame([(1, None, "a", 0, "", 0), (2, "", None, 0, "", 0)], DOCS)
    got = mixing.plan_copies(df).collect()
    assert [(r.target, r.copies) for r in got] == [(0.0, 0)] * 2


def test_every_row_lies_where_a_plain_loop_puts_it(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, *range(60)]), "x" * rnd.randrange(40) + rnd.choice(["", "é"]) , "mine")
            for _ in range(300)] + [(7, None, "mine"), (9, "y" * 3000, "mine")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(5)
    got = sharding.shard_by_bytes(sharding.text_sizes(df), 8, rows_per_slice=40).collect()
    plain = sorted(((r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()),
                     len((r[1] or "").encode()) + 1) for r in rows))
    total, at, slots, want = sum(r[3] for r in plain), 0, {}, []
    for known, i, crc, size in plain:
        shard = min(7, (2 * at + size) * 8 // (2 * total))
        want.append((i if known else None, size, crc, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        at += size
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_a_hot_id_is_spread_over_slices(spark):
    """Rows of one id (null) lie in many slices, and the result is the same row for row."""
    rows = [(None, f"{'w ' * 20}{i}", "hot") for i in range(900)] + [(i, "w " * 21, "s") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_copies(df, keep=("doc_id", "text"), rows_per_slice=50)
    again = mixing.plan_copies(df.repartition(7), keep=("doc_id", "text"), rows_per_slice=50)
    key = lambda d: sorted(str((r["row"].text, r.copies)) for r in d.collect())
    assert key(plan) == key(again)
    taken = plan.filter("row.doc_id is null").selectExpr("sum(copies * mix_size) t", "max(target) g").first()
    assert abs(taken.t - taken.g) <= 2 * 21
