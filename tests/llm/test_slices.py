"""Slice-and-intersect codes against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, FloatType, IntegerType, LongType, StringType, StructField,
                               StructType)

from mailsift.llm import slices

KIND = StructType([StructField("vec_id", LongType()), StructField("embedding", ArrayType(FloatType())),
                   StructField("label", IntegerType()), StructField("code", StringType())])


def plain(rows, parts=16, entries=64, rounds=2):
    """Every distance measured, one by one."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return {}, []
    w = len(kept[0][1]) // parts
    cut = [(i, [v[p * w:(p + 1) * w] for p in range(parts)], lab) for i, v, lab in kept]
    books = [[list(v[p]) for _, v, _ in cut[:entries]] for p in range(parts)]

    def near(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = [[] for _ in books[p]]
            for _, v, _ in cut:
                mine[near(books[p], v[p])[1]].append(v[p])
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else b
                        for m, b in zip(mine, books[p])]
    out, by_label = [], {}
    for i, v, lab in cut:
        found = [near(books[p], v[p]) for p in range(parts)]
        error = sum(f[0] for f in found)
        by_label[lab] = by_label.get(lab, 0) + error
        out.append((i, "".join(f"{f[1]:02x}" for f in found), error, lab))
    return sorted(((i, c, e, by_label[lab]) for i, c, e, lab in out), key=str), books


def run(spark, rows, n_parts=3):
    df = spark.createDataFrame([(*r, "x") for r in rows], KIND).repartition(n_parts)
    coded, books = slices.compress(df)
    got = slices.error_by_label(coded).select("row.vec_id", "code", "error", "label_error").collect()
    return sorted((tuple(r) for r in got), key=str), books


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_loops(spark, seed):
    rng = random.Random(seed)
    as32 = lambda x: float(np.float32(x))
    rows = [(i, [as32(rng.gauss(0, 0.2)) for _ in range(64)], rng.choice([None, 1, 2, 2, 2]))
            for i in range(150)]
    rows += [(1000, [0.0] * 64, 1), (1001, [0.0] * 64, 1), (1002, None, 1),
             (1003, [None] + [0.5] * 63, 2), (1004, [float("nan")] * 64, 2),
             (1005, [float("inf")] + [0.1] * 63, None), (None, [as32(0.3)] * 64, 3), rows[3]]
    want, books = plain(rows)
    got, made = run(spark, rows)
    assert got == want
    assert made.tolist() == books


def test_search_is_exact_at_any_radius():
    rng = np.random.default_rng(5)
    book = rng.integers(-40, 40, (64, 4))
    book[7] = book[3]                       # a repeated entry: the lower index wins
    points = np.concatenate([rng.integers(-60, 60, (500, 4)), book, [[10 ** 6] * 4, [-(2 ** 24)] * 4]])
    far = ((points[:, None] - book[None]) ** 2).sum(2)
    for radius in (1, 3, 20, 500):
        code, error = slices.nearest(points, book, radius=radius)
        assert (error == far.min(1)).all() and (code == far.argmin(1)).all()


def test_few_rows_empty_odd_lengths_and_huge_values(spark):
    assert run(spark, [])[0] == []
    rows = [(2, [0.25] * 32, None), (1, [-0.1] * 32, None), (3, [0.5] * 31, 1), (4, [], 1)]
    got, books = run(spark, rows)
    assert [r[0] for r in got] == [1, 2] and books.shape == (16, 2, 2)
    assert got == plain(rows[:2])[0]
    huge = [(1, [3e38] * 16, 1), (2, [-3e38] * 16, 1), (3, [0.0] * 16, 1)]
    assert [r[0] for r in run(spark, huge)[0]] == [1, 2, 3]


def test_other_columns_travel(spark):
    df = spark.createDataFrame([(1, [0.1] * 16, 5, "kept")], KIND).withColumn("ints", F.lit("mine"))
    coded, _ = slices.compress(df, keep=("vec_id", "code", "ints"))
    assert coded.select("row.*").collect()[0].asDict() == {"vec_id": 1, "code": "kept", "ints": "mine"}
