"""Repeated strings by merged transforms against a table of all windows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mailsift.llm import repeats as R

KIND = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                   StructField("rows", StringType())])


def plain(rows, length=50):
    """Removed spans of every row, by a dictionary of all windows."""
    low = {}
    for i, text in rows:
        b, i = (text or "").encode(), R.LAST if i is None else i
        for a in range(len(b) - length + 1):
            low[b[a:a + length]] = min(i, low.get(b[a:a + length], R.LAST))
    out = []
    for i, text in rows:
        b, own = (text or "").encode(), R.LAST if i is None else i
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if low[b[a:a + length]] < own:
                gone[a:a + length] = b"\1" * length
        spans = []
        for a, g in enumerate(gone):
            if g and a and gone[a - 1]:
                spans[-1][1] = a + 1
            elif g:
                spans.append([a, a + 1])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), tuple(map(tuple, spans)), kept))
    return sorted(out, key=str)


def run(spark, rows, parts=5, **more):
    df = spark.createDataFrame([(*r, "x") for r in rows], KIND).repartition(parts)
    got = R.remove_repeats(df, **more).select("row.doc_id", "n_bytes", "spans", "kept").collect()
    return sorted(((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept))
                   for r in got), key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 9))) for _ in range(60)]
    prose = lambda k: " ".join(rng.choice(words) for _ in range(k))
    passages = [prose(k) for k in (8, 9, 10, 12, 30, 60)]
    rows = []
    for i in range(n):
        parts = [prose(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            parts += [p[rng.randint(0, 9):], prose(rng.randint(0, 10))]
        rows.append((rng.choice([i, i, rng.randrange(n)]), rng.choice(["", " "]).join(parts)))
    whole = rows[3][1]
    rows += [(1000 + i, whole) for i in range(15)] + [(5, whole), (5, whole), (None, whole), (None, whole)]
    rows += [(2000, None), (2001, ""), (2002, "x" * 49), (2003, "x" * 50), (2004, "x" * 400),
             (2005, "ab" * 300), (2006, "ba" * 300), (2007, "x" * 50)]
    return rows


@pytest.mark.parametrize("seed, hot", [(1, R.HOT), (2, 3), (3, 0)])
def test_equals_a_table_of_windows(spark, seed, hot):
    rows = corpus(seed)
    assert run(spark, rows, hot=hot) == plain(rows)


def test_small_blocks_long_text_and_empty_table(spark, monkeypatch):
    assert run(spark, []) == []
    rows = [(i, t) for i, t in corpus(4, 40)]
    rows.append((7000, " ".join(t for _, t in rows if t) * 3))
    monkeypatch.setattr(R, "SLICE", 700)
    monkeypatch.setattr(R, "BLOCK", 1500)
    assert run(spark, rows) == plain(rows)


def plain_masks(texts, least, length=50):
    low = {}
    for t, i in zip(texts, least.tolist()):
        for a in range(len(t) - length + 1):
            low[t[a:a + length]] = min(i, low.get(t[a:a + length], R.LAST))
    return np.array([sum(1 << a for a in range(len(t) - length + 1) if low[t[a:a + length]] < i)
                     for t, i in zip(texts, least.tolist())], np.uint64)


@pytest.mark.parametrize("shard", [60, 400, 10 ** 6])
def test_merged_transforms_find_all_repeats(shard):
    rng = random.Random(shard)
    base = bytes(rng.choice(b"ab") for _ in range(300))
    texts = list({base[a:a + rng.randint(50, 110)] for a in (rng.randrange(180) for _ in range(60))}
                 | {bytes(50), bytes(60), b"a" * 113})
    low = np.array([rng.randrange(20) for _ in texts], np.int64)
    want = plain_masks(texts, low)
    assert (R.merged_repeats(texts, low, shard_bytes=shard) == want).all()


def test_interleave_orders_and_common_prefixes():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(20)) for _ in range(30)]
    code = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint16)
    n = np.arange(len(code))
    before = n - 1 + np.where(n % 20 == 0, 20, 0)
    orders = [R._suffix_order(n[a:a + 200], before, code, 8) for a in (0, 200, 400)]
    shard, apart = R._interleave([code[before[o]] for o in orders], 8)
    merged = np.empty(len(code), np.int64)
    merged[np.argsort(shard, kind="stable")] = np.concatenate(orders)
    view = lambda p: (texts[p // 20] * 2)[p % 20:p % 20 + 8]
    seen = [view(p) for p in merged.tolist()]
    assert seen == sorted(seen) and sorted(merged.tolist()) == n.tolist()
    for a, b, k in zip(seen, seen[1:], apart[1:].tolist()):
        assert k == next((i for i in range(8) if a[i] != b[i]), 8)


def test_colliding_codes_are_caught(monkeypatch):
    rng = random.Random(6)
    texts = [b"a" * 50, b"b" * 50, b"xx" + b"a" * 50] + \
        [bytes(rng.choice(b"ab") for _ in range(7)) * 9 for _ in range(40)]
    low = np.array([1, 0, 5, *[rng.randrange(9) for _ in range(40)]], np.int64)
    want = plain_masks(texts, low)
    for bits in (0, 1 << 48):
        monkeypatch.setattr(R, "_mixed", lambda h: h & np.uint64(bits))
        assert (R.merged_repeats(texts, low) == want).all()


def test_columns_travel(spark):
    df = spark.createDataFrame([(1, "a", "kept")], KIND).withColumn("block", F.lit("mine"))
    got = R.remove_repeats(df, keep=("doc_id", "rows", "block")).select("row.*").collect()
    assert [r.asDict() for r in got] == [{"doc_id": 1, "rows": "kept", "block": "mine"}]
