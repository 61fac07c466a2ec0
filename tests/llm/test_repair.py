"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import random
import re

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mailsift.llm import repair as R

KIND = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()),
                   StructField("role", StringType()), StructField("text", StringType()),
                   StructField("codes", StringType())])
LEGAL = re.compile(r"(s?(ua)+)?")


def facts(rows):
    """``(turn, role, text, fault)`` in order."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64],
                             hashlib.md5(r[2].encode()).hexdigest()))
    out, seen = [], set()
    for turn, role, text in rows:
        bare = text.rstrip(" \t\n\v\f\r")
        fault = ("blank" if not bare else "duplicate" if (role, text) in seen else
                 "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def cheapest(rows):
    """Least cost and, among those, the least audit, by Dijkstra over (row, role initials' end)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, "\n".join(lines)
        legal = lambda c: (last + c) in ("s", "u", "su", "ua", "au")
        for role in ("user", "assistant"):
            if legal(role[0]):
                heapq.heappush(heap, (cost + 2, audit + "I", i, role[0], (*lines, f"{role}:")))
        if i < len(rows):
            _, role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last, lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 1 if fault == "truncated" else 0
            for edit, to, price in (("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)):
                if to and legal(to[0]):
                    heapq.heappush(heap, (cost + price + extra, audit + edit, i + 1, to[0],
                                          (*lines, f"{to}:{text}")))
    raise AssertionError


def expected(rows):
    lined = facts(rows)
    turns = [r[0] for r in lined if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(lined, lined[1:]))
    cost, audit, text = cheapest(lined)
    count = lambda f: sum(r[3] == f for r in lined)
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit,
            hashlib.sha256(text.encode()).hexdigest())


def run(spark, convs, bits, parts=4):
    rows = [(c, *r, "x") for c, rs in convs.items() for r in rs]
    random.Random(3).shuffle(rows)
    report, repaired = R.repair(spark.createDataFrame(rows, KIND).repartition(parts), bits=bits)
    digest = {r.conv_id: r.sha256 for r in R.line_digests(repaired).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                        digest.get(r.conv_id, empty)) for r in report.collect()}


def made(rng, n):
    roles = ["system", "user", "assistant", "tool", "", None, "user", "assistant", "unknown"]
    texts = ["Yes.", "No!", "cut of", "", " \t", None, "Why?", "Well. ", "ends  "]
    return [(rng.choice([None, *range(n)]), rng.choice(roles), rng.choice(texts) if rng.random() < .5
             else f"line {rng.randrange(10 ** 6)}{rng.choice(['.', ''])}") for _ in range(n)]


@pytest.mark.parametrize("bits", [0, 1, 12])
def test_equals_a_plain_search(spark, bits):
    rng = random.Random(bits)
    convs = {c: made(rng, rng.choice([1, 2, 3, 8, 15, 40])) for c in [None, *range(40)]}
    convs[77] = [(0, "tool", "x.")] * 9
    got = run(spark, convs, bits)
    assert got == {c: expected(rs) for c, rs in convs.items()}


def test_one_conversation_over_many_tasks(spark):
    rng = random.Random(9)
    long = made(rng, 3000)
    same = [(5, "user", "Again and again.")] * 3000  # equal rows of one turn
    convs = {1: long, 2: same, 3: made(rng, 4)}
    got = run(spark, convs, 5)
    assert got == {c: expected(rs) for c, rs in convs.items()}


def test_vectors_that_differ_by_a_constant_stop_the_rerun():
    rng = random.Random(1)
    for _ in range(300):
        codes = "".join(rng.choice("ADEGHJKL") for _ in range(rng.randrange(1, 30)))
        old, new = ([rng.randrange(9) for _ in range(4)] for _ in range(2))
        assert R.run_again(codes, old, R.run_back(codes, old), new) == R.run_back(codes, new)


def test_clean_empty_and_repaired_rows(spark):
    clean = [(0, "system", "Be kind."), (1, "user", "Hi!"), (2, "assistant", "Hello.")]
    report, repaired = R.repair(spark.createDataFrame([(1, *r, None) for r in clean], KIND))
    assert [(r.cost, r.audit) for r in report.collect()] == [(0, "KKK")]
    assert [tuple(r) for r in repaired.orderBy("pos", "place").select("edit", "role", "text").collect()] \
        == [("keep", r, t) for _, r, t in clean]
    report, repaired = R.repair(spark.createDataFrame([], KIND))
    assert report.count() == repaired.count() == 0
    two = [(0, "user", "One?"), (1, "user", "Two.")]
    _, repaired = R.repair(spark.createDataFrame([(1, *r, None) for r in two], KIND))
    roles = [r.role for r in repaired.orderBy("pos", "place").collect()]
    assert LEGAL.fullmatch("".join(r[0] for r in roles))


def test_illegal_roles_have_a_single_meaning():
    assert [c for c, (i, _) in R._CODE.items() if i == "x"] == ["J", "K", "L"]
    assert R.trace("J", R.END, 0) == ("D", 0)
