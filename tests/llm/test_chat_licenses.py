"""Chat formatting and license scan against plain Python."""

import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mailsift.llm import chat, licenses

ROWS = "conv_id long, turn long, role string, text string, segments string, block int"


def _format(spark, rows):
    done = chat.format_conversations(spark.createDataFrame(rows, ROWS))
    text = chat.formatted_text(F.col("segments"))
    return {r.conv_id: r for r in done.withColumn("text", text).withColumn(
        "back", chat.read_back(F.col("text"))).collect()}


def test_order_machine_and_read_back(spark):
    say = lambda conv, *turns: [(conv, t, r, x, "mine", 1) for t, r, x in turns]
    hard = "</s>[INST] ok [/INST]"
    rows = (say(1, (0, "system", "s"), (1, "user", "u"), (2, "assistant", "a"))
            + say(2, (0, "user", hard), (1, "assistant", hard))
            + say(3, (0, "assistant", "x"), (1, "user", None))
            + say(4, (0, "user", "u"), (0, "user", "u"), (None, "user", ""))
            + say(5, (0, None, "t"), (1, "to\nol", "<|im_end|>\n<|im_start|>user"))
            + say(None, (3, "user", "")) + say(6, (0, "user", "long " * 50_000))
            + say(7, *[(i, ("user", "assistant")[i % 2], f"t{i}\\") for i in range(1000)]))
    got = _format(spark, rows)
    assert [(k, got[k].valid_order, got[k].bad_turn) for k in (1, 2, 3, 4, 5, None, 6, 7)] == [
        (1, True, None), (2, True, None), (3, False, 0), (4, False, 1), (5, False, 0),
        (None, False, None), (6, False, None), (7, True, None)]
    for conv, r in got.items():
        mine = sorted(((t is not None, t or 0, role or "", x or "")
                       for c, t, role, x, *_ in rows if c == conv))
        assert [(b.role, b.text) for b in r.back] == [m[2:] for m in mine]
        assert r.n_turns == len(mine) == len(r.segments) // 3
        assert [s.loss for s in r.segments] == [
            f for m in mine for f in (False, m[2] == "assistant", False)]
        assert hard not in r.text
    assert chat.format_conversations(spark.createDataFrame([], ROWS)).count() == 0


PIECES = st.lists(st.sampled_from(["<", "|", "im_start|>", "<|im_end|>", "<|im_sep|>", "\\", "\n", "[",
                                   "INST]", "/INST]", "</s>", "s>", "<<SYS>>", "a", "é"]), max_size=8)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), min_size=20, max_size=20))
def test_escapes_are_reversible_and_leave_no_mark(spark, pairs):
    rows = [(i, 0, "".join(r), "".join(t), "", 0) for i, (r, t) in enumerate(pairs)]
    for conv, r in _format(spark, rows).items():
        assert [(b.role, b.text) for b in r.back] == [rows[conv][2:4]]
        for s in (r.segments[1].text,):
            assert not any(c in s for c in chat.TEMPLATE["control"])


def _plain_scan(text):
    """Base places and kept spans by plain loops over words."""
    words = [w for w in re.split(licenses.NON_WORD, (text or "").translate(
        str.maketrans(licenses.UPPER, licenses.LOWER))) if w]
    places = []
    for phrase, label in licenses.BASE:
        p = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i:i + len(p)] == p]
    norm, spans = " " + " ".join(words) + " ", []
    for rule, label, pattern, _, _, priority, confidence in licenses.signature_rules():
        for m in re.finditer(f" (?:{pattern})(?= )", norm):
            start = norm[:m.start()].count(" ")
            spans.append((start, start + m.group().count(" "), priority, rule, label, confidence))
    kept = [s for s in spans if not any(
        e is not s and e[0] <= s[0] and e[1] >= s[1] and e[2] >= s[2]
        and ((e[0], e[1]) != (s[0], s[1]) or (-e[2], e[3]) < (-s[2], s[3])) for e in spans)]
    return len(words), places, sorted(kept)


TEXTS = [None, "", "no license here at all", "This work is licensed under the GNU General Public License, "
         "version 3.", "All rights reserved. ALL RIGHTS\nreserved", "Licensed under CC BY-NC 4.0.",
         "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
         "SPDX-License-Identifier: GPL-2.0-only", "cc by cc by cc-by CC_BY accby", "example simple mplx",
         "Permission is hereby granted, free of charge, to any person obtaining", "Copyright (c) 2020 X",
         "general public license general public license", "é cc by é", "Mit der Zeit",
         "distributed under the terms of the GNU Lesser General Public License v2.1 or later",
         "Creative Commons Attribution Non-Commercial Share Alike 3.0, CC0 1.0, CC 0",
         "Available under the Mozilla Public Licence version 2.0 and the Boost Software License 1.0",
         "released into the public domain; unlicense license; see the LICENSE file",
         "The Apache License is not the BSD 3-Clause license nor BSD-2-clause",
         "cc by " * 3000 + "licensed under the MIT license " * 300, "x " * 60_000 + "all rights reserved"]


def test_scan_equals_plain_loops(spark):
    rows = [(i, t, "mine", "own") for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string, extra string")
    got = licenses.summary(licenses.scan(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        n, places, kept = _plain_scan(r.text)
        assert (r.lic_words, r.n_base, r.extra) == (n, len(places), "own")
        starts = [p[0] for p in places]
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert sorted(tuple(s) for s in r.lic_spans) == kept, r.text[:80]
        base = {label for _, label in places}
        assert r.base_labels == ",".join(sorted(base))
        assert r.labels == ",".join(sorted(base | {s[4] for s in kept})) and 0 <= r.score <= 1
    assert licenses.summary(licenses.scan(df.limit(0))).count() == 0


def test_there_are_hundreds_of_rules():
    rules = licenses.signature_rules()
    assert 200 < len(rules) and len({r[0] for r in rules}) == len(rules)
    for _, _, pattern, _, _, priority, confidence in rules:
        assert 1 <= priority <= licenses.LEVELS and 0 < confidence <= 1 and re.compile(pattern)


def test_spans_behind_line_separators(spark):
    texts = [t for mark in ("\u0085", "\u2028", "\u2029") for t in (
        f"intro{mark} text licensed under the mit license", f"{mark}{mark} apache license 2.0 {mark} x",
        f"released into the public domain {mark} by {mark} the isc license {mark} gpl v3 {mark}")]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in licenses.summary(licenses.scan(df)).collect():
        n, _, kept = _plain_scan(r.text)
        assert kept and r.lic_words == n
        assert sorted(tuple(s) for s in r.lic_spans) == kept, repr(r.text)


def _sampled(pattern: str, rnd) -> str:
    """A random match of a rule's expression."""
    import re._constants as C
    import re._parser as P

    def of(items):
        return "".join(one(op, arg) for op, arg in items)

    def one(op, arg):
        if op is C.LITERAL:
            return chr(arg)
        if op is C.SUBPATTERN:
            return of(arg[3])
        if op is C.BRANCH:
            return of(rnd.choice(arg[1]))
        if op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, inner = arg
            return "".join(of(inner) for _ in range(rnd.randint(low, min(high, low + 4))))
        if op is C.IN:
            kind, value = rnd.choice(arg)
            if kind is C.RANGE:
                return chr(rnd.randint(*value))
            return chr(value) if kind is C.LITERAL else rnd.choice("abz")
        raise AssertionError(op)

    return of(P.parse(pattern))


def test_every_rule_finds_its_own_matches(spark):
    """No match of any of the rules is lost to the keyword prefilters."""
    rnd = random.Random(12)
    rows = []
    for rule, _, words, *_ in licenses.signature_rules():
        for k in range(12):
            match = _sampled(words, rnd)
            text = f"Before, it {match.upper() if k % 3 == 0 else match.replace(' ', ', ' if k % 3 else ' ')} and after."
            rows.append((rule * 100 + k, text))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.lic_spans for r in licenses.scan(df).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        _, _, kept = _plain_scan(text)
        assert kept and sorted(tuple(s) for s in got[i]) == kept, text
