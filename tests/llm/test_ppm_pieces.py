"""Language-model scores and sampled segmentations against brute force."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from mailsift.llm import pieces, ppm


def _plain_scores(train, texts, order):
    """Escape, exclude and code symbol by symbol, the textbook way."""
    count = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    symbols = lambda t: [ppm.START] * order + list(t) + [ppm.END]
    for t in train:
        s = symbols(t)
        for i in range(order, len(s)):
            for k in range(order + 1):
                count[k][tuple(s[i - k:i])][s[i]] += 1
    out = []
    for t in texts:
        s, total = symbols(t), 0.0
        for i in range(order, len(s)):
            gone, coded = set(), False
            for k in range(order, -1, -1):
                live = {a: n for a, n in count[k].get(tuple(s[i - k:i]), {}).items()
                        if a not in gone}
                if not live:
                    continue
                whole = 2 * sum(live.values())
                if s[i] in live:
                    total += math.log10((2 * live[s[i]] - 1) / whole)
                    coded = True
                    break
                total += math.log10(len(live) / whole)
                gone |= set(live)
            if not coded:
                total -= math.log10(ppm.ALPHABET - len(gone))
        out.append(total)
    return out


TEXTS = ["abracadabra", "Abra cadabra banana", "", None, "the cat sat on the mat", "the mat sat",
         "zzz é ñ qqq", "a", "abab abab", "banana band"]


@pytest.mark.parametrize("sent", [10 ** 6, 10, 0])
def test_scores_equal_the_plain_coder(spark, sent):
    rows = [(i, t, "mine", 1.0) for i, t in enumerate(TEXTS * 2)] + [(None, "xyz", "", 0.0)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, n string, score double")
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    low = lambda t: (t or "").encode().lower()
    train = [low(r[1]) for r in rows if not held(r[0])]
    words = collections.Counter(w for t in train for w in t.split())
    n, v = sum(words.values()) + len(train), len(words) + 1
    below = n + 0.1 * (v + 1)
    scores = _plain_scores(train, [low(r[1]) for r in rows], 3)
    want = []
    for (i, t, *_), score in zip(rows, scores):
        mine = low(t).split()
        base = sum(math.log10((c + 0.1) / below) for c in [words[w] for w in mine] + [len(train)])
        want.append((str(i), held(i), len(mine) + 1, sum(words[w] > 0 for w in mine) + 1, n,
                     round(base, 8), round(score, 8)))
    got = ppm.score_texts(df, order=3, keys_sent=sent).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens,
                   round(r.base_score, 8), round(r.score, 8)) for r in got) == sorted(want)


def test_scores_without_training_text_and_of_nothing(spark):
    key = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    df = spark.createDataFrame([(key, "ab")], "doc_id long, text string")
    row = ppm.score_texts(df).first()
    assert row.score == pytest.approx(-3 * math.log10(257)) and row.n_known == 0
    assert ppm.score_texts(df.limit(0)).count() == 0


def test_a_scoring_task_takes_little_text_at_a_time():
    """Texts are read one by one, and a step ends before the next text would pass the bound."""
    taken = []
    texts = (taken.append(i) or "ab " * 10 for i in range(50))
    at, part = next(ppm._parts(texts, 100))
    assert at == 0 and len(part) == 3 and len(taken) == 4
    column = pa.array([t or "" for t in TEXTS] * 5)
    parts = list(ppm._parts(ppm._texts(column), 64))
    assert [i for i, _ in parts] == [0, *np.cumsum([len(p) for _, p in parts])[:-1]]
    assert sum((p for _, p in parts), []) == [t.encode().lower() for t in column.to_pylist()]
    assert ppm.SCORED_AT_ONCE < ppm.BYTES_AT_ONCE


@pytest.mark.parametrize("n", [0, 1, 7, 300])
def test_missing_keys_are_counted_by_row(n):
    rng = np.random.default_rng(n)
    found = [(kind, rng.integers(0, 9, n), rng.integers(-3, 3, n)) for kind in (ppm.GRAM, ppm.WORD)]
    got = ppm._missing(11, *found).to_pylist()
    want = collections.Counter((int(r), kind, int(k)) for kind, rows, keys in found
                               for r, k in zip(rows, keys))
    assert {(r, x["kind"], x["key"]): x["n"] for r, xs in enumerate(got) for x in xs} == want
    assert len(got) == 11 and sum(map(len, got)) == len(want)


SMALL = {"▁": 5, "▁a": 6, "a": 7, "b": 8, "ab": 9, "ba": 10, "▁ab": 11, "aba": 12}


def _small():
    return pieces.Lattices(pieces.Vocabulary.of(SMALL, {i: 100 + i for i in range(256)}, 400, 1.0))


def _all(text, v):
    def spell(s):
        if not s:
            yield ()
            return
        for p, i in SMALL.items():
            if s.startswith(p):
                for rest in spell(s[len(p):]):
                    yield (i, *rest)
    every = list(spell(pieces._normalised(text)))
    mass = np.exp([sum(v.log_weight[i] for i in s) for s in every])
    return dict(zip(every, mass / mass.sum()))


def test_samples_are_distinct_and_scored_right():
    lat, runs, k = _small(), 3000, 3
    prob = _all("aba ab", lat.v)
    first, count, mass = collections.Counter(), 0.0, 0.0
    for seed in range(runs):
        out = list(pieces.sample_batch(lat, ["aba ab"], [seed * 7919 + 13], k))
        ids = [tuple(o[2].tolist()) for o in out]
        assert len(set(ids)) == k and [o[1] for o in out] == [1, 2, 3]
        assert all(abs(o[3] - math.log(prob[i])) < 1e-9 for o, i in zip(out, ids))
        assert [o[4] for o in out] == sorted((o[4] for o in out), reverse=True)
        first[ids[0]] += 1
        count += sum(1 / o[5] for o in out)
        mass += sum(prob[i] / o[5] for o, i in zip(out, ids))
    assert max(abs(first[s] / runs - prob[s]) for s in prob) < 0.03
    assert mass / runs == pytest.approx(1, abs=0.1)          # inclusion scores weigh without bias
    assert count / runs == pytest.approx(len(prob), rel=0.2)


def test_few_segmentations_are_all_given():
    lat = _small()
    out = list(pieces.sample_batch(lat, ["a", "", None], [5, 6, 7], 10))
    assert sorted((o[0], tuple(o[2].tolist()), o[5]) for o in out) == [
        (0, (5, 7), 1.0), (0, (6,), 1.0), (1, (), 1.0), (2, (), 1.0)]


def test_batching_does_not_change_samples():
    texts = ["aba ab ba", "ab", "b a b a", "aab  b"]
    whole = [(o[0], tuple(o[2].tolist())) for o in pieces.sample_batch(_small(), texts, [1, 2, 3, 4], 3)]
    alone = [(i, tuple(o[2].tolist())) for i, t in enumerate(texts)
             for o in pieces.sample_batch(_small(), [t], [i + 1], 3)]
    assert whole == alone


def test_used_words_keep_their_lattices(monkeypatch):
    """Only the less used words are built again, and samples do not change by that."""
    texts = [t + " ab aba" for t in ("aab bab", "abab baa", "bba abb", "bbab aabb", "baab bbb")]
    want = [list(pieces.sample_batch(_small(), [t], [i], 3)) for i, t in enumerate(texts * 3)]
    built, add = [], pieces.Lattices._add
    monkeypatch.setattr(pieces, "WORDS_KEPT", 5)
    monkeypatch.setattr(pieces.Lattices, "_add", lambda self, new: (built.extend(new), add(self, new)))
    lat = _small()
    for i, t in enumerate(texts * 3):
        got = list(pieces.sample_batch(lat, [t], [i], 3))
        assert len(lat.words) <= 5 + 4
        for a, b in zip(got, want[i], strict=True):
            assert a[:2] == b[:2] and a[2].tolist() == b[2].tolist() and a[3:] == pytest.approx(b[3:])
    assert built.count("▁ab") == built.count("▁aba") == 1 and built.count("▁bab") == 3


def test_words_come_numbered_by_kind():
    """A word that comes often is one value; words are those of the plain pattern."""
    texts = ["the cat  the\ncat", None, "", "  two\n\n x\n", "\n", " ", "é ▁ 𝒳▁ é", "the " * 50, "the"]
    words, ends = pieces._words(texts)
    got = [w.replace("▁", pieces.LITERAL).replace(" ", "▁") for w in words.to_pylist()]
    plain = re.compile("▁+[^▁\n]*|\n|[^▁\n]+")
    assert [got[a:b] for a, b in zip(ends, ends[1:])] == [
        plain.findall(pieces._normalised(t)) for t in texts]
    assert len(words.dictionary) == len(set(got))


def test_lattices_built_and_sampled_in_parts_are_the_same(monkeypatch):
    """New words, texts and moved edges are taken a few at a time, which bounds a worker's memory."""
    texts = ["aba ab ba", "ab", "b a b a", "aab  b", "bbab aabb", "é aba", None, "baab bbb ab"] * 2
    want = list(pieces.sample_batch(_small(), texts, range(16), 3))
    sizes, add = [], pieces.Lattices._add
    for name, n in (("WORDS_ADDED", 2), ("CHARS_AT_ONCE", 8), ("EDGES_MOVED", 3), ("WORDS_KEPT", 4)):
        monkeypatch.setattr(pieces, name, n)
    monkeypatch.setattr(pieces.Lattices, "_add", lambda self, new: (sizes.append(len(new)), add(self, new)))
    lat = _small()
    for _ in range(3):
        got = list(pieces.sample_batch(lat, texts, range(16), 3))
        for a, b in zip(got, want, strict=True):
            assert a[:2] == b[:2] and a[2].tolist() == b[2].tolist() and a[3:] == pytest.approx(b[3:])
    parts = list(pieces._sampled(lat, texts, range(16), 3))
    assert max(sizes) == 2 and len(parts) > 8 and parts[-1][1] == 16


def test_drawing_one_by_one_is_the_same():
    for seed, place, step, stream in ((5, 0, 3, 99), (2 ** 63 - 7, 12 + (2 << 32), 7, 2001)):
        many = pieces._draw(np.uint64(seed), np.array([place]), step, stream)
        assert pieces._draw_one(seed, place, step, stream) == float(many[0])


def test_round_trip_of_odd_texts(spark):
    texts = [None, "", " ", "  two  spaces ", "tab\tline\n\nfeed", "▁ literal ▁▁", "𝒳 𐍈 emoji 😀", "é́",
             "<s> </s> <0x0A>", "long " * 40_000, "x" * 5000, "​ "]
    rows = [(i, t, "mine", 3) for i, t in enumerate(texts)] + [(None, "no id", "", 0)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, sample int")
    got = pieces.decode_ids(pieces.sample_segmentations(df, samples=3), out_col="back").collect()
    by = {r[0]: r[1] or "" for r in rows}
    assert all(r.round_trip and r.back == by[r.doc_id] and r.n_pieces == len(r.ids)
               and zlib.crc32(np.array(r.ids, "<i4").tobytes()) == r.ids_crc32 for r in got)
    seen = collections.Counter((r.doc_id, tuple(r.ids)) for r in got if r.doc_id is not None)
    assert max(seen.values()) == 1 and {r.doc_id for r in got} == set(by)
    assert pieces.sample_segmentations(df.limit(0)).count() == 0


def test_texts_without_words_alone():
    schema = pa.schema([("doc_id", pa.int64()), ("sample", pa.int32()), ("n_pieces", pa.int64()),
                        ("log_prob", pa.float64()), ("perturbed", pa.float64()),
                        ("inclusion", pa.float64()), ("ids_crc32", pa.int64()),
                        ("round_trip", pa.bool_()), ("ids", pa.list_(pa.int32()))])
    lat = _small()
    (_, _, *found), = pieces._sampled(lat, [None, ""], [1, 2], 2)
    rows = pieces._table(lat.v, pa.array([7, 8]), [None, ""], *found, schema, True).to_pylist()
    assert [(r["doc_id"], r["sample"], r["n_pieces"], r["ids"], r["ids_crc32"], r["inclusion"],
             r["round_trip"]) for r in rows] == [(i, 1, 0, [], 0, 1.0, True) for i in (7, 8)]
    assert lat.v.decode(np.zeros(0, np.int64)) == b""
