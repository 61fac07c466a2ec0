"""Quality rules and SimHash groups against plain loops."""

import random
import zlib

import xxhash
from pyspark.sql import functions as F

from mailsift.llm import quality, simhash

DOCS = "doc_id long, text string, lang string, source string, fp string, q_kept int, k_id int"


def _good(rnd, n=80):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(3, 8)))
                    for _ in range(n))


def _plain_counts(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines, dup, seen = (text or "").split("\n"), 0, set()
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup,
            len(covered))


def test_counts_of_odd_texts():
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "a b c a b c", "é x y\x1cz", "l1\nl1\n\n\nl1 \nl1", "## $a |b|",
             "a a a a", "one two"] + [" ".join(rnd.choice("abc") for _ in range(30))
                                      for _ in range(30)]
    for t in texts:
        assert quality.text_counts(t)[:5] == _plain_counts(t), t


def test_groups_of_different_distributions_judge_one_text_differently(spark):
    """The sketch decides: the same text is an outlier in one group and common in the other."""
    rnd = random.Random(5)
    word = lambda a, b: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(a, b)))
    short = [" ".join(word(3, 5) for _ in range(90)) for _ in range(200)]
    long = [" ".join(word(4, 12) for _ in range(90)) for _ in range(200)]
    rows = [(i, t, "en", "short") for i, t in enumerate(short)]
    rows += [(1000 + i, t, "en", "long") for i, t in enumerate(long)]
    rows += [(5000, long[3], "en", "short"), (5001, short[3], "en", "long"), (5002, long[3], "en", "long"),
             (5003, long[3], "en", "few"), (5004, long[3], "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["row"].doc_id: r.q_kept for r in quality.quality_verdicts(df).collect()}
    assert not kept[5000] and not kept[5001] and kept[5002] and kept[5003] and kept[5004]
    assert sum(kept[i] for i in range(200)) >= 198 and sum(kept[1000 + i] for i in range(200)) >= 198
    cuts = {r.q_group.source: r for r in quality.thresholds(quality.sketch(quality.with_counts(
        df, ("doc_id",)))).collect()}
    assert cuts["short"].q_word_len_high < 5 < cuts["long"].q_word_len_low + 2
    q = {(r.q_group.source, r.ratio): r for r in quality.quantiles(quality.sketch(quality.with_counts(
        df, ("doc_id",))), quality.PROBS).collect()}
    for source in ("short", "long"):  # from quantiles, not from a margin
        r = q[source, "word_len"]
        assert 8 * (r.q2 - r.q1) >= 0.4
        assert abs(cuts[source].q_word_len_high - (r.q1 + 8 * (r.q2 - r.q1))) < 1e-9


def test_counts_of_a_very_long_text():
    import time

    words = [f"w{i % 70_000}" for i in range(1_000_000)]
    t0 = time.perf_counter()
    n, _, _, _, repeated, _ = quality.text_counts(" ".join(words))
    assert (n, repeated) == (1_000_000, 1_000_000) and time.perf_counter() - t0 < 10


def test_verdicts_keep_clean_and_drop_outliers(spark):
    rnd = random.Random(2)
    rows = [(i, _good(rnd), rnd.choice(["en", None]), "hot", "mine", 5, 6) for i in range(300)]
    junk = [" ".join(w + "&&&" for w in _good(rnd).split()), _good(rnd, 20), None, "",
            "the same three " * 40, "aaaaaaaaaaaaaaaaaaaaaaaaaaaa " * 2 + _good(rnd, 5)]
    rows += [(1000 + i, t, "en", "hot", "mine", 5, 6) for i, t in enumerate(junk)]
    rows += [(2000, "\n".join([_good(rnd, 6)] * 2 + [_good(rnd, 6) for _ in range(12)]), "en", "hot",
              "mine", 5, 6)] * 2
    df = spark.createDataFrame(rows, DOCS)
    kept = quality.keep_quality(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows if not 1000 <= r[0] < 2000}
    assert kept.filter("doc_id = 2000 and q_kept = 5 and fp = 'mine'").count() == 2
    verdicts = quality.quality_verdicts(df)
    assert verdicts.count() == len(rows)
    assert verdicts.filter("q_kept").count() == kept.count()
    empty = spark.createDataFrame([], DOCS)
    assert quality.keep_quality(empty).count() == quality.quality_verdicts(empty).count() == 0


def test_sketches_merge_to_the_sketch_of_the_whole(spark):
    rnd = random.Random(3)
    df = spark.createDataFrame([(i, _good(rnd, 60), "en", "s", "", 0, 0) for i in range(100)], DOCS)
    make = lambda part: quality.sketch(quality.with_counts(part, ("doc_id",)))
    whole = make(df)
    merged = quality.merge(make(df.filter("doc_id < 30")), make(df.filter("doc_id >= 30")))
    assert merged.exceptAll(whole.select(merged.columns)).count() == 0 == \
        whole.select(merged.columns).exceptAll(merged).count()
    q = quality.quantiles(whole, (0.5,)).filter("ratio = 'word_len'").first().q0
    lens = sorted(quality.text_counts(r.text)[1] / 60 for r in df.collect())
    assert lens[49] <= q <= lens[49] * quality.GAMMA


def _plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42)
              for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _near_copies(rnd, n):
    """Texts whose fingerprints crowd together: one long text, a word changed in each copy."""
    words = _good(rnd, 120).split()
    out = []
    for _ in range(n):
        copy = list(words)
        copy[rnd.randrange(120)] = "x" + str(rnd.randrange(1000))
        out.append(" ".join(copy))
    return out


def test_groups_equal_all_pairs_and_one_stays(spark):
    rnd = random.Random(4)
    texts = [None, "", "One", "one", "a b", "A  B", "é é"] + [_good(rnd) for _ in range(40)] \
        + _near_copies(rnd, 90) + ["exact copy of this text here"] * 30
    rows = [(i, t, "en", "s", "mine", 1, 2) for i, t in enumerate(texts)]
    rows += [(3, "one", "en", "s", "mine", 1, 2)] * 2 + [(None, "lone text without id", "", "", "", 0, 0)] * 2
    df = spark.createDataFrame(rows, DOCS)
    prints = [_plain_fingerprint(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    names = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            names[root(i)] = min(names.get(root(i), r[0]), r[0])
    want = sorted((str(r[0]), prints[i], str(names.get(root(i)))) for i, r in enumerate(rows))
    for pairs_up_to in (1, 4, 1000):
        got = simhash.duplicate_groups(df, pairs_up_to=pairs_up_to).collect()
        assert sorted((str(r.doc_id), r.fp & (1 << 64) - 1, str(r.component_id))
                      for r in got) == want
    kept = simhash.keep_one_each(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(names.get(r)) for r in {root(i) for i in range(len(rows))})


def test_rows_of_one_id_with_equal_crc_are_told_apart(spark):
    rnd, seen = random.Random(6), {}
    while True:
        a = f"{rnd.getrandbits(64):x} {rnd.getrandbits(64):x}"
        b = seen.setdefault(zlib.crc32(a.encode()), a)
        if a != b:
            break
    df = spark.createDataFrame([(0, a), (None, a), (None, b)], "doc_id long, text string")
    kept = simhash.keep_one_each(df).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(0, a), (None, b)} and len(kept) == 2


def test_fingerprint_is_spark_xxhash64_majority(spark):
    text = "Only three words"
    one = spark.range(1).select(F.xxhash64(F.lit("only three words"))).first()[0]
    assert simhash.fingerprint(text) == one


def test_groups_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.duplicate_groups(empty).count() == simhash.keep_one_each(empty).count() == 0


def test_long_chains_are_one_component(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    extra = spark.createDataFrame([(1000, 1001), (1001, 1000)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges.union(extra)).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
