"""Prediction by partial matching: a pretrained byte-context trie scores every text.

A symbol is a byte of the lower-cased (A-Z) text or the end sign; its context
is the ``ORDER`` symbols before it, start signs first. The trie of all contexts
is learnt from the training texts. Where a symbol was not seen in a context the
coder escapes to the next shorter one (escape estimate: half a count for each distinct symbol, taken
off the symbols' own counts), and the symbols seen in the longer context are
excluded there; below the empty context all symbols not excluded are alike.

Because what is excluded in a context is exactly what its longer context has
seen, each escape is a figure of one context, so the log probability of a
(context, symbol) pair is built level by level with joins over distinct pairs,
never over positions of the corpus:

    F(s, a) = log (2 c(s,a) - 1) / 2 T(s)       if a was seen in s
              log D(s) / 2 T(s) + U(s, a)        if not;  F(shorter) if s was not seen
    U(s, a) = log (2 c(s',a) - 1) / 2 X(s)      if a was seen in s', s one symbol shorter
              log E(s) / 2 X(s) + U(s', a)       if not (the first term is 0 if E(s) = 0)
    X(s) = T(s') - sum of c(s', seen in s),  E(s) = D(s') - D(s)

Counting and scoring are two narrow passes over the texts. Keys that are used
often, up to a fixed number, are sent to the tasks; the rest meet the rows that
hold them in a shuffle join. Every key goes one way or the other, so results
do not depend on the bound. Words for the base score are known by their 64-bit
hash (two of a billion words collide with a chance of about 3 per cent).

Defined results: null and empty texts are the end sign alone; a null id counts
as the empty text when the training part is chosen; with no training text all
symbols are alike; repeated rows are scored alike; an empty table gives no
rows. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailsift.llm._store import give_back, small_batches, written

ORDER = 5
BITS, END, START, ALPHABET = 9, 256, 257, 257
BYTES_AT_ONCE = 1 << 20         # of text that a counting task takes in one step
SCORED_AT_ONCE = 1 << 18        # and a scoring task, which holds the tables sent to it too
HELD_BACK = 1_000_000          # distinct keys a counting task holds before it emits them
KEYS_SENT = 1_000_000          # most used keys of each kind that are sent to the tasks
GRAM, WORD = 0, 1


def _codes(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed (context, symbol) pair of every symbol, and the first one of each text."""
    lead, end = np.full(order, START, np.int64), np.array([END])
    parts = []
    for t in texts:
        parts += [lead, np.frombuffer(t, np.uint8), end]
    codes = np.concatenate(parts).astype(np.int64)
    n = len(codes) - order
    grams = codes[:n].copy()
    for k in range(1, order + 1):
        grams <<= BITS
        grams |= codes[k:k + n]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    return grams[codes[order:] != START], np.cumsum(sizes) - sizes


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column one by one, so that a batch is never held as Python strings."""
    return (text.as_py() for text in column)


def _parts(texts: Iterable[str | None],
           at_once: int = BYTES_AT_ONCE) -> Iterator[tuple[int, list[bytes]]]:
    """Lower-cased bytes of consecutive texts, about ``at_once`` at a time, with the first's place."""
    at, size, out = 0, 0, []
    for i, text in enumerate(texts):
        raw = (text or "").encode().lower()
        if size and size + len(raw) > at_once:
            yield at, out
            at, size, out = i, 0, []
        out.append(raw)
        size += len(raw) + 1
    if out:
        yield at, out


def _added(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, more_counts: np.ndarray):
    keys, counts = np.concatenate((keys, more)), np.concatenate((counts, more_counts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else []
    return (keys[heads], np.add.reduceat(counts, heads)) if len(keys) else (keys, counts)


def _hashes(words) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in words], np.uint64).view(np.int64)


def _rows(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys), pa.array(counts)],
        names=["kind", "key", "n"])


def _missing(n: int, *found: tuple[int, np.ndarray, np.ndarray]) -> pa.ListArray:
    """Per row the distinct ``(kind, key)`` and how often, of some ``(kind, rows, keys)``."""
    kind = np.concatenate([np.full(len(keys), k, np.int32) for k, _, keys in found])
    who = np.concatenate([rows for _, rows, _ in found])
    key = np.concatenate([keys for _, _, keys in found])
    order = np.lexsort((key, kind, who))
    kind, who, key = kind[order], who[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (kind[1:] != kind[:-1]) | (who[1:] != who[:-1])
    heads = np.flatnonzero(new)
    pairs = pa.StructArray.from_arrays(
        [pa.array(kind[heads]), pa.array(key[heads]), pa.array(np.diff(np.append(heads, len(key))))],
        names=["kind", "key", "n"])
    starts = np.searchsorted(who[heads], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pairs)


def count_keys(texts: DataFrame, order: int) -> DataFrame:
    """``(kind, key, n)`` of ``texts (text, held_out)``: training counts; pairs that only
    held-out texts hold are listed with 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        keys, counts, words = none, none, Counter()
        for batch in batches:
            held = batch.column(1).to_pylist()
            for at, part in _parts(_texts(batch.column(0))):
                for out in (False, True):
                    mine = [t for i, t in enumerate(part) if held[at + i] is out]
                    if not mine:
                        continue
                    grams = np.sort(_codes(mine, order)[0])
                    heads = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
                    n = np.diff(np.append(heads, len(grams)))
                    keys, counts = _added(keys, counts, grams[heads], n * (not out))
                    if not out:
                        for t in mine:
                            words.update(t.split())
                if len(keys) > HELD_BACK:
                    yield _rows(GRAM, keys, counts)
                    keys, counts = none, none
                if len(words) > HELD_BACK // 4:
                    yield _rows(WORD, _hashes(words), np.array(list(words.values()), np.int64))
                    words = Counter()
        yield _rows(GRAM, keys, counts)
        if words:
            yield _rows(WORD, _hashes(words), np.array(list(words.values()), np.int64))
        del keys, counts, words
        give_back()

    return texts.select("text", "held_out").mapInArrow(run, "kind int, key long, n long") \
        .groupBy("kind", "key").agg(F.sum("n").alias("n"))


def pair_scores(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """``(key, n, value)``: log10 probability of each pair of ``grams (key, n)``."""
    levels = [grams.select("key", F.col("n").alias("c"))]
    for k in range(order - 1, -1, -1):
        mask = (1 << BITS * (k + 1)) - 1
        levels.insert(0, levels[0].groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key"))
                      .agg(F.sum("c").alias("c")))
    seen = F.col("c") > 0
    of = Window.partitionBy(F.shiftright("key", BITS))
    total = F.sum("c").over(of)
    kinds = F.sum(seen.cast("long")).over(of)
    share = lambda c, t: F.log((2 * F.col(c) - 1) / (2 * F.col(t)))
    free = F.lit(ALPHABET) - F.col("d")
    table = (levels[0].withColumn("t", total).withColumn("d", kinds)
             .withColumn("u", F.when(~seen, -F.log(free.cast("double"))))
             .withColumn("f", F.when(F.col("t") == 0, F.lit(-math.log(ALPHABET)))
                         .when(seen, share("c", "t"))
                         .otherwise(F.log(F.col("d") / (2 * F.col("t"))) + F.col("u"))))
    for k in range(1, order + 1):
        mask = (1 << BITS * k) - 1
        above = table.select(F.col("key").alias("up"), F.col("c").alias("cp"),
                             F.col("t").alias("tp"), F.col("d").alias("dp"),
                             F.col("u").alias("u_up"), F.col("f").alias("f_up"))
        level = (levels[k].withColumn("up", F.col("key").bitwiseAND(F.lit(mask)))
                 .join(above, "up").withColumn("t", total).withColumn("d", kinds)
                 .withColumn("taken", F.sum(F.when(seen, F.col("cp")).otherwise(0)).over(of))
                 .withColumn("e", F.col("dp") - F.col("d"))
                 .withColumn("x", F.col("tp") - F.col("taken")))
        u = F.when(F.col("cp") > 0, share("cp", "x")).otherwise(
            F.when(F.col("e") > 0, F.log(F.col("e") / (2 * F.col("x")))).otherwise(0.0)
            + F.col("u_up"))
        f = (F.when(F.col("t") == 0, F.col("f_up"))
             .when(seen, share("c", "t"))
             .otherwise(F.log(F.col("d") / (2 * F.col("t"))) + F.col("u")))
        table = level.withColumn("u", F.when(~seen, u)).withColumn("f", f) \
            .select("key", "c", "t", "d", "u", "f")
        if k < order:
            table = written(table, f"level{k}")
    return table.select("key", F.col("c").alias("n"), (F.col("f") / math.log(10)).alias("value"))


class Table:
    """Open-addressing table from int64 keys to float64 values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.used = np.zeros(1 << bits, bool)
        self.keys, self.values = np.zeros(1 << bits, np.int64), np.zeros(1 << bits)
        slot, rest = self._slot(keys), np.arange(len(keys))
        while len(rest):
            free = ~self.used[slot[rest]]
            where, first = np.unique(slot[rest[free]], return_index=True)
            put = rest[free][first]
            self.used[where], self.keys[where], self.values[where] = True, keys[put], values[put]
            done = np.zeros(len(keys), bool)
            done[put] = True
            rest = rest[~done[rest]]
            slot[rest] = (slot[rest] + 1) & self.mask

    @classmethod
    def of(cls, state: dict) -> Table:
        """The table from its plain arrays (what is broadcast)."""
        table = object.__new__(cls)
        table.__dict__.update(state)
        return table

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where absent) and whether each key is there."""
        slot = self._slot(keys)
        there = (self.keys[slot] == keys) & self.used[slot]
        rest = np.flatnonzero(~there & self.used[slot])
        while len(rest):
            slot[rest] = (slot[rest] + 1) & self.mask
            at = slot[rest]
            hit = self.used[at] & (self.keys[at] == keys[rest])
            there[rest[hit]] = True
            rest = rest[~hit & self.used[at]]
        return np.where(there, self.values[slot], 0.0), there


def _most_used(table: DataFrame, most: int) -> Table:
    """Keys and values of the rows used at least so often that ``most`` rows at most remain."""
    steps = table.groupBy(F.floor(F.log2(F.col("n") + 1) * 8).alias("step")) \
        .agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("low")).collect()  # < 512 rows
    held, least = 0, None
    for step in sorted(steps, key=lambda r: -r.step):
        if held + step.rows > most:
            break
        held, least = held + step.rows, step.low
    if least is None:
        return Table(np.zeros(0, np.int64), np.zeros(0))
    got = table.filter(F.col("n") >= least).select("key", "value").toArrow()
    return Table(got.column(0).to_numpy(), got.column(1).to_numpy())


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                order: int = ORDER, keys_sent: int = KEYS_SENT, held_mod: int = 10) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    Training rows are those whose crc32 of the id's text is not divisible by
    ``held_mod``. ``score`` is the trie's log10 probability of the text; ``base_score``
    the smoothed log10 probability of its words as a bag.
    """
    spark = docs.sparkSession
    small_batches(spark)
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       (crc % held_mod == 0).alias("held_out"))
    counted = written(count_keys(rows, order), "keys")
    pairs = written(pair_scores(counted.filter(F.col("kind") == GRAM), order), "pairs")
    words = counted.filter(F.col("kind") == WORD) \
        .select("key", "n", F.log10(F.col("n") + 0.1).alias("value"))
    sums = counted.filter(F.col("kind") == WORD).agg(F.sum("n").alias("n"),
                                                    F.count(F.lit(1)).alias("v")).first()
    ends = rows.filter(~F.col("held_out")).count()
    tokens = (sums.n or 0) + ends
    kinds = sums.v + (ends > 0)
    below = math.log10(tokens + 0.1 * (kinds + 1))
    end_value = math.log10(ends + 0.1)
    # Plain arrays, so that executors need no copy of this package.
    sent = [spark.sparkContext.broadcast(dict(_most_used(t, keys_sent).__dict__))
            for t in (pairs, words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {kind: Table.of(sent[kind].value) for kind in (GRAM, WORD)}
        for batch in batches:
            for at, part in _parts(_texts(batch.column(1)), SCORED_AT_ONCE):
                n = len(part)
                grams, firsts = _codes(part, order)
                value, there = tables[GRAM].get(grams)
                score = np.add.reduceat(value, firsts)
                split = [t.split() for t in part]
                sizes = np.fromiter(map(len, split), np.int64, n)
                flat = [w for words in split for w in words]
                place = {w: i for i, w in enumerate(dict.fromkeys(flat))}
                which = np.fromiter(map(place.__getitem__, flat), np.int64, len(flat))
                owner = np.repeat(np.arange(n), sizes)
                hashed = _hashes(place)
                word_value, known = tables[WORD].get(hashed)
                base = np.bincount(owner, word_value[which], n)
                n_known = np.bincount(owner, known[which], n).astype(np.int64)
                spread = np.repeat(np.arange(n), np.diff(np.append(firsts, len(grams))))
                new = ~known[which]
                rest = _missing(n, (GRAM, spread[~there], grams[~there]),
                                (WORD, owner[new], hashed[which[new]]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n), batch.column(2).slice(at, n),
                     pa.array(sizes + 1), pa.array(n_known), pa.array(base), pa.array(score),
                     rest],
                    names=["id", "held_out", "n_tokens", "n_known", "base", "score", "rest"])
        give_back()

    kind = rows.schema["id"].dataType.simpleString()
    first = rows.mapInArrow(run, f"id {kind}, held_out boolean, n_tokens long, n_known long, "
                                 "base double, score double, "
                                 "rest array<struct<kind:int,key:bigint,n:bigint>>")
    first = written(first.withColumn("row", F.monotonically_increasing_id()), "first")
    for table in sent:  # written: no task needs them any more
        table.destroy()
    model = pairs.select(F.lit(GRAM).alias("kind"), "key", "value", F.lit(0).cast("long").alias("c")) \
        .unionByName(words.select(F.lit(WORD).alias("kind"), "key", "value",
                                  F.col("n").alias("c")))
    late = first.select("row", F.explode("rest").alias("r")).select("row", "r.*") \
        .join(model, ["kind", "key"], "left")
    gram = F.col("kind") == GRAM
    late = late.groupBy("row").agg(
        F.sum(F.when(gram, F.col("n") * F.col("value"))).alias("late_score"),
        F.sum(F.when(~gram, F.col("n") * F.coalesce("value", F.lit(-1.0)))).alias("late_base"),
        F.sum(F.when(~gram & (F.col("c") > 0), F.col("n"))).alias("late_known"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return first.join(late, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + zero("late_known") + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("late_base") + F.lit(end_value)
         - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        (F.col("score") + zero("late_score")).alias("score"))
