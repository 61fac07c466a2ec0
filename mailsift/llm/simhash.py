"""SimHash near-duplicates: pigeonhole blocks, joined, then verified.

Fingerprints are 64 majority bits over the XXH64 values of word shingles. Two
fingerprints that differ in at most ``distance`` bits agree on at least
``blocks - distance`` of their blocks, so every choice of that many blocks
gives one key, equal keys are joined, and the Hamming distance is verified.

A key shared by few distinct fingerprints is joined to pairs. A key shared by
many (a large family of near copies) would give the square of its size, so
its members are linked through centres instead: two values are within two
bits exactly when some value is within one bit of both, so each member names
the values within one bit (over the bits outside the key), and all that name
the same value are linked to its smallest member. Both ways keep exactly the
links within two bits, up to reachability; the second needs ``distance`` 2.

Equal fingerprints meet before any join (one row per distinct value), and
components are found by alternating large-star and small-star rounds over the
linked values alone, each round written to the shared folder.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; repeated rows share their component; a null id never names a
component unless all of its ids are null; an empty table gives no rows;
extra columns, whatever their names, come out unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from mailsift.llm._store import give_back, small_batches, written

SHINGLE = 3
DISTANCE = 2
BLOCKS = 5
PAIRS_UP_TO = 32     # members of a key that are joined to pairs; beyond, linked by centres
SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit majority fingerprint of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z only, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    firsts, lasts = starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(firsts)
    for at in range(0, n, SHINGLES_AT_ONCE):
        hashes = np.array([digest(joined[a:b], 42) for a, b in
                           zip(firsts[at:at + SHINGLES_AT_ONCE], lasts[at:at + SHINGLES_AT_ONCE])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Add ``fp`` (long); narrow, whole texts."""
    small_batches(docs.sparkSession)

    @F.arrow_udf(LongType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(t, shingle) for t in texts.to_pylist()], pa.int64())
            del texts
        give_back()
    return docs.withColumn("fp", of(F.col(text_col)))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def block_masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """One 64-bit mask per choice of ``blocks - distance`` blocks."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(parts, blocks - distance)]


def _centres(fp: Column, which: Column, masks: list[int]) -> Column:
    """The value itself and every value one bit off outside the key's mask."""
    flips = [F.array(*[F.lit(0).cast("long")] + [F.lit(_signed(1 << i)) for i in range(64)
                                                   if not m >> i & 1]) for m in masks]
    return F.transform(F.element_at(F.array(*flips), which + 1), lambda x: fp.bitwiseXOR(x))


def links(values: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS,
          pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """Edges ``(a, b)`` among distinct values ``fp``: same reachability as all links."""
    if distance != 2:
        raise ValueError("the centre way for crowded keys is exact for a distance of 2")
    masks = block_masks(blocks, distance)
    keyed = values.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("which", "key"))
    shared = keyed.groupBy("which", "key").agg(F.count(F.lit(1)).alias("members")) \
        .filter("members > 1")
    members = written(keyed.join(shared, ["which", "key"]), "blocks")
    few = members.filter(F.col("members") <= pairs_up_to)
    left = few.select("which", "key", F.col("fp").alias("a"))
    right = few.select("which", "key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = left.join(right, ["which", "key"]).filter((F.col("a") < F.col("b")) & near) \
        .select("a", "b")
    named = members.filter(F.col("members") > pairs_up_to).select(
        "which", "key", "fp", F.explode(_centres(F.col("fp"), F.col("which"), masks)).alias("c"))
    lowest = named.groupBy("which", "key", "c").agg(F.min("fp").alias("b"))
    stars = named.join(lowest, ["which", "key", "c"]).filter("fp <> b") \
        .select(F.col("b").alias("a"), F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a, b)``; root is the smallest node reachable.

    Alternating stars: each round links a node's larger neighbours, then its
    smaller ones, to the smallest neighbour known; it ends when nothing moves.
    """
    pairs = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("node"),
                                                 F.least("a", "b").alias("root")).distinct(),
                    "edges")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("root").alias("node"),
                                              F.col("node").alias("root")))
        low = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("low"))
        large = both.join(low, "node").filter("root > node") \
            .select(F.col("root").alias("node"), F.col("low").alias("root")).distinct()
        least = large.groupBy("node").agg(F.min("root").alias("low"))
        joined = large.join(least, "node")
        small = joined.filter("root <> low").select(F.col("root").alias("node"),
                                                    F.col("low").alias("root")) \
            .unionByName(least.select("node", F.col("low").alias("root"))) \
            .filter("node <> root").distinct()
        pairs = written(small, "stars")
        now = pairs.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node", "root"))
                        .alias("x"), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))
                        .alias("s")).first()
        if now == state:
            break
        state = now
    roots = pairs.select("root").distinct().select(F.col("root").alias("node"), "root")
    return pairs.unionByName(roots)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE, distance: int = DISTANCE,
                     blocks: int = BLOCKS, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """``(id, text_key, fp, root, component_id)`` per row.

    ``root`` names the component by a fingerprint, ``component_id`` by its
    smallest id; ``text_key`` is a 64-bit hash of the text, to tell rows of one id apart.
    """
    marked = written(fingerprints(docs.select(id_col, text_col), text_col, shingle)
                     .select(id_col, F.xxhash64(text_col).alias("text_key"), "fp"), "fingerprints")
    values = written(marked.groupBy("fp").agg(F.min(id_col).alias("low_id")), "values")
    found = written(components(links(values.select("fp"), distance, blocks, pairs_up_to)),
                    "components")
    named = values.join(found, values.fp == found.node, "left") \
        .select("fp", "low_id", F.coalesce("root", "fp").alias("root"))
    names = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    named = named.join(names, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select(id_col, "text_key", "fp", "root", "component_id")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """One row of each group, columns unchanged: the smallest id, null last, then text hash.

    Ids and text hashes alone decide; the rows that go are anti-joined away.
    Rows that repeat a kept id and text are reduced to one.
    """
    groups = written(duplicate_groups(docs, id_col, text_col, **options), "groups")
    key = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), "text_key")
    first = groups.groupBy("root").agg(F.min(key).alias("first"))
    judged = written(groups.select("root", key.alias("key")).groupBy("root", "key")
                     .agg(F.count(F.lit(1)).alias("n")).join(first, "root")
                     .select(F.col("key.id").alias("k_id"), F.col("key.text_key").alias("k_text"),
                             (F.col("key") == F.col("first")).alias("stays"), "n"), "judged")

    def among(table: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        return rows.join(table, F.col("key_id").eqNullSafe(F.col("k_id"))
                         & (F.col("key_text") == F.col("k_text")), how)

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col(id_col).alias("key_id"), F.xxhash64(text_col).alias("key_text"))
    # Keys are unique and hashed task by task, so no task sorts or buffers the rows with their texts.
    gone = written(judged.filter("not stays").select("k_id", "k_text"), "gone")
    left = among(gone.hint("shuffle_hash"), "left_anti", packed)
    often = judged.filter("stays and n > 1")
    once, again = among(often, "left_anti", left), among(often, "left_semi", left)
    return once.unionByName(again.dropDuplicates(["key_id", "key_text"])).select("row.*")
