"""Repeated byte strings by merged Burrows-Wheeler transforms.

A byte goes if it lies in a string of ``length`` bytes that also starts in a
document with a smaller id. Windows of that length with equal bytes have equal
*minimisers* (the least hash among their 16-byte grams), so neighbouring windows
of one minimiser form a fragment, fragments meet by minimiser, and nothing else
has to. Three passes over blocks of documents, written once in buckets so that
they are joined to replies without being shuffled again:

1. Blocks send 32 bits for each distinct minimiser. One that only one document
   has marks no repeats.
2. Fragments of the others go to merge groups of bounded size. Equal fragments
   collapse to one with the least id. Where a minimiser is left with several,
   the fragments are dealt into shards; each shard has its Burrows-Wheeler
   transform built from its own suffix order, over an alphabet of ten-byte
   symbols in 16-bit codes. The transforms are merged by refining the
   interleave of shard numbers, one symbol a pass, each pass reading every
   transform in sequence; suffixes are not sorted again. The pass at which two
   neighbours part gives their common prefix, and stretches of at least
   ``length`` common bytes are the repeated intervals, whose least id decides.
   The bytes of every decided window are compared at the end.
3. Blocks mark what the replies say, and the bytes that stay are joined.

The fragments of a minimiser that has more than ``hot`` of them are cut into
single windows, which meet by their bytes, so no merge group grows with it; a
group holds a few megabytes and at most one copy of a fragment for each block.

Defined results: a null text is empty; a null id is larger than all others;
rows of equal ids do not affect each other; texts shorter than ``length`` stay
whole; an empty table gives no rows; other columns travel in a struct.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from mailsift.llm._store import give_back, shared_dir, small_batches, written

LENGTH = 50
GRAM = 16              # bytes of a minimiser's gram
STEP = 10              # bytes of a symbol; divides the length
MOST = 64              # windows of a fragment: one bit each
BLOCK = 2 << 20        # bytes of a block of documents
GROUP = 4 << 20        # bytes of fragments in a merge group, about
SHARD = 1 << 18        # bytes of a shard
HOT = 20_000           # fragments of one minimiser beyond which they are cut into windows
SLICE = 1 << 20        # bytes hashed at a time
LAST = 2 ** 63 - 1     # stands for a null id

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def _words(data: np.ndarray, n: int, kind: str, at: int = 0) -> np.ndarray:
    """The integers that start at each of ``n`` bytes."""
    return np.ndarray(n, np.dtype(kind), data, at, (1,))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M3
    return h ^ (h >> np.uint64(29))


def _minimisers(data: np.ndarray, length: int) -> np.ndarray:
    """For each window of ``length`` bytes the least hash of its grams."""
    n = len(data) - GRAM + 1
    best = _mixed(_words(data, n, "<u8") * _M1 + (_words(data, n, "<u8", 8) ^ _M2) * _M2)
    have, want = 1, length - GRAM + 1
    while have < want:
        step = min(have, want - have)
        best = np.minimum(best[:len(best) - step], best[step:])
        have += step
    return best


def fragments_of(data: np.ndarray, lengths: np.ndarray, length: int):
    """``start, windows, minimiser, document`` of all fragments of a block, in order."""
    ends = np.cumsum(lengths)
    begins = ends - lengths
    parts = []
    for low in range(0, len(data) - length + 1, SLICE):
        best = _minimisers(data[low:low + SLICE + length - 1], length)
        high = low + len(best)
        # A fragment ends where the minimiser changes, and where no window of its document follows.
        cuts = np.concatenate(([low], np.flatnonzero(best[1:] != best[:-1]) + low + 1,
                               begins[(begins > low) & (begins < high)],
                               (ends - length + 1)[(ends - length + 1 > low) & (ends - length + 1 < high)]))
        start = np.unique(cuts)
        windows = np.diff(start, append=high)
        doc = np.searchsorted(ends, start, "right")
        inside = start + length <= ends[doc]
        start, windows, doc = start[inside], windows[inside], doc[inside]
        pieces = -(-windows // MOST)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(start, pieces) + nth * MOST
        windows = np.minimum(np.repeat(windows, pieces) - nth * MOST, MOST)
        parts.append((start, windows, best[start - low], np.repeat(doc, pieces)))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none
    return tuple(np.concatenate(c) for c in zip(*parts))


class _Block:
    """A block's fragments and its distinct minimisers, in order of their values."""

    def __init__(self, data, lengths, ids, length: int):
        self.length, self.raw, self.data = length, bytes(data), np.frombuffer(data, np.uint8)
        self.lengths, self.ids = np.frombuffer(lengths, np.int64), np.frombuffer(ids, np.int64)
        self.start, self.windows, self.mini, doc = fragments_of(self.data, self.lengths, length)
        self.owner = self.ids[doc]
        self.minis, self.of = np.unique(self.mini, return_inverse=True)

    def text(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.start[i] + self.windows[i] + self.length - 1]

    def told(self) -> tuple[np.ndarray, np.ndarray]:
        """Per minimiser: whether documents of different ids have it, and how many kinds of
        fragments, at most 65,535 (by their ends and sizes: near enough to choose a way)."""
        n = len(self.minis)
        least, most = np.full(n, LAST, np.int64), np.full(n, -2 ** 63, np.int64)
        np.minimum.at(least, self.of, self.owner)
        np.maximum.at(most, self.of, self.owner)
        room = np.concatenate((self.data, np.zeros(8, np.uint8)))
        word = _words(room, len(self.data), "<u8")
        ends = word[self.start + self.windows + self.length - 9]
        look = _mixed(word[self.start] * _M1 + ends * _M2 + self.mini + self.windows.astype(np.uint64))
        _, one = np.unique(look, return_index=True)
        return most > least, np.minimum(np.bincount(self.of[one], minlength=n), 65535).astype(np.uint16)


class _Entries:
    """The distinct fragments among those of a status, with their least ids.

    Hot fragments are taken window by window, each a fragment of its own.
    """

    def __init__(self, block: _Block, status: np.ndarray):
        merge, hot = (np.flatnonzero(status[block.of] == k) for k in (1, 2))
        each = block.windows[hot]
        nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        hot = np.repeat(hot, each)
        self.start = np.concatenate((block.start[merge], block.start[hot] + nth))
        self.windows = np.concatenate((block.windows[merge], np.ones(len(hot), np.int64)))
        self.owner = block.owner[np.concatenate((merge, hot))]
        raw, known = block.raw, {}
        end = self.start + self.windows + block.length - 1
        self.entry = np.fromiter((known.setdefault(raw[a:b], len(known))
                                  for a, b in zip(self.start.tolist(), end.tolist())),
                                 np.int64, len(self.start))
        self.texts, n = list(known), len(known)
        first = np.zeros(n, np.int64)
        first[self.entry[::-1]] = np.arange(len(self.start))[::-1]
        self.size = self.windows[first]
        self.least = np.full(n, LAST, np.int64)
        np.minimum.at(self.least, self.entry, self.owner)
        # What has to meet: fragments of one minimiser; of hot ones only equal windows.
        self.key = np.concatenate((block.mini[merge], np.zeros(len(hot), np.uint64)))[first]
        for i in np.flatnonzero(first >= len(merge)).tolist():
            self.key[i] = xxhash.xxh64_intdigest(self.texts[i])

    def groups(self, merges: int) -> Iterator[tuple[int, np.ndarray]]:
        return _by_number(_mixed(self.key) % np.uint64(merges))


def _by_number(numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number with the places where it stands, in order."""
    order = np.argsort(numbers, kind="stable")
    found = numbers[order]
    cuts = np.flatnonzero(np.diff(found)) + 1
    for places in np.split(order, cuts) if len(order) else []:
        yield int(numbers[places[0]]), places


# ------------------------------------------------------------ the merge

def _suffix_order(positions: np.ndarray, before: np.ndarray, code: np.ndarray,
                  passes: int) -> np.ndarray:
    """A shard's suffixes in the order of their first ``passes`` symbols."""
    for _ in range(passes):
        ahead = before[positions]
        positions = ahead[np.argsort(code[ahead], kind="stable")]
    return positions


def _interleave(transforms: list[np.ndarray], passes: int) -> tuple[np.ndarray, np.ndarray]:
    """``(shard numbers in merged order, common prefixes in symbols with the one before)``."""
    sizes = [len(t) for t in transforms]
    shard = np.repeat(np.arange(len(sizes), dtype=np.uint8), sizes)
    symbols = np.concatenate(transforms)
    apart = np.full(len(shard), passes, np.int16)   # the pass that parts a suffix from the one before
    block = np.zeros(len(shard), np.int32)
    line = np.empty_like(symbols)
    for k in range(passes):
        line[np.argsort(shard, kind="stable")] = symbols   # each transform is read in sequence
        order = np.argsort(line, kind="stable")
        shard, block = shard[order], block[order]
        line = line[order]
        new = np.concatenate(([True], (line[1:] != line[:-1]) | (block[1:] != block[:-1])))
        apart[new & (apart == passes)] = k
        block = np.cumsum(new, dtype=np.int32)
    return shard, apart


def merged_repeats(texts: list[bytes], least: np.ndarray, length: int = LENGTH,
                   shard_bytes: int = SHARD) -> np.ndarray:
    """For each fragment the windows (bits) that also stand in a fragment with a smaller id."""
    sizes = np.array([len(t) for t in texts], np.int64)
    start = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    n, passes = int(sizes.sum()), length // STEP
    which = np.repeat(np.arange(len(texts)), sizes)
    inside = np.arange(n) - start[which]
    # Fragments are read as circles: every suffix has symbols before and after it.
    ring = np.frombuffer(b"".join(t + t[:STEP - 1] for t in texts) + bytes(8), np.uint8)
    at = np.arange(n) + which * (STEP - 1)
    hashed = _mixed(_words(ring, len(ring) - 8, "<u8")[:len(ring) - STEP + 1] * _M1
                    + _words(ring, len(ring) - STEP + 1, "<u2", 8).astype(np.uint64) * _M2)
    code = (hashed >> np.uint64(48)).astype(np.uint16)[at]
    before = np.arange(n) - STEP + np.where(inside < STEP, sizes[which], 0)
    # Shards of whole fragments.
    many = min(255, max(2, -(-n // shard_bytes)))
    edge = np.unique(np.concatenate(([0], start[np.searchsorted(
        start, np.arange(1, many) * n // many, "right") - 1], [n])))
    orders = [_suffix_order(np.arange(a, b), before, code, passes) for a, b in zip(edge, edge[1:])]
    shard, apart = _interleave([code[before[o]] for o in orders], passes)
    merged = np.empty(n, np.int64)
    merged[np.argsort(shard, kind="stable")] = np.concatenate(orders)
    # Intervals of at least ``length`` common bytes; only whole windows count.
    whole = inside[merged] <= sizes[which[merged]] - length
    interval = (np.cumsum(apart < passes) - 1)[whole]
    merged = merged[whole]
    owner = which[merged]
    masks = np.zeros(len(texts), np.uint64)
    if not len(merged):
        return masks
    new = np.flatnonzero(np.concatenate(([True], np.diff(interval) != 0)))
    low = np.repeat(np.minimum.reduceat(least[owner], new), np.diff(new, append=len(merged)))
    hit = np.flatnonzero(low < least[owner])
    if not len(hit):
        return masks
    # Codes are hashes: compare the bytes with the window that holds the least id.
    ranked = np.lexsort((least[owner], interval))
    head = np.repeat(ranked[new], np.diff(new, append=len(merged)))[hit]
    reach = np.arange(length)
    byte = lambda p: ring[(at[merged[p]])[:, None] + reach]
    same = np.concatenate([(byte(hit[i:i + 65536]) == byte(head[i:i + 65536])).all(1)
                           for i in range(0, len(hit), 65536)])
    sure = hit[same]
    if not same.all():  # windows whose codes collide: part their intervals by the bytes
        mixed = np.flatnonzero(np.isin(interval, interval[hit[~same]]))
        sure = np.concatenate((sure, mixed[_later(
            [w.tobytes() for w in byte(mixed)], least[owner[mixed]])]))
    np.bitwise_or.at(masks, owner[sure], np.uint64(1) << inside[merged[sure]].astype(np.uint64))
    return masks


def _later(windows: list[bytes], least: np.ndarray) -> np.ndarray:
    """Which windows also stand with a smaller id."""
    low: dict[bytes, int] = {}
    for w, i in zip(windows, least.tolist()):
        low[w] = min(i, low.get(w, LAST))
    return np.array([low[w] < i for w, i in zip(windows, least.tolist())], bool)


# ------------------------------------------------------------ the passes

_BLOCKS = [StructField("block", LongType()), StructField("data", BinaryType()),
           StructField("lengths", BinaryType()), StructField("ids", BinaryType())]


def blocks_of(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """Documents packed in blocks, written once in buckets of the block number."""
    spark = docs.sparkSession
    source = docs.select(F.struct(*[F.col(f"`{k}`") for k in keep]).alias("row"),
                         F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"),
                         F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    kind = StructType(_BLOCKS + [StructField("rows", ArrayType(source.schema["row"].dataType))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, texts, ids, size = [], [], [], 0

        def block():
            rows = pa.concat_arrays(held)
            number = uuid.uuid4().int >> 65
            return pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.array([b"".join(texts)], pa.binary()),
                pa.array([np.array([len(t) for t in texts], np.int64).tobytes()], pa.binary()),
                pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)], kind.names)

        for batch in batches:
            for i, (number, text) in enumerate(zip(batch.column(1).to_pylist(),
                                                   batch.column(2).to_pylist())):
                held.append(batch.column(0).slice(i, 1))
                texts.append(text)
                ids.append(number)
                size += len(text) + 64
                if size >= BLOCK:
                    yield block()
                    held, texts, ids, size = [], [], [], 0
        if held:
            yield block()
        give_back()

    name = f"mailsift_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (source.mapInArrow(run, kind).write.format("parquet").bucketBy(buckets, "block")
     .option("compression", "zstd").option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name))
    table = spark.table(name)
    table.schema  # noqa: B018  resolved now; the catalogue entry is not needed any more
    spark.sql(f"DROP TABLE {name}")
    return table


def _over_blocks(blocks: DataFrame, columns: list[str], kind: StructType, length: int, fn) -> DataFrame:
    """Rows that ``fn(block number, _Block, *columns)`` yields as lists of columns."""
    width = len(_BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, lengths, ids = (batch.column(c)[i].as_buffer() for c in range(1, width))
                more = [batch.column(width + c)[i] for c in range(len(columns))]
                block = _Block(data, lengths, ids, length)
                yield pa.RecordBatch.from_arrays(fn(batch.column(0)[i].as_py(), block, *more),
                                                 kind.names)
                del block
        give_back()

    return blocks.select(*[f.name for f in _BLOCKS], *columns).mapInArrow(run, kind)


def _binary(values) -> pa.Array:
    return pa.array(list(values), pa.binary())


def _sent_minimisers(number: int, block: _Block, groups: int) -> list[pa.Array]:
    several, kinds = block.told()
    low = block.minis.astype(np.uint32)
    parts = list(_by_number((block.minis >> np.uint64(32)) % np.uint64(groups)))
    return [pa.array([g for g, _ in parts], pa.int64()),
            pa.array([number] * len(parts), pa.int64()),
            _binary(low[p].tobytes() for _, p in parts),
            _binary(several[p].tobytes() for _, p in parts),
            _binary(kinds[p].tobytes() for _, p in parts)]


_REPLY = StructType([StructField("block", LongType()), StructField("grp", LongType()),
                     StructField("status", BinaryType()), StructField("n", LongType())])


def _counted(table: pa.Table, hot: int) -> pa.Table:
    """Per block the status of its minimisers: 0 in one document, 1 to merge, 2 hot."""
    table = table.combine_chunks()
    low = [np.frombuffer(x.as_buffer(), np.uint32) for x in table["low"]]
    several = np.frombuffer(b"".join(table["several"].to_pylist()), np.bool_)
    kinds = np.frombuffer(b"".join(table["kinds"].to_pylist()), np.uint16)
    _, back, count = np.unique(np.concatenate(low), return_inverse=True, return_counts=True)
    shared = (count > 1) | (np.bincount(back, weights=several) > 0)
    status = np.where(shared, np.where(np.bincount(back, weights=kinds) > hot, 2, 1), 0) \
        .astype(np.uint8)[back]
    cuts = np.cumsum([len(x) for x in low])[:-1]
    size = np.where(status == 1, kinds.astype(np.int64), 0)
    return pa.table([table["block"], table["grp"], _binary(c.tobytes() for c in np.split(status, cuts)),
                     pa.array([int(c.sum()) for c in np.split(size, cuts)], pa.int64())], _REPLY.names)


def _status(block: _Block, groups: int, replies) -> np.ndarray:
    out = np.zeros(len(block.minis), np.uint8)
    if replies.as_py() is not None:
        told = {r["grp"]: r["status"] for r in replies.as_py()}
        for g, places in _by_number((block.minis >> np.uint64(32)) % np.uint64(groups)):
            out[places] = np.frombuffer(told[g], np.uint8)
    return out


def _sent_fragments(number: int, block: _Block, replies, groups: int, merges: int) -> list[pa.Array]:
    e = _Entries(block, _status(block, groups, replies))
    parts = list(e.groups(merges))
    return [pa.array([g for g, _ in parts], pa.int64()),
            pa.array([number] * len(parts), pa.int64()),
            _binary(b"".join([e.texts[i] for i in p.tolist()]) for _, p in parts),
            _binary(e.size[p].astype(np.uint8).tobytes() for _, p in parts),
            _binary(e.key[p].tobytes() for _, p in parts),
            _binary(e.least[p].tobytes() for _, p in parts)]


_DECIDED = StructType([StructField("block", LongType()), StructField("grp", LongType()),
                       StructField("older", BinaryType()), StructField("masks", BinaryType())])


def _decided(table: pa.Table, length: int) -> pa.Table:
    """Per block and entry: whether an equal fragment has a smaller id, else the windows that do."""
    known: dict[bytes, int] = {}
    entry, counts, minis, least = [], [], [], []
    for row in table.to_pylist():
        sizes = np.frombuffer(row["size"], np.uint8).astype(np.int64) + length - 1
        end = np.cumsum(sizes)
        entry += [known.setdefault(row["texts"][a:b], len(known))
                  for a, b in zip((end - sizes).tolist(), end.tolist())]
        counts.append(len(sizes))
        minis.append(np.frombuffer(row["key"], np.uint64))
        least.append(np.frombuffer(row["least"], np.int64))
    entry, mini, own = np.array(entry, np.int64), np.concatenate(minis), np.concatenate(least)
    texts = list(known)
    low = np.full(len(texts), LAST, np.int64)
    np.minimum.at(low, entry, own)
    of = np.zeros(len(texts), np.uint64)
    of[entry] = mini
    _, back, count = np.unique(of, return_inverse=True, return_counts=True)
    masks = np.zeros(len(texts), np.uint64)
    several = np.flatnonzero(count[back] > 1)
    if len(several):
        masks[several] = merged_repeats([texts[i] for i in several], low[several], length)
    older, mask = own > low[entry], masks[entry]
    mask[older] = 0
    cuts = np.cumsum(counts)[:-1]
    return pa.table([table["block"], table["grp"], _binary(x.tobytes() for x in np.split(older, cuts)),
                     _binary(x.tobytes() if x.any() else b"" for x in np.split(mask, cuts))],
                    _DECIDED.names)


def _marked(block: _Block, replies, decided, groups: int, merges: int) -> np.ndarray:
    """Which bytes of the block go."""
    e = _Entries(block, _status(block, groups, replies))
    older, mask = np.zeros(len(e.texts), bool), np.zeros(len(e.texts), np.uint64)
    told = {r["grp"]: r for r in decided.as_py() or ()}
    for g, places in e.groups(merges):
        older[places] = np.frombuffer(told[g]["older"], bool)
        if told[g]["masks"]:
            mask[places] = np.frombuffer(told[g]["masks"], np.uint64)
    every = older[e.entry] | (e.owner > e.least[e.entry])
    change = np.zeros(len(block.data) + 1, np.int32)
    np.add.at(change, e.start[every], 1)
    np.add.at(change, (e.start + e.windows + block.length - 1)[every], -1)
    some = np.flatnonzero(~every & (mask[e.entry] != 0))
    bits = (mask[e.entry[some], None] >> np.arange(MOST, dtype=np.uint64)) & np.uint64(1)
    row, at = np.nonzero(bits)
    np.add.at(change, e.start[some[row]] + at, 1)
    np.add.at(change, e.start[some[row]] + at + block.length, -1)
    return np.cumsum(change[:-1]) > 0


_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])


def _cut(block: _Block, gone: np.ndarray, rows) -> list[pa.Array]:
    """Per document: its row, bytes, removed spans and the bytes that stay."""
    ends = np.cumsum(block.lengths)
    begins = ends - block.lengths
    edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
    inner = begins[(begins > 0) & (begins < len(gone))]
    cut = inner[gone[inner] & gone[inner - 1]]       # a span never runs on into the next document
    start = np.sort(np.concatenate((np.flatnonzero(edge == 1), np.unique(cut))))
    end = np.sort(np.concatenate((np.flatnonzero(edge == -1), np.unique(cut))))
    first = np.searchsorted(start, begins), np.searchsorted(start, ends)
    base = np.repeat(begins, np.maximum(first[1] - first[0], 0))
    offsets = np.concatenate(([0], np.cumsum(first[1] - first[0])))
    spans = pa.StructArray.from_arrays([pa.array(start - base, pa.int64()),
                                        pa.array(end - base, pa.int64())], ["start", "end"])
    kept = (block.data[a:b][~gone[a:b]].tobytes() for a, b in zip(begins.tolist(), ends.tolist()))
    return [rows.values, pa.array(block.lengths, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), _binary(kept)]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep: tuple[str, ...] = ("doc_id",), length: int = LENGTH,
                   hot: int = HOT) -> DataFrame:
    """``row, n_bytes, spans (start, end), kept`` per document; the texts' bytes, UTF-8."""
    if length % STEP or length < 2 * GRAM:
        raise ValueError(f"the length must be a multiple of {STEP} and at least {2 * GRAM}")
    small_batches(docs.sparkSession)
    blocks = blocks_of(docs, id_col, text_col, keep)
    size = blocks.agg(F.sum(F.length("data"))).first()[0] or 0
    groups = max(8, -(-size // (32 << 20)))
    kind = StructType([StructField("grp", LongType()), StructField("block", LongType()),
                       *[StructField(c, BinaryType()) for c in ("low", "several", "kinds")]])
    sent = _over_blocks(blocks, [], kind, length, lambda n, b: _sent_minimisers(n, b, groups))
    status = written(sent.groupBy("grp").applyInArrow(lambda t: _counted(t, hot), _REPLY), "status")
    replies = status.groupBy("block").agg(F.collect_list(F.struct("grp", "status")).alias("replies"))
    known = blocks.join(replies.hint("shuffle_hash"), "block", "left")

    n = status.agg(F.sum("n")).first()[0] or 0
    merges = max(8, -(-n * (length + 20) // GROUP))
    kind = StructType([StructField("grp", LongType()), StructField("block", LongType()),
                       *[StructField(c, BinaryType()) for c in ("texts", "size", "key", "least")]])
    frags = _over_blocks(known, ["replies"], kind, length,
                         lambda n, b, r: _sent_fragments(n, b, r, groups, merges))
    # One task a group, about: groups are of one size, but hashing deals them unevenly to few tasks.
    frags = frags.repartition(merges, "grp")
    decided = written(frags.groupBy("grp").applyInArrow(lambda t: _decided(t, length), _DECIDED),
                      "decided")
    decided = decided.groupBy("block").agg(F.collect_list(F.struct("grp", "older", "masks"))
                                           .alias("decided"))
    whole = known.join(decided.hint("shuffle_hash"), "block", "left")
    kind = StructType([StructField("row", blocks.schema["rows"].dataType.elementType),
                       StructField("n_bytes", LongType()), StructField("spans", ArrayType(_SPAN)),
                       StructField("kept", BinaryType())])
    return _over_blocks(whole, ["replies", "decided", "rows"], kind, length, lambda n, b, r, d, rows:
                        _cut(b, _marked(b, r, d, groups, merges), rows))
