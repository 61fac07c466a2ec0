"""Vector code compression: exact codebook search by slices and bitmasks.

Vectors become integers (256ths, rounded down) and are cut into equal parts; a
part is coded by the nearest entry of its position's codebook. A codebook of
at most 64 entries is indexed by dimension: the entries' coordinates are
sorted, and position j of the sorted list carries a 64-bit mask of the entries
before it. Two lookups in one dimension give, as the difference of two prefix
masks, the entries within a radius there; the masks of all dimensions ANDed
are the candidates, and only those are measured. If the best one is no farther
than the radius it is the nearest entry; else the search is repeated with the
distance found (or a doubled radius where nothing was found). Ties go to the
lower index: entries at equal distance are candidates together.

Spark keeps the integer vectors in a written table, each round adds up counts
and sums per entry inside the tasks, and at most 64 rows a part position come
to the driver, whatever the number of vectors.

Defined results: vectors that are null or hold null, NaN or infinite
components take no part, nor do those whose length is not the most common one
among the lengths that can be cut into equal parts (the larger of equally
common ones); null ids come after all others; rows of one id are told apart by
their vectors; repeated rows get equal codes; integers beyond +-2**24 (components
beyond 65,536) count as that bound, so that no sum of squares overflows; fewer rows than entries give
smaller codebooks; an empty table gives no rows; other columns travel in a struct.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mailsift.llm._store import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BOUND = 1 << 24


def integers(vec: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component as an integer within the bound."""
    return F.transform(vec, lambda x: F.greatest(F.lit(-BOUND), F.least(
        F.lit(BOUND), F.floor(x.cast("double") * scale))).cast("int"))


def usable(vec: Column) -> Column:
    """Neither null nor holding null or non-finite components."""
    odd = F.exists(vec, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (F.abs(x.cast("double")) == float("inf")))
    return vec.isNotNull() & ~odd


def index(book: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per dimension the sorted coordinates and the masks of the entries before each place."""
    out = []
    for column in book.T:
        order = np.argsort(column, kind="stable")
        bits = np.uint64(1) << order.astype(np.uint64)
        out.append((column[order], np.concatenate(([np.uint64(0)],
                                                   np.bitwise_or.accumulate(bits)))))
    return out


def first_radius(book: np.ndarray) -> int:
    """The median distance from an entry to its nearest other value, at least 1."""
    gaps = ((book[:, None, :] - book[None, :, :]) ** 2).sum(2)
    near = [int(row[row > 0].min()) for row in gaps if (row > 0).any()]
    return max(1, int(np.sqrt(np.median(near)))) if near else 1


def nearest(points: np.ndarray, book: np.ndarray, slices=None,
            radius: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and its squared distance, for each point."""
    slices = index(book) if slices is None else slices
    n = len(points)
    code, error = np.zeros(n, np.int64), np.zeros(n, np.int64)
    reach = np.full(n, radius or first_radius(book), np.int64)
    todo = np.arange(n)
    while len(todo):
        at, r = points[todo], reach[todo]
        mask = np.full(len(todo), ~np.uint64(0))
        for d, (places, before) in enumerate(slices):
            low = np.searchsorted(places, at[:, d] - r, "left")
            high = np.searchsorted(places, at[:, d] + r, "right")
            mask &= before[high] ^ before[low]
        best, which = np.full(len(todo), np.iinfo(np.int64).max), np.zeros(len(todo), np.int64)
        some = np.flatnonzero(mask)
        while len(some):  # the lowest candidate of every point, then the next
            left = mask[some]
            entry = np.log2((left & (~left + np.uint64(1))).astype(np.float64)).astype(np.int64)
            far = ((at[some] - book[entry]) ** 2).sum(1)
            closer = far < best[some]
            best[some[closer]], which[some[closer]] = far[closer], entry[closer]
            mask[some] = left & (left - np.uint64(1))
            some = some[mask[some] != 0]
        done = best <= r * r
        code[todo[done]], error[todo[done]] = which[done], best[done]
        found = best < np.iinfo(np.int64).max
        # Found but outside the ball: its distance is a radius that must do.
        reach[todo] = np.where(found, np.ceil(np.sqrt(best.astype(np.float64))).astype(np.int64) + 1,
                               2 * r)
        todo = todo[~done]
    return code, error


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _spread(books: np.ndarray) -> list[tuple]:
    return [(book, index(book), first_radius(book)) for book in books]


def _round(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; the tasks send counts and sums, never vectors."""
    parts, entries, width = books.shape
    kind = StructType([StructField(n, LongType()) for n in
                       ("part", "entry", "n", *[f"s{i}" for i in range(width)])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        tables = _spread(books)
        for batch in batches:
            rows = _matrix(batch.column(0), parts * width)
            for p, (book, slices, radius) in enumerate(tables):
                points = rows[:, p * width:(p + 1) * width]
                code, _ = nearest(points, book, slices, radius)
                count[p] += np.bincount(code, minlength=entries)
                np.add.at(total[p], code, points)
        part, entry = np.nonzero(count)
        columns = [part, entry, count[part, entry], *total[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], kind.names)

    sums = (vectors.select("ints").mapInArrow(run, kind).groupBy("part", "entry")
            .agg(*[F.sum(c).alias(c) for c in kind.names[2:]]))
    out = books.copy()
    for part, entry, n, *total in sums.collect():  # at most parts x entries rows
        out[part, entry] = [t // n for t in total]
    return out


def common_length(rows: DataFrame, vec_col: str, parts: int = PARTS) -> int:
    """The most common length that can be cut into ``parts``; 0 if there is none."""
    size = F.size(vec_col)
    top = (rows.filter((size > 0) & (size % parts == 0)).groupBy(size.alias("size")).count()
           .orderBy(F.desc("count"), F.desc("size")).limit(1).collect())
    return top[0]["size"] if top else 0


def compress(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
             keep: tuple[str, ...] = ("vec_id", "label"), parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``row, code, error`` per kept vector, and the codebooks (part, entry, position)."""
    if not 0 < entries <= 64:
        raise ValueError("a mask has 64 bits: 1 to 64 entries")
    good = rows.filter(usable(F.col(vec_col)))
    dims = common_length(good, vec_col, parts)
    if dims > 4096:
        raise ValueError("vectors of more than 4,096 dimensions are not supported")
    vectors = written(good.filter(F.size(vec_col) == max(dims, 1)).select(
        F.struct(*[F.col(f"`{k}`") for k in keep]).alias("row"), F.col(id_col).alias("id"),
        integers(F.col(vec_col)).alias("ints")), "vectors")
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "ints").select("ints") \
        .limit(entries).collect()
    width = dims // parts
    books = np.array([r["ints"] for r in first], np.int64).reshape(len(first), parts, width) \
        .transpose(1, 0, 2)
    for _ in range(rounds if len(first) else 0):
        books = _round(vectors, books)
    kind = StructType([vectors.schema["row"], StructField("code", StringType()),
                       StructField("error", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _spread(books)
        for batch in batches:
            values = _matrix(batch.column(1), dims)
            codes, errors = np.zeros((len(values), parts), np.uint8), np.zeros(len(values), np.int64)
            for p, (book, slices, radius) in enumerate(tables):
                code, error = nearest(values[:, p * width:(p + 1) * width], book, slices, radius)
                codes[:, p] = code
                errors += error
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([c.tobytes().hex() for c in codes], pa.string()),
                 pa.array(errors, pa.int64())], kind.names)

    return vectors.select("row", "ints").mapInArrow(run, kind), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry, position, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def error_by_label(coded: DataFrame, label: str = "row.label") -> DataFrame:
    """``coded`` with ``label_error``: the errors of equal labels added up, nulls together.

    Sums are made before the shuffle; one row per label meets the rows again.
    """
    sums = coded.groupBy(F.col(label).alias("of_label")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(sums, F.col(label).eqNullSafe(F.col("of_label")), "left").drop("of_label")
