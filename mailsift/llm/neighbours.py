"""Approximate nearest neighbours: probed lists, scanned by dimension with early abandons.

Vectors are put into lists by their nearest centre and turned by one random
rotation, which spreads every difference evenly over the dimensions. A query
visits its nearest lists. In a list the candidates are scanned in blocks of
columns; after ``d`` of ``D`` dimensions the partial squared distance, scaled by
``D / d``, estimates the whole one, and a candidate is abandoned when the
hypothesis that it lies within the query's bound is rejected:
``partial * D / d > (1 + EPSILON / sqrt(d))**2 * bound``. What is left is measured
exactly on the original vectors, in double precision.

The bound starts as the distance to the tenth nearest row of a sample and
falls as better candidates are found. Centres, rotation, start bounds and the
number of lists to visit (the least that finds ``RECALL`` of the sample's own
neighbours) come from one sample of at most ``SAMPLE`` rows and an eighth of the
table; every row is listed, and the answers come from the scan of the lists.

A list is cut into parts of about ``PART`` rows, its queries into parts of about
``PART_QUERIES``, and each pair of parts is one group, so a crowded list (equal
vectors, say) is worked by many tasks and no group grows with the data.

Defined results: a vector that is null, zero, holds null or non-finite parts,
or has not the most common length takes no part, nor does a row without id;
of several rows with a query's id the smallest vector asks, and none of them
is its candidate; rows with equal ids are one candidate, at the nearest of
them; equal distances are ordered by id; with fewer than ``k`` other rows all
are returned (a query that is left with fewer rows than it must have gets the
sample's own nearest too); an empty table gives no rows. Extra
columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsift.llm._store import written

K = 10
SAMPLE, SAMPLED_OF = 20_000, 8   # rows of the sample: at most so many, at most an eighth of all
LIST_ROWS, MOST_LISTS = 1_000, 4_096
PART, PART_QUERIES = 20_000, 20_000   # alike: both sides are then repeated least
COLUMNS = 16          # dimensions in a column block
EPSILON = 2.1         # width of the test: larger abandons later and errs less
RECALL = 0.985        # share of the sample's neighbours that the visited lists must hold
ROUNDS = 8
SEED = 11


def usable(vector: Column, size: int) -> Column:
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) == size) & whole \
        & F.exists(vector, lambda x: x != 0)


class Model:
    """Rotation, centres and the sample, all of bounded size."""

    def __init__(self, sample_ids: np.ndarray, sample: np.ndarray, rows: int, k: int):
        rng = np.random.default_rng(SEED)
        size = sample.shape[1]
        # Lengths beyond the square root of the largest double would overflow; measure scaled.
        self.scale = float(max(np.abs(sample).max(), 1e-300)) if len(sample) else 1.0
        self.rotation = np.linalg.qr(rng.standard_normal((size, size)))[0]
        self.ids, self.plain, self.sample = sample_ids, sample, self.turned(sample)
        lists = int(min(max(1, rows // LIST_ROWS), MOST_LISTS, len(sample)))
        self.centres = self.sample[rng.permutation(len(sample))[:lists]]
        for _ in range(ROUNDS):
            own = self.nearest(self.sample)
            count = np.bincount(own, minlength=lists)
            total = np.zeros_like(self.centres)
            np.add.at(total, own, self.sample)
            full = count > 0
            self.centres[full] = total[full] / count[full, None]
        self.probes, self.k = lists, k
        if lists > 1:
            ask = rng.permutation(len(sample))[:200]
            own = self.nearest(self.sample)
            ranks = np.argsort(np.argsort(self.far(self.sample[ask], self.centres), axis=1), axis=1)
            d = self.far(self.sample[ask], self.sample)
            d[np.arange(len(ask)), ask] = np.inf
            near = np.argpartition(d, min(k, len(sample) - 1), axis=1)[:, :k]
            found = np.sort(np.take_along_axis(ranks, own[near], axis=1).ravel())
            self.probes = int(found[min(len(found) - 1, math.ceil(RECALL * len(found)) - 1)]) + 1

    @classmethod
    def of(cls, state: dict) -> Model:
        """The model from its plain arrays and numbers (what is broadcast)."""
        model = object.__new__(cls)
        model.__dict__.update(state)
        return model

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        return np.clip(vectors / self.scale, -1e150, 1e150) @ self.rotation

    @staticmethod
    def far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)

    def nearest(self, turned: np.ndarray) -> np.ndarray:
        out = [self.far(turned[i:i + 2048], self.centres).argmin(1)
               for i in range(0, len(turned), 2048)]
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def start(self, ids: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """For each query: a squared distance within which ``k`` other ids surely lie, and the
        places of the sample's nearest rows."""
        bounds, near = np.full(len(ids), np.inf), []
        for i in range(0, len(ids), 256):
            d = self.far(turned[i:i + 256], self.sample)
            d[ids[i:i + 256, None] == self.ids[None, :]] = np.inf
            for j, row in enumerate(d, i):
                most = min(len(row), 2 * self.k)
                some = np.argpartition(row, most - 1)[:most]
                some = some[np.argsort(row[some], kind="stable")]
                some = some[np.isfinite(row[some])]
                some = some[np.sort(np.unique(self.ids[some], return_index=True)[1])][:self.k]
                near.append(some)
                if len(some) == self.k:
                    bounds[j] = row[some[-1]]
        return bounds * (1 + 1e-6) + 1e-12, near


def _distance(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Euclidean distances; lengths whose square a double cannot hold are scaled."""
    diff = rows - one
    big = np.abs(diff).max(axis=1, initial=0.0)
    unit = np.where((big > 1e140) | ((big < 1e-140) & (big > 0)), big, 1.0)
    return np.sqrt(((diff / unit[:, None]) ** 2).sum(1)) * unit


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest ids, each at its nearest row, ties to the smaller id."""
    order = np.lexsort((ids, scores))
    order = order[np.sort(np.unique(ids[order], return_index=True)[1])][:k]
    return ids[order], scores[order]


def scan(query: np.ndarray, bound: float, columns: list[np.ndarray]) -> np.ndarray:
    """Places of the candidates that no test abandons; ``columns`` are the turned blocks."""
    size, done = len(query), 0
    alive = np.arange(len(columns[0]))
    partial = np.zeros(len(alive))
    for block in columns:
        diff = block[alive] - query[done:done + block.shape[1]]
        partial = partial + np.einsum("ij,ij->i", diff, diff)
        done += block.shape[1]
        limit = bound * (1 + (EPSILON / math.sqrt(done) if done < size else 0.0)) ** 2
        keep = partial * (size / done) <= limit
        alive, partial = alive[keep], partial[keep]
    return alive


def _matrix(cells, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), np.float64).reshape(-1, size)


def nearest_rows(table: DataFrame, asks: Column, id_col: str = "vec_id",
                 vector_col: str = "embedding", k: int = K, sample: int = SAMPLE) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` of the rows for which ``asks`` holds; score is the distance."""
    spark = table.sparkSession
    given = table.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(asks, F.lit(False)).alias("asks"))
    common = given.filter("v is not null").groupBy(F.size("v").alias("size")).count() \
        .orderBy(F.desc("count"), "size").first()
    size = common["size"] if common else 0
    clean = given.filter(usable(F.col("v"), size))
    rows = clean.count()
    out = "query_id long, vec_id long, score double"
    if not rows:
        return spark.createDataFrame([], out).withColumn("rank", F.lit(0)) \
            .select("query_id", "rank", "vec_id", "score")
    # The limit is the documented bound of the sample that the index is fitted on.
    taken = clean.select("id", "v").orderBy(F.xxhash64("id"), "id") \
        .limit(max(min(sample, rows // SAMPLED_OF), 1)).toArrow()
    model = Model(taken.column(0).to_numpy(),
                  np.array(taken.column(1).to_pylist(), np.float64).reshape(-1, size), rows, k)
    # Plain arrays, so that executors need no copy of this package; at most SAMPLE + MOST_LISTS vectors.
    shared = spark.sparkContext.broadcast(dict(model.__dict__))

    def vectors(column) -> np.ndarray:
        return column.flatten().to_numpy().reshape(-1, size)

    def listed(batches):
        for batch in batches:
            m, plain = Model.of(shared.value), vectors(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(m.nearest(m.turned(plain)).astype(np.int32)),
                 pa.array([x.tobytes() for x in plain], pa.binary())], names=["id", "list", "plain"])

    def visits(batches):
        for batch in batches:
            m, plain = Model.of(shared.value), vectors(batch.column(1))
            turned = m.turned(plain)
            bounds, near = m.start(batch.column(0).to_numpy(), turned)
            scores = [_distance(m.plain[n], p) for n, p in zip(near, plain)]
            lists = [x for i in range(0, len(turned), 512) for x in np.argsort(
                m.far(turned[i:i + 512], m.centres), axis=1)[:, :m.probes].astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(bounds), pa.array([x.tobytes() for x in plain], pa.binary()),
                 pa.array(lists, pa.list_(pa.int32())),
                 pa.array([m.ids[n] for n in near], pa.list_(pa.int64())),
                 pa.array(scores, pa.list_(pa.float64()))],
                names=["id", "bound", "plain", "lists", "near", "scores"])

    lists = written(clean.select("id", "v").mapInArrow(listed, "id long, list int, plain binary"),
                    "lists")
    asked = clean.filter("asks").groupBy("id").agg(F.min("v").alias("v"))
    # One row a query: its vector meets each of its lists in the shuffle alone.
    queries = written(asked.mapInArrow(
        visits, "id long, bound double, plain binary, lists array<int>, near array<long>, "
                "scores array<double>"), "queries")
    sizes = lists.groupBy("list").count().collect()      # one row per list: MOST_LISTS at most
    visitors = {r["list"]: r["count"] for r in queries.select(F.explode("lists").alias("list"))
                .groupBy("list").count().collect()}
    parts = spark.createDataFrame(
        [(r["list"], -(-r["count"] // PART), -(-visitors[r["list"]] // PART_QUERIES))
         for r in sizes if r["list"] in visitors], "list int, parts int, query_parts int")
    parts = F.broadcast(parts)
    left = lists.join(parts, "list").select(
        "list", F.pmod(F.xxhash64("id", "plain"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("query_part"), "id", "plain")
    right = queries.select("id", "bound", "plain", F.explode("lists").alias("list")) \
        .join(parts, "list").select(
            "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            F.pmod(F.xxhash64("id", F.lit(1)), "query_parts").cast("int").alias("query_part"),
            "id", "bound", "plain")

    def search(candidates: pa.Table, askers: pa.Table) -> pa.Table:
        ids = candidates.column("id").to_numpy()
        found = []
        if len(ids) and askers.num_rows:
            m = Model.of(shared.value)
            plain, questions = (_matrix(t.column("plain"), size) for t in (candidates, askers))
            turned = m.turned(plain)
            columns = [np.ascontiguousarray(turned[:, i:i + COLUMNS])
                       for i in range(0, size, COLUMNS)]
            for asker, bound, q, p in zip(askers.column("id").to_pylist(),
                                          askers.column("bound").to_pylist(),
                                          m.turned(questions), questions):
                best_ids, best = np.zeros(0, np.int64), np.zeros(0)
                for i in range(0, len(ids), 2048):
                    left = i + scan(q, bound, [c[i:i + 2048] for c in columns])
                    left = left[ids[left] != asker]
                    score = _distance(plain[left], p)
                    best_ids, best = _best(np.append(best_ids, ids[left]), np.append(best, score), k)
                    if len(best) == k:
                        bound = min(bound, (best[-1] / m.scale) ** 2 * (1 + 1e-6) + 1e-12)
                found += zip([asker] * len(best), best_ids.tolist(), best.tolist())
        columns_out = list(zip(*found)) or [[], [], []]
        return pa.table([pa.array(columns_out[0], pa.int64()), pa.array(columns_out[1], pa.int64()),
                         pa.array(columns_out[2], pa.float64())],
                        names=["query_id", "vec_id", "score"])

    keys = ["list", "part", "query_part"]
    near = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, out)
    known = queries.select(
        F.col("id").alias("query_id"), F.explode(F.arrays_zip("near", "scores")).alias("z")) \
        .select("query_id", F.col("z.near").alias("vec_id"), F.col("z.scores").alias("score"))
    # The sample's rows answer only for queries to which the scan leaves too few.
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    scanned = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    served = scanned.groupBy("query_id").count().filter(F.col("count") >= k).select("query_id")
    known = known.join(served, "query_id", "left_anti")
    each = scanned.unionByName(known).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
