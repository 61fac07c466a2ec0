"""Quality rules with thresholds learnt from quantile sketches.

Each document gets a few ratios (symbols, repeated lines, repeated word
windows, word length). Per language and source their distribution is kept as
a log-bucket quantile sketch: a table of bucket counts, so sketches of two
parts merge by adding counts, in any order and with the same result. A
threshold is a quantile plus a multiple of the distance between two quantiles of
the sketch, in place of one fixed cutoff for all: eight quartile distances
around the median for word length, and the 0.95 quantile plus four times its
distance from the upper quartile for the ratios that most documents have at
zero. A noise floor bounds the distance from below, so that a group of almost
equal documents does not reject one for a trifle; in groups of fewer than
``FEW`` documents, too small to tell quantiles, a wider one holds. The
thresholds are joined to the documents and the verdict is read off.

Defined results: a null or empty text has no words and fails; null languages
and sources form groups of their own; repeated rows get equal verdicts; an
empty table gives no rows; extra columns, whatever their names, travel inside
a struct and come out unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from mailsift.llm._store import give_back, small_batches, written

GAMMA = 1.02          # buckets a factor apart: quantiles within one per cent
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
FEW = 20              # documents below which a group's quantiles say too little
PROBS = (0.25, 0.5, 0.75, 0.95)
# Rule: (ratio, side, quantile to start from, quantile to measure the distance from, times,
# least distance, least distance in groups of fewer than FEW documents)
RULES = (("symbols", "high", 0.5, 0.75, 6.0, 0.05, 0.05),
         ("dup_lines", "high", 0.95, 0.75, 4.0, 0.25, 0.35),
         ("repeats", "high", 0.95, 0.75, 4.0, 0.2, 0.35),
         ("word_len", "high", 0.5, 0.75, 8.0, 0.4, 3.0),
         ("word_len", "low", 0.5, 0.25, 8.0, 0.4, 2.0))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def text_counts(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The counts of one whole text (see ``COUNTS``)."""
    if not text:
        return (0, 0, 0, 0, 0, 0)
    raw = text.encode()
    words = raw.split()  # bytes split at the six ASCII white spaces
    lines = [x for x in raw.split(b"\n") if x.strip()]
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    n, repeated = len(words), 0
    if n > 2:
        place: dict[bytes, int] = {}
        which = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, n)
        pairs = np.unique(which[:-1] * len(place) + which[1:], return_inverse=True)[1]
        _, window, count = np.unique(pairs[:-1] * len(place) + which[2:], return_inverse=True,
                                     return_counts=True)
        again = np.flatnonzero(count[window] > 1)
        covered = np.zeros(n, bool)
        for k in range(3):
            covered[again + k] = True
        repeated = int(covered.sum())
    return (n, chars, symbols, len(lines) - len(set(lines)), repeated, len(lines))


def _counts(text: Column) -> Column:
    kind = StructType([StructField(n, LongType()) for n in COUNTS])

    @F.arrow_udf(kind)
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            columns = zip(*[text_counts(t) for t in texts.to_pylist()]) if len(texts) else \
                [[] for _ in COUNTS]
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             list(COUNTS))
            del texts, columns
        give_back()
    return of(text)


def with_counts(docs: DataFrame, keep: tuple[str, ...], text_col: str = "text",
                groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``row`` (struct of the columns to keep), ``q_group``, ``q_counts``, ``q_base_failed``."""
    small_batches(docs.sparkSession)
    c = F.col("q_counts")
    failed = (c.n_words < 50) | (100 * c.n_repeat_words > 50 * c.n_words)
    return docs.select(F.struct(*[F.col(f"`{k}`") for k in keep]).alias("row"),
                       F.struct(*[F.col(g) for g in groups]).alias("q_group"),
                       _counts(F.col(text_col)).alias("q_counts")) \
        .withColumn("q_base_failed", failed)


def ratios() -> dict[str, Column]:
    c = F.col("q_counts")
    over = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return {"symbols": over(c.n_symbols, c.word_chars), "dup_lines": over(c.n_dup_lines, c.n_lines),
            "repeats": over(c.n_repeat_words, c.n_words), "word_len": over(c.word_chars, c.n_words)}


def sketch(counted: DataFrame) -> DataFrame:
    """Bucket counts ``(q_group, ratio, bucket, n)`` of the documents that pass the base.

    Bucket null holds zeros; bucket b holds values in (GAMMA^(b-1), GAMMA^b].
    """
    values = F.array(*[F.struct(F.lit(k).alias("ratio"), v.alias("value"))
                       for k, v in ratios().items()])
    bucket = F.when(F.col("v.value") > 0,
                    F.ceil(F.log(F.col("v.value")) / F.lit(math.log(GAMMA)))).cast("int")
    return (counted.filter(~F.col("q_base_failed")).select("q_group", F.explode(values).alias("v"))
            .groupBy("q_group", F.col("v.ratio").alias("ratio"), bucket.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def merge(*sketches: DataFrame) -> DataFrame:
    """The sketch of all parts together: counts of equal buckets added."""
    out = sketches[0]
    for other in sketches[1:]:
        out = out.unionByName(other)
    return out.groupBy(*[c for c in out.columns if c != "n"]).agg(F.sum("n").alias("n"))


def quantiles(table: DataFrame, probs: tuple[float, ...]) -> DataFrame:
    """One row per group and ratio with columns ``n, q0, q1, ...``: upper bucket ends."""
    of = Window.partitionBy("q_group", "ratio")
    order = of.orderBy(F.col("bucket").asc_nulls_first())
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(F.pow(F.lit(GAMMA), F.col("bucket")))
    run = (table.withColumn("upto", F.sum("n").over(
               order.rowsBetween(Window.unboundedPreceding, 0)))
           .withColumn("all", F.sum("n").over(of)).withColumn("value", value))
    return run.groupBy("q_group", "ratio").agg(
        F.max("all").alias("n"), *[F.min(F.when(F.col("upto") >= F.ceil(F.col("all") * p), F.col("value"))).alias(f"q{i}")
          for i, p in enumerate(probs)])


def thresholds(table: DataFrame) -> DataFrame:
    """One row per group: ``q_<ratio>_<side>`` for every rule."""
    q, picked = quantiles(table, PROBS), []
    at = {p: F.col(f"q{i}") for i, p in enumerate(PROBS)}
    for ratio, side, start, other, times, least, least_few in RULES:
        margin = F.when(F.col("n") < FEW, least_few).otherwise(least)
        reach = F.greatest(times * F.abs(at[start] - at[other]), margin)
        cut = at[start] + (reach if side == "high" else -reach)
        picked.append(F.max(F.when(F.col("ratio") == ratio, cut)).alias(f"q_{ratio}_{side}"))
    return q.groupBy("q_group").agg(*picked)


def judge(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """Join the limits of each row's group and add ``q_kept``.

    The limits hold one row per language and source; the planner broadcasts
    them from their written size, and joins on the keys beyond the bound.
    """
    right = limits.withColumnRenamed("q_group", "q_of")
    same = F.lit(True)
    for field in limits.schema["q_group"].dataType.names:
        same = same & F.col(f"q_group.{field}").eqNullSafe(F.col(f"q_of.{field}"))
    broken, value = F.lit(False), ratios()
    for ratio, side, *_ in RULES:
        cut = F.col(f"q_{ratio}_{side}")
        over = value[ratio] > cut if side == "high" else value[ratio] < cut
        broken = broken | F.coalesce(over, F.lit(False))
    return (counted.join(right, same, "left")
            .withColumn("q_kept", ~F.col("q_base_failed") & ~broken).drop(*right.columns))


def quality_verdicts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                     groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """``row, q_group, q_counts, q_base_failed, q_kept`` per row; texts are read once."""
    counted = written(with_counts(docs, keep, text_col, groups), "counts")
    return judge(counted, written(thresholds(sketch(counted)), "limits"))


def keep_quality(docs: DataFrame, text_col: str = "text",
                 groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """The documents whose verdict is to keep, columns unchanged.

    The texts are read twice, in two narrow passes, and shuffled in neither.
    """
    limits = written(thresholds(sketch(with_counts(docs, groups, text_col, groups))), "limits")
    return judge(with_counts(docs, tuple(docs.columns), text_col, groups), limits) \
        .filter("q_kept").select("row.*")
