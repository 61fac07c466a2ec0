"""Mixing sources to target weights by systematic sampling (DataFrame only).

Every document of a source has the same expected number of copies, the
source's target over its size. The expected copies are prefix-summed along
the source's documents in size order, one random offset is added per source,
and a document is emitted once per integer boundary that its interval
crosses. Size order makes neighbours alike, so a source's taken words miss
its target by little more than one long document.

The running position is built from counts: documents are numbered inside
``(source, size bucket, slice)`` groups, and the counts of those groups, summed
in order, give each group its first position. A source that holds a third of
all rows is thus spread over many groups.

Defined results: a null text has size 0; a null source is a source, ordered
last; a null id hashes as the empty text; sources without words have target 0
and no copies; an empty table gives no rows. Equal rows are numbered one
after the other, so which of them gets an extra copy cannot be told apart. Extra
columns, whatever their names, travel inside a struct and come out unchanged.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailsift.llm._store import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5      # size of the mix over the size of the input
MOST = 2.0       # no source and no document is taken more often than this
ROWS_PER_SLICE = 100_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(col: Column, salt: str) -> Column:
    """First 32 bits of the MD5 of ``salt`` and the value, as a long."""
    text = F.concat(F.lit(salt), F.coalesce(col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


def source_targets(docs: DataFrame, source_col: str = "source", size_col: str = "mix_size",
                   weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MOST) -> DataFrame:
    """One row per source: ``mix_source, mix_docs, source_size, target, mix_offset``.

    Weights repeat over the sources by code point, null last. A target is
    weight times the water level, at most ``most`` times the source's size;
    the level that spends the whole share is the largest of (share left after
    the smaller caps) / (weights not capped), walking the sources by cap per
    weight. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("mix_source").asc_nulls_last())
    nth = F.element_at(F.array(*[F.lit(w) for w in weights]),
                       ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = (docs.groupBy(F.col(source_col).alias("mix_source"))
           .agg(F.count(F.lit(1)).alias("mix_docs"), F.sum(size_col).alias("source_size"))
           .withColumn("weight", nth)
           .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("mix_source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    left = (F.sum("source_size").over(everything) * F.lit(float(share))
            - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    free = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    return (per.withColumn("level", left / free)
            .withColumn("level", F.max("level").over(everything))
            .select("mix_source", "mix_docs", "source_size",
                    F.least("cap", F.col("weight") * F.col("level")).alias("target"),
                    (unit_hash(F.col("mix_source"), "mix-offset:") / F.lit(float(2 ** 32)))
                    .alias("mix_offset")))


def plan_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", keep: tuple[str, ...] | None = None,
                rows_per_slice: int = ROWS_PER_SLICE, **mix) -> DataFrame:
    """``row`` (struct of the columns to keep, all by default) and ``mix_size, source_size,
    target, copies`` for each input row; copies are 0, 1 or 2 by default."""
    carried = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
    facts = [F.col(source_col).alias("mix_of"), F.col(id_col).alias("mix_id"),
             word_count(F.col(text_col)).alias("mix_size"),
             unit_hash(F.col(text_col), "").alias("mix_text")]
    # Targets and counts come from a narrow table; texts are read again only to be carried.
    slim = written(docs.select(*([carried] if keep else []), *facts), "mix")
    sized = slim if keep else docs.select(carried, *facts)
    source_col, id_col = "mix_of", "mix_id"
    targets = written(source_targets(slim, source_col, **mix), "targets")
    rows = targets.agg(F.sum("mix_docs").alias("n")).first().n or 0
    slices = max(1, math.ceil(rows / rows_per_slice))
    grouped = lambda df: (
        df.withColumn("mix_hash", unit_hash(F.col(id_col), "mix:"))
        .withColumn("mix_bucket", F.floor(F.log2(F.col("mix_size") + 1) * 16))
        .withColumn("mix_slice", (F.col("mix_hash") + F.col("mix_text")) % slices))
    keyed = grouped(sized)
    group = [F.col(source_col), F.col("mix_bucket"), F.col("mix_slice")]
    counts = grouped(slim).groupBy(F.col(source_col).alias("mix_source"), "mix_bucket", "mix_slice") \
        .agg(F.count(F.lit(1)).alias("n"))
    # First positions in two steps, so that no window holds all groups of a source.
    in_bucket = Window.partitionBy("mix_source", "mix_bucket").orderBy("mix_slice")
    counts = counts.withColumn("head", F.coalesce(F.sum("n").over(
        in_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    of_source = Window.partitionBy("mix_source").orderBy("mix_bucket")
    buckets = (counts.groupBy("mix_source", "mix_bucket").agg(F.sum("n").alias("n"))
               .select("mix_source", "mix_bucket", F.coalesce(F.sum("n").over(
                   of_source.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base")))
    heads = (counts.alias("c").join(buckets.alias("b"),
                                    F.col("c.mix_source").eqNullSafe(F.col("b.mix_source"))
                                    & (F.col("c.mix_bucket") == F.col("b.mix_bucket")))
             .join(targets.alias("t"), F.col("c.mix_source").eqNullSafe(F.col("t.mix_source")))
             .select(F.col("c.mix_source").alias("h_source"), F.col("c.mix_bucket").alias("h_bucket"),
                     F.col("c.mix_slice").alias("h_slice"),
                     (F.col("base") + F.col("head")).alias("h_first"),
                     "source_size", "target", "mix_offset"))
    heads = written(heads, "heads")
    inside = Window.partitionBy(*group).orderBy("mix_size", "mix_hash",
                                                F.col(id_col).asc_nulls_first(), "mix_text")
    placed = keyed.withColumn("mix_nth", F.row_number().over(inside)).join(
        heads, F.col(source_col).eqNullSafe(F.col("h_source"))
        & (F.col("mix_bucket") == F.col("h_bucket")) & (F.col("mix_slice") == F.col("h_slice")))
    end = F.col("h_first") + F.col("mix_nth")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    crossed = (F.floor(end * rate + F.col("mix_offset"))
               - F.floor((end - 1) * rate + F.col("mix_offset")))
    most = math.ceil(mix.get("most", MOST))
    return placed.select("row", "mix_size", "source_size", "target",
                         F.least(crossed, F.lit(most)).cast("int").alias("copies"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each input row as often as it is taken, columns unchanged."""
    return (plan_copies(docs, **options).filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            .select("row.*"))
