"""Contiguous shards of equal byte size from global prefix sums.

Rows are laid out in ``(id, checksum)`` order over range partitions; the byte
totals of the partitions, summed in order, tell every partition where its
first byte lies in the whole, so each row knows its global byte position and
the cuts at equal targets need no task that sees more than one partition.

Only ``(id, size, checksum)`` is ever shuffled, never a text. The laid-out
rows are written once, so the partition totals and the rows they describe
come from the same table (a second range exchange would sample other bounds).

Defined results: a null text has size 1 and checksum 0; a null id sorts
first; repeated rows take neighbouring slots; an empty table gives no rows;
a text longer than a whole target fills its shard alone (its neighbours may
then be empty). Extra columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailsift.llm._store import written

ROWS_PER_SLICE = 1_000_000


def text_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, text_crc32)``: UTF-8 bytes plus one, and the unsigned checksum."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col),
                       (F.octet_length(text).cast("long") + 1).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))


def shard_by_bytes(sizes: DataFrame, shards: int = 8, id_col: str = "doc_id",
                   rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Add ``shard`` (0..shards-1) and ``slot`` (gapless from 0 in the shard).

    ``sizes`` holds ``id_col``, ``size`` and ``text_crc32``. A row belongs to the
    shard that holds its middle byte, so shards are contiguous in (id,
    checksum) order and differ from the target by less than one text.
    """
    spark = sizes.sparkSession
    tie = F.monotonically_increasing_id()  # fixed by the write; splits runs of equal rows
    keys = written(sizes.select(id_col, "size", "text_crc32", tie.alias("tie")), "sizes")
    total = keys.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    slices = max(math.ceil(total.n / rows_per_slice),
                 min(total.n, int(spark.conf.get("spark.sql.shuffle.partitions"))), 1)
    order = [F.col(id_col).asc_nulls_first(), F.col("text_crc32"), F.col("tie")]
    laid = written(keys.repartitionByRange(slices, *order)
                   .withColumn("slice", F.spark_partition_id()), "laid")

    upto = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (laid.groupBy("slice")
              .agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
              .select("slice", F.coalesce(F.sum("b").over(upto), F.lit(0)).alias("byte0"),
                      F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("row0")))
    within = Window.partitionBy("slice").orderBy(*order)
    start = F.col("byte0") + F.col("run") - F.col("size")
    middle = (2 * start + F.col("size")) * shards
    placed = (laid.withColumn("run", F.sum("size").over(
                  within.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("nth", F.row_number().over(within))
              .join(starts, "slice")
              .withColumn("shard", F.least(F.expr("int(0)") + shards - 1, F.floor(
                  middle / F.lit(max(2 * (total.bytes or 0), 1))).cast("int")))
              .withColumn("place", F.col("row0") + F.col("nth") - 1))
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first_place"))
    return (placed.join(F.broadcast(firsts), "shard")  # one row per shard
            .select(id_col, "size", "text_crc32", "shard",
                    (F.col("place") - F.col("first_place")).alias("slot")))
