"""Message sources (S1) and the latest-N limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType

_BOUNDS = (IntegralType, StringType, DateType)  # key types that a scan can be bounded by

RAW_SCHEMA = "uid LONG, raw BINARY"


def read_messages(spark: SparkSession, path: str, fmt: str = "auto") -> DataFrame:
    """A table of raw messages ``(uid LONG, raw BINARY, path STRING)``.

    * ``fmt="eml"``: one RFC 822 file per message, read with the
      ``binaryFile`` source (one row per file, content read lazily, only for
      selected rows). The mailbox order ``uid`` is the number in the file
      name (``123.eml``); files without a number get null and sort first.
    * ``fmt="parquet"``: a landed message table that already has
      ``uid`` and ``raw`` columns.
    """
    if fmt == "auto":
        fmt = "parquet" if path.rstrip("/").endswith(".parquet") else "eml"
    if fmt == "parquet":
        return spark.read.parquet(path)
    df = (spark.read.format("binaryFile")
          .option("pathGlobFilter", "*.eml")
          .option("recursiveFileLookup", "true")
          .load(path))
    uid = F.regexp_extract(F.col("path"), r"(\d+)\.eml$", 1)
    return df.select(
        F.when(uid == "", F.lit(None)).otherwise(uid).cast("long").alias("uid"),
        F.col("content").alias("raw"),
        F.col("path"),
    )


def latest_n(df: DataFrame, n: int, order_col: str = "uid",
             by: Sequence[str] | str | None = None) -> DataFrame:
    """The last ``n`` messages in mailbox order (largest ``order_col``).

    ``n == 0`` means *all* messages (the source's ``uids[-0:]``); negative
    ``n`` is rejected. ``order_col`` identifies a message within a mailbox.

    * without ``by``: two steps. The ``n``-th newest key is found on the key column
      alone (a Parquet scan then reads just that; each task keeps its own ``n``
      keys, and one number comes to the driver, when this is called); the rows are
      then read with that key as a literal bound, which reaches the scan, so
      files and row groups of older messages are skipped. Keys of a type without
      such literals (times, doubles) are joined with the ``n`` keys instead;
    * with ``by`` (one mailbox per group): ``row_number() <= n`` over the rows
      plans as ``WindowGroupLimit`` partial + final, so every task ships at
      most ``n`` rows per mailbox, however large the mailbox.
    """
    if n < 0:
        raise ValueError(f"latest_n: n must be >= 0, got {n}")
    if n == 0:
        return df
    by = [by] if isinstance(by, str) else list(by or [])
    newest = F.col(order_col).desc_nulls_last()
    if by:
        w = Window.partitionBy(*by).orderBy(newest)
        return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")
    top = df.select(F.col(order_col).alias("__top")).orderBy(F.col("__top").desc_nulls_last()) \
        .limit(n)
    if isinstance(df.schema[order_col].dataType, _BOUNDS) and not df.isStreaming:
        # Fewer than n keys, or a null among the newest n: nothing is older than the n-th.
        found = top.agg(F.min("__top").alias("bound"), F.count("__top").alias("n")).first()
        return df.filter(F.col(order_col) >= F.lit(found["bound"])) if found["n"] == n else df
    return df.join(top, F.col(order_col).eqNullSafe(F.col("__top")), "left_semi")
