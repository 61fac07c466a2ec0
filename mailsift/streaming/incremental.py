"""Incremental digest (T1) with Structured Streaming.

New messages land in a folder; each micro-batch

1. writes the items of its messages that pass the filters under
   ``items/report=<key>/batch=<id>``: a replayed batch overwrites its own folders,
   so retries never duplicate;
2. with a latest-N limit, brings the state up to date: the keys of the N newest
   messages of each mailbox, made from the state before it and its own keys
   alone, under ``newest/batch=<id>``;
3. recomputes the order-sensitive stages (ordered dedupe, tail drop, keyword
   filter, numbering) of the reports it touched, from those reports' item folders
   alone, replaces their folders of ``<out>/digest`` and removes the folders of
   those that came out empty.

A report is touched by a message of its own, or by one of its messages that a
newer message pushed out of the N newest. So a batch reads its own messages, N
keys a mailbox and the items of the reports it touches; what landed before for
other reports is neither read nor listed.

Order lives in the data (uid, pos), so the result equals the batch pipeline on
the same messages whatever the arrival order. Progress and outputs live under
a shared folder (the session's ``spark.checkpoint.dir`` by default), so a
restarted driver or a lost executor resumes from the last committed batch.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mailsift.plans.digest import (
    DigestParams, digest_columns, item_stages, match_messages, message_bodies, message_items,
)
from mailsift.session import checkpoint_dir, written
from mailsift.sinks import existing_folders, overwrite_partitions, report_key, write_reports
from mailsift.sinks.writers import delete_folder, sub_folders
from mailsift.sources.messages import latest_n


TABLE_BATCHES = 4  # in which a table that is read as a stream arrives, if it has the files


def _same(columns: list[str]):
    """Null-safe equality of ``columns`` with their ``__of_`` copies."""
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__of_{c}"))
    return same


def _keys(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"__of_{c}") for c in columns]).distinct()


def _land_items(items: DataFrame, path: str, by: list[str], batch_id: int) -> None:
    # Rebalanced by report: few files a folder, and a hot report is still written by many tasks.
    rows = items.withColumn("report", report_key(by)).withColumn("batch", F.lit(batch_id).cast("long"))
    overwrite_partitions(rows.hint("rebalance", "report")).partitionBy("report", "batch").parquet(path)


def _landed(spark: SparkSession, path: str, schema: StructType, touched: DataFrame,
            by: list[str]) -> DataFrame:
    """The landed items of the touched reports; no other folder is opened."""
    folders = existing_folders(spark, path, touched, by)
    if not folders:
        return spark.createDataFrame([], schema)
    full = StructType([*schema.fields, StructField("report", StringType()),
                       StructField("batch", LongType())])
    return spark.read.schema(full).option("basePath", path).parquet(*folders).drop("report", "batch")


def _newest(seen: DataFrame, path: str, batch_id: int, p: DigestParams) -> tuple[DataFrame, DataFrame]:
    """``(newest, gone)``: the N newest keys of each mailbox after the batch, and those it pushed out."""
    spark, message = seen.sparkSession, p.message_keys
    earlier = sorted(int(n.removeprefix("batch=")) for n in sub_folders(spark, path)
                     if n.startswith("batch=") and int(n.removeprefix("batch=")) < batch_id)
    before = spark.read.schema(seen.schema).parquet(os.path.join(path, f"batch={earlier[-1]}")) \
        if earlier else spark.createDataFrame([], seen.schema)
    keys = written(before.unionByName(seen).distinct(), "keys")
    own = os.path.join(path, f"batch={batch_id}")
    latest_n(keys, p.recent, "uid", by=list(p.mailbox_by) or None).write.mode("overwrite").parquet(own)
    for old in earlier[:-1]:  # no batch that may be replayed needs them
        delete_folder(spark, os.path.join(path, f"batch={old}"))
    newest = spark.read.schema(seen.schema).parquet(own)
    return newest, before.join(_keys(newest, message), _same(message), "left_anti")


def start_incremental_digest(stream: DataFrame, out_dir: str, p: DigestParams,
                             available_now: bool = True):
    """Start T1 over a streaming DataFrame of messages; returns the ``StreamingQuery``.

    ``stream`` needs ``uid``, the report and mailbox columns and ``html`` or ``raw``
    RFC 822 bytes (e.g. a ``binaryFile`` stream of ``.eml`` files). Equal uids of
    one mailbox are one message.
    """
    items_path, newest_path, digest_path = (os.path.join(out_dir, k)
                                            for k in ("items", "newest", "digest"))
    by, message = list(p.report_by), p.message_keys

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        items = message_items(message_bodies(match_messages(batch, p), p), p)
        _land_items(items, items_path, by, batch_id)
        seen = written(batch.select(*message).distinct(), "seen")
        touched = seen.select(*by)
        if p.recent:
            newest, gone = _newest(seen, newest_path, batch_id, p)
            touched = touched.unionByName(gone.select(*by))
        touched = written(touched.distinct(), "touched")
        live = _landed(spark, items_path, items.schema, touched, by)
        if p.recent:
            live = live.join(_keys(newest, message), _same(message), "left_semi")
        out = written(item_stages(live, p)["numbered"].select(*digest_columns(p)), "digest")
        write_reports(out, digest_path, by, touched)

    def run_batch_if_any(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            run_batch(batch, batch_id)

    writer = (stream.writeStream.foreachBatch(run_batch_if_any)
              .option("checkpointLocation", os.path.join(out_dir, "_progress")))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def incremental_digest_from_table(spark: SparkSession, sf_dir: str, p: DigestParams,
                                  out_dir: str | None = None) -> DataFrame:
    """Run T1 to completion over the ``pages`` table as a file stream; read the digest back.

    The table is one file or a folder of files, which arrive in at most
    ``TABLE_BATCHES`` batches: each batch recomputes the reports it touches whole, so
    a batch a file would take time in the square of the files.
    """
    from mailsift.plans.standins import page_messages

    pages = spark.read.parquet(os.path.join(sf_dir, "pages.parquet"))
    at_once = max(1, -(-len(pages.inputFiles()) // TABLE_BATCHES))
    # A pattern, as a file stream takes the path of a single file in no other form.
    stream = (spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", at_once)
              .parquet(os.path.join(sf_dir, "[p]ages.parquet")))
    out_dir = out_dir or os.path.join(checkpoint_dir(spark), f"incremental-{uuid.uuid4().hex}")
    q = start_incremental_digest(page_messages(stream), out_dir, p)
    q.awaitTermination()
    digest_path = os.path.join(out_dir, "digest")
    if not any(n.startswith("report=") for n in sub_folders(spark, digest_path)):
        items = message_items(message_bodies(match_messages(page_messages(pages), p), p), p)
        return spark.createDataFrame([], items.schema).withColumn("ordinal", F.lit(0)) \
            .select(*digest_columns(p))
    return spark.read.parquet(digest_path).select(*digest_columns(p))
