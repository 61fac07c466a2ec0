"""Sinks (K1-K4, K7): dated outputs, one folder per report, safe to run again.

A report's folder is named by an encoded key (``report=is-2025-11-19``; a null
part is ``none``), and the key columns stay in the rows, so their types, null
and the empty text survive. A run replaces the folders of the reports it has
rows for, removes those of the reports it touched but has no rows for, and
leaves every other folder alone.

A run commits by a manifest. Its folders are first written beside the old ones,
under a name that readers skip; then one manifest file that names the run and
the folders to remove is put in place by a rename: that is the commit. Only then
are the folders moved, and the manifest goes last. A run that is killed before
its commit leaves the old reports whole; one killed after it is finished by the
next run (or ``recover``), whose steps can be repeated.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsift.session import small_batches


def report_key(by: Sequence[str]) -> Column:
    """Folder name of a report: one part per key column, null told from the empty text."""
    return F.concat_ws("~", *[
        F.coalesce(F.concat(F.lit("is-"), F.col(b).cast("string")), F.lit("none")) for b in by])


def overwrite_partitions(df: DataFrame):
    """A writer that replaces only the partitions present in ``df`` (K7).

    Set as a write option, not a session setting: inside ``foreachBatch``
    the stream runs on its own session copy, which would not see it.
    """
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def sub_folders(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, at = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at(path))] if fs.exists(at(path)) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at(path), True)


def _folder_names(spark: SparkSession, reports: DataFrame) -> Iterator[str]:
    """Folder names of the ``report`` keys, fetched one partition at a time."""
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in reports.toLocalIterator():
        yield f"report={escaped(row.report)}"


def existing_folders(spark: SparkSession, path: str, reports: DataFrame, by: Sequence[str]) -> list[str]:
    """The folders under ``path`` of the reports in ``reports``, without listing the others."""
    fs, at = _fs(spark, path)
    names = _folder_names(spark, reports.select(report_key(by).alias("report")).distinct())
    return [f for f in (os.path.join(path, n) for n in names) if fs.exists(at(f))]


def _emptied(kept: DataFrame, touched: DataFrame, by: Sequence[str]) -> DataFrame:
    names = touched.select(report_key(by).alias("report")).distinct()
    return names.join(kept.select(report_key(by).alias("report")).distinct(), "report", "left_anti")


def remove_emptied(path: str, kept: DataFrame, touched: DataFrame, by: Sequence[str]) -> None:
    """Delete the folders of the reports in ``touched`` that ``kept`` has no row for."""
    spark = kept.sparkSession
    for name in _folder_names(spark, _emptied(kept, touched, by)):
        delete_folder(spark, os.path.join(path, name))


RUNS = "_runs"  # what runs have under way; readers skip names that begin so


def recover(spark: SparkSession, path: str) -> None:
    """Finish the runs whose manifest is in place, and clear what uncommitted runs left.

    One run writes to ``path`` at a time. Every step can be repeated: a folder that
    is still under the run's name has not been moved yet. The reports themselves
    are not listed.
    """
    fs, at = _fs(spark, path)
    runs = os.path.join(path, RUNS)
    names = sub_folders(spark, runs)
    committed = {n.removeprefix("manifest-") for n in names if n.startswith("manifest-")}
    for run in sorted(committed):
        manifest, staged = os.path.join(runs, f"manifest-{run}"), os.path.join(runs, f"run-{run}")
        stream = fs.open(at(manifest))
        gone = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        for name in filter(None, gone.split("\n")):
            fs.delete(at(os.path.join(path, name)), True)
        for name in sub_folders(spark, staged):
            if name.startswith("report="):
                target = os.path.join(path, name)
                fs.delete(at(target), True)
                if not fs.rename(at(os.path.join(staged, name)), at(target)):
                    raise OSError(f"could not move {name} to {path}")
        fs.delete(at(staged), True)
        fs.delete(at(manifest), True)
    for name in names:
        if name.split("-", 1)[1] not in committed:
            fs.delete(at(os.path.join(runs, name)), True)


def commit(spark: SparkSession, path: str, write: Callable[[str], None],
           gone: DataFrame | None = None) -> None:
    """Replace the reports that ``write(folder)`` writes, and remove those in ``gone``, as one step."""
    recover(spark, path)
    run, runs = uuid.uuid4().hex, os.path.join(path, RUNS)
    write(os.path.join(runs, f"run-{run}"))
    draft = os.path.join(runs, f"draft-{run}")
    names = [] if gone is None else list(_folder_names(spark, gone))
    fs, at = _fs(spark, path)
    stream = fs.create(at(draft))
    stream.write(bytearray("\n".join(names).encode()))
    stream.close()
    if not fs.rename(at(draft), at(os.path.join(runs, f"manifest-{run}"))):  # the commit
        raise OSError(f"could not commit to {path}")
    recover(spark, path)


def _commit_reports(df: DataFrame, path: str, by: Sequence[str], touched: DataFrame | None,
                    write: Callable[[str], None]) -> None:
    gone = None if touched is None else _emptied(df, touched, by)
    commit(df.sparkSession, path, write, gone)


def write_reports(df: DataFrame, path: str, by: Sequence[str],
                  touched: DataFrame | None = None) -> None:
    """Parquet rows under their report's folder; see the module's text for reruns."""
    keyed = df.withColumn("report", report_key(by))
    _commit_reports(df, path, by, touched, lambda to: keyed.write.partitionBy("report").parquet(to))


def write_items_jsonl(items: DataFrame, path: str, partition_by: Sequence[str] = ("report_date",),
                      order: Sequence[str] = ("ordinal",),
                      fields: Sequence[str] = ("title", "link", "abstract"),
                      touched: DataFrame | None = None) -> None:
    """K1: one JSON object per item, non-ASCII kept, a null abstract written as ``null``.

    Rows are range-partitioned on the report key and order so each output
    file holds consecutive items, and sorted within the file; no single task
    ever holds a whole report.
    """
    keys = [F.col(k).asc_nulls_first() for k in (*partition_by, *order)]
    out = items.withColumn("report", report_key(partition_by)).repartitionByRange(*keys) \
        .sortWithinPartitions("report", *order).select("report", *fields)
    _commit_reports(items, path, partition_by, touched, lambda to: out.write.partitionBy("report")
                    .option("ignoreNullFields", "false").json(to))


def write_text_documents(docs: DataFrame, path: str, text_col: str,
                         partition_by: Sequence[str] = ("report_date",),
                         order: Sequence[str] = ("chunk",),
                         touched: DataFrame | None = None) -> None:
    """K2/K3: one text document (Markdown list, prompt) per row, in its report's folder."""
    write_reports(docs.select(*partition_by, *order, F.col(text_col).alias("text")), path,
                  partition_by, touched)


def write_text_files(docs: DataFrame, path: str, text_col: str,
                     partition_by: Sequence[str] = ("report_date",),
                     order: Sequence[str] = (),
                     touched: DataFrame | None = None) -> None:
    """K2/K3 as plain text: one file per document in its report's folder.

    The file is the text; a final line feed is added where the text has none. A
    large document can come in parts of whole lines, numbered by ``order``: they are
    written to its file one after the other, and no value holds them all.
    """
    body = F.regexp_replace(text_col, r"\n\z", "")  # the text source ends the row with one
    out = docs.select(report_key(partition_by).alias("report"), body.alias("value"), *order) \
        .repartition("report").sortWithinPartitions("report", *order).select("report", "value")
    _commit_reports(docs, path, partition_by, touched,
                    lambda to: out.write.partitionBy("report").text(to))


def text_file_digests(spark: SparkSession, path: str) -> DataFrame:
    """``report, text_md5`` of the files that ``write_text_files`` wrote under ``path``.

    A digest has to see a file in order: its lines are read by many tasks and
    stream through one, in place, and are never gathered.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            done = []
            for report, lines in groupby(zip(*[c.to_pylist() for c in batch.columns]), itemgetter(0)):
                if report != at:
                    if digest:
                        done.append((at, digest.hexdigest()))
                    at, digest = report, hashlib.md5()
                digest.update(b"".join(line for _, line in lines))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*done)],
                                                 ["report", "text_md5"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([digest.hexdigest()])],
                                             ["report", "text_md5"])

    small_batches(spark)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "report", F.concat("value", F.lit("\n")).cast("binary").alias("line"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"))
    return lines.repartition("report").sortWithinPartitions("report", "block", "place") \
        .select("report", "line").mapInArrow(run, "report string, text_md5 string")


def write_summaries(summaries: DataFrame, path: str,
                    partition_by: Sequence[str] = ("report_date", "backend"),
                    touched: DataFrame | None = None) -> None:
    """K4: summaries in a folder per report and backend (two backends, two outputs)."""
    write_reports(summaries, path, partition_by, touched)
