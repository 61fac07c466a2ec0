"""Archives of many messages (mbox): one splittable scan, batch or streaming.

An archive holds messages one after the other, each behind a line ``From ...``;
lines of a message that look like one are quoted with ``>``. Spark's text source
reads such files with ``"\\nFrom "`` as the record separator, so a large archive is
cut into byte ranges like any text file, a stream keeps its own offsets, and no
file has to hold one message only. Bytes pass unchanged, whatever their charset.

The mailbox order ``uid`` is the number in the header ``X-UID`` of the message,
which ``write_archive`` writes and mail programs keep; null where there is none.

Defined results: empty files hold no message; a null raw message is not
written; a missing final line feed is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEPARATOR = "\nFrom "
_UID_RE = r"(?im)^X-UID:[ \t]*([0-9]{1,18})[ \t]*\r?$"


def _latin(raw: Column) -> Column:
    """Bytes as characters 0 to 255: regular expressions on them lose nothing."""
    return F.decode(raw, "ISO-8859-1")


def write_archive(messages: DataFrame, path: str, uid_col: str = "uid", raw_col: str = "raw") -> None:
    """Messages (``uid``, ``raw`` bytes) as archive files, each written by one task."""
    text = F.regexp_replace(_latin(F.col(raw_col)), r"(?dm)^(>*From )", ">$1")
    uid = F.coalesce(F.concat(F.lit("X-UID: "), F.col(uid_col).cast("string"), F.lit("\r\n")), F.lit(""))
    whole = F.concat(F.lit("From -\n"), uid, F.regexp_replace(text, r"\n\z", ""))
    messages.filter(F.col(raw_col).isNotNull()) \
        .select(F.encode(whole, "ISO-8859-1").cast("string").alias("value")).write.text(path)


def _messages(records: DataFrame) -> DataFrame:
    """Records between separators -> ``uid, raw``; what is left of the ``From`` line goes."""
    text = F.regexp_replace(_latin(F.col("value").cast("binary")), r"\A[^\n]*\n?", "")
    text = F.regexp_replace(text, r"(?dm)^>(>*From )", "$1")
    headers = F.substring_index(F.substring_index(text, "\r\n\r\n", 1), "\n\n", 1)
    uid = F.regexp_extract(headers, _UID_RE, 1)
    own = F.regexp_replace(F.regexp_replace(text, r"\A(?i:X-UID):[^\n]*(?:\n|\z)", ""), r"\n\z", "")
    return records.filter(F.length(F.trim("value")) > 0).select(
        F.when(uid != "", uid.cast("long")).alias("uid"),
        F.encode(F.concat(own, F.lit("\n")), "ISO-8859-1").alias("raw"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All messages ``(uid, raw)`` of the archives under ``path``."""
    return _messages(spark.read.option("lineSep", SEPARATOR).text(path))


def stream_archive(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """S1 as a stream: archives that land under ``path``, with ``uid, raw`` as in a batch."""
    reader = spark.readStream.option("lineSep", SEPARATOR)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _messages(reader.text(path))
