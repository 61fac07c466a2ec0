"""Tables written once into the folder that the driver and all executors share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset a scratch folder is used on a local master (tests); on a
    cluster that would be one machine's disk, so it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="mailsift-shared-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return it read back.

    Cuts the lineage (a lost executor re-reads the table), runs costly work
    once where several branches need it, and gives the planner true sizes, so
    a broadcast is chosen from a measured size. Column names must be unique.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/mailsift-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python workers in batches of at most ``BATCH_BYTES`` (or one row).

    The session's own bound stays where it is smaller. Texts differ in length
    by orders of magnitude, so a bound in rows alone does not bound memory.
    """
    now = spark.conf.get(_BATCH_SETTING, "64m").lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[-1:], 1)
    if not 0 < int(now.rstrip("kmg")) * scale <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


def give_back() -> None:
    """Called where a Python task ends: a reused worker would else keep what the task freed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass
