"""Session helpers.

Production jobs receive a session from the cluster; ``get_spark`` exists for
tests, the benchmark and the smoke entry point. It only fills settings that
are unset, so a cluster's own ``spark.checkpoint.dir`` and partition sizing
always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package assumes. Session time zone UTC keeps
# timestamp <-> string conversions independent of the executor host.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "mailsift", cpus: str | int = "*",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and benchmarks (no UI, AQE on, UTC)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = os.environ.get("MAILSIFT_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set to a file system that the driver and all
    executors share; an unset folder is an error there, since a folder of one
    machine would lose what other machines wrote. A local master (tests) gets
    a scratch folder of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="mailsift-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def written(df: DataFrame, label: str = "stage", codec: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return it read back.

    Used where several branches read one costly or order-bearing result: all
    of them then see the same rows, a lost executor re-reads the table, and
    the planner knows its size. The write runs when this is called.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_FREED_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go when their job ends instead of when the driver collects garbage.

    For jobs that write whole tables and run once each; a later run of the same
    DataFrame makes its shuffles again.
    """
    before = spark.conf.get(_FREED_SETTING, None)
    spark.conf.set(_FREED_SETTING, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREED_SETTING)
        else:
            spark.conf.set(_FREED_SETTING, before)


BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Send bodies to Python workers in batches of at most ``BATCH_BYTES`` (or one row).

    Bodies differ in size by orders of magnitude, so a bound in rows alone does not
    bound memory. A smaller bound of the session's own stays.
    """
    now = spark.conf.get(_BATCH_SETTING, "64m").lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[-1:], 1)
    if not 0 < int(now.rstrip("kmg")) * scale <= BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)


SPREAD_SETTING = "mailsift.spread.partitions"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal rows over as many partitions as the session asks for, by a unique key.

    The setting ``mailsift.spread.partitions`` is off unless someone sets it:
    it helps where a CPU-heavy stage reads a table of one small file, and would
    only add a shuffle on a large one.
    """
    n = df.sparkSession.conf.get(SPREAD_SETTING, None)
    return df.repartition(int(n), key) if n and not df.isStreaming else df
