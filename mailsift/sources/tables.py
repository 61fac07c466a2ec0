"""Parquet tables under one folder (the test-data layout ``<dir>/<name>.parquet``)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read ``<sf_dir>/<name>.parquet``; column pruning and filters reach the scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
