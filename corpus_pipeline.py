"""The corpus pipeline: documents through quality rules, near-dedup, mixing and encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; the caller
writes it as Parquet and hands the reread table to the next stage. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mailsift.llm._store import written
from mailsift.llm.mixing import mix_sources
from mailsift.llm.pieces import sample_segmentations
from mailsift.llm.quality import keep_quality
from mailsift.llm.simhash import DISTANCE, SHINGLE, keep_one_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the learnt thresholds of their language and source."""
    return keep_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours."""
    return keep_one_each(docs, shingle=SHINGLE, distance=DISTANCE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source targets ask for."""
    return mix_sources(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of each document, as piece ids."""
    return sample_segmentations(docs)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("mixing", mix),
          ("encoding", encode)]

# No SQL: fingerprints (XXH64), components and sampled segmentations are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
