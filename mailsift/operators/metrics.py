"""Aggregations: item totals (A1) and the stage funnel (A2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def report_totals(items: DataFrame, by: Sequence[str], name: str = "total") -> DataFrame:
    """A1: selected items per report (hash aggregate, partial map-side)."""
    return items.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def funnel_counts(stages: Mapping[str, DataFrame], by: Sequence[str]) -> DataFrame:
    """A2: row counts after each stage, one row per (report, stage).

    Each stage is counted by a partial aggregate on its own plan and the
    small per-stage results are unioned; ``stage_no`` keeps the stage order.
    """
    out = None
    for i, (name, df) in enumerate(stages.items(), 1):
        counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).select(
            *by, F.lit(i).alias("stage_no"), F.lit(name).alias("stage"), "n")
        out = counted if out is None else out.unionByName(counted)
    return out
