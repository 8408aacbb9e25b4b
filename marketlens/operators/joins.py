"""Join helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def squash(df: DataFrame, key: str, *aggregates: Column) -> DataFrame:
    """Bring a finer table to one row per key, so that joining it cannot multiply rows."""
    return df.groupBy(key).agg(*aggregates)


def squash_join(base: DataFrame, key: str, *parts: DataFrame) -> DataFrame:
    """Left join tables already squashed to `key`; all joins share one hash partitioning."""
    for part in parts:
        base = base.join(part, key, "left")
    return base


def side_by_side(*one_row: DataFrame) -> DataFrame:
    """One-row frames with different columns as a single row, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), one_row)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
