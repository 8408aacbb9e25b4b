"""Reshaping small aggregates: shares of a total, binning, pivoting, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def total(column: str | Column) -> Column:
    """Sum over the whole frame, for frames already aggregated to a bounded number of groups
    (months, states, segments ...)."""
    return F.sum(column).over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))


def in_order(df: DataFrame, *order: str | Column) -> DataFrame:
    """Sort a report of bounded size (months, states, labels ...) in one task, which saves the
    sampling pass and the exchange of a distributed sort."""
    return df.repartition(1).orderBy(*order)


def bin_index(value: Column, width: int, last_edge: int) -> Column:
    """Equal-width bins over [0, last_edge]; the last bin is closed, values outside get NULL."""
    last_bin = last_edge // width - 1
    return F.when(
        value.between(0, last_edge),
        F.least(F.floor(value / F.lit(float(width))).cast("long"), F.lit(last_bin).cast("long")),
    )


def spread(df: DataFrame, rows: str, columns: str, values: list, value: Column) -> DataFrame:
    """Pivot with declared column values: no extra pass to find them, and a stable schema."""
    return df.groupBy(rows).pivot(columns, values).agg(value)
