"""Distinct counts that can be merged: sets of dense numbers as bitmaps.

A person with a dense number is one bit. Bitmaps per group and range of numbers are built where the rows
are, a few KB each, and merge exactly: the count over any choice of groups needs neither the rows nor
the persons' ids again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_bitmaps(df: DataFrame, key: str, *by: str) -> DataFrame:
    """(by..., bucket, bits): the numbers of `key` in each group; unknown ones are left out."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(*by, F.bitmap_bucket_number(key).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))
    )


def distinct_keys(bitmaps: DataFrame, name: str, *by: str) -> DataFrame:
    """How many different numbers are in the bitmaps, in all or per group."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = merged.groupBy(*by) if by else merged
    return counted.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias(name))
