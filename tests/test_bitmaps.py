"""Distinct counts from bitmaps against plain ones, over any choice of groups."""

import pytest
from pyspark.sql import functions as F

from marketlens.operators.bitmaps import distinct_keys, key_bitmaps


@pytest.fixture(scope="module")
def rows(spark):
    """Numbers over several ranges of bits; a third of the rows is one person, some have none."""
    return spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 101 != 5, F.col("id") * 7919 % 130_000).alias("k"),
        (F.col("id") % 4).alias("a"), F.when(F.col("id") % 5 != 0, F.col("id") % 5).alias("b"),
    )


def test_counts_merge_exactly(rows):
    bits = key_bitmaps(rows, "k", "a", "b")
    assert distinct_keys(bits, "n").first().n == rows.agg(F.count_distinct("k")).first()[0]
    some = distinct_keys(bits.where("a < 2 AND b = 3"), "n").first().n
    assert some == rows.where("a < 2 AND b = 3").agg(F.count_distinct("k")).first()[0]
    by_b = {r.b: r.n for r in distinct_keys(bits, "n", "b").collect()}
    assert by_b == {r.b: r.n for r in rows.groupBy("b").agg(F.count_distinct("k").alias("n")).collect()}


def test_nothing_to_count(rows):
    assert distinct_keys(key_bitmaps(rows.where("k < 0"), "k", "a"), "n").first().n == 0
