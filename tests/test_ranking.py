"""Distributed ranks against plain windows, with many ranges, ties, NULLs and hot groups."""

import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlens.operators import ranking
from marketlens.session import stash as ranking_stash


@pytest.fixture(scope="module")
def values(spark):
    """2,000 rows; a third share one value and a third belong to one group, some values are NULL."""
    return spark.range(2000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 97 != 1, F.col("id") * 37 % 101)
        .alias("v"),
        F.when(F.col("id") % 3 == 1, F.lit(-1)).otherwise(F.col("id") % 50).alias("g"),
    )


def same(left, right):
    assert left.columns == right.columns
    assert sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, right.collect()), key=str)


@pytest.mark.parametrize("per_range", [64, 333, 10_000])
def test_number_rows(values, per_range):
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    mine = ranking.number_rows(values, order, "n", rows_per_range=per_range)
    plain = values.withColumn("n", F.row_number().over(W.orderBy(*order)).cast("long"))
    same(mine, plain)


@pytest.mark.parametrize("buckets", [1, 5, 7, 2000, 3000])
def test_ntiles(values, buckets):
    order = [F.col("v").asc_nulls_last(), F.col("id").asc()]
    mine = ranking.ntiles(values, [("n", order, buckets)], rows_per_range=150)
    plain = values.withColumn("n", F.ntile(buckets).over(W.orderBy(*order)).cast("long"))
    same(mine, plain)


def test_ntile_remainder_goes_to_the_first_buckets(spark):
    tiles = ranking.ntiles(spark.range(7), [("n", [F.col("id").asc()], 5)])
    sizes = [r["count"] for r in tiles.groupBy("n").count().orderBy("n").collect()]
    assert sizes == [2, 2, 1, 1, 1]


@pytest.mark.parametrize("descending", [False, True])
def test_rank_with_ties(values, descending):
    known = values.where("v IS NOT NULL")
    order = F.col("v").desc() if descending else F.col("v").asc()
    mine = ranking.rank_by(known, "v", "n", descending, rows_per_range=10)
    same(mine, known.withColumn("n", F.rank().over(W.orderBy(order)).cast("long")))


def test_rank_puts_null_last(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 9.0), (4, None)], "id int, v double")
    got = {r.id: r.n for r in ranking.rank_by(df, "v", "n", descending=True).collect()}
    assert got == {3: 1, 1: 2, 2: 3, 4: 3}


def test_dense_rank(values):
    mine = ranking.dense_rank_by(values.drop("v"), "g", "n", rows_per_range=9)
    plain = values.drop("v").withColumn("n", F.dense_rank().over(W.orderBy("g")).cast("long"))
    same(mine.select(*plain.columns), plain)


@pytest.mark.parametrize("parts", [1, 10, 10_000])
def test_number_in_group_by_slices(values, parts):
    order = [F.col("v").asc_nulls_last(), F.col("id").asc()]
    mine = ranking.number_in_group(values, ["g"], F.floor(F.col("v") / parts), order, "n")
    plain = values.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy(*order)).cast("long"))
    same(mine, plain)


def test_number_in_group_descending_with_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), (None, None)], "g string, id int")
    mine = ranking.number_in_group(
        df, ["g"], F.col("id"), [F.col("id").desc_nulls_last()], "n", descending=True
    )
    assert sorted((str(r.id), r.n) for r in mine.collect()) == [("1", 2), ("2", 1), ("3", 1), ("None", 3)]


def test_number_in_group_tells_null_from_the_values_beside_it(spark):
    rows = [(None, None, 1), (None, 0, 2), ("", 0, 3), ("", None, 4), (None, 0, 5), ("", 3, 6), (None, 3, 7)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    order = [F.col("v").asc_nulls_last(), F.col("id").asc()]
    mine = ranking.number_in_group(df, ["g"], F.col("v"), order, "n")
    same(mine, df.withColumn("n", F.row_number().over(W.partitionBy("g").orderBy(*order)).cast("long")))


def test_number_in_group_exchanges_the_rows_once(spark, values):
    """Window and join share one exchange and one sort of the rows."""
    wide = values.withColumn("payload", F.col("id") * 3)
    numbered = ranking.number_in_group(wide, ["g"], F.floor(F.col("v") / 7), [F.col("v").asc(), F.col("id").asc()], "n")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = numbered._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    left = lines[join + 1 : next(i for i, x in enumerate(lines) if i > join and "Exchange" in x) + 1]
    assert any("Window" in x for x in left) and sum("Sort [" in x for x in left) == 1, left
    assert sum("Exchange hashpartitioning(_part0" in x for x in lines) == 2


def test_weighted_counts_ahead(spark):
    df = spark.createDataFrame([(1, 3), (2, 1), (2, 4), (5, 2)], "v int, w int")
    got = ranking.counts_ahead(df, "v", weight="w", rows_per_range=1).collect()
    assert sorted((r.v, r.ties, r.ahead) for r in got) == [(1, 3, 0), (2, 5, 3), (5, 2, 8)]


def test_no_single_task_window_over_rows(values):
    """The only single-partition window runs over one row per range."""
    numbered = ranking.number_rows(values, [F.col("id").asc()], "n", rows_per_range=100)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    above_single = re.findall(r"Window.*?\n.*?Sort.*?\n.*?SinglePartition.*?\n(.*?)\n", plan)
    assert len(above_single) == 1 and "HashAggregate(keys=[_range" in above_single[0]


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_running_totals_restart_at_a_segment(values, ranges):
    order = [F.col("v").asc_nulls_last(), F.col("id").asc()]
    df = values.withColumn("g", F.when(F.col("g") != 3, F.col("g"))).withColumn("w", F.col("id") % 5)
    mine = ranking.running_in_segments(df, ["g"], order, "n", "w", ranges)
    before = F.sum("w").over(W.partitionBy("g").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    same(mine, df.withColumn("n", F.coalesce(before, F.lit(0))))


def test_numbers_in_two_segment_columns_and_one_hot_segment(values):
    order = [F.col("id").desc()]
    df = values.select(F.lit(None).cast("string").alias("a"), (F.col("id") > 1990).alias("b"), "id", "v")
    mine = ranking.running_in_segments(df, ["a", "b"], order, "n", ranges=25)
    same(mine, df.withColumn("n", (F.row_number().over(W.partitionBy("a", "b").orderBy(*order)) - 1).cast("long")))
    assert ranking.running_in_segments(df.limit(0), ["a"], order, "n").count() == 0


def test_counts_ahead_in_segments(values):
    df = values.select("g", "v", (F.col("id") % 3).alias("w"))
    got = {(r.g, r.v): (r.ties, r.ahead) for r in ranking.counts_ahead_in_segments(df, ["g"], "v", "w").collect()}
    rows = df.collect()
    for (g, v), (ties, ahead) in got.items():
        mine = [r for r in rows if r.g == g]
        assert ties == sum(r.w for r in mine if r.v == v)
        assert ahead == sum(r.w for r in mine if r.v != v and (v is None or (r.v is not None and r.v < v)))
    assert len(got) == len({(r.g, r.v) for r in rows})


@pytest.mark.parametrize("buckets", [1, 2, 5, 7, 2000, 3000])
@pytest.mark.parametrize("descending", [False, True])
def test_ntiles_by_levels(values, buckets, descending):
    v = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    mine = ranking.ntiles_by_levels(values, [("n", "v", descending, buckets), ("m", "g", True, 4)], "id")
    plain = values.withColumn("n", F.ntile(buckets).over(W.orderBy(v, "id")).cast("long")).withColumn(
        "m", F.ntile(4).over(W.orderBy(F.col("g").desc(), "id")).cast("long")
    )
    same(mine, plain)


def test_only_rows_in_levels_with_a_border_are_numbered(spark, monkeypatch):
    """A third of the rows share the value in which a border falls; all others are told by comparison."""
    df = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 1000, id) AS v")
    numbered = []
    monkeypatch.setattr(ranking, "stash", lambda df, label="": numbered.append(ranking_stash(df, label)) or numbered[-1])
    mine = ranking.ntiles_by_levels(df, [("n", "v", False, 5)], "id")
    same(mine, df.withColumn("n", F.ntile(5).over(W.orderBy("v", "id")).cast("long")))
    rows = [f.count() for f in numbered if "id" in f.columns]
    assert rows == [df.where("v = 1000").count()]
    assert ranking.ntiles_by_levels(df.limit(0), [("n", "v", False, 5)], "id").count() == 0
