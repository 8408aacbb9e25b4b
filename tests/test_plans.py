"""Physical plans: what is pushed down, pruned, and never brought into a single task."""

import re

import pytest
from comparing import spark_result
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketlens import catalogue, session
from marketlens.plans import marts
from marketlens.sources import standin

FOLDER = "/root/testdata/sf0.01"


def plan(spark, name, **conf):
    return text_of(spark, lambda: catalogue.run(name, spark, FOLDER), **conf)


def text_of(spark, frame, **conf):
    conf["spark.sql.maxMetadataStringLength"] = "5000"
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        text = frame()._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in conf:
            spark.conf.unset(key)
    return re.sub(r"#\d+L?", "", text)


def below_single_partition_windows(text):
    """The operator under each single-partition exchange that feeds a window."""
    return re.findall(r"Window.*\n.*Sort.*\n.*Exchange SinglePartition.*\n[\s:]*\+- (.*)", text)


@pytest.mark.parametrize(
    "name",
    ["fct_orders", "customer_order_number", "customer_rfm", "rfm_scores", "seller_scorecard",
     "export_orders", "seller_concentration", "dash_seller_kpis", "review_dedup_trace"],
)
def test_no_window_over_all_rows_in_one_task(spark, name):
    for operator in below_single_partition_windows(plan(spark, name)):
        assert operator.startswith("HashAggregate(keys=[_range"), operator


@pytest.mark.parametrize("name", sorted(catalogue.PLANS))
def test_no_cross_join(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_trend_reads_four_columns_and_pushes_its_filters(spark):
    text = plan(spark, "monthly_trend")
    columns = re.search(r"FileScan parquet \[(.*?)\]", text).group(1).split(",")
    assert set(columns) == {"order_status", "order_date", "order_revenue", "in_analysis_window"}
    assert "GreaterThanOrEqual(order_date" in text


def test_unused_joins_and_windows_disappear(spark):
    """Order revenue needs items only: payments, reviews and order numbers leave the plan."""
    text = plan(spark, "analysis_window_flag")
    assert "payment" not in text and "review" not in text and "Window" not in text


def test_items_meet_categories_as_sums_per_product(spark):
    text = plan(spark, "category_pareto", **{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    join = text.index("SortMergeJoin [product_id]")
    assert "partial_sum" in text[join:] and "keys=[product_id]" in text[join:]


def test_fact_joins_share_the_order_partitioning(spark):
    """The three left joins of the fact add no exchange of the fact between them."""
    text = plan(spark, "fct_orders", **{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    assert text.count("LeftOuter") == 3
    first = text.index("LeftOuter")
    last = text.rindex("LeftOuter")
    assert "Exchange" not in text[first:last]


def test_the_window_prunes_the_item_scan(spark):
    f = catalogue.Frames(catalogue.warehouse(spark, FOLDER))
    for df in (marts.seller_orders(f.items, f.orders, f.cfg), catalogue.run("repeat_by_first_category", spark, FOLDER)):
        scans = re.findall(r"FileScan.*", text_of(spark, lambda df=df: df))
        items = [x for x in scans if "order_item_id" in x or "item_revenue" in x]
        assert items and all("GreaterThanOrEqual(order_date" in x for x in items)


def exchanged(spark, model, keys):
    """How often the plan of a mart exchanges rows by exactly these keys."""
    text = re.sub(r"#\d+L?", "", plan(spark, model, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}))
    return text.count(f"hashpartitioning({keys}, ")


def test_sellers_of_an_order_need_no_exchange_of_their_own(spark):
    assert exchanged(spark, "order_item_rollup", "order_id, seller_id") == 0
    assert exchanged(spark, "order_item_rollup", "order_id") <= 1


def test_people_are_aggregated_in_one_exchange(spark):
    assert exchanged(spark, "dim_customers", "customer_unique_id, order_id") == 0
    assert exchanged(spark, "dim_customers", "customer_unique_id") == 1


def test_shuffles_grow_with_the_input(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    session.size_shuffles(spark, FOLDER)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    monkeypatch.setattr(session, "BYTES_PER_SHUFFLE_PARTITION", 100_000)
    try:
        session.size_shuffles(spark, FOLDER)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) > int(before)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_shuffle_partition_sorts_in_memory(spark, monkeypatch):
    """A GB of tables is dealt to enough partitions that sorting one of them needs no spill."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(session, "folder_bytes", lambda *_: 1_000_000_000)
    try:
        session.size_shuffles(spark, FOLDER)
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_keys_survive_lost_placement(spark):
    """Numbers come from written files, so evaluating them twice gives the same answer."""
    from marketlens.operators.ranking import number_rows

    df = spark.range(5000).withColumn("v", F.col("id") % 3)
    numbered = number_rows(df, [F.col("v").asc(), F.col("id").asc()], "n", rows_per_range=400)
    assert sorted(numbered.collect()) == sorted(numbered.repartition(3).collect())


def test_order_numbers_need_one_exchange_and_no_join(spark, monkeypatch):
    """Beside joining the person: one range exchange, written, and no aggregation of all orders."""
    from marketlens.operators import ranking

    written = []
    monkeypatch.setattr(ranking, "stash", lambda df, label="": written.append(df) or session.stash(df, label))
    f = catalogue.Frames(catalogue.warehouse(spark, FOLDER))
    numbered = marts.customer_order_numbers(f.stg("stg_orders"), f.stg("stg_customers"))
    assert len(written) == 1
    assert text_of(spark, lambda: written[0]).count("Exchange rangepartitioning") == 1
    read = text_of(spark, lambda: numbered)
    assert "Exchange" not in read and "Join" not in read and "Window" not in read


def test_rank_correlations_share_one_seating(spark, monkeypatch):
    from marketlens.operators import ranking
    from marketlens.plans import hypothesis

    written = []
    monkeypatch.setattr(ranking, "stash", lambda df, label="": written.append(label) or session.stash(df, label))
    f = catalogue.Frames(catalogue.warehouse(spark, FOLDER))
    hypothesis.spearman(f.delivered, ["delivery_days", "days_vs_estimate", "order_revenue"], "review_score")
    assert written == ["segments"]


def test_row_counts_come_from_footers(spark):
    text = plan(spark, "load_summary")
    scans = re.findall(r"BatchScan parquet.*", text)
    assert len(scans) >= 4 and "FileScan" not in text
    assert sum("PushedAggregation: [COUNT(*)]" in s for s in scans) >= 4
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_buyers_are_not_rewritten_for_their_scores(spark, monkeypatch):
    from marketlens.operators import ranking

    written = []
    monkeypatch.setattr(ranking, "stash", lambda df, label="": written.append(df.columns) or session.stash(df, label))
    f = catalogue.Frames(catalogue.warehouse(spark, FOLDER))
    rows = marts.rfm_scores(f.orders, f.cfg)
    assert ["score", "value", "ties"] == written[0][:3]
    assert all("_value" in columns for columns in written[1:]) and len(written) <= 3
    assert "Exchange" not in text_of(spark, lambda: rows)


@pytest.mark.parametrize("name", ["headline_kpis", "state_revenue", "dash_kpis", "dash_top_states",
                                  "dash_kpis_filtered", "dash_top_states_filtered"])
def test_distinct_people_shuffle_no_person(spark, name):
    text = plan(spark, name, **{"spark.sql.autoBroadcastJoinThreshold": "-1"})
    assert "bitmap_or_agg" in text
    assert not re.search(r"hashpartitioning\([^)]*customer_(unique_id|key)", text)
    assert "customer_unique_id" not in text and "customer_key" not in text


def test_item_numbers_move_only_the_columns_of_an_item(spark):
    """What breaks ties between lines that give the same item is neither read nor moved, and the items are
    the same as with it."""
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = text_of(spark, lambda: standin.order_items(lines))
    assert "l_extendedprice" in text
    assert not re.search("l_discount|l_tax|l_returnflag|l_linestatus", text)
    # Lines repeated with another tax and flag tie in all columns of an item.
    tied = lines.unionByName(lines.where("l_orderkey % 5 = 0").withColumn("l_tax", F.lit(0.5)).withColumn("l_returnflag", F.lit("Z")))
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    number = F.row_number().over(W.partitionBy("l_orderkey").orderBy(*order)).cast("long")
    whole = tied.select(
        F.col("l_orderkey").alias("order_id"), number.alias("order_item_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"), F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"), (F.col("l_quantity") * 1.25).alias("freight_value"),
    )
    assert spark_result(standin.order_items(tied)) == spark_result(whole)


def test_stored_tables_are_compressed_well(spark):
    for table in (session.stash(spark.range(10)), catalogue.warehouse(spark, FOLDER).mart("fct_orders")):
        assert all(".zstd." in path for path in table.inputFiles())
