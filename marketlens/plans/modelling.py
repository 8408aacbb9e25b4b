"""What the star schema is for: joins, fan-out, deduplication, first questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import expressions as X
from ..operators.joins import squash
from ..operators.ranking import number_in_group
from ..operators.shape import in_order, total


def facts_of(dimension: DataFrame, facts: DataFrame, key: str, keep_unmatched: bool) -> DataFrame:
    """Dimension rows joined with their facts: an inner join, or with `keep_unmatched` a left join
    that keeps dimension rows without any fact.

    The left join is put together from the inner join and the unmatched rows. In a plain left outer
    join the facts of one busy key could not be split over tasks.
    """
    matched = dimension.join(facts, key)
    if not keep_unmatched:
        return matched
    unmatched = dimension.join(facts.select(key).distinct(), key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def calendar_orders(calendar: DataFrame, orders: DataFrame, keep_unmatched: bool) -> DataFrame:
    """Days with their orders; with `keep_unmatched` also the days on which nobody ordered."""
    bought = orders.select(F.col("purchased_at").cast("date").alias("date"), "order_id")
    return facts_of(calendar.select("date", "day_name"), bought, "date", keep_unmatched)


def orders_with_person(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers, "customer_id").select(
        "order_id", "customer_id", "customer_unique_id", "state"
    )


def fanout_probe(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Rows, orders and inflated revenue of joining items and payments straight to orders.

    An order with i items and p payments would give i * p rows; the sums are taken from the two
    counts per order, so the pairs themselves are never produced.
    """
    per_order_items = squash(
        items, "order_id", X.rows().alias("i"), F.sum(X.cents("price") + X.cents("freight_value")).alias("c")
    )
    pairs = (
        orders.select("order_id")
        .join(per_order_items, "order_id")
        .join(squash(payments, "order_id", X.rows().alias("p")), "order_id")
    )
    inflated = X.money(F.sum(F.col("c") * F.col("p")))
    return pairs.agg(
        F.sum(F.col("i") * F.col("p")).alias("rows_after_join"),
        F.count_distinct("order_id").alias("actual_orders"),
        X.rounded(inflated / 1e6, 2).alias("revenue_millions_wrong"),
    )


def correct_revenue(orders: DataFrame) -> DataFrame:
    revenue = X.rounded(X.sum_money("order_revenue") / 1e6, 2)
    return orders.agg(revenue.alias("revenue_millions_correct"))


def state_aov_top5(orders: DataFrame, settings: Settings) -> DataFrame:
    return (
        orders.where((F.col("order_status") == "delivered") & F.col("in_analysis_window"))
        .groupBy("customer_state")
        .agg(
            X.rows().alias("orders"),
            X.rounded(X.mean_money("order_revenue"), 2).alias("avg_order_value"),
        )
        .where(F.col("orders") >= settings.aov_min_orders)
        .orderBy(F.desc_nulls_last("avg_order_value"), "customer_state")
        .limit(5)
    )


def review_dedup_trace(reviews: DataFrame) -> DataFrame:
    """Reviews of orders that have several, numbered newest first; number 1 is the one kept."""
    sizes = reviews.groupBy("order_id").agg(X.rows().alias("rows")).where(F.col("rows") > 1)
    several = reviews.join(sizes.select("order_id"), "order_id", "left_semi")
    newest = [F.col("review_answer_timestamp").desc_nulls_last(), F.col("review_id").desc()]
    day = F.col("review_answer_timestamp").cast("date")
    return number_in_group(several, ["order_id"], day, newest, "rn", descending=True).select(
        "order_id", "review_id", "review_score", "review_answer_timestamp", "rn"
    )


def delivery_speed_buckets(orders: DataFrame) -> DataFrame:
    days = F.col("delivery_days")
    # The report's labels.
    speed = X.ladder(
        (days <= 7, "1. within a week"),
        (days <= 14, "2. 1-2 weeks"),
        (days <= 30, "3. 2-4 weeks"),
        otherwise="4. over a month",
    )
    return (
        orders.where(days.isNotNull())
        .groupBy(speed.alias("delivery_speed"))
        .agg(X.rows().alias("orders"), X.rounded(F.avg("review_score"), 2).alias("avg_review"))
        .transform(in_order, "delivery_speed")
    )


def top_categories_delivered(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items are summed per product before the join, so a best seller is one row in it."""
    per_product = (
        items.where(F.col("order_status") == "delivered")
        .groupBy("product_id")
        .agg(X.rows().alias("n"), X.sum_cents("item_revenue").alias("c"))
    )
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("n").alias("items_sold"), X.whole_units(F.sum("c")).alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
        .limit(10)
    )


def late_vs_on_time(orders: DataFrame) -> DataFrame:
    by_lateness = (
        orders.where("is_late IS NOT NULL")
        .groupBy("is_late")
        .agg(X.rows().alias("orders"), X.rounded(F.avg("review_score"), 2).alias("avg_review_score"))
    )
    return by_lateness.select(
        F.when(F.col("is_late"), "Late").otherwise("On time").alias("delivery"),
        "orders",
        X.percent(F.col("orders"), total("orders"), 1).alias("pct_orders"),
        "avg_review_score",
    )
