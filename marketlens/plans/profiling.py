"""Profiling of the raw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators.joins import side_by_side
from ..operators.shape import in_order, total


def distinct_counts(df: DataFrame, **columns: str) -> DataFrame:
    """Row count and the exact distinct count of each named column.

    Every column is counted in its own aggregate: one combined count-distinct would copy each row
    once per column before the shuffle.
    """
    counts = [df.agg(F.count_distinct(column).alias(name)) for name, column in columns.items()]
    return side_by_side(df.agg(X.rows().alias("total_rows")), *counts)


def row_vs_distinct(orders: DataFrame) -> DataFrame:
    return distinct_counts(orders, unique_orders="order_id")


def status_share(orders: DataFrame) -> DataFrame:
    by_status = orders.groupBy("order_status").agg(X.rows().alias("orders"))
    share = X.percent(F.col("orders"), total("orders"), 2)
    return by_status.withColumn("pct_of_total", share).orderBy(F.desc("orders"), "order_status")


def date_range(orders: DataFrame) -> DataFrame:
    moment = "order_purchase_timestamp"
    return orders.agg(F.min(moment).alias("first_order"), F.max(moment).alias("last_order"))


def monthly_orders(orders: DataFrame) -> DataFrame:
    """Grouped by the month's first day; only the finished groups are formatted."""
    return (
        orders.groupBy(X.month_start("order_purchase_timestamp").alias("month_day"))
        .agg(X.rows().alias("orders"))
        .select(X.month_text("month_day").alias("month"), "orders")
        .transform(in_order, "month")
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    missing: list[Column] = [
        (X.rows() - F.count(F.col(c))).alias(f"missing_{c}") for c in columns or df.columns
    ]
    return df.agg(*missing)


def describe_columns(df: DataFrame) -> DataFrame:
    """Name and type of every column with its number of known values, in one pass."""
    known = [F.count(F.col(c)).alias(c) for c in df.columns]
    described = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("column_type"), F.col(c).alias("known"))
        for c, t in df.dtypes
    ]
    return df.agg(*known).select(F.inline(F.array(*described)))


def delivered_without_date(orders: DataFrame) -> DataFrame:
    undated = (F.col("order_status") == "delivered") & F.col("order_delivered_customer_date").isNull()
    return orders.where(undated).agg(X.rows().alias("delivered_but_no_date"))


def customer_ids(customers: DataFrame) -> DataFrame:
    return distinct_counts(
        customers,
        unique_customer_id="customer_id",
        unique_customer_unique_id="customer_unique_id",
    )


def repeat_share(customers: DataFrame) -> DataFrame:
    """People with more than one order; their share of all people comes from the same groups."""
    per_person = customers.groupBy("customer_unique_id").agg(X.rows().alias("n"))
    repeat = F.count_if(F.col("n") > 1)
    people = F.count("customer_unique_id")
    return per_person.agg(
        repeat.alias("repeat_customers"), X.percent(repeat, people, 2).alias("pct_repeat")
    )


def review_duplicates(reviews: DataFrame) -> DataFrame:
    return distinct_counts(reviews, unique_reviews="review_id", unique_orders="order_id")


def multi_review_orders(reviews: DataFrame) -> DataFrame:
    per_order = reviews.groupBy("order_id").agg(X.rows().alias("n"))
    return per_order.agg(F.count_if(F.col("n") > 1).alias("orders_with_multiple_reviews"))


def geo_fanout(geolocation: DataFrame) -> DataFrame:
    zips = F.count_distinct("geolocation_zip_code_prefix")
    return geolocation.agg(
        X.rows().alias("total_rows"),
        zips.alias("unique_zip_prefixes"),
        X.rounded(X.ratio(X.rows(), zips), 1).alias("avg_rows_per_zip"),
    )


def geo_centroids(geolocation: DataFrame) -> DataFrame:
    """One mean point per zip prefix, which makes the table safe to join."""
    return (
        geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"))
        .agg(
            X.rows().alias("points"),
            X.rounded(F.avg("geolocation_lat"), 6).alias("lat"),
            X.rounded(F.avg("geolocation_lng"), 6).alias("lng"),
        )
    )


def missing_category(products: DataFrame) -> DataFrame:
    missing = X.rows() - F.count("product_category_name")
    return products.agg(missing.alias("products_missing_category"))


def untranslated(products: DataFrame, translation: DataFrame) -> DataFrame:
    names = products.select("product_category_name").where("product_category_name IS NOT NULL")
    return (
        names.distinct()
        .join(translation, "product_category_name", "left_anti")
        .select(F.col("product_category_name").alias("untranslated_category"))
    )


def orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The item side is reduced to distinct orders first, so a huge order is one row in the join."""
    return (
        orders.select("order_id", "order_status")
        .join(items.select("order_id").distinct(), "order_id", "left_anti")
        .groupBy("order_status")
        .agg(X.rows().alias("orders_without_items"))
        .transform(in_order, F.desc("orders_without_items"), "order_status")
    )


def payment_types(payments: DataFrame) -> DataFrame:
    by_type = payments.groupBy("payment_type").agg(X.rows().alias("payments"))
    return by_type.transform(in_order, F.desc("payments"), "payment_type")
