"""Narrow extracts the dashboard aggregates read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..operators.ranking import dense_rank_by
from .marts import valid_items, valid_orders


def export_orders(orders: DataFrame, settings: Settings) -> DataFrame:
    """Valid orders; persons appear only as their rank, so no id is published."""
    keyed = dense_rank_by(valid_orders(orders, settings), "customer_unique_id", "customer_key")
    return keyed.select(
        "customer_key", "customer_state", "order_status", "order_date", "order_revenue",
        "item_count", "main_payment_type", "installments", "delivery_days", "days_vs_estimate",
        "is_late", "review_score", "customer_order_number",
    )


def export_items(
    items: DataFrame, products: DataFrame, sellers: DataFrame, people: DataFrame, settings: Settings
) -> DataFrame:
    return (
        valid_items(items, settings)
        .select("order_date", "product_id", "seller_id", "customer_unique_id", "item_revenue")
        .join(products.select("product_id", "category"), "product_id")
        .join(sellers.select("seller_id", F.col("state").alias("seller_state")), "seller_id")
        .join(
            people.select("customer_unique_id", F.col("state").alias("customer_state")),
            "customer_unique_id",
        )
        .select("order_date", "customer_state", "category", "seller_state", "item_revenue")
    )


def export_rfm(rfm: DataFrame, people: DataFrame) -> DataFrame:
    states = people.select("customer_unique_id", F.col("state").alias("customer_state"))
    return rfm.join(states, "customer_unique_id").drop("customer_unique_id")


def export_sellers(scorecard: DataFrame) -> DataFrame:
    prefix = F.left(F.col("seller_id").cast("string"), F.lit(8))
    return scorecard.select(prefix.alias("seller"), *scorecard.columns[1:])
