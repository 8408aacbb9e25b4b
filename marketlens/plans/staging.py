"""Staging layer: renamed, cleaned, one review per order. Narrow projections, except the dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings


def _lower_trim(name: str) -> Column:
    return F.lower(F.trim(name))


def _upper_trim(name: str) -> Column:
    return F.upper(F.trim(name))


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    return raw_customers.select(
        "customer_id",
        "customer_unique_id",
        F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        _lower_trim("customer_city").alias("city"),
        _upper_trim("customer_state").alias("state"),
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    renamed = {
        "order_purchase_timestamp": "purchased_at",
        "order_approved_at": "approved_at",
        "order_delivered_carrier_date": "shipped_at",
        "order_delivered_customer_date": "delivered_at",
        "order_estimated_delivery_date": "estimated_delivery_at",
    }
    return raw_orders.select(
        "order_id", "customer_id", "order_status", *[F.col(a).alias(b) for a, b in renamed.items()]
    )


def stg_order_items(raw_items: DataFrame) -> DataFrame:
    return raw_items.withColumnRenamed("shipping_limit_date", "shipping_limit_at")


def stg_payments(raw_payments: DataFrame) -> DataFrame:
    """Payments of a known type; a NULL type does not pass the comparison either."""
    return raw_payments.where(F.col("payment_type") != "not_defined")


def stg_products(raw_products: DataFrame, translation: DataFrame, settings: Settings) -> DataFrame:
    by_hand = F.lit(None).cast("string")
    for source, english in settings.hand_translations.items():
        by_hand = F.when(F.col("product_category_name") == source, english).otherwise(by_hand)
    return raw_products.join(translation, "product_category_name", "left").select(
        "product_id",
        F.coalesce("product_category_name_english", by_hand, F.lit("unknown")).alias("category"),
        F.col("product_name_lenght").alias("name_length"),
        F.col("product_description_lenght").alias("description_length"),
        F.col("product_photos_qty").alias("photos_qty"),
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"),
    )


def stg_reviews(raw_reviews: DataFrame) -> DataFrame:
    """Latest answered review per order as an aggregate, so each map task keeps one row per order.

    One aggregate per column, so that a reader of the score alone never moves the comments.
    """
    latest = F.struct("review_answer_timestamp", "review_id")
    columns = {
        "review_id": "review_id",
        "review_score": "review_score",
        "review_comment_message": "review_comment_message",
        "review_creation_date": "review_created_at",
        "review_answer_timestamp": "review_answered_at",
    }
    return raw_reviews.groupBy("order_id").agg(
        *[F.max_by(source, latest).alias(name) for source, name in columns.items()]
    )


def stg_sellers(raw_sellers: DataFrame) -> DataFrame:
    return raw_sellers.select(
        "seller_id",
        F.col("seller_zip_code_prefix").alias("zip_code_prefix"),
        _lower_trim("seller_city").alias("city"),
        _upper_trim("seller_state").alias("state"),
    )
