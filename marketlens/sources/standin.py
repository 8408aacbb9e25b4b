"""The nine raw marketplace tables derived from the generic test tables.

The values are invented by integer arithmetic on keys. They exercise every edge the analyses handle
(repeat buyers, split payments, duplicate reviews, late and undated deliveries ...).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import number_in_group


# Derived with a join or a window; the others are projections of one table.
DERIVED = ("customers", "orders", "order_items")


def standin_sources(spark: SparkSession, folder: str) -> dict[str, Callable[[], DataFrame]]:
    def base(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return {
        "customers": lambda: customers(base("orders"), base("customer"), base("nation")),
        "geolocation": lambda: geolocation(base("customer"), base("nation")),
        "order_items": lambda: order_items(base("lineitem")),
        "order_payments": lambda: order_payments(base("orders")),
        "order_reviews": lambda: order_reviews(base("orders")),
        "orders": lambda: orders(base("orders")),
        "products": lambda: products(base("part")),
        "sellers": lambda: sellers(base("supplier"), base("nation")),
        "category_translation": lambda: category_translation(base("part")),
    }


def _interval(count: Column, unit: str) -> Column:
    return F.make_dt_interval(**{unit: count.cast("int")})


def _with_source_order(orders: DataFrame) -> DataFrame:
    """Each order with the person and date it takes over: its own, or those of the order before for
    every 40th key. Only those keys need the self-join, so only 1/40 of the rows is shuffled."""
    own = orders.where("o_orderkey % 40 <> 1").select(
        "o_orderkey", F.col("o_orderkey").alias("b_orderkey"), "o_custkey", "o_orderdate"
    )
    follower = orders.where("o_orderkey % 40 = 1").select("o_orderkey")
    leader = orders.where("o_orderkey % 40 = 0").select(
        F.col("o_orderkey").alias("b_orderkey"), "o_custkey", "o_orderdate"
    )
    copied = follower.join(leader, F.expr("o_orderkey - 1 = b_orderkey"))
    return own.unionByName(copied)


def customers(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    return (
        _with_source_order(orders.select("o_orderkey", "o_custkey", "o_orderdate"))
        .join(customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
        .join(nation, F.expr("c_nationkey = n_nationkey"))
        .select(
            F.col("o_orderkey").alias("customer_id"),
            F.expr("o_custkey * 8 + b_orderkey % 8").alias("customer_unique_id"),
            F.col("c_nationkey").alias("customer_zip_code_prefix"),
            F.concat(F.lit(" "), "c_mktsegment", F.lit(" ")).alias("customer_city"),
            F.lower("n_name").alias("customer_state"),
        )
    )


def orders(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    status = (
        F.when(key % 101 == 7, "canceled")
        .when(key % 103 == 9, "unavailable")
        .when(key % 67 == 11, "shipped")
        .otherwise("delivered")
    )
    clock = (
        _with_source_order(orders.select("o_orderkey", "o_custkey", "o_orderdate"))
        .withColumn("order_status", status)
        .withColumn("purchased", F.col("o_orderdate") + _interval(key * 7919 % 86400, "secs"))
        .withColumn(
            "approved",
            F.when(key % 611 != 3, F.col("purchased") + _interval(key * 31 % 40, "hours")),
        )
        .withColumn("shipped", F.col("approved") + _interval(key * 37 % 144 - 2, "hours"))
    )
    return clock.select(
        key.alias("order_id"),
        key.alias("customer_id"),
        "order_status",
        F.col("purchased").alias("order_purchase_timestamp"),
        F.col("approved").alias("order_approved_at"),
        F.when(F.col("order_status").isin("delivered", "shipped"), F.col("shipped")).alias(
            "order_delivered_carrier_date"
        ),
        F.when(
            (F.col("order_status") == "delivered") & (key % 1201 != 5),
            F.col("shipped") + _interval(24 + key * 53 % 480, "hours"),
        ).alias("order_delivered_customer_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 20 DAY")).alias("order_estimated_delivery_date"),
    )


def order_items(lineitem: DataFrame) -> DataFrame:
    """Lines that agree in all of these columns give rows that differ in nothing but their number, so no
    further column of theirs has to be moved and sorted to break the tie."""
    line = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]
    numbered = number_in_group(
        lineitem.select("l_orderkey", *line),
        ["l_orderkey"],
        F.floor(F.col("l_linenumber") / 1000),
        [F.col(c).asc() for c in line],
        "order_item_id",
    )
    return numbered.select(
        F.col("l_orderkey").alias("order_id"),
        "order_item_id",
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        ((F.col("l_quantity").cast("long") * 125).cast("double") / 100).alias("freight_value"),
    )


def order_payments(orders: DataFrame) -> DataFrame:
    """First and, for every 12th order, second payment; one scan instead of a union of two."""
    first = F.when(
        F.expr("o_orderkey % 1501 <> 2"),
        F.expr("""named_struct(
            'payment_sequential', 1,
            'payment_type', CASE WHEN o_orderkey % 2003 = 17 THEN 'not_defined'
                                 WHEN o_orderkey % 20 < 15 THEN 'credit_card'
                                 WHEN o_orderkey % 20 < 19 THEN 'boleto' ELSE 'debit_card' END,
            'payment_installments',
                CASE WHEN o_orderkey % 20 < 15 THEN 1 + o_orderkey * 7 % 10 ELSE 1L END,
            'payment_value', o_totalprice)"""),
    )
    second = F.when(
        F.expr("o_orderkey % 12 = 0"),
        F.expr("""named_struct(
            'payment_sequential', 2, 'payment_type', 'voucher', 'payment_installments', 1L,
            'payment_value', CAST(25 + o_orderkey % 50 AS DOUBLE))"""),
    )
    return (
        orders.select(F.col("o_orderkey").alias("order_id"), F.explode(F.array(first, second)).alias("p"))
        .where("p IS NOT NULL")
        .select("order_id", "p.*")
    )


def order_reviews(orders: DataFrame) -> DataFrame:
    """First and, for every 181st order, second review."""
    first = F.when(
        F.expr("o_orderkey % 131 <> 4"),
        F.expr("""named_struct(
            'review_id', o_orderkey * 2,
            'review_score',
                CASE WHEN o_orderkey * 31 % 40 + o_orderkey * 37 % 144 + o_orderkey * 53 % 480 > 456
                     THEN 1 + o_orderkey * 11 % 3 ELSE 3 + o_orderkey * 13 % 3 END,
            'review_comment_message', CASE WHEN o_orderkey % 3 = 0 THEN 'ok' END,
            'review_creation_date', o_orderdate + INTERVAL 26 DAY,
            'review_answer_timestamp',
                o_orderdate + make_dt_interval(CAST(27 + o_orderkey % 5 AS INT)))"""),
    )
    second = F.when(
        F.expr("o_orderkey % 181 = 0"),
        F.expr("""named_struct(
            'review_id', o_orderkey * 2 + 1,
            'review_score', 1 + o_orderkey % 5,
            'review_comment_message', CAST(NULL AS STRING),
            'review_creation_date', o_orderdate + INTERVAL 28 DAY,
            'review_answer_timestamp',
                o_orderdate + make_dt_interval(CAST(33 + o_orderkey % 5 AS INT)))"""),
    )
    return (
        orders.select(F.col("o_orderkey").alias("order_id"), F.explode(F.array(first, second)).alias("r"))
        .where("r IS NOT NULL")
        .select(
            "r.review_id", "order_id", "r.review_score", "r.review_comment_message",
            "r.review_creation_date", "r.review_answer_timestamp",
        )
    )


def _category() -> Column:
    return F.concat(F.lower("p_type"), F.lit("_"), F.split_part("p_name", F.lit(" "), F.lit(2)))


def products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 53 != 0, _category()).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        (F.length("p_name") * 7).alias("product_description_lenght"),
        F.expr("1 + p_partkey % 6").alias("product_photos_qty"),
        F.expr("CASE WHEN p_partkey % 997 <> 1 THEN p_size * 100 END").alias("product_weight_g"),
        F.expr("p_size + 10").alias("product_length_cm"),
        F.expr("p_size + 2").alias("product_height_cm"),
        F.expr("p_size + 6").alias("product_width_cm"),
    )


def sellers(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    return supplier.join(nation, F.expr("s_nationkey = n_nationkey")).select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_nationkey").alias("seller_zip_code_prefix"),
        F.expr("concat(' City', CAST(s_nationkey AS STRING), ' ')").alias("seller_city"),
        F.lower("n_name").alias("seller_state"),
    )


def category_translation(part: DataFrame) -> DataFrame:
    names = part.select(_category().alias("product_category_name")).distinct()
    return names.where(~F.col("product_category_name").isin("economy_ring", "promo_bolt")).select(
        "product_category_name",
        F.concat(F.lit("en_"), "product_category_name").alias("product_category_name_english"),
    )


def geolocation(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, F.expr("c_nationkey = n_nationkey")).select(
        F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
        (F.expr("c_custkey % 3000").cast("double") / 100 - 30).alias("geolocation_lat"),
        (F.expr("c_custkey * 7 % 2500").cast("double") / 100 - 60).alias("geolocation_lng"),
        F.lower("c_mktsegment").alias("geolocation_city"),
        F.col("n_name").alias("geolocation_state"),
    )
