"""Star schema: two facts, four dimensions, customer RFM and the seller scorecard."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import expressions as X
from ..operators.joins import squash, squash_join
from ..operators.ranking import ntiles_by_levels, rank_by, running_in_segments
from ..session import stash


def _calendar_columns(day: Column) -> list[Column]:
    weekday = X.iso_weekday(day)
    return [
        day.alias("date"),
        F.year(day).cast("long").alias("year"),
        F.quarter(day).cast("long").alias("quarter"),
        F.month(day).cast("long").alias("month"),
        X.month_text(day).alias("year_month"),
        F.date_format(day, "MMM").alias("month_name"),
        weekday.alias("day_of_week"),
        F.date_format(day, "E").alias("day_name"),
        weekday.isin(6, 7).alias("is_weekend"),
    ]


def dim_date(orders: DataFrame, settings: Settings) -> DataFrame:
    """One row per day, both ends included: the days of the settings, or whole years around the orders."""
    first, last = F.min("purchased_at").cast("date"), F.max("purchased_at").cast("date")
    year_end = F.date_sub(F.add_months(F.trunc(last, "year"), 12), 1)
    start, end = settings.calendar_start, settings.calendar_end
    span = orders.agg(
        (X.date_lit(start) if start else F.trunc(first, "year")).alias("start"),
        (X.date_lit(end) if end else year_end).alias("end"),
    )
    days = span.select(F.explode(F.sequence("start", "end", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return days.select(*_calendar_columns(F.col("day")))


def _with_person(orders: DataFrame, customers: DataFrame) -> DataFrame:
    people = customers.select("customer_id", "customer_unique_id", "city", "state")
    return orders.join(people, "customer_id")


def dim_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per person with the place of the latest order: a single aggregation, no self-join.

    Orders are unique by key (a check of the build), so counting them needs no second exchange.
    """
    latest = F.max_by(F.struct("city", "state"), F.struct("purchased_at", "order_id"))
    return (
        _with_person(orders.select("order_id", "customer_id", "purchased_at"), customers)
        .groupBy("customer_unique_id")
        .agg(
            latest.alias("place"),
            F.min("purchased_at").alias("first_order_at"),
            F.max("purchased_at").alias("last_order_at"),
            F.count("order_id").alias("total_orders"),
        )
        .select(
            "customer_unique_id", "place.city", "place.state", "first_order_at", "last_order_at",
            "total_orders", (F.col("total_orders") > 1).alias("is_repeat_customer"),
        )
    )


def dim_products(products: DataFrame) -> DataFrame:
    volume = F.col("length_cm").cast("long") * F.col("height_cm") * F.col("width_cm")
    return products.select(
        "product_id", "category", "weight_g", volume.alias("volume_cm3"), "photos_qty"
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "city", "state")


def fct_order_items(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per item sold. The order and person keys are joined first, so items shuffle once."""
    order_facts = _with_person(
        orders.select("order_id", "customer_id", "order_status", "purchased_at"), customers
    ).select("order_id", "customer_unique_id", "order_status", "purchased_at")
    return items.join(order_facts, "order_id").select(
        "order_id", "order_item_id", "product_id", "seller_id", "customer_unique_id",
        "order_status", "purchased_at", F.col("purchased_at").cast("date").alias("order_date"),
        "price", "freight_value",
        X.money(X.cents("price") + X.cents("freight_value")).alias("item_revenue"),
    )


def order_item_rollup(items: DataFrame) -> DataFrame:
    return squash(
        items,
        "order_id",
        F.count(F.lit(1)).alias("item_count"),
        # A set of one order's sellers is small, and unlike a distinct count needs one exchange.
        F.size(F.collect_set("seller_id")).cast("long").alias("seller_count"),
        X.sum_money("price").alias("items_value"),
        X.sum_money("freight_value").alias("freight_value"),
    )


def order_payment_rollup(payments: DataFrame) -> DataFrame:
    """Paid total, longest plan, and the type of the largest payment (first one if tied)."""
    size = F.struct("payment_value", -F.col("payment_sequential"))
    return squash(
        payments,
        "order_id",
        X.sum_money("payment_value").alias("payment_value"),
        F.max("payment_installments").cast("long").alias("installments"),
        F.max_by("payment_type", size).alias("main_payment_type"),
    )


def customer_order_numbers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with person, state and the running number of the order within the person, over all
    orders: a segmented scan, so no person has to fit one task."""
    joined = _with_person(orders, customers).drop("customer_id", "city")
    order = [F.col("purchased_at").asc_nulls_last(), F.col("order_id").asc()]
    numbered = running_in_segments(joined.withColumnRenamed("state", "customer_state"), ["customer_unique_id"], order, "_before")
    return numbered.withColumn("customer_order_number", F.col("_before") + 1).drop("_before")


def delivery_columns() -> dict[str, Column]:
    """NULL unless the order is delivered and has a delivery date."""
    delivered = (F.col("order_status") == "delivered") & F.col("delivered_at").isNotNull()
    late_by = X.days_between("estimated_delivery_at", "delivered_at")
    return {
        "delivery_days": F.when(delivered, X.days_between("purchased_at", "delivered_at")),
        "days_vs_estimate": F.when(delivered, late_by),
        "is_late": F.when(delivered, late_by > 0),
    }


def delivery_metrics(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", *[c.alias(name) for name, c in delivery_columns().items()])


def in_window(settings: Settings) -> Column:
    moment = F.col("purchased_at")
    return (moment >= X.ts_lit(settings.window_start)) & (moment < X.ts_lit(settings.window_end))


def fct_orders(
    orders: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    settings: Settings,
) -> DataFrame:
    """One row per order: items, payments and reviews are squashed to the order before the joins."""
    wide = squash_join(
        customer_order_numbers(orders, customers),
        "order_id",
        order_item_rollup(items),
        order_payment_rollup(payments),
        reviews.select("order_id", "review_score"),
    )
    revenue = X.money(X.cents("items_value") + X.cents("freight_value"))
    delivery = delivery_columns()
    return wide.select(
        "order_id", "customer_unique_id", "customer_state", "order_status", "purchased_at",
        F.col("purchased_at").cast("date").alias("order_date"),
        "approved_at", "shipped_at", "delivered_at", "estimated_delivery_at",
        "customer_order_number",
        F.coalesce("item_count", F.lit(0)).cast("long").alias("item_count"),
        "seller_count", "items_value", "freight_value", revenue.alias("order_revenue"),
        "payment_value", "main_payment_type", "installments",
        *[column.alias(name) for name, column in delivery.items()],
        "review_score",
        in_window(settings).alias("in_analysis_window"),
    )


def _inside(df: DataFrame, settings: Settings) -> Column:
    """Window bounds on the order date, in a form that lets the Parquet scan skip row groups, and on
    the month a table may be partitioned by."""
    day = F.col("order_date")
    inside = (day >= X.date_lit(settings.window_start)) & (day < X.date_lit(settings.window_end))
    if "order_month" in df.columns:
        last_day = settings.window_end - timedelta(days=1)
        inside &= F.col("order_month").between(
            settings.window_start.isoformat()[:7], last_day.isoformat()[:7]
        )
    return inside


def valid_orders(orders: DataFrame, settings: Settings) -> DataFrame:
    """Orders inside the window that were neither canceled nor unavailable."""
    return orders.where(
        F.col("in_analysis_window")
        & _inside(orders, settings)
        & ~F.col("order_status").isin(*settings.excluded_statuses)
    )


def delivered_orders(orders: DataFrame, settings: Settings) -> DataFrame:
    """Orders inside the window that were delivered on a known date."""
    return orders.where(
        F.col("in_analysis_window")
        & _inside(orders, settings)
        & (F.col("order_status") == "delivered")
        & F.col("delivered_at").isNotNull()
    )


def valid_items(items: DataFrame, settings: Settings) -> DataFrame:
    return items.where(
        _inside(items, settings) & ~F.col("order_status").isin(*settings.excluded_statuses)
    )


def rfm_scores(orders: DataFrame, settings: Settings) -> DataFrame:
    """Recency, frequency, spend per person of the valid orders, with quintiles of the first and
    last. A person with unknown spend sorts last and so lands in the top spend quintile."""
    recency = F.datediff(X.date_lit(settings.rfm_reference), F.max("purchased_at"))
    base = (
        valid_orders(orders, settings)
        .groupBy("customer_unique_id")
        .agg(
            recency.cast("long").alias("recency_days"),
            F.count(F.lit(1)).alias("frequency"),
            X.sum_money("order_revenue").alias("monetary"),
        )
    )
    return ntiles_by_levels(
        stash(base, "buyers"),
        [("r_score", "recency_days", True, 5), ("m_score", "monetary", False, 5)],
        "customer_unique_id",
    )


def customer_rfm(orders: DataFrame, settings: Settings) -> DataFrame:
    repeat = F.col("frequency") >= 2
    recent, old = F.col("r_score") >= 4, F.col("r_score") <= 2
    big = F.col("m_score") >= 4
    # The published segment names.
    segment = X.ladder(
        (repeat & recent, "Champions"),
        (repeat, "Loyal (lapsing)"),
        (recent & big, "New big spenders"),
        (recent, "New customers"),
        (old & big, "At risk: big spenders"),
        (old, "Lost / one-off"),
        otherwise="Needs attention",
    )
    return rfm_scores(orders, settings).withColumn("segment", segment)


def seller_orders(items: DataFrame, orders: DataFrame, settings: Settings) -> DataFrame:
    """One row per seller and order. The join leaves rows hashed by order, so the aggregation
    needs no further exchange."""
    facts = valid_orders(orders, settings).select(
        "order_id", "review_score", "is_late",
        X.hours_between("approved_at", "shipped_at").alias("handling_hours"),
    )
    return (
        # An item carries its order's date and status, so the same window prunes its scan.
        valid_items(items, settings)
        .select("order_id", "seller_id", "item_revenue")
        .join(facts, "order_id")
        .groupBy("seller_id", "order_id")
        .agg(
            X.sum_money("item_revenue").alias("revenue"),
            F.max("review_score").alias("review_score"),
            F.max(F.col("is_late").cast("int")).alias("is_late"),
            (F.max("handling_hours") / F.lit(24.0)).alias("handling_days"),
        )
    )


def seller_scorecard(
    items: DataFrame, orders: DataFrame, sellers: DataFrame, settings: Settings
) -> DataFrame:
    """KPIs per seller. Rank and flag are taken from the rounded KPIs."""
    # Whole hours sum exactly; the mean of hours / 24 is taken from the sum.
    hours = F.rint(F.col("handling_days") * 24)
    kpis = (
        seller_orders(items, orders, settings)
        .groupBy("seller_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            X.sum_money("revenue").alias("revenue"),
            X.rounded(F.avg("review_score"), 2).alias("avg_review"),
            X.rounded(F.avg("is_late"), 3).alias("late_rate"),
            X.rounded(F.avg(hours) / F.lit(24.0), 1).alias("avg_handling_days"),
        )
    )
    ranked = rank_by(
        kpis.join(sellers.select("seller_id", F.col("state").alias("seller_state")), "seller_id"),
        "revenue",
        "revenue_rank",
        descending=True,
    )
    # The published flag names.
    flag = X.ladder(
        (F.col("orders") < settings.seller_min_orders, "Low volume"),
        (
            (F.col("late_rate") > settings.seller_late_limit)
            | (F.col("avg_review") < settings.seller_review_limit),
            "Underperforming",
        ),
        otherwise="Good",
    )
    return ranked.select(
        "seller_id", "seller_state", "orders", "revenue", "avg_review", "late_rate",
        "avg_handling_days", "revenue_rank", flag.alias("performance_flag"),
    )
