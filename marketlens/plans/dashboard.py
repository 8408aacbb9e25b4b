"""Dashboard aggregates over the extracts. Frames come in already filtered by `apply_filters`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import expressions as X
from ..operators.bitmaps import distinct_keys, key_bitmaps
from ..operators.joins import side_by_side
from ..operators.ranking import counts_ahead
from ..operators.shape import in_order, total
from ..session import stash

# The action shown for each RFM segment.
SEGMENT_ACTIONS = {
    "Champions": "Reward & referral program",
    "Loyal (lapsing)": "Personalised win-back",
    "New big spenders": "Nurture toward a 2nd purchase",
    "New customers": "Welcome series",
    "Needs attention": "Reminder offers",
    "At risk: big spenders": "High-value win-back campaign",
    "Lost / one-off": "Low-cost or no spend",
}


def with_month(extract: DataFrame) -> DataFrame:
    return extract.withColumn("month", X.month_text("order_date"))


def filter_options(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The months and the known states a reader can choose from."""
    months = orders.select(X.month_start("order_date").alias("m")).distinct()
    states = orders.select("customer_state").where("customer_state IS NOT NULL").distinct()
    return months.select(X.month_text("m").alias("month")).orderBy("month"), states.orderBy(
        "customer_state"
    )


def apply_filters(
    extract: DataFrame,
    first_month: str | None = None,
    last_month: str | None = None,
    states: list[str] | None = None,
) -> DataFrame:
    """Months (yyyy-MM, inclusive) as date bounds and a state list, both pushed into the scan.

    No states means all of them. A frame without order dates (RFM) is filtered by state only.
    """
    if "order_date" in extract.columns:
        day = F.col("order_date")
        if first_month:
            extract = extract.where(day >= F.to_date(F.lit(first_month), "yyyy-MM"))
        if last_month:
            extract = extract.where(day < F.add_months(F.to_date(F.lit(last_month), "yyyy-MM"), 1))
    return extract.where(F.col("customer_state").isin(*states)) if states else extract


def _late(orders: DataFrame) -> DataFrame:
    return orders.where("is_late IS NOT NULL")


def people_by_month_and_state(orders: DataFrame) -> DataFrame:
    """The persons of each month and state as bitmaps; months by their first day, so filters apply."""
    months = orders.select(X.month_start("order_date").alias("order_date"), "customer_state", "customer_key")
    return key_bitmaps(months, "customer_key", "order_date", "customer_state")


def kpis(orders: DataFrame, people: DataFrame) -> DataFrame:
    """`people` holds the bitmaps of the same orders."""
    sums = orders.agg(
        X.sum_money("order_revenue").alias("revenue"),
        X.rows().alias("orders"),
        X.rounded(X.mean_money("order_revenue"), 2).alias("aov"),
        X.rounded(X.share_true("is_late") * 100.0, 1).alias("late_pct"),
        X.rounded(F.avg("review_score"), 2).alias("avg_review"),
    )
    return side_by_side(sums, distinct_keys(people, "customers")).select(
        "revenue", "orders", "customers", "aov", "late_pct", "avg_review"
    )


def monthly(orders: DataFrame) -> DataFrame:
    months = orders.groupBy(X.month_start("order_date").alias("m")).agg(
        X.sum_money("order_revenue").alias("revenue"), X.rows().alias("orders")
    )
    return months.select(
        X.month_text("m").alias("month"),
        "revenue",
        "orders",
        X.rounded(X.ratio(F.col("revenue"), F.col("orders")), 2).alias("aov"),
    ).transform(in_order, "month")


def top_categories(items: DataFrame) -> DataFrame:
    return (
        items.dropna(subset=["category"])
        .groupBy("category")
        .agg(X.sum_money("item_revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "category")
        .limit(10)
    )


def payment_share(orders: DataFrame) -> DataFrame:
    types = (
        orders.dropna(subset=["main_payment_type"])
        .groupBy("main_payment_type")
        .agg(X.rows().alias("orders"), X.rounded(X.mean_money("order_revenue"), 2).alias("aov"))
    )
    share = X.percent(F.col("orders"), total("orders"), 1)
    return types.withColumn("share", share).orderBy(F.desc("orders"), "main_payment_type")


def customer_kpis(orders: DataFrame, rfm: DataFrame) -> DataFrame:
    """Repeat share counts orders within the filter only."""
    per_person = orders.groupBy("customer_key").agg(
        X.rows().alias("n"), X.sum_cents("order_revenue").alias("c")
    )
    people = per_person.agg(
        X.percent(F.count_if(F.col("n") > 1), X.rows(), 1).alias("pct_ordered_twice"),
        X.rounded(X.ratio(X.money(F.sum("c")), X.rows()), 2).alias("revenue_per_customer"),
    )
    return side_by_side(people, rfm.agg(X.rows().alias("rfm_customers")))


def rfm_segments(rfm: DataFrame) -> DataFrame:
    segments = rfm.groupBy("segment").agg(
        X.rows().alias("customers"),
        X.sum_cents("monetary").alias("c"),
        X.rounded(X.mean_money("monetary"), 0).alias("avg_spend"),
        X.rounded(F.avg("recency_days"), 0).alias("avg_recency"),
    )
    action = F.create_map(*[F.lit(x) for pair in SEGMENT_ACTIONS.items() for x in pair])
    return segments.select(
        "segment",
        "customers",
        X.money(F.col("c")).alias("revenue"),
        X.percent(F.col("customers"), total("customers"), 1).alias("pct_customers"),
        X.percent(F.col("c"), total("c"), 1).alias("pct_revenue"),
        "avg_spend",
        "avg_recency",
        F.try_element_at(action, F.col("segment")).alias("action"),
    ).orderBy(F.desc_nulls_last("revenue"))


def top_states(orders: DataFrame, people: DataFrame) -> DataFrame:
    states = orders.dropna(subset=["customer_state"]).groupBy("customer_state")
    return (
        states.agg(X.sum_money("order_revenue").alias("revenue"))
        .join(distinct_keys(people, "customers", "customer_state"), "customer_state")
        .orderBy(F.desc_nulls_last("revenue"), "customer_state")
        .limit(10)
    )


def delivery_kpis(orders: DataFrame) -> DataFrame:
    def review(late: bool):
        return X.rounded(F.avg(F.when(F.col("is_late") == late, F.col("review_score"))), 2)

    return _late(orders).agg(
        X.rounded(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
        X.rounded(F.avg("days_vs_estimate"), 1).alias("avg_days_vs_estimate"),
        review(True).alias("review_late"),
        review(False).alias("review_on_time"),
    )


def late_monthly(orders: DataFrame, settings: Settings) -> DataFrame:
    """The alert compares the unrounded rate."""
    months = (
        _late(orders)
        .groupBy(X.month_start("order_date").alias("m"))
        .agg((X.share_true("is_late") * 100.0).alias("pct"))
    )
    return months.select(
        X.month_text("m").alias("month"),
        X.rounded(F.col("pct"), 1).alias("late_pct"),
        (F.col("pct") > settings.late_alert_pct).alias("above_alert"),
    ).transform(in_order, "month")


def review_by_arrival(orders: DataFrame) -> DataFrame:
    """Right-closed bins over (-1000, 1000]; arrivals outside are left out."""
    days = F.col("days_vs_estimate")
    # The report's bin edges and labels.
    arrival = X.ladder(
        (days <= -10, "10+ days early"),
        (days <= -1, "1-9 days early"),
        (days <= 0, "on the day"),
        (days <= 3, "1-3 days late"),
        (days <= 7, "4-7 days late"),
        (days <= 1000, "8+ days late"),
    )
    return (
        _late(orders)
        .where("review_score IS NOT NULL")
        .where((days > -1000) & (days <= 1000))
        .groupBy(arrival.alias("arrival"))
        .agg(
            X.rounded(F.avg("review_score"), 2).alias("avg_review"),
            X.rows().alias("orders"),
            F.min(days).alias("earliest"),
        )
        .transform(in_order, "earliest")
        .drop("earliest")
    )


def worst_states(orders: DataFrame, settings: Settings) -> DataFrame:
    return (
        _late(orders)
        .dropna(subset=["customer_state"])
        .groupBy("customer_state")
        .agg(
            X.rounded(X.share_true("is_late") * 100.0, 4).alias("late_pct"),
            X.rows().alias("orders"),
            X.rounded(F.avg("delivery_days"), 1).alias("avg_days"),
        )
        .where(F.col("orders") >= settings.dashboard_late_min_orders)
        .orderBy(F.desc("late_pct"), "customer_state")
        .limit(10)
    )


def seller_kpis(sellers: DataFrame) -> DataFrame:
    """Sellers per flag, and the revenue share of the first tenth (rounded down) by revenue."""
    sellers = stash(sellers.select("revenue", "performance_flag"))
    tenth = sellers.count() // 10
    # Equal revenues share a level, so it doesn't matter which of them are in the first tenth.
    levels = counts_ahead(sellers, "revenue", descending=True)
    inside = F.greatest(F.lit(0), F.least("ties", F.lit(tenth) - F.col("ahead")))
    first = levels.agg(F.sum(X.cents("revenue") * inside).alias("first"))

    def flagged(flag: str):
        return F.count_if(F.col("performance_flag") == flag)

    totals = sellers.agg(
        X.rows().alias("sellers"),
        flagged("Good").alias("good"),
        flagged("Underperforming").alias("underperforming"),
        flagged("Low volume").alias("low_volume"),
        X.sum_cents("revenue").alias("total"),
    )
    both = side_by_side(totals, first)
    top = X.percent(F.coalesce("first", F.lit(0)), F.col("total"), 2).alias("top_tenth_revenue_pct")
    return both.select("sellers", "good", "underperforming", "low_volume", top)


def established(sellers: DataFrame) -> DataFrame:
    late = X.rounded(F.col("late_rate") * 100.0, 1)
    return sellers.where(F.col("performance_flag") != "Low volume").withColumn("late_pct", late)


def seller_table(sellers: DataFrame, flag: str | None = None) -> DataFrame:
    shown = sellers.where(F.col("performance_flag") == flag) if flag else sellers
    return shown.orderBy(F.desc("revenue"), "seller").select(
        "revenue_rank", "seller", "seller_state", "orders", "revenue", "avg_review", "late_rate",
        "avg_handling_days", "performance_flag",
    )
