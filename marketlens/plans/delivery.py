"""Delivery performance and sellers. `delivered` is the delivered-orders frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import expressions as X
from ..operators.ranking import ntiles
from ..operators.shape import in_order, total


def late_percent(digits: int = 1):
    return X.rounded(X.share_true("is_late") * 100.0, digits)


def delivery_kpis(delivered: DataFrame) -> DataFrame:
    """The median is exact; its state is one counter per distinct day count."""
    return delivered.agg(
        X.rows().alias("delivered_orders"),
        X.rounded(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
        F.median("delivery_days").cast("double").alias("median_delivery_days"),
        late_percent().alias("late_pct"),
        X.rounded(F.avg("days_vs_estimate"), 1).alias("avg_days_vs_estimate"),
    )


def delivery_stages(delivered: DataFrame) -> DataFrame:
    """Mean days per stage, leaving out orders handed over before they were approved."""

    def stage(start: str, end: str):
        return X.rounded(F.avg(X.hours_between(start, end)) / F.lit(24.0), 1)

    return delivered.where(F.col("shipped_at") >= F.col("approved_at")).agg(
        stage("purchased_at", "approved_at").alias("approval_days"),
        stage("approved_at", "shipped_at").alias("seller_handling_days"),
        stage("shipped_at", "delivered_at").alias("carrier_days"),
    )


def late_rate_monthly(delivered: DataFrame, settings: Settings) -> DataFrame:
    months = delivered.groupBy(X.month_start("order_date").alias("m")).agg(
        X.rows().alias("orders"), late_percent().alias("late_pct")
    )
    alert = F.col("late_pct") > settings.late_alert_pct
    return months.select(
        X.month_text("m").alias("month"), "orders", "late_pct", alert.alias("above_alert")
    ).transform(in_order, "month")


def late_rate_by_state(delivered: DataFrame, settings: Settings) -> DataFrame:
    return (
        delivered.groupBy(F.col("customer_state").alias("state"))
        .agg(
            X.rows().alias("orders"),
            X.rounded(F.avg("delivery_days"), 1).alias("avg_delivery_days"),
            late_percent().alias("late_pct"),
        )
        .where(F.col("orders") >= settings.late_min_orders)
        .transform(in_order, F.desc("late_pct"), "state")
    )


def review_by_arrival(delivered: DataFrame) -> DataFrame:
    days = F.col("days_vs_estimate")
    # The report's labels.
    arrival = X.ladder(
        (days <= -10, "1. 10+ days early"),
        (days <= -1, "2. 1-9 days early"),
        (days == 0, "3. on the day"),
        (days <= 3, "4. 1-3 days late"),
        (days <= 7, "5. 4-7 days late"),
        otherwise="6. 8+ days late",
    )
    bad = F.count_if(F.col("review_score") <= 2)
    return (
        delivered.where("review_score IS NOT NULL")
        .groupBy(arrival.alias("arrival"))
        .agg(
            X.rows().alias("orders"),
            X.rounded(F.avg("review_score"), 2).alias("avg_review"),
            X.percent(bad, X.rows(), 1).alias("pct_bad_reviews"),
        )
        .transform(in_order, "arrival")
    )


def seller_flag_summary(scorecard: DataFrame) -> DataFrame:
    flags = scorecard.groupBy("performance_flag").agg(
        X.rows().alias("sellers"),
        X.sum_cents("revenue").alias("c"),
        X.rounded(X.mean_fixed("avg_review", 2), 2).alias("avg_review"),
        X.rounded(X.mean_fixed("late_rate", 3) * 100.0, 1).alias("avg_late_pct"),
    )
    return flags.select(
        "performance_flag",
        "sellers",
        X.whole_units(F.col("c")).alias("revenue"),
        X.percent(F.col("c"), total("c"), 1).alias("pct_revenue"),
        "avg_review",
        "avg_late_pct",
    ).orderBy(F.desc("revenue"))


def seller_concentration(scorecard: DataFrame) -> DataFrame:
    """Revenue share of the first of ten equal groups of sellers by revenue."""
    order = [F.col("revenue").desc_nulls_last(), F.col("seller_id").asc()]
    sellers = scorecard.select("seller_id", "revenue")
    deciles = ntiles(sellers, [("decile", order, 10)], sellers.count())
    top = F.sum(F.when(F.col("decile") == 1, X.cents("revenue")))
    return deciles.agg(
        F.count_if(F.col("decile") == 1).alias("top_sellers"),
        X.percent(top, X.sum_cents("revenue"), 2).alias("top_revenue_pct"),
    )


def underperformers_top10(scorecard: DataFrame) -> DataFrame:
    return (
        scorecard.where(F.col("performance_flag") == "Underperforming")
        .orderBy(F.desc("revenue"), "seller_id")
        .limit(10)
        .select(
            "seller_id",
            "seller_state",
            "orders",
            X.whole_units(X.cents("revenue")).alias("revenue"),
            "avg_review",
            X.rounded(F.col("late_rate") * 100.0, 1).alias("late_pct"),
            "avg_handling_days",
        )
    )


def established(scorecard: DataFrame, settings: Settings) -> DataFrame:
    return scorecard.where(F.col("orders") >= settings.seller_min_orders)


def established_sellers(scorecard: DataFrame, settings: Settings) -> DataFrame:
    """Sellers with enough orders, and how many of them carry the same flag."""
    sellers = established(scorecard, settings)
    # At most one row per flag label.
    flags = sellers.groupBy("performance_flag").agg(X.rows().alias("sellers_with_flag"))
    return sellers.join(F.broadcast(flags), "performance_flag").select(
        "seller_id", "orders", "revenue", "avg_review",
        X.rounded(F.col("late_rate") * 100.0, 1).alias("late_pct"),
        "performance_flag", "sellers_with_flag",
    )
