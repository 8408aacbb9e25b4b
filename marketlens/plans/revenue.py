"""Revenue and growth. `orders` is the valid-orders frame unless a name says otherwise."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import expressions as X
from ..operators.bitmaps import distinct_keys
from ..operators.joins import side_by_side
from ..operators.shape import in_order, spread, total


def headline_kpis(orders: DataFrame, people: DataFrame) -> DataFrame:
    """`people`: the bitmaps of the persons of these orders, by month and state."""
    sums = orders.agg(
        X.rows().alias("orders"),
        X.whole_units(X.sum_cents("order_revenue")).alias("revenue"),
        X.rounded(X.mean_money("order_revenue"), 2).alias("aov"),
        X.rounded(F.avg("item_count"), 2).alias("items_per_order"),
    )
    return side_by_side(sums, distinct_keys(people, "customers")).select(
        "orders", "revenue", "customers", "aov", "items_per_order"
    )


def monthly_trend(orders: DataFrame) -> DataFrame:
    """Windows run over one row per month, after the aggregation."""
    months = orders.groupBy(X.month_start("order_date").alias("m")).agg(
        X.rows().alias("orders"), X.sum_cents("order_revenue").alias("c")
    )
    chrono = W.orderBy("m")
    three = chrono.rowsBetween(-2, 0)
    revenue, before = X.money(F.col("c")), X.money(F.lag("c").over(chrono))
    trailing = X.ratio(X.money(F.sum("c").over(three)), F.count("c").over(three))
    return months.select(
        X.month_text("m").alias("month"),
        "orders",
        X.whole_units(F.col("c")).alias("revenue"),
        X.rounded(X.ratio(revenue, F.col("orders")), 2).alias("aov"),
        X.whole_units(F.lag("c").over(chrono)).alias("prev_month_revenue"),
        X.rounded((X.ratio(revenue, before) - 1.0) * 100.0, 1).alias("mom_growth_pct"),
        X.whole_units(F.sum("c").over(chrono)).alias("cumulative_revenue"),
        X.rounded(trailing, 0).alias("revenue_3m_avg"),
    ).orderBy("month")


def yoy_growth(orders: DataFrame, settings: Settings) -> DataFrame:
    """The same months of every year; growth is taken from the rounded revenue."""
    years = (
        orders.where(F.month("order_date") <= settings.compared_last_month)
        .groupBy(F.year("order_date").cast("long").alias("year"))
        .agg(
            X.rows().alias("orders"),
            X.whole_units(X.sum_cents("order_revenue")).alias("revenue"),
            X.rounded(X.mean_money("order_revenue"), 2).alias("aov"),
        )
    )
    growth = X.ratio(F.col("revenue"), F.lag("revenue").over(W.orderBy("year"))) - 1.0
    return years.withColumn("revenue_growth_pct", X.rounded(growth * 100.0, 1)).orderBy("year")


def _days(orders: DataFrame, settings: Settings) -> DataFrame:
    days = F.col("order_date").between(
        X.date_lit(settings.spike_start), X.date_lit(settings.spike_end)
    )
    return (
        orders.where(days)
        .groupBy("order_date")
        .agg(X.rows().alias("orders"), X.whole_units(X.sum_cents("order_revenue")).alias("revenue"))
    )


def daily_orders(orders: DataFrame, settings: Settings) -> DataFrame:
    return _days(orders, settings).transform(in_order, "order_date")


def demand_spike(orders: DataFrame, settings: Settings) -> DataFrame:
    """Mean day before the event, the busiest day (the first one if tied), and their ratio."""
    day = F.col("order_date")
    earliness = -F.unix_date(day)
    quiet = F.when(day < X.date_lit(settings.spike_baseline_end), F.col("orders"))
    found = _days(orders, settings).agg(
        F.avg(quiet).alias("baseline"),
        F.max_by(day, F.struct("orders", earliness)).alias("peak_date"),
        F.max("orders").alias("peak_orders"),
    )
    return found.select(
        X.rounded(F.col("baseline"), 2).alias("baseline_orders"),
        "peak_date",
        "peak_orders",
        X.rounded(X.ratio(F.col("peak_orders"), F.col("baseline")), 2).alias("peak_vs_baseline"),
    )


def weekday_hour_grid(orders: DataFrame) -> DataFrame:
    """Seven rows by 24 hour columns; a cell without orders is NULL."""
    cells = orders.groupBy(
        X.iso_weekday("purchased_at").alias("weekday"), F.hour("purchased_at").alias("hour")
    ).agg(X.rows().alias("n"))
    hours = list(range(24))
    grid = spread(cells, "weekday", "hour", hours, F.sum("n"))
    return grid.select("weekday", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours]).transform(in_order, "weekday")


def category_pareto(items: DataFrame, products: DataFrame, settings: Settings) -> DataFrame:
    """`items` is the valid-items frame. Sums per product go into the join, not single items."""
    first, second = settings.compared_years

    def in_months_of(year: int):
        same_months = F.month("order_date") <= settings.compared_last_month
        return F.when((F.year("order_date") == year) & same_months, X.cents("item_revenue"))

    per_product = items.groupBy("product_id").agg(
        X.sum_cents("item_revenue").alias("c"),
        F.sum(in_months_of(first)).alias("c1"),
        F.sum(in_months_of(second)).alias("c2"),
    )
    categories = (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("c").alias("c"), F.sum("c1").alias("c1"), F.sum("c2").alias("c2"))
    )
    by_size = W.orderBy(F.desc("c"))
    growth = X.ratio(X.money(F.col("c2")), X.money(F.col("c1"))) - 1.0
    # The running sum keeps the default RANGE frame: equal revenues move together.
    return categories.select(
        F.rank().over(by_size).cast("long").alias("rank"),
        "category",
        X.whole_units(F.col("c")).alias("revenue"),
        X.percent(F.col("c"), total("c"), 1).alias("share_pct"),
        X.percent(F.sum("c").over(by_size), total("c"), 1).alias("cumulative_share_pct"),
        X.rounded(growth * 100.0, 0).alias("yoy_growth_pct"),
    ).orderBy("rank", "category")


def categories_to_80pct(pareto: DataFrame) -> DataFrame:
    return pareto.agg(
        (F.count_if(F.col("cumulative_share_pct") < 80) + 1).alias("top_categories"),
        X.rows().alias("categories"),
    )


def state_revenue(orders: DataFrame, people: DataFrame) -> DataFrame:
    sums = orders.groupBy(F.col("customer_state").alias("state")).agg(X.sum_cents("order_revenue").alias("c"))
    persons = distinct_keys(people, "customers", "customer_state")
    states = sums.join(persons, F.col("state").eqNullSafe(F.col("customer_state")))
    each = X.ratio(X.money(F.col("c")), F.col("customers"))
    return states.select(
        "state",
        "customers",
        X.whole_units(F.col("c")).alias("revenue"),
        X.percent(F.col("c"), total("c"), 1).alias("share_pct"),
        X.rounded(each, 1).alias("revenue_per_customer"),
    ).orderBy(F.desc_nulls_last("revenue"), "state")


def payment_mix(orders: DataFrame) -> DataFrame:
    types = (
        orders.where("main_payment_type IS NOT NULL")
        .groupBy(F.col("main_payment_type").alias("payment_type"))
        .agg(
            X.rows().alias("orders"),
            X.rounded(X.mean_money("order_revenue"), 2).alias("aov"),
            X.rounded(F.avg("installments"), 1).alias("avg_installments"),
        )
    )
    return types.select(
        "payment_type",
        "orders",
        X.percent(F.col("orders"), total("orders"), 1).alias("share_pct"),
        "aov",
        "avg_installments",
    ).orderBy(F.desc("orders"), "payment_type")


def installment_buckets(orders: DataFrame) -> DataFrame:
    """Credit card orders by plan length; an unknown length falls into the last bucket."""
    n = F.col("installments")
    # The report's labels.
    bucket = X.ladder(
        (n <= 1, "1 (paid in full)"), (n <= 3, "2-3"), (n <= 6, "4-6"), otherwise="7-24"
    )
    return (
        orders.where(F.col("main_payment_type") == "credit_card")
        .groupBy(bucket.alias("bucket"))
        .agg(
            X.rows().alias("orders"),
            X.rounded(X.mean_money("order_revenue"), 2).alias("aov"),
            F.min(n).alias("shortest"),
        )
        .transform(in_order, F.asc_nulls_last("shortest"))
        .select(F.col("bucket").alias("installments"), "orders", "aov")
    )
