"""Repeat buying, cohorts and RFM. `orders` is the valid-orders frame."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import expressions as X
from ..operators.joins import side_by_side
from ..operators.shape import bin_index, in_order, spread, total

PERSON = "customer_unique_id"


def repeat_percent(orders_placed: Column, digits: int = 2) -> Column:
    return X.percent(F.count_if(orders_placed > 1), X.rows(), digits)


def orders_per_customer(orders: DataFrame) -> DataFrame:
    per_person = orders.groupBy(PERSON).agg(X.rows().alias("n"))
    label = F.when(F.col("n") >= 4, "4+").otherwise(F.col("n").cast("string"))
    groups = per_person.groupBy(label.alias("orders_placed")).agg(X.rows().alias("customers"))
    share = X.percent(F.col("customers"), total("customers"), 2)
    return groups.withColumn("pct_customers", share).orderBy("orders_placed")


def second_order_gap(orders: DataFrame) -> DataFrame:
    """Days from the first to the second order, where both are valid: one aggregation, no self-join."""
    number = F.col("customer_order_number")

    def moment(n: int) -> Column:
        return F.max(F.when(number == n, F.col("purchased_at")))

    return (
        orders.where(number.isin(1, 2))
        .groupBy(PERSON)
        .agg(moment(1).alias("first"), moment(2).alias("second"))
        .where("first IS NOT NULL AND second IS NOT NULL")
        .select(PERSON, X.days_between("first", "second").alias("days_to_second_order"))
    )


def repeat_summary(orders: DataFrame) -> DataFrame:
    days = F.col("days_to_second_order")
    gaps = second_order_gap(orders).agg(
        X.rows().alias("second_orders"),
        F.count_if(days == 0).alias("same_day"),
        F.count_if(days > 0).alias("true_repeats"),
        F.median(F.when(days > 0, days)).alias("median_days"),
    )
    people = orders.agg(F.count_distinct(PERSON).alias("customers"))
    return side_by_side(gaps, people).select(
        "customers",
        "second_orders",
        "same_day",
        "true_repeats",
        X.percent(F.col("second_orders"), F.col("customers"), 1).alias("pct_second"),
        X.percent(F.col("same_day"), F.col("second_orders"), 1).alias("pct_same_day"),
        X.percent(F.col("true_repeats"), F.col("customers"), 1).alias("pct_true_repeat"),
        F.col("median_days").cast("double").alias("median_days"),
    )


def gap_histogram(gaps: DataFrame, settings: Settings) -> DataFrame:
    """Equal bins of the gaps of genuine repeat buyers, empty bins included."""
    width, last_edge = settings.gap_bin_days, settings.gap_last_edge
    days = F.col("days_to_second_order")
    counted = (
        gaps.where(days > 0)
        .groupBy(bin_index(days, width, last_edge).alias("bin"))
        .agg(X.rows().alias("n"))
        .where("bin IS NOT NULL")
    )
    bins = gaps.sparkSession.range(last_edge // width).withColumnRenamed("id", "bin")
    return (
        bins.join(counted, "bin", "left")
        .select(
            (F.col("bin") * width).alias("from_day"),
            ((F.col("bin") + 1) * width).alias("to_day"),
            F.coalesce("n", F.lit(0)).alias("customers"),
        )
        .transform(in_order, "from_day")
    )


def cohort_counts(orders: DataFrame) -> DataFrame:
    """Distinct buyers per first-purchase month (its first day) and months since.

    A person's active months are a small set (bounded by the calendar), built with map-side combine,
    so a single exchange on the person serves both the cohort and the activity.
    """
    months = F.collect_set(X.month_start("purchased_at"))
    active = orders.groupBy(PERSON).agg(months.alias("months"))
    return (
        active.select(F.array_min("months").alias("first"), F.explode("months").alias("month"))
        .groupBy("first", "month")
        .agg(X.rows().alias("customers"))
        .select(
            "first",
            X.months_between_starts(F.col("first"), F.col("month")).alias("month_number"),
            "customers",
        )
    )


def cohort_long(orders: DataFrame) -> DataFrame:
    return (
        cohort_counts(orders)
        .select(X.month_text("first").alias("cohort"), "month_number", "customers")
        .transform(in_order, "cohort", "month_number")
    )


def _retained(cohorts: DataFrame) -> DataFrame:
    size = F.max(F.when(F.col("month_number") == 0, F.col("customers"))).over(W.partitionBy("first"))
    return cohorts.select(
        "first",
        "month_number",
        size.alias("cohort_size"),
        X.percent(F.col("customers"), size, 4).alias("retention_pct"),
    )


def cohort_retention(cohorts: DataFrame, settings: Settings) -> DataFrame:
    """Retention matrix; a month without buyers is NULL. The columns cover the analysis window."""
    start, end = settings.window_start, settings.window_end
    last = (end.year - start.year) * 12 + end.month - start.month - 1
    numbers = list(range(last + 1))
    grid = spread(_retained(cohorts), "first", "month_number", numbers, F.max("retention_pct"))
    named = [F.col(str(n)).alias(f"m{n:02d}") for n in numbers]
    return grid.select(X.month_text("first").alias("cohort"), *named).transform(in_order, "cohort")


def _month(text: str) -> Column:
    return X.date_lit(date.fromisoformat(f"{text}-01"))


def cohort_retention_filled(cohorts: DataFrame, settings: Settings) -> DataFrame:
    """Chosen cohorts by months 1..n: 0 for a month that has passed, NULL for one still to come."""
    chosen = F.col("first").between(_month(settings.cohort_first), _month(settings.cohort_last))
    by_number = F.collect_list(F.struct("month_number", "retention_pct"))
    grid = (
        _retained(cohorts)
        .where(chosen)
        .groupBy("first")
        .agg(F.max("cohort_size").alias("cohort_size"), F.map_from_entries(by_number).alias("seen"))
    )
    available = X.months_between_starts(F.col("first"), _month(settings.cohort_horizon))
    numbers = F.sequence(F.lit(1).cast("long"), F.lit(settings.cohort_months).cast("long"))
    seen = F.try_element_at("seen", F.col("month_number"))
    passed = F.col("month_number") <= available
    return (
        grid.select("*", F.explode(numbers).alias("month_number"))
        .select(
            X.month_text("first").alias("cohort"),
            "cohort_size",
            "month_number",
            F.coalesce(seen, F.when(passed, F.lit(0.0))).alias("retention_pct"),
        )
        .transform(in_order, "cohort", "month_number")
    )


def returned_within(orders: DataFrame, days: int, cohorts_before: date) -> DataFrame:
    """Per cohort: people, and the share with an order in (first + 1 day, first + `days` days].

    Orders are first reduced to one row per person and day. Both bounds of the interval share the
    clock time of the first order, so on the first day inside the interval only the latest order
    matters and on the last day only the earliest; every other day is wholly in or out.
    """
    if days < 2:
        raise ValueError("the interval after the first day is empty for fewer than two days")
    per_day = orders.groupBy(PERSON, F.col("purchased_at").cast("date").alias("day")).agg(
        F.min("purchased_at").alias("earliest"), F.max("purchased_at").alias("latest")
    )
    first = F.min("earliest").over(W.partitionBy(PERSON))
    came_back = (F.col("latest") > F.col("first_at") + F.expr("INTERVAL 1 DAY")) & (
        F.col("earliest") <= F.col("first_at") + F.make_dt_interval(F.lit(days))
    )
    people = (
        per_day.withColumn("first_at", first)
        .where(F.col("first_at") < X.ts_lit(cohorts_before))
        .groupBy(PERSON)
        .agg(F.min("first_at").alias("first_at"), F.bool_or(came_back).alias("returned"))
    )
    return (
        people.groupBy(X.month_start("first_at").alias("m"))
        .agg(X.rows().alias("customers"), F.count_if("returned").alias("n"))
        .select(
            X.month_text("m").alias("cohort"),
            "customers",
            X.percent(F.col("n"), F.col("customers"), 2).alias("pct_returned"),
        )
        .transform(in_order, "cohort")
    )


def mean_return_share(returned: DataFrame) -> DataFrame:
    """Unweighted mean over the cohorts."""
    return returned.agg(X.rounded(F.avg("pct_returned"), 4).alias("mean_pct_returned"))


def _first_orders(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("customer_order_number") == 1)


def _with_history(first_orders: DataFrame, people: DataFrame) -> DataFrame:
    return first_orders.join(people.select(PERSON, "total_orders"), PERSON)


def repeat_by_first_lateness(orders: DataFrame, people: DataFrame) -> DataFrame:
    first = _first_orders(orders).where("is_late IS NOT NULL").select(PERSON, "is_late")
    return (
        _with_history(first, people)
        .groupBy("is_late")
        .agg(X.rows().alias("customers"), repeat_percent(F.col("total_orders")).alias("repeat_rate_pct"))
    )


def repeat_by_first_category(
    orders: DataFrame, items: DataFrame, products: DataFrame, people: DataFrame, settings: Settings
) -> DataFrame:
    """Category of the first item of the first order. Counts per product go into the product join."""
    first_item = items.where(F.col("order_item_id") == 1).select("order_id", "product_id")
    buyers = _first_orders(orders).select("order_id", PERSON).join(first_item, "order_id")
    per_product = (
        _with_history(buyers, people)
        .groupBy("product_id")
        .agg(X.rows().alias("n"), F.count_if(F.col("total_orders") > 1).alias("r"))
    )
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            F.sum("n").alias("customers"),
            X.percent(F.sum("r"), F.sum("n"), 2).alias("repeat_rate_pct"),
        )
        .where(F.col("customers") >= settings.category_min_customers)
        .transform(in_order, F.desc("repeat_rate_pct"), "category")
    )


def overall_repeat_rate(people: DataFrame) -> DataFrame:
    return people.agg(repeat_percent(F.col("total_orders"), 4).alias("repeat_rate_pct"))


def rfm_score_check(rfm: DataFrame) -> DataFrame:
    """Spend per spend quintile; `customers` leaves out unknown spend."""
    return (
        rfm.groupBy("m_score")
        .agg(
            F.count("monetary").alias("customers"),
            X.rounded(F.min("monetary"), 1).alias("min_monetary"),
            X.rounded(F.max("monetary"), 1).alias("max_monetary"),
            X.rounded(X.mean_money("monetary"), 1).alias("mean_monetary"),
        )
        .transform(in_order, "m_score")
    )


def rfm_segments(rfm: DataFrame) -> DataFrame:
    segments = rfm.groupBy("segment").agg(
        X.rows().alias("customers"),
        X.sum_cents("monetary").alias("c"),
        X.rounded(X.mean_money("monetary"), 0).alias("avg_spend"),
        X.rounded(F.avg("recency_days"), 0).alias("avg_days_since_order"),
    )
    return segments.select(
        "segment",
        "customers",
        X.percent(F.col("customers"), total("customers"), 1).alias("pct_customers"),
        X.whole_units(F.col("c")).alias("revenue"),
        X.percent(F.col("c"), total("c"), 1).alias("pct_revenue"),
        "avg_spend",
        "avg_days_since_order",
    ).orderBy(F.desc_nulls_last("revenue"))
