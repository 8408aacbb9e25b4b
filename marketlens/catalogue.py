"""Every query by name, over the stand-in tables of a folder with the stand-in settings."""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .config import STANDIN
from .plans import checks, customers, dashboard, delivery, extracts, hypothesis, marts
from .plans import modelling, profiling, revenue
from .session import configure, counting_session, fingerprint, remove, size_shuffles
from .sources import catalog
from .sources.standin import DERIVED, standin_sources
from .warehouse import MARTS, STAGING, Warehouse

class Store(dict):
    """What has been written of one state of a folder: label -> (path, schema). Whoever may still read it
    holds it; once nobody does, its files are removed."""

    def __init__(self, spark: SparkSession, state: tuple):
        super().__init__()
        self.state = state
        self.paths: list[str] = []
        weakref.finalize(self, _removed, spark, self.paths).atexit = False

    def __setitem__(self, label: str, written: tuple) -> None:
        self.paths.append(written[0])
        super().__setitem__(label, written)


def _removed(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        remove(spark, path)


_stores: dict[tuple[str, str], Store] = {}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """The warehouse of a folder as it is now; its stored tables are shared by all queries of an application
    until a file of the folder changes."""
    size_shuffles(configure(spark), folder)
    key, state = (spark.sparkContext.applicationId, folder), fingerprint(spark, folder)
    if key not in _stores or _stores[key].state != state:
        _stores[key] = Store(spark, state)
    return Warehouse(spark, standin_sources(spark, folder), STANDIN, DERIVED, _stores[key])


class Frames:
    """The inputs the analyses are written against."""

    def __init__(self, w: Warehouse, folder: str = ""):
        self.folder = folder
        self.w, self.cfg, self.raw, self.stg, self.mart = w, w.settings, w.raw, w.stg, w.mart

    @property
    def counted(self) -> Warehouse:
        """The same tables, for counting their rows."""
        return warehouse(counting_session(self.w.spark), self.folder)

    @property
    def orders(self) -> DataFrame:
        return self.mart("fct_orders")

    @property
    def items(self) -> DataFrame:
        return self.mart("fct_order_items")

    @property
    def people(self) -> DataFrame:
        return self.mart("dim_customers")

    @property
    def products(self) -> DataFrame:
        return self.mart("dim_products")

    @property
    def scorecard(self) -> DataFrame:
        return self.mart("seller_scorecard")

    @property
    def valid(self) -> DataFrame:
        return marts.valid_orders(self.orders, self.cfg)

    @property
    def valid_items(self) -> DataFrame:
        return marts.valid_items(self.items, self.cfg)

    @property
    def delivered(self) -> DataFrame:
        return marts.delivered_orders(self.orders, self.cfg)

    def extract_model(self, name: str) -> DataFrame:
        match name:
            case "orders":
                return extracts.export_orders(self.orders, self.cfg)
            case "items":
                return extracts.export_items(
                    self.items, self.products, self.mart("dim_sellers"), self.people, self.cfg
                )
            case "rfm":
                return extracts.export_rfm(self.mart("customer_rfm"), self.people)
            case "sellers":
                return extracts.export_sellers(self.scorecard)
        raise KeyError(name)

    def extract(self, name: str) -> DataFrame:
        return self.w.stored(f"extracts.{name}", lambda: self.extract_model(name))

    @property
    def persons(self) -> DataFrame:
        """Bitmaps of the persons of the valid orders, by month and state."""
        orders = Frames.extract(self, "orders")
        return self.w.stored("extracts.persons", lambda: dashboard.people_by_month_and_state(orders))


class FilteredFrames(Frames):
    """The same, as a reader of the dashboard sees them who chose months and states. Buyers' segments
    have no month, so they follow the states only; sellers follow neither."""

    # A choice that the stand-in tables can answer.
    CHOICE = {
        "first_month": "1999-02",
        "last_month": "2000-07",
        "states": [f"NATION_{n}" for n in (2, 3, 7, 11, 12, 13, 15, 19)],
    }

    def extract(self, name: str) -> DataFrame:
        whole = super().extract(name)
        return whole if name == "sellers" else dashboard.apply_filters(whole, **self.CHOICE)

    @property
    def persons(self) -> DataFrame:
        return dashboard.apply_filters(super().persons, **self.CHOICE)


def _cohorts(f: Frames) -> DataFrame:
    return customers.cohort_counts(f.valid)


def _returned(f: Frames) -> DataFrame:
    return customers.returned_within(f.valid, f.cfg.return_days, f.cfg.return_cohorts_before)


PLANS: dict[str, Callable[[Frames], DataFrame]] = {
    # Catalog
    "load_summary": lambda f: catalog.table_sizes(f.counted.layers(("raw",))["raw"]),
    "layer_inventory": lambda f: catalog.layer_inventory(f.counted.layers()),
    "describe_orders": lambda f: profiling.describe_columns(f.raw("orders")),
    # Layers
    **{name: (lambda f, name=name: f.stg(name)) for name in STAGING},
    **{name: (lambda f, name=name: f.w.mart_model(name)) for name in MARTS},
    "order_item_rollup": lambda f: marts.order_item_rollup(f.stg("stg_order_items")),
    "order_payment_rollup": lambda f: marts.order_payment_rollup(f.stg("stg_payments")),
    "customer_order_number": lambda f: marts.customer_order_numbers(
        f.stg("stg_orders"), f.stg("stg_customers")
    ).select("order_id", "customer_unique_id", "customer_order_number"),
    "delivery_metrics": lambda f: marts.delivery_metrics(f.stg("stg_orders")),
    "analysis_window_flag": lambda f: f.w.mart_model("fct_orders").select(
        "order_id", "item_count", "order_revenue", "in_analysis_window"
    ),
    "seller_orders": lambda f: marts.seller_orders(f.items, f.orders, f.cfg),
    # Checks
    "check_summary": lambda f: checks.check_summary(f.raw, f.stg, f.mart),
    # Extracts
    "export_orders": lambda f: f.extract_model("orders"),
    "export_items": lambda f: f.extract_model("items"),
    "export_rfm": lambda f: f.extract_model("rfm"),
    "export_sellers": lambda f: f.extract_model("sellers"),
    # Profiling
    "profile_row_vs_distinct": lambda f: profiling.row_vs_distinct(f.raw("orders")),
    "profile_status_share": lambda f: profiling.status_share(f.raw("orders")),
    "profile_date_range": lambda f: profiling.date_range(f.raw("orders")),
    "profile_monthly_orders": lambda f: profiling.monthly_orders(f.raw("orders")),
    "profile_nulls": lambda f: profiling.null_counts(f.raw("orders")),
    "profile_delivered_no_date": lambda f: profiling.delivered_without_date(f.raw("orders")),
    "profile_customer_ids": lambda f: profiling.customer_ids(f.raw("customers")),
    "profile_repeat_share": lambda f: profiling.repeat_share(f.raw("customers")),
    "profile_review_dups": lambda f: profiling.review_duplicates(f.raw("order_reviews")),
    "profile_multi_review_orders": lambda f: profiling.multi_review_orders(f.raw("order_reviews")),
    "profile_geo_fanout": lambda f: profiling.geo_fanout(f.raw("geolocation")),
    "profile_missing_category": lambda f: profiling.missing_category(f.raw("products")),
    "profile_untranslated": lambda f: profiling.untranslated(
        f.raw("products"), f.raw("category_translation")
    ),
    "profile_orders_without_items": lambda f: profiling.orders_without_items(
        f.raw("orders"), f.raw("order_items")
    ),
    "profile_payment_types": lambda f: profiling.payment_types(f.raw("order_payments")),
    "geo_centroids": lambda f: profiling.geo_centroids(f.raw("geolocation")),
    # Modelling
    "toy_inner_join": lambda f: modelling.calendar_orders(
        f.w.mart_model("dim_date"), f.stg("stg_orders"), keep_unmatched=False
    ),
    "toy_left_join": lambda f: modelling.calendar_orders(
        f.w.mart_model("dim_date"), f.stg("stg_orders"), keep_unmatched=True
    ),
    "orders_with_person": lambda f: modelling.orders_with_person(
        f.stg("stg_orders"), f.stg("stg_customers")
    ),
    "fanout_probe": lambda f: modelling.fanout_probe(
        f.stg("stg_orders"), f.stg("stg_order_items"), f.stg("stg_payments")
    ),
    "correct_revenue": lambda f: modelling.correct_revenue(f.orders),
    "state_aov_top5": lambda f: modelling.state_aov_top5(f.orders, f.cfg),
    "review_dedup_trace": lambda f: modelling.review_dedup_trace(f.raw("order_reviews")),
    "delivery_speed_buckets": lambda f: modelling.delivery_speed_buckets(f.orders),
    "top_categories_delivered": lambda f: modelling.top_categories_delivered(f.items, f.products),
    "late_vs_on_time": lambda f: modelling.late_vs_on_time(f.orders),
    # Revenue
    "headline_kpis": lambda f: revenue.headline_kpis(f.valid, f.persons),
    "monthly_trend": lambda f: revenue.monthly_trend(f.valid),
    "yoy_growth": lambda f: revenue.yoy_growth(f.valid, f.cfg),
    "daily_orders": lambda f: revenue.daily_orders(f.valid, f.cfg),
    "demand_spike": lambda f: revenue.demand_spike(f.valid, f.cfg),
    "weekday_hour_grid": lambda f: revenue.weekday_hour_grid(f.valid),
    "category_pareto": lambda f: revenue.category_pareto(f.valid_items, f.products, f.cfg),
    "categories_to_80pct": lambda f: revenue.categories_to_80pct(
        revenue.category_pareto(f.valid_items, f.products, f.cfg)
    ),
    "state_revenue": lambda f: revenue.state_revenue(f.valid, f.persons),
    "payment_mix": lambda f: revenue.payment_mix(f.valid),
    "installment_buckets": lambda f: revenue.installment_buckets(f.valid),
    # Customers
    "orders_per_customer": lambda f: customers.orders_per_customer(f.valid),
    "second_order_gap": lambda f: customers.second_order_gap(f.valid),
    "repeat_summary": lambda f: customers.repeat_summary(f.valid),
    "gap_histogram": lambda f: customers.gap_histogram(customers.second_order_gap(f.valid), f.cfg),
    "cohort_long": lambda f: customers.cohort_long(f.valid),
    "cohort_retention": lambda f: customers.cohort_retention(_cohorts(f), f.cfg),
    "cohort_retention_filled": lambda f: customers.cohort_retention_filled(_cohorts(f), f.cfg),
    "returned_within_180d": _returned,
    "returned_within_180d_mean": lambda f: customers.mean_return_share(_returned(f)),
    "repeat_by_first_lateness": lambda f: customers.repeat_by_first_lateness(f.valid, f.people),
    "repeat_by_first_category": lambda f: customers.repeat_by_first_category(
        f.valid, f.valid_items, f.products, f.people, f.cfg
    ),
    "overall_repeat_rate": lambda f: customers.overall_repeat_rate(f.people),
    "rfm_scores": lambda f: marts.rfm_scores(f.orders, f.cfg),
    "rfm_score_check": lambda f: customers.rfm_score_check(f.mart("customer_rfm")),
    "rfm_segments": lambda f: customers.rfm_segments(f.mart("customer_rfm")),
    # Delivery and sellers
    "delivery_kpis": lambda f: delivery.delivery_kpis(f.delivered),
    "delivery_stages": lambda f: delivery.delivery_stages(f.delivered),
    "late_rate_monthly": lambda f: delivery.late_rate_monthly(f.delivered, f.cfg),
    "late_rate_by_state": lambda f: delivery.late_rate_by_state(f.delivered, f.cfg),
    "review_by_arrival": lambda f: delivery.review_by_arrival(f.delivered),
    "seller_flag_summary": lambda f: delivery.seller_flag_summary(f.scorecard),
    "seller_concentration": lambda f: delivery.seller_concentration(f.scorecard),
    "underperformers_top10": lambda f: delivery.underperformers_top10(f.scorecard),
    "established_sellers": lambda f: delivery.established_sellers(f.scorecard, f.cfg),
    # Statistical tests
    "welch_review_late": lambda f: hypothesis.welch_review_late(f.delivered),
    "cohens_d": lambda f: hypothesis.cohens_d(f.delivered),
    "mannwhitney_review_late": lambda f: hypothesis.mannwhitney_review_late(f.delivered),
    "late_repeat_crosstab": lambda f: hypothesis.late_repeat_crosstab(f.delivered, f.people),
    "chi2_late_repeat": lambda f: hypothesis.chi2_late_repeat(
        hypothesis.late_repeat_crosstab(f.delivered, f.people)
    ),
    "spearman_delivery_review": lambda f: hypothesis.spearman_delivery_review(f.delivered),
    "spearman_handling_late": lambda f: hypothesis.spearman_handling_late(
        delivery.established(f.scorecard, f.cfg)
    ),
    # Dashboard
    "dash_kpis": lambda f: dashboard.kpis(f.extract("orders"), f.persons),
    "dash_monthly": lambda f: dashboard.monthly(f.extract("orders")),
    "dash_top_categories": lambda f: dashboard.top_categories(f.extract("items")),
    "dash_payment_share": lambda f: dashboard.payment_share(f.extract("orders")),
    "dash_customer_kpis": lambda f: dashboard.customer_kpis(f.extract("orders"), f.extract("rfm")),
    "dash_rfm_segments": lambda f: dashboard.rfm_segments(f.extract("rfm")),
    "dash_top_states": lambda f: dashboard.top_states(f.extract("orders"), f.persons),
    "dash_delivery_kpis": lambda f: dashboard.delivery_kpis(f.extract("orders")),
    "dash_late_monthly": lambda f: dashboard.late_monthly(f.extract("orders"), f.cfg),
    "dash_review_by_arrival": lambda f: dashboard.review_by_arrival(f.extract("orders")),
    "dash_worst_states": lambda f: dashboard.worst_states(f.extract("orders"), f.cfg),
    "dash_seller_kpis": lambda f: dashboard.seller_kpis(f.extract("sellers")),
    "dash_established": lambda f: dashboard.established(f.extract("sellers")),
    "dash_seller_table": lambda f: dashboard.seller_table(f.extract("sellers")),
    "dash_seller_table_underperforming": lambda f: dashboard.seller_table(
        f.extract("sellers"), "Underperforming"
    ),
    "dash_filter_months": lambda f: dashboard.filter_options(f.extract("orders"))[0],
    "dash_filter_states": lambda f: dashboard.filter_options(f.extract("orders"))[1],
}

FILTERED = {
    f"{name}_filtered": name
    for name in ("dash_kpis", "dash_monthly", "dash_top_categories", "dash_payment_share",
                 "dash_customer_kpis", "dash_rfm_segments", "dash_top_states", "dash_delivery_kpis",
                 "dash_late_monthly", "dash_review_by_arrival", "dash_worst_states")
}


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    plan, frames = (PLANS[FILTERED[name]], FilteredFrames) if name in FILTERED else (PLANS[name], Frames)
    tables = warehouse(spark, folder)
    result = plan(frames(tables, folder))
    result._reads = tables  # keeps the store as long as the result may be read
    return result


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, folder, name=name: run(name, spark, folder)) for name in [*PLANS, *FILTERED]}
