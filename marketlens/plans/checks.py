"""The twelve data checks over the built tables, and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators.quality import Equal, Measure, Never, Rule, Table, Unique, compiled, offending


def rules() -> dict[str, list[Rule]]:
    """Check name -> its rules. Tables are named layer.table."""
    orders, items = "marts.fct_orders", "marts.fct_order_items"
    rows = F.count(F.lit(1))
    # Money that is not known cannot be shown to be right.
    negative = [F.coalesce(F.col(c) < 0, F.lit(True)) for c in ("price", "freight_value")]

    def kept(raw: str, fact: str) -> list[Rule]:
        return [Equal(Measure(raw, rows, "raw_rows"), Measure(fact, rows, "fct_rows"))]

    return {
        "chk_rfm_complete": [
            Unique("marts.customer_rfm", ("customer_unique_id",), F.count_if(F.col("segment").isNull()))
        ],
        "chk_customers_unique": [Unique("marts.dim_customers", ("customer_unique_id",))],
        "chk_items_no_rows_lost": kept("raw.order_items", items),
        "chk_orders_no_rows_lost": kept("raw.orders", orders),
        "chk_orders_unique": [Unique(orders, ("order_id",))],
        "chk_keys_not_null": [
            Never(orders, F.col("order_id").isNull() | F.col("customer_unique_id").isNull(), ("order_id",)),
            Never(items, F.col("product_id").isNull() | F.col("seller_id").isNull(), ("order_id",)),
        ],
        "chk_no_negative_money": [
            Never(items, negative[0] | negative[1], ("order_id", "price", "freight_value"))
        ],
        "chk_products_have_category": [
            Never("marts.dim_products", F.col("category").isNull(), ("product_id",))
        ],
        # Whole cents, so equal means equal.
        "chk_revenue_reconciles": [
            Equal(
                Measure(items, X.sum_money("item_revenue"), "items_total"),
                Measure(orders, X.sum_money("order_revenue"), "orders_total"),
            )
        ],
        "chk_review_range": [
            Never(orders, ~F.col("review_score").between(1, 5), ("order_id", "review_score"))
        ],
        "chk_scorecard_unique": [Unique("marts.seller_scorecard", ("seller_id",))],
        "chk_reviews_one_per_order": [Unique("staging.stg_reviews", ("order_id",))],
    }


def by_layer(raw, stg, mart) -> Table:
    """One function for tables named layer.table, from one per layer."""
    layers = {"raw": raw, "staging": stg, "marts": mart}

    def table(name: str) -> DataFrame:
        layer, _, short = name.partition(".")
        return layers[layer](short)

    return table


def all_checks(raw, stg, mart) -> dict[str, DataFrame]:
    """Check name -> the rows that break it."""
    table = by_layer(raw, stg, mart)
    return {name: offending(declared, table) for name, declared in rules().items()}


def run_checks(raw, stg, mart) -> DataFrame:
    """One row per check: the number of offending rows and one of them as JSON."""
    return compiled(rules(), by_layer(raw, stg, mart))


def check_summary(raw, stg, mart) -> DataFrame:
    return run_checks(raw, stg, mart).select(
        "check_name", "bad_rows", (F.col("bad_rows") == 0).alias("passed")
    )
