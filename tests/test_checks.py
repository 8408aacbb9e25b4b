"""Each check passes on the built tables and fires on a deliberately broken copy."""

import json
import re

import pytest
from pyspark.sql import functions as F

from marketlens import catalogue
from marketlens.plans import checks
from marketlens.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def w(spark) -> Warehouse:
    return catalogue.warehouse(spark, FOLDER)


def doubled(df):
    return df.unionByName(df.limit(1))


def with_first(df, key, column, value):
    """The value of one column replaced in the row with the lowest key."""
    lowest = df.agg(F.min(key)).collect()[0][0]
    return df.withColumn(
        column, F.when(F.col(key) == lowest, F.lit(value).cast(df.schema[column].dataType)).otherwise(F.col(column))
    )


BROKEN = {
    "chk_rfm_complete": ("customer_rfm", lambda d: with_first(d, "customer_unique_id", "segment", None)),
    "chk_customers_unique": ("dim_customers", doubled),
    "chk_items_no_rows_lost": ("fct_order_items", lambda d: d.where("order_item_id > 1")),
    "chk_orders_no_rows_lost": ("fct_orders", lambda d: d.where("item_count > 0")),
    "chk_orders_unique": ("fct_orders", doubled),
    "chk_keys_not_null": ("fct_order_items", lambda d: with_first(d, "order_id", "seller_id", None)),
    "chk_no_negative_money": ("fct_order_items", lambda d: with_first(d, "order_id", "freight_value", -1.0)),
    "chk_products_have_category": ("dim_products", lambda d: with_first(d, "product_id", "category", None)),
    "chk_revenue_reconciles": ("fct_orders", lambda d: with_first(d, "order_id", "order_revenue", 0.01)),
    "chk_review_range": ("fct_orders", lambda d: d.withColumn("review_score", F.lit(6))),
    "chk_scorecard_unique": ("seller_scorecard", doubled),
    "chk_reviews_one_per_order": ("stg_reviews", doubled),
}


def patched(get, table, breaking):
    return lambda t: breaking(get(t)) if t == table else get(t)


def test_all_pass(w):
    found = checks.run_checks(w.raw, w.stg, w.mart).collect()
    assert {r.check_name for r in found} == set(BROKEN)
    assert all(r.bad_rows == 0 and r.sample is None for r in found)


@pytest.mark.parametrize("name", BROKEN)
def test_check_fires(w, name):
    """The compiled summary and the rows themselves tell the same."""
    table, breaking = BROKEN[name]
    layers = w.raw, patched(w.stg, table, breaking), patched(w.mart, table, breaking)
    bad = checks.all_checks(*layers)[name].collect()
    row = {r.check_name: r for r in checks.run_checks(*layers).collect()}[name]
    assert row.bad_rows == len(bad) > 0 and row.sample.startswith("{")
    shown = json.loads(row.sample)
    assert set(shown) == set(bad[0].asDict())
    assert any(all(shown[k] == v or float(shown[k]) == float(v) for k, v in b.asDict().items()) for b in bad)


@pytest.mark.parametrize("column", ["price", "freight_value"])
def test_unknown_money_fires(w, column):
    def unknown(d):
        return with_first(d, "order_id", column, None)

    found = checks.run_checks(w.raw, w.stg, patched(w.mart, "fct_order_items", unknown)).collect()
    assert {r.check_name: r.bad_rows > 0 for r in found}["chk_no_negative_money"]


def test_each_table_is_read_once_and_once_per_key(w):
    plan = checks.run_checks(w.raw, w.stg, w.mart)._jdf.queryExecution().optimizedPlan().toString()
    scans = re.findall(r"Relation \[(.*?)\] parquet", re.sub(r"#\d+L?", "", plan))
    assert len(scans) == 9 + 1  # orders: once for their rules, once for their key
    assert len(set(scans)) == 9
