"""Every query against its SQL, on the smallest and the comparison scale."""

import sys

import pytest
from comparing import difference, open_oracle

import __spark_entry__ as contract
import oracle
from marketlens import catalogue
from marketlens.plans import delivery, hypothesis

SQL = oracle.statements()
QUERIES = catalogue.queries()
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return open_oracle(FOLDER)


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


@pytest.mark.parametrize("name", ["customer_rfm", "seller_scorecard", "cohort_long", "check_summary",
                                  "spearman_handling_late", "seller_concentration", "export_orders"])
def test_query_matches_sql_on_few_rows(spark, name):
    small = "/root/testdata/sf0.001"
    assert difference(QUERIES[name](spark, small), open_oracle(small), SQL[name]) is None


def test_entry_gives_twenty_months(spark):
    months = contract.entry(spark).collect()
    assert len(months) == 20
    assert months[0]["prev_month_revenue"] is None
    assert sys.modules["marketlens"]


def test_properties(spark):
    def rows(name):
        return QUERIES[name](spark, FOLDER).collect()

    segments = rows("rfm_segments")
    people = QUERIES["customer_rfm"](spark, FOLDER).count()
    assert sum(r.customers for r in segments) == people
    assert abs(sum(r.pct_customers for r in segments) - 100) < 0.5
    assert all(r.m00 == 100.0 for r in rows("cohort_retention"))
    u = rows("mannwhitney_review_late")[0]
    assert 0 <= u.u_stat <= u.late_n * u.on_time_n
    filled = rows("cohort_retention_filled")
    assert len(filled) == 19 * 12
    future = [r for r in filled if r.cohort == "2000-07" and r.month_number > 1]
    assert all(r.retention_pct is None for r in future)
    past = [r for r in filled if r.cohort == "1999-01" and r.month_number <= 12]
    assert all(r.retention_pct is not None for r in past)


def test_p_values(spark):
    f = catalogue.Frames(catalogue.warehouse(spark, FOLDER))
    sellers = delivery.established(f.scorecard, f.cfg)
    tests = {r.test: r for r in hypothesis.p_values(f.delivered, f.people, sellers).collect()}
    assert len(tests) == 6
    assert all(0 <= r.p_value <= 1 for r in tests.values())
    assert tests["welch_review_late"].p_value < 1e-6
