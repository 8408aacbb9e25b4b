"""Small hand-made cases for the semantics that are easy to get wrong."""

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marketlens.config import STANDIN
from marketlens.functions import distributions as D
from marketlens.functions import expressions as X
from marketlens.operators.shape import bin_index
from marketlens.plans import customers, dashboard, hypothesis, marts, modelling, revenue, staging


def one(df):
    return tuple(df.collect()[0])


def test_toy_joins(spark):
    people = spark.createDataFrame(
        [("Asha", "Chennai"), ("Ravi", "Mumbai"), ("Meera", "Delhi")], "customer string, city string"
    )
    orders = spark.createDataFrame(
        [(1, "Asha"), (2, "Asha"), (3, "Ravi"), (4, "Unknown person")], "order_id int, customer string"
    )
    inner = modelling.facts_of(people, orders, "customer", keep_unmatched=False).collect()
    left = modelling.facts_of(people, orders, "customer", keep_unmatched=True).collect()
    assert sorted(r.order_id for r in inner) == [1, 2, 3]
    assert len(left) == 4
    assert [r.customer for r in left if r.order_id is None] == ["Meera"]


def test_fan_out_is_probed_without_pairs(spark):
    orders = spark.createDataFrame([(1,)], "order_id int")
    items = spark.createDataFrame([(1, 10.0, 1.0), (1, 20.0, 2.0)], "order_id int, price double, freight_value double")
    payments = spark.createDataFrame([(1,), (1,)], "order_id int")
    probe = modelling.fanout_probe(orders, items.withColumn("price", F.col("price") * 1e6), payments)
    assert one(probe) == (4, 1, 60.0)


def test_boundaries_across_midnight(spark):
    df = spark.createDataFrame(
        [(datetime(2020, 1, 1, 23, 50), datetime(2020, 1, 2, 0, 10))], "a timestamp_ntz, b timestamp_ntz"
    )
    got = df.select(X.days_between("a", "b"), X.hours_between("a", "b"), X.hours_between("b", "a"))
    assert one(got) == (1, 1, -1)
    ends = df.select(X.months_between_starts(F.lit(date(2019, 11, 30)), F.col("b")))
    assert one(ends) == (2,)


@pytest.mark.parametrize("x, digits, want", [(1.005, 2, 1.01), (0.285, 2, 0.29), (-2.5, 0, -3.0), (None, 1, None)])
def test_rounding(spark, x, digits, want):
    df = spark.createDataFrame([(x,)], "x double")
    assert one(df.select(X.rounded(F.col("x"), digits))) == (want,)


def test_money_is_exact_in_any_order(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(19.99,), (None,)], "m double")
    assert one(df.agg(X.sum_money("m"), X.mean_money("m"))) == (20.99, 20.99 / 11)
    assert one(df.agg(X.whole_units(X.sum_cents("m")))) == (21.0,)


def test_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1, 0)], "a int, b int")
    got = df.select(X.ratio(F.col("a"), F.col("b")), X.percent(F.col("a"), F.col("b"), 1))
    assert one(got) == (None, None)


def test_latest_review_even_without_answer_time(spark):
    reviews = spark.createDataFrame(
        [
            (1, 10, 5, "old", None, datetime(2020, 1, 1)),
            (2, 10, 2, None, None, datetime(2020, 1, 2)),
            (3, 10, 4, "unanswered", None, None),
            (4, 11, 1, "only", None, None),
            (5, 12, 3, "a", None, datetime(2020, 1, 3)),
            (6, 12, 4, "b", None, datetime(2020, 1, 3)),
        ],
        """review_id int, order_id int, review_score int, review_comment_message string,
           review_creation_date timestamp_ntz, review_answer_timestamp timestamp_ntz""",
    )
    kept = {r.order_id: (r.review_id, r.review_score, r.review_comment_message)
            for r in staging.stg_reviews(reviews).collect()}
    assert kept == {10: (2, 2, None), 11: (4, 1, "only"), 12: (6, 4, "b")}


def test_payment_types_and_categories(spark):
    payments = spark.createDataFrame([("credit_card",), ("not_defined",), (None,)], "payment_type string")
    assert staging.stg_payments(payments).count() == 1
    products = spark.createDataFrame(
        [(i, name, 1, 1, 1, 1, 2, 3, 4) for i, name in enumerate(["a", "promo_bolt", "zzz", None])],
        """product_id int, product_category_name string, product_name_lenght int,
           product_description_lenght int, product_photos_qty int, product_weight_g int,
           product_length_cm int, product_height_cm int, product_width_cm int""",
    )
    words = spark.createDataFrame([("a", "A!")], "product_category_name string, product_category_name_english string")
    staged = staging.stg_products(products, words, STANDIN)
    assert [r.category for r in staged.orderBy("product_id").collect()] == ["A!", "promo_bolt", "unknown", "unknown"]
    assert {r.volume_cm3 for r in marts.dim_products(staged).collect()} == {24}


def test_delivery_metrics_need_status_and_date(spark):
    late = datetime(2020, 1, 10, 0, 5)
    rows = [
        (1, "delivered", datetime(2020, 1, 1, 23, 59), late, datetime(2020, 1, 9)),
        (2, "delivered", datetime(2020, 1, 1), datetime(2020, 1, 9, 23, 59), datetime(2020, 1, 9)),
        (3, "delivered", datetime(2020, 1, 1), None, datetime(2020, 1, 9)),
        (4, "shipped", datetime(2020, 1, 1), late, datetime(2020, 1, 9)),
    ]
    df = spark.createDataFrame(
        rows,
        """order_id int, order_status string, purchased_at timestamp_ntz, delivered_at timestamp_ntz,
           estimated_delivery_at timestamp_ntz""",
    )
    got = {r.order_id: tuple(r)[1:] for r in marts.delivery_metrics(df).collect()}
    assert got == {1: (9, 1, True), 2: (8, 0, False), 3: (None,) * 3, 4: (None,) * 3}


def test_unknown_spend_gets_the_top_quintile(spark):
    orders = spark.createDataFrame(
        [(i, datetime(1999, 5, i), date(1999, 5, i), "delivered", None if i == 1 else float(i), True)
         for i in range(1, 11)],
        """customer_unique_id int, purchased_at timestamp_ntz, order_date date, order_status string,
           order_revenue double, in_analysis_window boolean""",
    )
    rfm = {r.customer_unique_id: r for r in marts.customer_rfm(orders, STANDIN).collect()}
    assert rfm[1].monetary is None and rfm[1].m_score == 5 and rfm[1].r_score == 1
    assert rfm[1].segment == "At risk: big spenders"
    assert rfm[10].r_score == 5 and rfm[2].m_score == 1


def test_gap_bins(spark):
    days = [0, 1, 14, 15, 569, 570, 584, 585, 586, 9999]
    gaps = spark.createDataFrame([(d,) for d in days], "days_to_second_order long")
    histogram = {r.from_day: r.customers for r in customers.gap_histogram(gaps, STANDIN).collect()}
    assert len(histogram) == 39 and sum(histogram.values()) == 7
    assert (histogram[0], histogram[15], histogram[555], histogram[570]) == (2, 1, 1, 3)
    assert one(gaps.agg(F.max(bin_index(F.col("days_to_second_order"), 15, 585)))) == (38,)


def test_arrival_bins_are_right_closed(spark):
    days = [-1000, -999, -10, -1, 0, 3, 7, 1000, 1001]
    df = spark.createDataFrame(
        [(d, d > 0, 4) for d in days], "days_vs_estimate int, is_late boolean, review_score int"
    )
    got = [(r.arrival, r.orders) for r in dashboard.review_by_arrival(df).collect()]
    assert got == [
        ("10+ days early", 2), ("1-9 days early", 1), ("on the day", 1), ("1-3 days late", 1),
        ("4-7 days late", 1), ("8+ days late", 1),
    ]


def test_returned_within_bounds_by_brute_force(spark):
    """Whole-second cases around both ends of the interval, several orders a day."""
    import itertools
    from datetime import timedelta

    first = datetime(1999, 3, 5, 13, 30)
    offsets = [
        timedelta(0), timedelta(hours=5), timedelta(days=1), timedelta(days=1, seconds=1),
        timedelta(days=180), timedelta(days=180, seconds=1), timedelta(days=1, hours=-2),
    ]
    rows, want = [], {}
    for person, chosen in enumerate(itertools.combinations(offsets[1:], 2)):
        rows += [(person, first)] + [(person, first + o) for o in chosen]
        want[person] = any(timedelta(days=1) < o <= timedelta(days=180) for o in chosen)
    df = spark.createDataFrame(rows, "customer_unique_id int, purchased_at timestamp_ntz")
    got = one(customers.returned_within(df, 180, date(2000, 3, 1)))
    assert got == ("1999-03", len(want), round(100 * sum(want.values()) / len(want), 2))


def test_spike_takes_the_first_of_tied_days(spark):
    days = ["1999-10-16", "1999-10-17", "1999-11-25", "1999-11-25", "1999-11-26", "1999-11-26"]
    df = spark.createDataFrame([(date.fromisoformat(d), 1.0) for d in days], "order_date date, order_revenue double")
    assert one(revenue.demand_spike(df, STANDIN)) == (1.0, date(1999, 11, 25), 2, 2.0)


def test_filters(spark):
    df = spark.createDataFrame(
        [(date(2000, 1, 31), "A"), (date(2000, 2, 29), "B"), (date(2000, 3, 1), None)],
        "order_date date, customer_state string",
    )
    assert dashboard.apply_filters(df).count() == 3
    assert dashboard.apply_filters(df, "2000-02", "2000-02").count() == 1
    assert dashboard.apply_filters(df, states=["A", "B"]).count() == 2
    assert dashboard.apply_filters(df.drop("order_date"), "2000-02", states=["A"]).count() == 1
    months, states = dashboard.filter_options(df)
    assert [r.month for r in months.collect()] == ["2000-01", "2000-02", "2000-03"]
    assert [r.customer_state for r in states.collect()] == ["A", "B"]


def test_spearman_average_ranks(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (None, 9)], "x int, y int")
    # Ranks 1.5, 1.5, 3 and 1, 2, 3.
    measure, n, rho = one(hypothesis.spearman(df, ["x"], "y"))
    assert (measure, n) == ("x", 3) and rho == pytest.approx(1.5 / math.sqrt(1.5 * 2))


def test_unknown_lateness_is_in_no_group(spark):
    rows = [(True, 1), (True, 2), (False, 5), (False, 4), (None, 3), (None, 1)]
    delivered = spark.createDataFrame(rows, "is_late boolean, review_score int")
    assert one(hypothesis.mannwhitney_review_late(delivered))[:2] == (2, 2)
    first = delivered.withColumn("customer_unique_id", F.monotonically_increasing_id()).withColumn(
        "customer_order_number", F.lit(1)
    )
    people = first.select("customer_unique_id", F.lit(1).alias("total_orders"))
    assert {r.is_late for r in hypothesis.late_repeat_crosstab(first, people).collect()} == {True, False}


def test_a_window_of_one_day_is_rejected(spark):
    orders = spark.createDataFrame([], "customer_unique_id string, purchased_at timestamp_ntz")
    with pytest.raises(ValueError, match="two days"):
        customers.returned_within(orders, 1, date(2020, 1, 1))


@pytest.mark.parametrize("df", [1e5 + 1, 1e8, 1e11, 1e12, 1e13])
def test_t_tail_of_large_samples(df):
    for t in (0.1, 1.0, 2.5, 5.0):
        assert D.t_two_sided(t, df) == pytest.approx(D.normal_two_sided(t), rel=1e-6 + t**4 / df)
    assert D.t_two_sided(1.0, 99_999) == pytest.approx(D.t_two_sided(1.0, 100_001), abs=1e-9)


def test_chi_square_with_yates(spark):
    table = spark.createDataFrame([(False, 20, 10), (True, 5, 15)], "is_late boolean, did_not_return int, returned int")
    n, a, b, c, d = 50, 20, 10, 5, 15
    want = n * (abs(a * d - b * c) - n / 2) ** 2 / (30 * 20 * 25 * 25)
    assert one(hypothesis.chi2_late_repeat(table))[3] == pytest.approx(want, abs=1e-6)


def test_mann_whitney_by_hand(spark):
    late, on_time = [1, 2, 2], [2, 4, 5, 5]
    df = spark.createDataFrame(
        [(True, s) for s in late] + [(False, s) for s in on_time], "is_late boolean, review_score int"
    )
    u = sum((a > b) + 0.5 * (a == b) for a in late for b in on_time)
    tie = (3**3 - 3) + (2**3 - 2)
    sd = math.sqrt(12 / 12 * (8 - tie / (7 * 6)))
    got = hypothesis.mannwhitney_review_late(df).collect()[0]
    assert (got.late_n, got.on_time_n, got.u_stat) == (3, 4, u)
    assert got.z_stat == pytest.approx((12 - u - 6 - 0.5) / sd, abs=1e-6)


def test_tail_probabilities():
    # Table values.
    assert D.normal_two_sided(1.959963985) == pytest.approx(0.05, abs=1e-9)
    assert D.chi_square_one_df(3.841458821) == pytest.approx(0.05, abs=1e-9)
    assert D.t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert D.t_two_sided(12.7062047, 1) == pytest.approx(0.05, abs=1e-8)
    assert D.t_two_sided(0.0, 5) == 1.0
    assert D.t_two_sided(1.0, 1) == pytest.approx(0.5, abs=1e-12)
    assert D.t_two_sided(-3.0, 1e6) == pytest.approx(D.normal_two_sided(3.0), rel=1e-4)


def test_spearman_of_several_measures_and_of_nothing(spark):
    df = spark.createDataFrame([(1, 4, 1), (2, 3, 2), (3, 2, 3), (4, None, 4)], "a int, b int, y int")
    got = {r.measure: (r.n, r.rho) for r in hypothesis.spearman(df, ["a", "b"], "y").collect()}
    assert got["a"] == (4, pytest.approx(1.0)) and got["b"] == (3, pytest.approx(-1.0))
    assert one(hypothesis.spearman(df.where("a > 9"), ["a"], "y")) == ("a", 0, None)
    constant = df.withColumn("a", F.lit(1))
    assert one(hypothesis.spearman(constant, ["a"], "y")) == ("a", 4, None)
