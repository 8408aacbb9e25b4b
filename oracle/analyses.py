"""One statement body per query, on top of the chain in `layers`."""

import re

from .layers import DELIVERY_COLUMNS, RAW, calendar
from .text import dbl, dec, hours, mean_money, pct, rnd, total, units

MONTH = "strftime(order_date, '%Y-%m')"
ALL = "sum(count(*)) OVER ()"
RAW_WIDTHS = {
    "customers": 5, "geolocation": 5, "order_items": 7, "order_payments": 5, "order_reviews": 6,
    "orders": 8, "products": 9, "sellers": 4, "category_translation": 2,
}
STAGING_TABLES = {
    "stg_customers": "s_customers", "stg_orders": "s_orders", "stg_order_items": "s_items",
    "stg_payments": "s_payments", "stg_products": "s_products", "stg_reviews": "s_reviews",
    "stg_sellers": "s_sellers",
}
MART_TABLES = {
    "dim_date": "d_date", "dim_customers": "d_customers", "dim_products": "d_products",
    "dim_sellers": "d_sellers", "fct_order_items": "f_items", "fct_orders": "f_orders",
    "customer_rfm": "rfm", "seller_scorecard": "scorecard",
}


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


CATALOG = {
    "load_summary": _union(
        f"SELECT '{t}' AS table_name, count(*) AS rows, CAST({n} AS BIGINT) AS columns FROM raw_{t}"
        for t, n in RAW_WIDTHS.items()
    ),
    "layer_inventory": _union(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, count(*) AS rows FROM {source}"
        for layer, tables in (
            ("raw", {name[4:]: name for name in RAW}),
            ("staging", STAGING_TABLES),
            ("marts", MART_TABLES),
        )
        for name, source in tables.items()
    ),
}

LAYERS = {
    **{name: f"FROM {source}" for name, source in {**STAGING_TABLES, **MART_TABLES}.items()},
    "dim_date": calendar(
        "first", "last",
        """FROM (SELECT date_trunc('year', min(purchased_at))::TIMESTAMP AS first,
                        (date_trunc('year', max(purchased_at)) + INTERVAL 1 YEAR
                         - INTERVAL 1 DAY)::TIMESTAMP AS last FROM s_orders)""",
    ),
    "order_item_rollup": "FROM item_rollup",
    "order_payment_rollup": "FROM payment_rollup",
    "customer_order_number": "FROM order_numbers SELECT * EXCLUDE (customer_state)",
    "delivery_metrics": f"SELECT order_id, {DELIVERY_COLUMNS} FROM s_orders",
    "analysis_window_flag": "FROM f_orders SELECT order_id, item_count, order_revenue, in_analysis_window",
    "seller_orders": "FROM per_seller_order",
    "export_orders": "FROM x_orders",
    "export_items": "FROM x_items",
    "export_rfm": "FROM x_rfm",
    "export_sellers": "FROM x_sellers",
}


def _repeated(table: str, key: str) -> str:
    return f"SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1"


def _differing(a: str, b: str) -> str:
    return f"SELECT 1 WHERE (SELECT {a}) <> (SELECT {b})"


CHECKS = {
    "chk_rfm_complete": """SELECT customer_unique_id FROM rfm GROUP BY ALL
        HAVING count(*) > 1 OR bool_or(segment IS NULL)""",
    "chk_customers_unique": _repeated("d_customers", "customer_unique_id"),
    "chk_items_no_rows_lost": _differing("count(*) FROM raw_order_items", "count(*) FROM f_items"),
    "chk_orders_no_rows_lost": _differing("count(*) FROM raw_orders", "count(*) FROM f_orders"),
    "chk_orders_unique": _repeated("f_orders", "order_id"),
    "chk_keys_not_null": """SELECT order_id FROM f_orders WHERE order_id IS NULL OR customer_unique_id IS NULL
        UNION ALL SELECT order_id FROM f_items WHERE product_id IS NULL OR seller_id IS NULL""",
    "chk_no_negative_money": """SELECT 1 FROM f_items WHERE price < 0 OR freight_value < 0
        OR price IS NULL OR freight_value IS NULL""",
    "chk_products_have_category": "SELECT 1 FROM d_products WHERE category IS NULL",
    "chk_revenue_reconciles": _differing(
        total("item_revenue") + " FROM f_items", total("order_revenue") + " FROM f_orders"
    ),
    "chk_review_range": "SELECT 1 FROM f_orders WHERE review_score < 1 OR review_score > 5",
    "chk_scorecard_unique": _repeated("scorecard", "seller_id"),
    "chk_reviews_one_per_order": _repeated("s_reviews", "order_id"),
}
CHECK_SUMMARY = {
    "check_summary": _union(
        f"SELECT '{name}' AS check_name, count(*) AS bad_rows, count(*) = 0 AS passed FROM ({bad})"
        for name, bad in CHECKS.items()
    )
}

ORDER_COLUMNS = {
    "order_id": "bigint", "customer_id": "bigint", "order_status": "string",
    "order_purchase_timestamp": "timestamp_ntz", "order_approved_at": "timestamp_ntz",
    "order_delivered_carrier_date": "timestamp_ntz",
    "order_delivered_customer_date": "timestamp_ntz",
    "order_estimated_delivery_date": "timestamp_ntz",
}
PROFILING = {
    "describe_orders": _union(
        f"SELECT '{c}' AS column_name, '{t}' AS column_type, count({c}) AS known FROM raw_orders"
        for c, t in ORDER_COLUMNS.items()
    ),
    "profile_row_vs_distinct": "SELECT count(*) AS total_rows, count(DISTINCT order_id) AS unique_orders FROM raw_orders",
    "profile_status_share": f"""SELECT order_status, count(*) AS orders,
        {pct('count(*)', ALL, 2)} AS pct_of_total FROM raw_orders GROUP BY ALL""",
    "profile_date_range": """SELECT min(order_purchase_timestamp) AS first_order,
        max(order_purchase_timestamp) AS last_order FROM raw_orders""",
    "profile_monthly_orders": """SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month,
        count(*) AS orders FROM raw_orders GROUP BY ALL""",
    "profile_nulls": "SELECT " + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS missing_{c}"
        for c in ORDER_COLUMNS
    ) + " FROM raw_orders",
    "profile_delivered_no_date": """SELECT count(*) FILTER (WHERE order_status = 'delivered'
        AND order_delivered_customer_date IS NULL) AS delivered_but_no_date FROM raw_orders""",
    "profile_customer_ids": """SELECT count(*) AS total_rows,
        count(DISTINCT customer_id) AS unique_customer_id,
        count(DISTINCT customer_unique_id) AS unique_customer_unique_id FROM raw_customers""",
    "profile_repeat_share": f"""SELECT count(*) FILTER (WHERE n > 1) AS repeat_customers,
        {pct('count(*) FILTER (WHERE n > 1)', 'count(*)', 2)} AS pct_repeat
        FROM (SELECT count(*) AS n FROM raw_customers GROUP BY customer_unique_id)""",
    "profile_review_dups": """SELECT count(*) AS total_rows,
        count(DISTINCT review_id) AS unique_reviews, count(DISTINCT order_id) AS unique_orders
        FROM raw_order_reviews""",
    "profile_multi_review_orders": f"""SELECT count(*) AS orders_with_multiple_reviews
        FROM ({_repeated('raw_order_reviews', 'order_id')})""",
    "profile_geo_fanout": f"""SELECT count(*) AS total_rows,
        count(DISTINCT geolocation_zip_code_prefix) AS unique_zip_prefixes,
        {rnd('count(*) / ' + dbl('count(DISTINCT geolocation_zip_code_prefix)'), 1)}
            AS avg_rows_per_zip FROM raw_geolocation""",
    "profile_missing_category": """SELECT count(*) FILTER (WHERE product_category_name IS NULL)
        AS products_missing_category FROM raw_products""",
    "profile_untranslated": """SELECT product_category_name AS untranslated_category
        FROM raw_products WHERE product_category_name IS NOT NULL
        EXCEPT SELECT product_category_name FROM raw_category_translation""",
    "profile_orders_without_items": """SELECT order_status, count(*) AS orders_without_items
        FROM raw_orders ANTI JOIN raw_order_items USING (order_id) GROUP BY ALL""",
    "profile_payment_types": "SELECT payment_type, count(*) AS payments FROM raw_order_payments GROUP BY ALL",
    "geo_centroids": f"""SELECT geolocation_zip_code_prefix AS zip_code_prefix, count(*) AS points,
        {rnd('avg(geolocation_lat)', 6)} AS lat, {rnd('avg(geolocation_lng)', 6)} AS lng
        FROM raw_geolocation GROUP BY ALL""",
}

MODELLING = {
    "toy_inner_join": "SELECT date, day_name, order_id FROM d_date JOIN s_orders ON purchased_at::DATE = date",
    "toy_left_join": "SELECT date, day_name, order_id FROM d_date LEFT JOIN s_orders ON purchased_at::DATE = date",
    "orders_with_person": """FROM s_orders JOIN s_customers USING (customer_id)
        SELECT order_id, customer_id, customer_unique_id, state""",
    "fanout_probe": f"""SELECT count(*) AS rows_after_join, count(DISTINCT order_id) AS actual_orders,
        {rnd(dbl(f"SUM({dec('price')} + {dec('freight_value')})") + ' / 1e6', 2)}
            AS revenue_millions_wrong
        FROM s_orders JOIN s_items USING (order_id) JOIN s_payments USING (order_id)""",
    "correct_revenue": f"""SELECT {rnd(dbl(total('order_revenue')) + ' / 1e6', 2)}
        AS revenue_millions_correct FROM f_orders""",
    "state_aov_top5": f"""SELECT customer_state, count(*) AS orders,
        {rnd(mean_money('order_revenue'), 2)} AS avg_order_value
        FROM f_orders WHERE in_analysis_window AND order_status = 'delivered'
        GROUP BY ALL HAVING count(*) >= 120
        ORDER BY avg_order_value DESC NULLS LAST, customer_state LIMIT 5""",
    "review_dedup_trace": """SELECT order_id, review_id, review_score, review_answer_timestamp,
        row_number() OVER newest AS rn
        FROM raw_order_reviews
        WINDOW newest AS (PARTITION BY order_id
                          ORDER BY review_answer_timestamp DESC NULLS LAST, review_id DESC)
        QUALIFY count(*) OVER (PARTITION BY order_id) > 1""",
    "delivery_speed_buckets": f"""SELECT CASE WHEN delivery_days > 30 THEN '4. over a month'
            WHEN delivery_days > 14 THEN '3. 2-4 weeks' WHEN delivery_days > 7 THEN '2. 1-2 weeks'
            ELSE '1. within a week' END AS delivery_speed,
        count(*) AS orders, {rnd('avg(review_score)', 2)} AS avg_review
        FROM f_orders WHERE delivery_days IS NOT NULL GROUP BY ALL""",
    "top_categories_delivered": f"""SELECT category, count(*) AS items_sold,
        {units(total('item_revenue'))} AS revenue
        FROM f_items JOIN d_products USING (product_id) WHERE order_status = 'delivered'
        GROUP BY ALL ORDER BY revenue DESC, category LIMIT 10""",
    "late_vs_on_time": f"""SELECT if(is_late, 'Late', 'On time') AS delivery, count(*) AS orders,
        {pct('count(*)', ALL, 1)} AS pct_orders, {rnd('avg(review_score)', 2)} AS avg_review_score
        FROM f_orders WHERE is_late IS NOT NULL GROUP BY ALL""",
}

PARETO = f"""SELECT rank() OVER (ORDER BY rev DESC) AS rank, category, {units('rev')} AS revenue,
    {pct('rev', 'sum(rev) OVER ()', 1)} AS share_pct,
    {pct('sum(rev) OVER (ORDER BY rev DESC)', 'sum(rev) OVER ()', 1)} AS cumulative_share_pct,
    {rnd(f"({dbl('rev2')} / nullif({dbl('rev1')}, 0) - 1.0) * 100.0", 0)} AS yoy_growth_pct
FROM (SELECT category, {total('item_revenue')} AS rev,
             {total('item_revenue', 'year(order_date) = 1999 AND month(order_date) < 9')} AS rev1,
             {total('item_revenue', 'year(order_date) = 2000 AND month(order_date) < 9')} AS rev2
      FROM valid_items JOIN d_products USING (product_id) GROUP BY category)"""
DAILY = f"""SELECT order_date, count(*) AS orders, {units(total('order_revenue'))} AS revenue
    FROM valid WHERE order_date BETWEEN DATE '1999-10-15' AND DATE '1999-12-15' GROUP BY ALL"""

REVENUE = {
    "headline_kpis": f"""SELECT count(*) AS orders, {units(total('order_revenue'))} AS revenue,
        count(DISTINCT customer_unique_id) AS customers,
        {rnd(mean_money('order_revenue'), 2)} AS aov, {rnd('avg(item_count)', 2)} AS items_per_order
        FROM valid""",
    "monthly_trend": f"""SELECT month, orders, {units('rev')} AS revenue,
        {rnd(dbl('rev') + ' / orders', 2)} AS aov,
        {units('lag(rev) OVER chrono')} AS prev_month_revenue,
        {rnd(f"({dbl('rev')} / nullif({dbl('lag(rev) OVER chrono')}, 0) - 1.0) * 100.0", 1)}
            AS mom_growth_pct,
        {units('sum(rev) OVER chrono')} AS cumulative_revenue,
        {rnd(dbl('sum(rev) OVER last3') + ' / count(rev) OVER last3', 0)} AS revenue_3m_avg
        FROM (SELECT {MONTH} AS month, count(*) AS orders, {total('order_revenue')} AS rev
              FROM valid GROUP BY ALL)
        WINDOW chrono AS (ORDER BY month),
               last3 AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "yoy_growth": f"""SELECT *, {rnd('(revenue / nullif(lag(revenue) OVER (ORDER BY year), 0) - 1.0) * 100.0', 1)}
            AS revenue_growth_pct
        FROM (SELECT year(order_date) AS year, count(*) AS orders,
                     {units(total('order_revenue'))} AS revenue,
                     {rnd(mean_money('order_revenue'), 2)} AS aov
              FROM valid WHERE month(order_date) < 9 GROUP BY ALL)""",
    "daily_orders": DAILY,
    "demand_spike": f"""SELECT {rnd('base', 2)} AS baseline_orders, peak_date, peak_orders,
        {rnd('peak_orders / base', 2)} AS peak_vs_baseline
        FROM (SELECT avg(orders) FILTER (WHERE order_date < DATE '1999-11-20') AS base,
                     first(order_date ORDER BY orders DESC, order_date) AS peak_date,
                     max(orders) AS peak_orders FROM ({DAILY}))""",
    "weekday_hour_grid": "SELECT isodow(purchased_at) AS weekday, " + ", ".join(
        f"nullif(count(*) FILTER (WHERE hour(purchased_at) = {h}), 0) AS h{h:02d}" for h in range(24)
    ) + " FROM valid GROUP BY weekday",
    "category_pareto": PARETO,
    "categories_to_80pct": f"""SELECT count(*) FILTER (WHERE cumulative_share_pct < 80) + 1
        AS top_categories, count(*) AS categories FROM ({PARETO})""",
    "state_revenue": f"""SELECT customer_state AS state,
        count(DISTINCT customer_unique_id) AS customers, {units(total('order_revenue'))} AS revenue,
        {pct(total('order_revenue'), f"sum({total('order_revenue')}) OVER ()", 1)} AS share_pct,
        {rnd(dbl(total('order_revenue')) + ' / count(DISTINCT customer_unique_id)', 1)}
            AS revenue_per_customer
        FROM valid GROUP BY ALL""",
    "payment_mix": f"""SELECT main_payment_type AS payment_type, count(*) AS orders,
        {pct('count(*)', ALL, 1)} AS share_pct, {rnd(mean_money('order_revenue'), 2)} AS aov,
        {rnd('avg(installments)', 1)} AS avg_installments
        FROM valid WHERE main_payment_type IS NOT NULL GROUP BY ALL""",
    "installment_buckets": f"""SELECT CASE WHEN installments <= 1 THEN '1 (paid in full)'
            WHEN installments BETWEEN 2 AND 3 THEN '2-3' WHEN installments BETWEEN 4 AND 6 THEN '4-6'
            ELSE '7-24' END AS installments,
        count(*) AS orders, {rnd(mean_money('order_revenue'), 2)} AS aov
        FROM valid WHERE main_payment_type = 'credit_card' GROUP BY 1""",
}

GAPS = """SELECT a.customer_unique_id,
    b.purchased_at::DATE - a.purchased_at::DATE AS days_to_second_order
    FROM (FROM valid WHERE customer_order_number = 1) a
    JOIN (FROM valid WHERE customer_order_number = 2) b USING (customer_unique_id)"""
COHORTS = """SELECT strftime(first_month, '%Y-%m') AS cohort,
    date_diff('month', first_month, month) AS month_number,
    count(DISTINCT customer_unique_id) AS customers
    FROM (SELECT customer_unique_id, date_trunc('month', purchased_at) AS month,
                 min(date_trunc('month', purchased_at)) OVER (PARTITION BY customer_unique_id)
                     AS first_month FROM valid)
    GROUP BY ALL"""
RETAINED = f"""SELECT cohort, month_number, size AS cohort_size, {pct('customers', 'size', 4)} AS retention_pct
    FROM ({COHORTS}) c
    JOIN (SELECT cohort, customers AS size FROM ({COHORTS}) WHERE month_number = 0) USING (cohort)"""
RETURNED = f"""SELECT strftime(first_at, '%Y-%m') AS cohort, count(*) AS customers,
    {pct('count(*) FILTER (WHERE back)', 'count(*)', 2)} AS pct_returned
    FROM (SELECT customer_unique_id, any_value(first_at) AS first_at,
                 bool_or(purchased_at > first_at + INTERVAL 1 DAY
                         AND purchased_at <= first_at + INTERVAL 180 DAY) AS back
          FROM (SELECT customer_unique_id, purchased_at,
                       min(purchased_at) OVER (PARTITION BY customer_unique_id) AS first_at
                FROM valid)
          WHERE first_at < DATE '2000-03-01' GROUP BY customer_unique_id)
    GROUP BY cohort"""
REPEAT = pct("count(*) FILTER (WHERE total_orders > 1)", "count(*)", 2)

CUSTOMERS = {
    "orders_per_customer": f"""SELECT if(n < 4, CAST(n AS VARCHAR), '4+') AS orders_placed,
        count(*) AS customers, {pct('count(*)', ALL, 2)} AS pct_customers
        FROM (SELECT count(*) AS n FROM valid GROUP BY customer_unique_id) GROUP BY 1""",
    "second_order_gap": GAPS,
    "repeat_summary": f"""SELECT customers, n AS second_orders, same_day, later AS true_repeats,
        {pct('n', 'customers', 1)} AS pct_second, {pct('same_day', 'n', 1)} AS pct_same_day,
        {pct('later', 'customers', 1)} AS pct_true_repeat, median_days
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE days_to_second_order = 0) AS same_day,
                     count(*) FILTER (WHERE days_to_second_order > 0) AS later,
                     {dbl('median(days_to_second_order) FILTER (WHERE days_to_second_order > 0)')}
                         AS median_days FROM ({GAPS})),
             (SELECT count(DISTINCT customer_unique_id) AS customers FROM valid)""",
    "gap_histogram": f"""SELECT low AS from_day, low + 15 AS to_day,
        count(days_to_second_order) AS customers
        FROM (SELECT unnest(range(0, 585, 15)) AS low) LEFT JOIN ({GAPS}) g
          ON days_to_second_order > 0 AND days_to_second_order >= low
         AND (days_to_second_order < low + 15 OR (low = 570 AND days_to_second_order = 585))
        GROUP BY ALL""",
    "cohort_long": COHORTS,
    "cohort_retention": "SELECT cohort, " + ", ".join(
        f"max(retention_pct) FILTER (WHERE month_number = {m}) AS m{m:02d}" for m in range(20)
    ) + f" FROM ({RETAINED}) GROUP BY cohort",
    "cohort_retention_filled": f"""SELECT cohort, cohort_size, month_number,
        CASE WHEN retention_pct IS NULL AND month_number <= date_diff('month',
                  strptime(cohort, '%Y-%m'), TIMESTAMP '2000-08-01') THEN CAST(0 AS DOUBLE)
             ELSE retention_pct END AS retention_pct
        FROM (SELECT DISTINCT cohort, cohort_size FROM ({RETAINED})
              WHERE cohort BETWEEN '1999-01' AND '2000-07') a
        CROSS JOIN (SELECT unnest(range(1, 13)) AS month_number) b
        LEFT JOIN (SELECT cohort, month_number, retention_pct FROM ({RETAINED})) c
          USING (cohort, month_number)""",
    "returned_within_180d": RETURNED,
    "returned_within_180d_mean": f"SELECT {rnd('avg(pct_returned)', 4)} AS mean_pct_returned FROM ({RETURNED})",
    "repeat_by_first_lateness": f"""SELECT is_late, count(*) AS customers, {REPEAT} AS repeat_rate_pct
        FROM valid JOIN d_customers USING (customer_unique_id)
        WHERE customer_order_number = 1 AND is_late IS NOT NULL GROUP BY is_late""",
    "repeat_by_first_category": f"""SELECT category, count(*) AS customers, {REPEAT} AS repeat_rate_pct
        FROM valid o JOIN d_customers USING (customer_unique_id)
        JOIN (SELECT order_id, product_id FROM f_items WHERE order_item_id = 1) USING (order_id)
        JOIN d_products USING (product_id)
        WHERE customer_order_number = 1 GROUP BY category HAVING count(*) >= 30""",
    "overall_repeat_rate": f"""SELECT
        {pct('count(*) FILTER (WHERE total_orders > 1)', 'count(*)', 4)} AS repeat_rate_pct
        FROM d_customers""",
    "rfm_scores": "FROM rfm_scored",
    "rfm_score_check": f"""SELECT m_score, count(monetary) AS customers,
        {rnd('min(monetary)', 1)} AS min_monetary, {rnd('max(monetary)', 1)} AS max_monetary,
        {rnd(mean_money('monetary'), 1)} AS mean_monetary FROM rfm GROUP BY m_score""",
    "rfm_segments": f"""SELECT segment, count(*) AS customers, {pct('count(*)', ALL, 1)} AS pct_customers,
        {units(total('monetary'))} AS revenue,
        {pct(total('monetary'), f"sum({total('monetary')}) OVER ()", 1)} AS pct_revenue,
        {rnd(mean_money('monetary'), 0)} AS avg_spend,
        {rnd('avg(recency_days)', 0)} AS avg_days_since_order FROM rfm GROUP BY segment""",
}

LATE = rnd("avg(is_late::INT) * 100.0", 1)
DELIVERY = {
    "delivery_kpis": f"""SELECT count(*) AS delivered_orders,
        {rnd('avg(delivery_days)', 1)} AS avg_delivery_days,
        {dbl('median(delivery_days)')} AS median_delivery_days, {LATE} AS late_pct,
        {rnd('avg(days_vs_estimate)', 1)} AS avg_days_vs_estimate FROM delivered""",
    "delivery_stages": "SELECT " + ", ".join(
        f"{rnd(f'avg({hours(a, b)}) / CAST(24 AS DOUBLE)', 1)} AS {name}"
        for name, a, b in (
            ("approval_days", "purchased_at", "approved_at"),
            ("seller_handling_days", "approved_at", "shipped_at"),
            ("carrier_days", "shipped_at", "delivered_at"),
        )
    ) + " FROM delivered WHERE NOT shipped_at < approved_at",
    "late_rate_monthly": f"""SELECT *, late_pct > 10 AS above_alert
        FROM (SELECT {MONTH} AS month, count(*) AS orders, {LATE} AS late_pct
              FROM delivered GROUP BY month)""",
    "late_rate_by_state": f"""SELECT customer_state AS state, count(*) AS orders,
        {rnd('avg(delivery_days)', 1)} AS avg_delivery_days, {LATE} AS late_pct
        FROM delivered GROUP BY customer_state HAVING count(*) >= 150""",
    "review_by_arrival": f"""SELECT CASE WHEN days_vs_estimate > 7 THEN '6. 8+ days late'
            WHEN days_vs_estimate > 3 THEN '5. 4-7 days late'
            WHEN days_vs_estimate > 0 THEN '4. 1-3 days late'
            WHEN days_vs_estimate = 0 THEN '3. on the day'
            WHEN days_vs_estimate > -10 THEN '2. 1-9 days early'
            ELSE '1. 10+ days early' END AS arrival,
        count(*) AS orders, {rnd('avg(review_score)', 2)} AS avg_review,
        {pct('count(*) FILTER (WHERE review_score < 3)', 'count(*)', 1)} AS pct_bad_reviews
        FROM delivered WHERE review_score IS NOT NULL GROUP BY 1""",
    "seller_flag_summary": f"""SELECT performance_flag, count(*) AS sellers,
        {units(total('revenue'))} AS revenue,
        {pct(total('revenue'), f"sum({total('revenue')}) OVER ()", 1)} AS pct_revenue,
        {rnd(mean_money('avg_review'), 2)} AS avg_review,
        {rnd(f"{dbl('sum(CAST(late_rate AS DECIMAL(9,3)))')} / count(late_rate) * 100.0", 1)}
            AS avg_late_pct
        FROM scorecard GROUP BY performance_flag""",
    "seller_concentration": f"""SELECT count(*) FILTER (WHERE tenth = 1) AS top_sellers,
        {pct(total('revenue', 'tenth = 1'), total('revenue'), 2)} AS top_revenue_pct
        FROM (SELECT revenue, ntile(10) OVER (ORDER BY revenue DESC, seller_id) AS tenth
              FROM scorecard)""",
    "underperformers_top10": f"""SELECT seller_id, seller_state, orders,
        CAST(round({dec('revenue')}, 0) AS DOUBLE) AS revenue, avg_review,
        {rnd('late_rate * 100.0', 1)} AS late_pct, avg_handling_days
        FROM (SELECT * FROM scorecard WHERE performance_flag = 'Underperforming'
              ORDER BY scorecard.revenue DESC, seller_id LIMIT 10)""",
    "established_sellers": f"""SELECT seller_id, orders, revenue, avg_review,
        {rnd('late_rate * 100.0', 1)} AS late_pct, performance_flag,
        count(*) OVER (PARTITION BY performance_flag) AS sellers_with_flag
        FROM scorecard WHERE orders >= 135""",
}

SCORED = "(SELECT * FROM delivered WHERE review_score IS NOT NULL)"
MOMENTS = f"""(SELECT n1, n0, s1 / n1 AS m1, s0 / n0 AS m0,
        (q1 - s1 * s1 / n1) / (n1 - 1) AS v1, (q0 - s0 * s0 / n0) / (n0 - 1) AS v0
    FROM (SELECT count(*) FILTER (WHERE is_late) AS n1, count(*) FILTER (WHERE NOT is_late) AS n0,
                 {dbl('sum(review_score) FILTER (WHERE is_late)')} AS s1,
                 {dbl('sum(review_score) FILTER (WHERE NOT is_late)')} AS s0,
                 {dbl('sum(review_score * review_score) FILTER (WHERE is_late)')} AS q1,
                 {dbl('sum(review_score * review_score) FILTER (WHERE NOT is_late)')} AS q0
          FROM {SCORED}))"""
CROSSTAB = """SELECT is_late, count(*) FILTER (WHERE total_orders = 1) AS did_not_return,
    count(*) FILTER (WHERE total_orders > 1) AS returned
    FROM delivered JOIN d_customers USING (customer_unique_id)
    WHERE customer_order_number = 1 GROUP BY is_late"""


def _midrank(value: str) -> str:
    return f"rank() OVER (ORDER BY {value}) + (count(*) OVER (PARTITION BY {value}) - 1) / CAST(2 AS DOUBLE)"


def _spearman(source: str, x: str, y: str, extra: str = "") -> str:
    return f"""SELECT {extra} count(*) AS n, {rnd('CASE WHEN NOT isnan(corr(rx, ry)) THEN corr(rx, ry) END', 6)} AS rho
        FROM (SELECT {_midrank(x)} AS rx, {_midrank(y)} AS ry FROM {source}
              WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"""


STATISTICS = {
    "welch_review_late": f"""SELECT n1 AS late_n, {rnd('m1', 6)} AS late_mean, n0 AS on_time_n,
        {rnd('m0', 6)} AS on_time_mean, {rnd('m0 - m1', 6)} AS difference,
        {rnd('(m1 - m0) / sqrt(v1 / n1 + v0 / n0)', 6)} AS t_stat,
        {rnd('pow(v1 / n1 + v0 / n0, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v0 / n0, 2) / (n0 - 1))', 4)}
            AS df FROM {MOMENTS}""",
    "cohens_d": f"SELECT {rnd('(m0 - m1) / sqrt((v1 + v0) / 2)', 6)} AS cohens_d FROM {MOMENTS}",
    "mannwhitney_review_late": f"""SELECT n1 AS late_n, n2 AS on_time_n, u AS u_stat,
        {rnd('''(greatest(u, CAST(n1 AS DOUBLE) * n2 - u) - CAST(n1 AS DOUBLE) * n2 / 2 - 0.5)
            / sqrt(CAST(n1 AS DOUBLE) * n2 / 12
                   * (n + 1 - tie_term / (CAST(n AS DOUBLE) * (n - 1))))''', 6)} AS z_stat
        FROM (SELECT count(*) AS n, count(*) FILTER (WHERE is_late) AS n1,
                     count(*) FILTER (WHERE NOT is_late) AS n2,
                     sum(midrank) FILTER (WHERE is_late)
                         - CAST(count(*) FILTER (WHERE is_late) AS DOUBLE)
                           * (count(*) FILTER (WHERE is_late) + 1) / 2 AS u,
                     sum(CAST(ties AS DOUBLE) * ties - 1) AS tie_term
              FROM (SELECT is_late, {_midrank('review_score')} AS midrank,
                           count(*) OVER (PARTITION BY review_score) AS ties FROM {SCORED}))""",
    "late_repeat_crosstab": CROSSTAB,
    "chi2_late_repeat": f"""SELECT {rnd('p0 * 100.0', 4)} AS on_time_repeat_pct,
        {rnd('p1 * 100.0', 4)} AS late_repeat_pct, {rnd('(1.0 - p1 / p0) * 100.0', 4)} AS relative_drop_pct,
        {rnd('''pow(greatest(abs(a - (a + b) * (a + c) / n) - 0.5, 0), 2)
            * (n / ((a + b) * (a + c)) + n / ((a + b) * (b + d))
               + n / ((c + d) * (a + c)) + n / ((c + d) * (b + d)))''', 6)} AS chi2
        FROM (SELECT *, a + b + c + d AS n, b / (a + b) AS p0, d / (c + d) AS p1
              FROM (SELECT {dbl('sum(did_not_return) FILTER (WHERE NOT is_late)')} AS a,
                           {dbl('sum(returned) FILTER (WHERE NOT is_late)')} AS b,
                           {dbl('sum(did_not_return) FILTER (WHERE is_late)')} AS c,
                           {dbl('sum(returned) FILTER (WHERE is_late)')} AS d FROM ({CROSSTAB})))""",
    "spearman_delivery_review": _union(
        _spearman("delivered", x, "review_score", f"'{x}' AS measure,")
        for x in ("delivery_days", "days_vs_estimate")
    ),
    "spearman_handling_late": _spearman(
        "(SELECT * FROM scorecard WHERE orders >= 135)", "avg_handling_days", "late_rate"
    ),
}

# The dashboard's segments, actions, bin edges and labels.
ACTIONS = """(VALUES ('Champions', 'Reward & referral program'),
    ('Loyal (lapsing)', 'Personalised win-back'),
    ('New big spenders', 'Nurture toward a 2nd purchase'), ('New customers', 'Welcome series'),
    ('Needs attention', 'Reminder offers'),
    ('At risk: big spenders', 'High-value win-back campaign'),
    ('Lost / one-off', 'Low-cost or no spend')) actions(segment, action)"""
DASHBOARD = {
    "dash_kpis": f"""SELECT {dbl(total('order_revenue'))} AS revenue, count(*) AS orders,
        count(DISTINCT customer_key) AS customers, {rnd(mean_money('order_revenue'), 2)} AS aov,
        {LATE} AS late_pct, {rnd('avg(review_score)', 2)} AS avg_review FROM x_orders""",
    "dash_monthly": f"""SELECT {MONTH} AS month, {dbl(total('order_revenue'))} AS revenue,
        count(*) AS orders, {rnd(dbl(total('order_revenue')) + ' / count(*)', 2)} AS aov
        FROM x_orders GROUP BY month""",
    "dash_top_categories": f"""SELECT category, {dbl(total('item_revenue'))} AS revenue
        FROM x_items WHERE category IS NOT NULL GROUP BY category
        ORDER BY revenue DESC, category LIMIT 10""",
    "dash_payment_share": f"""SELECT main_payment_type, count(*) AS orders,
        {rnd(mean_money('order_revenue'), 2)} AS aov, {pct('count(*)', ALL, 1)} AS share
        FROM x_orders WHERE main_payment_type IS NOT NULL GROUP BY main_payment_type""",
    "dash_customer_kpis": f"""SELECT
        {pct('count(*) FILTER (WHERE n > 1)', 'count(*)', 1)} AS pct_ordered_twice,
        {rnd(dbl('sum(rev)') + ' / count(*)', 2)} AS revenue_per_customer,
        (SELECT count(*) FROM x_rfm) AS rfm_customers
        FROM (SELECT count(*) AS n, {total('order_revenue')} AS rev FROM x_orders GROUP BY customer_key)""",
    "dash_rfm_segments": f"""SELECT segment, count(*) AS customers, {dbl(total('monetary'))} AS revenue,
        {pct('count(*)', ALL, 1)} AS pct_customers,
        {pct(total('monetary'), f"sum({total('monetary')}) OVER ()", 1)} AS pct_revenue,
        {rnd(mean_money('monetary'), 0)} AS avg_spend, {rnd('avg(recency_days)', 0)} AS avg_recency,
        action FROM x_rfm LEFT JOIN {ACTIONS} USING (segment) GROUP BY segment, action""",
    "dash_top_states": f"""SELECT customer_state, {dbl(total('order_revenue'))} AS revenue,
        count(DISTINCT customer_key) AS customers FROM x_orders WHERE customer_state IS NOT NULL
        GROUP BY customer_state ORDER BY revenue DESC NULLS LAST, customer_state LIMIT 10""",
    "dash_delivery_kpis": f"""SELECT {rnd('avg(delivery_days)', 1)} AS avg_delivery_days,
        {rnd('avg(days_vs_estimate)', 1)} AS avg_days_vs_estimate,
        {rnd('avg(review_score) FILTER (WHERE is_late)', 2)} AS review_late,
        {rnd('avg(review_score) FILTER (WHERE NOT is_late)', 2)} AS review_on_time
        FROM x_orders WHERE is_late IS NOT NULL""",
    "dash_late_monthly": f"""SELECT {MONTH} AS month, {LATE} AS late_pct,
        avg(is_late::INT) * 100.0 > 10 AS above_alert
        FROM x_orders WHERE is_late IS NOT NULL GROUP BY month""",
    "dash_review_by_arrival": f"""SELECT label AS arrival, {rnd('avg(review_score)', 2)} AS avg_review,
        count(*) AS orders
        FROM x_orders JOIN (VALUES (-1000, -10, '10+ days early'), (-10, -1, '1-9 days early'),
            (-1, 0, 'on the day'), (0, 3, '1-3 days late'), (3, 7, '4-7 days late'),
            (7, 1000, '8+ days late')) bins(above, upto, label)
          ON days_vs_estimate > above AND days_vs_estimate <= upto
        WHERE is_late IS NOT NULL AND review_score IS NOT NULL GROUP BY label""",
    "dash_worst_states": f"""SELECT customer_state, {rnd('avg(is_late::INT) * 100.0', 4)} AS late_pct,
        count(*) AS orders, {rnd('avg(delivery_days)', 1)} AS avg_days
        FROM x_orders WHERE is_late IS NOT NULL AND customer_state IS NOT NULL
        GROUP BY customer_state HAVING count(*) >= 120
        ORDER BY late_pct DESC, customer_state LIMIT 10""",
    "dash_seller_kpis": f"""SELECT count(*) AS sellers,
        count(*) FILTER (WHERE performance_flag = 'Good') AS good,
        count(*) FILTER (WHERE performance_flag = 'Underperforming') AS underperforming,
        count(*) FILTER (WHERE performance_flag = 'Low volume') AS low_volume,
        {pct(f"coalesce({total('revenue', 'place <= n // 10')}, 0)", total('revenue'), 2)}
            AS top_tenth_revenue_pct
        FROM (SELECT *, row_number() OVER (ORDER BY revenue DESC, seller) AS place,
                     count(*) OVER () AS n FROM x_sellers)""",
    "dash_established": f"""SELECT *, {rnd('late_rate * 100.0', 1)} AS late_pct FROM x_sellers
        WHERE performance_flag <> 'Low volume'""",
    "dash_seller_table": "FROM x_sellers",
}

SEEN = "customer_state IN (" + ", ".join(f"'NATION_{n}'" for n in (2, 3, 7, 11, 12, 13, 15, 19)) + ")"
IN_MONTHS = "order_date >= DATE '1999-02-01' AND order_date < DATE '2000-08-01'"


def _filtered(body: str) -> str:
    """The same figure over the chosen months and states; segments of buyers follow the states only."""
    for name, where in (("x_orders", f"{IN_MONTHS} AND {SEEN}"), ("x_items", f"{IN_MONTHS} AND {SEEN}"), ("x_rfm", SEEN)):
        body = re.sub(rf"\b{name}\b", f"(SELECT * FROM {name} WHERE {where})", body)
    return body


DASHBOARD_FILTERED = {
    f"{name}_filtered": _filtered(body) for name, body in DASHBOARD.items() if "x_sellers" not in body
}
DASHBOARD_CHOICES = {
    "dash_seller_table_underperforming": "FROM x_sellers WHERE performance_flag = 'Underperforming'",
    "dash_filter_months": f"SELECT DISTINCT {MONTH} AS month FROM x_orders",
    "dash_filter_states": "SELECT DISTINCT customer_state FROM x_orders WHERE customer_state IS NOT NULL",
}

ANALYSES = {
    **CATALOG, **LAYERS, **CHECK_SUMMARY, **PROFILING, **MODELLING, **REVENUE, **CUSTOMERS,
    **DELIVERY, **STATISTICS, **DASHBOARD, **DASHBOARD_FILTERED, **DASHBOARD_CHOICES,
}
