"""Stand-in raw tables, staging, marts and extracts as a chain of named subqueries."""

from .text import dbl, dec, hours, mean_money, rnd, total  # noqa: F401

RAW = {
    "raw_customers": """
SELECT o.o_orderkey AS customer_id, b.o_custkey * 8 + b.o_orderkey % 8 AS customer_unique_id,
       c.c_nationkey AS customer_zip_code_prefix, concat(' ', c.c_mktsegment, ' ') AS customer_city,
       lower(n.n_name) AS customer_state
FROM orders o
JOIN orders b ON b.o_orderkey = o.o_orderkey - CASE WHEN o.o_orderkey % 40 = 1 THEN 1 ELSE 0 END
JOIN customer c ON b.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "raw_orders": """
SELECT order_id, customer_id, order_status, purchased_at AS order_purchase_timestamp,
       approved_at AS order_approved_at,
       CASE WHEN order_status IN ('delivered','shipped') THEN shipped_at END
           AS order_delivered_carrier_date,
       CASE WHEN order_status = 'delivered' AND order_id % 1201 <> 5
            THEN shipped_at + (24 + order_id * 53 % 480) * INTERVAL '1' HOUR END
           AS order_delivered_customer_date,
       day0 + 20 * INTERVAL '1' DAY AS order_estimated_delivery_date
FROM (SELECT *, approved_at + (order_id * 37 % 144 - 2) * INTERVAL '1' HOUR AS shipped_at
      FROM (SELECT *, CASE WHEN order_id % 611 <> 3
                           THEN purchased_at + (order_id * 31 % 40) * INTERVAL '1' HOUR END
                      AS approved_at
            FROM (SELECT o.o_orderkey AS order_id, o.o_orderkey AS customer_id,
                         b.o_orderdate AS day0,
                         b.o_orderdate + (o.o_orderkey * 7919 % 86400) * INTERVAL '1' SECOND
                             AS purchased_at,
                         CASE WHEN o.o_orderkey % 101 = 7 THEN 'canceled'
                              WHEN o.o_orderkey % 103 = 9 THEN 'unavailable'
                              WHEN o.o_orderkey % 67 = 11 THEN 'shipped'
                              ELSE 'delivered' END AS order_status
                  FROM orders o
                  JOIN orders b ON b.o_orderkey
                       = o.o_orderkey - CASE WHEN o.o_orderkey % 40 = 1 THEN 1 ELSE 0 END) x) y) z""",
    "raw_order_items": """
SELECT l_orderkey AS order_id,
       row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate,
                    l_discount, l_tax, l_returnflag, l_linestatus) AS order_item_id,
       l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
       l_extendedprice AS price,
       CAST(CAST(l_quantity AS BIGINT) * 125 AS DOUBLE) / 100 AS freight_value
FROM lineitem""",
    "raw_order_payments": """
SELECT o_orderkey AS order_id, 1 AS payment_sequential,
       CASE WHEN o_orderkey % 2003 = 17 THEN 'not_defined'
            WHEN o_orderkey % 20 < 15 THEN 'credit_card'
            WHEN o_orderkey % 20 < 19 THEN 'boleto' ELSE 'debit_card' END AS payment_type,
       CASE WHEN o_orderkey % 20 < 15 THEN 1 + o_orderkey * 7 % 10 ELSE 1 END
           AS payment_installments,
       o_totalprice AS payment_value
FROM orders WHERE o_orderkey % 1501 <> 2
UNION ALL
SELECT o_orderkey, 2, 'voucher', 1, CAST(25 + o_orderkey % 50 AS DOUBLE)
FROM orders WHERE o_orderkey % 12 = 0""",
    "raw_order_reviews": """
SELECT o_orderkey * 2 AS review_id, o_orderkey AS order_id,
       CASE WHEN (o_orderkey * 31 % 40) + (o_orderkey * 37 % 144) + (o_orderkey * 53 % 480) > 456
            THEN 1 + o_orderkey * 11 % 3 ELSE 3 + o_orderkey * 13 % 3 END AS review_score,
       CASE WHEN o_orderkey % 3 = 0 THEN 'ok' END AS review_comment_message,
       o_orderdate + 26 * INTERVAL '1' DAY AS review_creation_date,
       o_orderdate + (27 + o_orderkey % 5) * INTERVAL '1' DAY AS review_answer_timestamp
FROM orders WHERE o_orderkey % 131 <> 4
UNION ALL
SELECT o_orderkey * 2 + 1, o_orderkey, 1 + o_orderkey % 5, NULL,
       o_orderdate + 28 * INTERVAL '1' DAY, o_orderdate + (33 + o_orderkey % 5) * INTERVAL '1' DAY
FROM orders WHERE o_orderkey % 181 = 0""",
    "raw_products": """
SELECT p_partkey AS product_id,
       CASE WHEN p_partkey % 53 = 0 THEN NULL
            ELSE concat(lower(p_type), '_', split_part(p_name, ' ', 2)) END AS product_category_name,
       CAST(length(p_name) AS INTEGER) AS product_name_lenght,
       CAST(length(p_name) * 7 AS INTEGER) AS product_description_lenght,
       1 + p_partkey % 6 AS product_photos_qty,
       CASE WHEN p_partkey % 997 = 1 THEN NULL ELSE p_size * 100 END AS product_weight_g,
       p_size + 10 AS product_length_cm, p_size + 2 AS product_height_cm,
       p_size + 6 AS product_width_cm
FROM part""",
    "raw_sellers": """
SELECT s_suppkey AS seller_id, s_nationkey AS seller_zip_code_prefix,
       concat(' City', CAST(s_nationkey AS VARCHAR), ' ') AS seller_city,
       lower(n_name) AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "raw_category_translation": """
SELECT DISTINCT concat(lower(p_type), '_', split_part(p_name, ' ', 2)) AS product_category_name,
       concat('en_', lower(p_type), '_', split_part(p_name, ' ', 2)) AS product_category_name_english
FROM part
WHERE concat(lower(p_type), '_', split_part(p_name, ' ', 2)) NOT IN ('economy_ring', 'promo_bolt')""",
    "raw_geolocation": """
SELECT c_nationkey AS geolocation_zip_code_prefix,
       CAST(c_custkey % 3000 AS DOUBLE) / 100 - 30 AS geolocation_lat,
       CAST(c_custkey * 7 % 2500 AS DOUBLE) / 100 - 60 AS geolocation_lng,
       lower(c_mktsegment) AS geolocation_city, n_name AS geolocation_state
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
}

STAGING = {
    "s_customers": """
SELECT customer_id, customer_unique_id, customer_zip_code_prefix AS zip_code_prefix,
       trim(lower(customer_city)) AS city, trim(upper(customer_state)) AS state
FROM raw_customers""",
    "s_orders": """
SELECT * RENAME (order_purchase_timestamp AS purchased_at, order_approved_at AS approved_at,
                 order_delivered_carrier_date AS shipped_at,
                 order_delivered_customer_date AS delivered_at,
                 order_estimated_delivery_date AS estimated_delivery_at)
FROM raw_orders""",
    "s_items": "SELECT * RENAME (shipping_limit_date AS shipping_limit_at) FROM raw_order_items",
    "s_payments": "SELECT * FROM raw_order_payments WHERE payment_type <> 'not_defined'",
    "s_products": """
SELECT product_id,
       CASE WHEN product_category_name_english IS NOT NULL THEN product_category_name_english
            WHEN product_category_name IN ('economy_ring', 'promo_bolt') THEN product_category_name
            ELSE 'unknown' END AS category,
       product_name_lenght AS name_length, product_description_lenght AS description_length,
       product_photos_qty AS photos_qty, product_weight_g AS weight_g,
       product_length_cm AS length_cm, product_height_cm AS height_cm, product_width_cm AS width_cm
FROM raw_products LEFT JOIN raw_category_translation USING (product_category_name)""",
    "s_reviews": """
SELECT DISTINCT ON (order_id) order_id, review_id, review_score, review_comment_message,
       review_creation_date AS review_created_at, review_answer_timestamp AS review_answered_at
FROM raw_order_reviews
ORDER BY order_id, review_answer_timestamp DESC NULLS LAST, review_id DESC""",
    "s_sellers": """
SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix, trim(lower(seller_city)) AS city,
       trim(upper(seller_state)) AS state
FROM raw_sellers""",
}


def calendar(first: str, last: str, source: str = "") -> str:
    return f"""
SELECT CAST(day AS DATE) AS date, date_part('year', day) AS year,
       date_part('quarter', day) AS quarter, date_part('month', day) AS month,
       strftime(day, '%Y-%m') AS year_month, strftime(day, '%b') AS month_name,
       date_part('isodow', day) AS day_of_week, strftime(day, '%a') AS day_name,
       date_part('isodow', day) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series({first}, {last}, INTERVAL 1 DAY)) AS day {source})"""


DELIVERED = "order_status = 'delivered' AND delivered_at IS NOT NULL"
LATE_BY = "date_diff('day', estimated_delivery_at::DATE, delivered_at::DATE)"
DELIVERY_COLUMNS = f"""
       CASE WHEN {DELIVERED} THEN date_diff('day', purchased_at, delivered_at) END AS delivery_days,
       CASE WHEN {DELIVERED} THEN {LATE_BY} END AS days_vs_estimate,
       CASE WHEN {DELIVERED} THEN {LATE_BY} > 0 END AS is_late"""

MARTS = {
    "d_date": calendar("TIMESTAMP '1995-01-01'", "TIMESTAMP '2001-12-31'"),
    "d_customers": """
SELECT customer_unique_id,
       first(city ORDER BY purchased_at DESC NULLS LAST, order_id DESC) AS city,
       first(state ORDER BY purchased_at DESC NULLS LAST, order_id DESC) AS state,
       min(purchased_at) AS first_order_at, max(purchased_at) AS last_order_at,
       count(DISTINCT order_id) AS total_orders,
       count(DISTINCT order_id) > 1 AS is_repeat_customer
FROM s_orders JOIN s_customers USING (customer_id)
GROUP BY customer_unique_id""",
    "d_products": """
SELECT product_id, category, weight_g,
       CAST(length_cm AS BIGINT) * height_cm * width_cm AS volume_cm3, photos_qty
FROM s_products""",
    "d_sellers": "SELECT seller_id, city, state FROM s_sellers",
    "f_items": f"""
SELECT order_id, order_item_id, product_id, seller_id, customer_unique_id, order_status,
       purchased_at, purchased_at::DATE AS order_date, price, freight_value,
       {dbl(dec('price') + ' + ' + dec('freight_value'))} AS item_revenue
FROM s_items JOIN s_orders USING (order_id) JOIN s_customers USING (customer_id)""",
    "item_rollup": f"""
SELECT order_id, count(*) AS item_count, count(DISTINCT seller_id) AS seller_count,
       {dbl(total('price'))} AS items_value, {dbl(total('freight_value'))} AS freight_value
FROM s_items GROUP BY order_id""",
    "payment_rollup": f"""
SELECT order_id, {dbl(total('payment_value'))} AS payment_value,
       CAST(max(payment_installments) AS BIGINT) AS installments,
       first(payment_type ORDER BY payment_value DESC NULLS LAST, payment_sequential)
           AS main_payment_type
FROM s_payments GROUP BY order_id""",
    "order_numbers": """
SELECT order_id, customer_unique_id, state AS customer_state,
       row_number() OVER (PARTITION BY customer_unique_id
                          ORDER BY purchased_at NULLS LAST, order_id) AS customer_order_number
FROM s_orders JOIN s_customers USING (customer_id)""",
    "f_orders": f"""
SELECT order_id, customer_unique_id, customer_state, order_status, purchased_at,
       purchased_at::DATE AS order_date, approved_at, shipped_at, delivered_at,
       estimated_delivery_at, customer_order_number, ifnull(item_count, 0) AS item_count,
       seller_count, items_value, freight_value,
       {dbl(dec('items_value') + ' + ' + dec('freight_value'))} AS order_revenue,
       payment_value, main_payment_type, installments, {DELIVERY_COLUMNS},
       review_score,
       purchased_at >= DATE '1999-01-01' AND purchased_at < DATE '2000-09-01' AS in_analysis_window
FROM s_orders JOIN order_numbers USING (order_id)
LEFT JOIN item_rollup USING (order_id) LEFT JOIN payment_rollup USING (order_id)
LEFT JOIN (SELECT order_id, review_score FROM s_reviews) USING (order_id)""",
    "valid": """
SELECT * FROM f_orders
WHERE in_analysis_window AND order_status NOT IN ('canceled', 'unavailable')""",
    "valid_items": """
SELECT * FROM f_items
WHERE order_date >= DATE '1999-01-01' AND order_date < DATE '2000-09-01'
  AND order_status NOT IN ('canceled', 'unavailable')""",
    "delivered": """
SELECT * FROM f_orders
WHERE in_analysis_window AND order_status = 'delivered' AND delivered_at IS NOT NULL""",
    "rfm_scored": f"""
SELECT *, ntile(5) OVER (ORDER BY recency_days DESC NULLS LAST, customer_unique_id) AS r_score,
       ntile(5) OVER (ORDER BY monetary NULLS LAST, customer_unique_id) AS m_score
FROM (SELECT customer_unique_id, count(*) AS frequency, {dbl(total('order_revenue'))} AS monetary,
             DATE '2000-09-01' - max(purchased_at)::DATE AS recency_days
      FROM valid GROUP BY customer_unique_id)""",
    "rfm": """
SELECT *, CASE WHEN frequency >= 2 THEN if(r_score >= 4, 'Champions', 'Loyal (lapsing)')
               WHEN r_score >= 4 THEN if(m_score >= 4, 'New big spenders', 'New customers')
               WHEN r_score <= 2 THEN if(m_score >= 4, 'At risk: big spenders', 'Lost / one-off')
               ELSE 'Needs attention' END AS segment
FROM rfm_scored""",
    "per_seller_order": f"""
SELECT seller_id, order_id, {dbl(total('item_revenue'))} AS revenue,
       any_value(o.review_score) AS review_score, any_value(o.is_late::INT) AS is_late,
       any_value({hours('o.approved_at', 'o.shipped_at')}) / CAST(24 AS DOUBLE) AS handling_days
FROM f_items JOIN valid o USING (order_id)
GROUP BY seller_id, order_id""",
    "seller_kpis": f"""
SELECT seller_id, count(*) AS orders, {dbl(total('revenue'))} AS revenue,
       {rnd('avg(review_score)', 2)} AS avg_review, {rnd('avg(is_late)', 3)} AS late_rate,
       {rnd('avg(CAST(round(handling_days * 24) AS BIGINT)) / CAST(24 AS DOUBLE)', 1)}
           AS avg_handling_days
FROM per_seller_order GROUP BY seller_id""",
    "scorecard": """
SELECT seller_id, state AS seller_state, orders, revenue, avg_review, late_rate, avg_handling_days,
       rank() OVER (ORDER BY revenue DESC) AS revenue_rank,
       CASE WHEN orders < 135 THEN 'Low volume'
            WHEN late_rate > CAST(0.24 AS DOUBLE) OR avg_review < CAST(3.5 AS DOUBLE) THEN 'Underperforming'
            ELSE 'Good' END AS performance_flag
FROM seller_kpis JOIN d_sellers USING (seller_id)""",
}

EXTRACTS = {
    "x_orders": """
SELECT dense_rank() OVER (ORDER BY customer_unique_id) AS customer_key, customer_state,
       order_status, order_date, order_revenue, item_count, main_payment_type, installments,
       delivery_days, days_vs_estimate, is_late, review_score, customer_order_number
FROM valid""",
    "x_items": """
SELECT order_date, c.state AS customer_state, category, s.state AS seller_state, item_revenue
FROM valid_items JOIN d_products USING (product_id)
JOIN (SELECT seller_id, state FROM d_sellers) s USING (seller_id)
JOIN (SELECT customer_unique_id, state FROM d_customers) c USING (customer_unique_id)""",
    "x_rfm": """
SELECT segment, recency_days, frequency, monetary, r_score, m_score, state AS customer_state
FROM rfm JOIN d_customers USING (customer_unique_id)""",
    "x_sellers": """
SELECT substr(CAST(seller_id AS VARCHAR), 1, 8) AS seller, * EXCLUDE (seller_id) FROM scorecard""",
}

CHAIN = {**RAW, **STAGING, **MARTS, **EXTRACTS}
