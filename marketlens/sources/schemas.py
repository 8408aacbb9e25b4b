"""Declared schemas of the nine raw tables, and the file each is delivered in."""

from __future__ import annotations

RAW_SCHEMAS: dict[str, str] = {
    "customers": """customer_id STRING, customer_unique_id STRING, customer_zip_code_prefix STRING,
        customer_city STRING, customer_state STRING""",
    "geolocation": """geolocation_zip_code_prefix STRING, geolocation_lat DOUBLE,
        geolocation_lng DOUBLE, geolocation_city STRING, geolocation_state STRING""",
    "order_items": """order_id STRING, order_item_id INT, product_id STRING, seller_id STRING,
        shipping_limit_date TIMESTAMP_NTZ, price DOUBLE, freight_value DOUBLE""",
    "order_payments": """order_id STRING, payment_sequential INT, payment_type STRING,
        payment_installments INT, payment_value DOUBLE""",
    "order_reviews": """review_id STRING, order_id STRING, review_score INT,
        review_comment_title STRING, review_comment_message STRING,
        review_creation_date TIMESTAMP_NTZ, review_answer_timestamp TIMESTAMP_NTZ""",
    "orders": """order_id STRING, customer_id STRING, order_status STRING,
        order_purchase_timestamp TIMESTAMP_NTZ, order_approved_at TIMESTAMP_NTZ,
        order_delivered_carrier_date TIMESTAMP_NTZ, order_delivered_customer_date TIMESTAMP_NTZ,
        order_estimated_delivery_date TIMESTAMP_NTZ""",
    "products": """product_id STRING, product_category_name STRING, product_name_lenght INT,
        product_description_lenght INT, product_photos_qty INT, product_weight_g INT,
        product_length_cm INT, product_height_cm INT, product_width_cm INT""",
    "sellers": """seller_id STRING, seller_zip_code_prefix STRING, seller_city STRING,
        seller_state STRING""",
    "category_translation": """product_category_name STRING,
        product_category_name_english STRING""",
}


def default_files() -> dict[str, str]:
    """Raw table -> CSV file or folder name. Pass your own mapping if the files are named otherwise."""
    return {name: f"{name}.csv" for name in RAW_SCHEMAS}
