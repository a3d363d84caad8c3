"""Declared schemas of the nine base tables and the six monthly rollups.

Spark does not enforce keys; KEYS states what ingest guarantees and tests check.
"""

from __future__ import annotations

from pyspark.sql.types import StructType


def _struct(columns: str) -> StructType:
    """'name type, name type' to a schema; needs no running session."""
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        schema = schema.add(name, "integer" if kind == "int" else kind)
    return schema


BASE_TABLES: dict[str, StructType] = {
    name: _struct(columns)
    for name, columns in {
        "orders": (
            "order_id string, customer_id string, order_status string, "
            "order_purchase_timestamp timestamp, order_approved_at timestamp, "
            "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, "
            "order_estimated_delivery_date timestamp"
        ),
        "order_items": (
            "order_id string, order_item_id int, product_id string, seller_id string, "
            "shipping_limit_date timestamp, price double, freight_value double"
        ),
        "products": (
            "product_id string, product_category_name string, product_name_length double, "
            "product_description_length double, product_photos_qty double, product_weight_g double, "
            "product_length_cm double, product_height_cm double, product_width_cm double"
        ),
        "customers": (
            "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
            "customer_city string, customer_state string"
        ),
        "sellers": "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
        "payments": (
            "order_id string, payment_sequential int, payment_type string, "
            "payment_installments int, payment_value double"
        ),
        "order_reviews": (
            "review_id string, order_id string, review_score int, review_comment_title string, "
            "review_comment_message string, review_creation_date timestamp, review_answer_timestamp timestamp"
        ),
        "geolocation": (
            "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
            "geolocation_city string, geolocation_state string"
        ),
        "product_category_name_translation": (
            "product_category_name string, product_category_name_english string"
        ),
    }.items()
}

KEYS: dict[str, list[str]] = {
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "products": ["product_id"],
    "customers": ["customer_id"],
    "sellers": ["seller_id"],
    "payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "product_category_name_translation": ["product_category_name"],
}

ROLLUPS: dict[str, StructType] = {
    name: _struct(columns)
    for name, columns in {
        "mv_monthly_sales": "ym string, total_gmv double, total_orders long, avg_basket double, total_freight double",
        "mv_state_sales": "ym string, customer_state string, total_gmv double, total_orders long, unique_customers long",
        "mv_category_sales": (
            "ym string, product_category_english string, total_gmv double, total_orders long, avg_price double"
        ),
        "mv_delivery_perf": (
            "ym string, customer_state string, avg_delivery_days double, on_time_rate double, delayed_orders long"
        ),
        "mv_seller_perf": (
            "ym string, seller_id string, seller_state string, total_gmv double, total_orders long, "
            "avg_review_score double"
        ),
        "mv_payment_dist": (
            "ym string, payment_type string, total_transactions long, avg_installments double, total_value double"
        ),
    }.items()
}

ROLLUP_KEYS: dict[str, list[str]] = {
    "mv_monthly_sales": ["ym"],
    "mv_state_sales": ["ym", "customer_state"],
    "mv_category_sales": ["ym", "product_category_english"],
    "mv_delivery_perf": ["ym", "customer_state"],
    "mv_seller_perf": ["ym", "seller_id"],
    "mv_payment_dist": ["ym", "payment_type"],
}

# Columns of one wide export row (order x item x payment). The export spells
# "length" as "lenght" in two names; ingest renames them.
WIDE_ENTITIES = ["orders", "order_items", "products", "customers", "sellers", "payments"]
MISSPELT = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}
TIMESTAMP_COLUMNS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
    "shipping_limit_date",
    "review_creation_date",
    "review_answer_timestamp",
]


def wide_columns() -> list[str]:
    seen: dict[str, None] = {}
    for entity in WIDE_ENTITIES:
        for name in BASE_TABLES[entity].fieldNames():
            seen.setdefault(name)
    return list(seen)


def text_schema(columns: list[str]) -> StructType:
    """All columns as text, for sources whose timestamps may be broken."""
    schema = StructType()
    for name in columns:
        schema = schema.add(name, "string")
    return schema
