"""Declared schemas: source tables, the Silver row, warehouse contracts, payloads."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
}


def _struct(**columns: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in columns.items()])


# Column names and types of the eight source tables. Identifiers and
# zip prefixes stay strings so leading zeros survive.
SOURCES: dict[str, T.StructType] = {
    "orders": _struct(
        order_id="string",
        customer_id="string",
        order_status="string",
        order_purchase_timestamp="timestamp",
        order_approved_at="timestamp",
        order_delivered_carrier_date="timestamp",
        order_delivered_customer_date="timestamp",
        order_estimated_delivery_date="timestamp",
    ),
    "order_items": _struct(
        order_id="string",
        order_item_id="int",
        product_id="string",
        seller_id="string",
        shipping_limit_date="timestamp",
        price="double",
        freight_value="double",
    ),
    "payments": _struct(
        order_id="string",
        payment_sequential="int",
        payment_type="string",
        payment_installments="int",
        payment_value="double",
    ),
    "reviews": _struct(
        review_id="string",
        order_id="string",
        review_score="int",
        review_comment_title="string",
        review_comment_message="string",
        review_creation_date="timestamp",
        review_answer_timestamp="timestamp",
    ),
    "customers": _struct(
        customer_id="string",
        customer_unique_id="string",
        customer_zip_code_prefix="string",
        customer_city="string",
        customer_state="string",
    ),
    "sellers": _struct(
        seller_id="string",
        seller_zip_code_prefix="string",
        seller_city="string",
        seller_state="string",
    ),
    "products": _struct(
        product_id="string",
        product_category_name="string",
        product_name_lenght="int",
        product_description_lenght="int",
        product_photos_qty="int",
        product_weight_g="double",
        product_length_cm="double",
        product_height_cm="double",
        product_width_cm="double",
    ),
    "category_translation": _struct(
        product_category_name="string",
        product_category_name_english="string",
    ),
}

# Comments of reviews may hold line breaks; every other file stays splittable.
MULTILINE = frozenset({"reviews"})

LINEAGE = ("ingested_at", "source_table", "source_file")

# The 27 columns of a Silver row.
SILVER = (
    "order_id",
    "customer_id",
    "main_seller_id",
    "is_late",
    "delay_days",
    "delivery_days",
    "review_score",
    "order_purchase_timestamp",
    "purchase_year",
    "purchase_month",
    "purchase_weekday",
    "purchase_hour",
    "customer_state",
    "customer_city",
    "seller_state",
    "seller_city",
    "cross_state_delivery",
    "nb_items",
    "nb_sellers",
    "total_price",
    "total_freight",
    "total_payment_value",
    "payment_type",
    "max_installments",
    "product_category_name_english",
    "estimated_weight_kg",
    "product_photos_qty",
)

# Names, order, text widths and scales of the warehouse columns; "!" marks a column
# that may not be null. Counts and amounts are as wide as the target data needs.
# ``inserted_at`` is added to each table on export.
CONTRACTS: dict[str, dict[str, str]] = {
    "late_rate_by_state": {
        "customer_state": "varchar(2)!",
        "total_orders": "bigint!",
        "late_orders": "bigint!",
        "avg_delivery_days": "decimal(18,2)",
        "avg_review_score": "decimal(18,2)",
        "late_rate_pct": "decimal(18,2)",
    },
    "late_rate_by_category": {
        "product_category_name_english": "varchar(50)!",
        "total_orders": "bigint!",
        "late_orders": "bigint!",
        "avg_price": "decimal(18,2)",
        "avg_review_score": "decimal(18,2)",
        "late_rate_pct": "decimal(18,2)",
    },
    "seller_performance": {
        "main_seller_id": "varchar(64)!",
        "seller_state": "varchar(2)",
        "total_orders": "bigint!",
        "late_orders": "bigint!",
        "avg_delivery_days": "decimal(18,2)",
        "avg_review_score": "decimal(18,2)",
        "avg_order_value": "decimal(18,2)",
        "late_rate_pct": "decimal(18,2)",
        "seller_rank": "int!",
    },
    "cross_state_impact": {
        "cross_state_delivery": "boolean!",
        "total_orders": "bigint!",
        "late_orders": "bigint!",
        "avg_delivery_days": "decimal(18,2)",
        "avg_review_score": "decimal(18,2)",
        "late_rate_pct": "decimal(18,2)",
    },
    "delay_review_impact": {
        "is_late": "boolean!",
        "total_orders": "bigint!",
        "avg_review_score": "decimal(18,2)",
        "bad_reviews": "bigint",
        "bad_review_rate_pct": "decimal(18,2)",
    },
    "monthly_trend": {
        "purchase_year": "smallint!",
        "purchase_month": "smallint!",
        "total_orders": "bigint!",
        "late_orders": "bigint!",
        "avg_order_value": "decimal(18,2)",
        "avg_review_score": "decimal(18,2)",
        "late_rate_pct": "decimal(18,2)",
    },
    "weekday_pattern": {
        "purchase_weekday": "smallint!",
        "total_orders": "bigint!",
        "late_orders": "bigint!",
        "avg_delivery_days": "decimal(18,2)",
        "late_rate_pct": "decimal(18,2)",
    },
}

PAYLOAD = _struct(
    order_id="string",
    nb_items="int",
    nb_sellers="int",
    total_price="double",
    total_freight="double",
    cross_state_delivery="boolean",
    purchase_weekday="int",
    purchase_hour="int",
    estimated_weight_kg="double",
    max_installments="int",
    state="string",
)
