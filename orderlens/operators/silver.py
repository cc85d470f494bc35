"""One typed row per delivered order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, Settings
from orderlens.functions.measures import count_of, half_up
from orderlens.operators import cleaning
from orderlens.operators.joins import left_by_key
from orderlens.schemas import LINEAGE, SILVER


def with_customers(df: DataFrame, customers: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    columns = {c: c for c in ("customer_id", "customer_state", "customer_city")}
    return left_by_key(df, customers, "customer_id", columns, settings.join_salts)


def with_sellers(df: DataFrame, sellers: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    columns = {"main_seller_id": "seller_id", "seller_state": "seller_state", "seller_city": "seller_city"}
    return left_by_key(df, sellers, "main_seller_id", columns, settings.join_salts)


def with_products(df: DataFrame, products: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    columns = {
        "main_product_id": "product_id",
        "product_category_name": "product_category_name",
        "product_weight_g": "product_weight_g",
        "product_photos_qty": "product_photos_qty",
    }
    return left_by_key(df, products, "main_product_id", columns, settings.join_salts)


def with_category(df: DataFrame, translation: DataFrame) -> DataFrame:
    """English category name; an untranslated one stays null."""
    columns = {c: c for c in ("product_category_name", "product_category_name_english")}
    return left_by_key(df, translation, "product_category_name", columns)


def cross_state(settings: Settings = DEFAULTS) -> Column:
    """Customer and seller in different states. An unknown state counts as no."""
    differ = F.col("customer_state") != F.col("seller_state")
    return F.coalesce(differ, F.lit(settings.unknown_state_crosses))


def weight_kg(grams: str = "product_weight_g") -> Column:
    return F.round(F.col(grams) / 1000.0, 2)


def join_orders(
    orders: DataFrame, items: DataFrame, payments: DataFrame, reviews: DataFrame
) -> DataFrame:
    """Clean orders with their per-order aggregates. All four sides are unique per order and
    hashed on it, so each is shuffled at most once and no key is skewed."""
    return (
        orders.join(items, "order_id", "inner")
        .join(payments, "order_id", "left")
        .join(reviews, "order_id", "left")
    )


def build_silver(tables: Mapping[str, DataFrame], settings: Settings = DEFAULTS) -> DataFrame:
    """The 27 Silver columns from the eight source tables."""
    t = {name: df.drop(*LINEAGE) for name, df in tables.items()}
    joined = join_orders(
        cleaning.clean_orders(t["orders"], settings),
        cleaning.items_by_order(cleaning.clean_items(t["order_items"], settings)),
        cleaning.payments_by_order(t["payments"]),
        cleaning.dedup_reviews(t["reviews"], settings),
    )
    located = joined.transform(with_customers, t["customers"], settings).transform(
        with_sellers, t["sellers"], settings
    )
    described = located.transform(with_products, t["products"], settings).transform(
        with_category, t["category_translation"]
    )
    derived = described.withColumns(
        {"cross_state_delivery": cross_state(settings), "estimated_weight_kg": weight_kg()}
    )
    return derived.select(*SILVER)


def quality_report(silver: DataFrame) -> DataFrame:
    """Row count, late share and share without review, in one pass; null shares when empty."""
    counts = silver.agg(
        F.count("*").alias("total_orders"),
        count_of(F.col("is_late")).alias("late"),
        count_of(F.col("review_score").isNull()).alias("unreviewed"),
    )
    total = F.col("total_orders").cast("double")
    return counts.select(
        "total_orders",
        half_up(F.try_divide(F.col("late").cast("double"), total), 4).alias("late_share"),
        half_up(F.try_divide(F.col("unreviewed").cast("double"), total), 4).alias("missing_review_share"),
    )
