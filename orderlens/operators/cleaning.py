"""Row filters and per-order aggregates of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, Settings
from orderlens.functions import calendar
from orderlens.functions.measures import cents, money
from orderlens.operators.joins import left_by_key

# Columns a row must have to be used.
REQUIRED = {
    "orders": (calendar.BOUGHT, calendar.DELIVERED, calendar.PROMISED),
    "order_items": ("price", "freight_value", "seller_id", "product_id"),
    "payments": ("order_id", "payment_type", "payment_value"),
    "reviews": ("order_id", "review_score"),
}


def filter_delivered(orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return orders.where(F.col("order_status").isin(*settings.statuses))


def drop_incomplete(df: DataFrame, table: str) -> DataFrame:
    return df.dropna(subset=list(REQUIRED[table]))


def filter_delivery_range(orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    if settings.max_delivery_days is None:
        return orders
    return orders.where(F.col("delivery_days").between(0, settings.max_delivery_days))


def filter_price(items: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return items.where(
        (F.col("price") > 0) & (F.col("price") <= settings.max_price) & (F.col("freight_value") >= 0)
    )


def filter_score(reviews: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return reviews.where(F.col("review_score").between(*settings.score_range))


def clean_orders(orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Delivered orders with their target and calendar columns."""
    usable = orders.transform(filter_delivered, settings).transform(drop_incomplete, "orders")
    timed = usable.withColumns(
        {
            "delivery_days": calendar.delivery_days(),
            "delay_days": calendar.delay_days(),
            "is_late": calendar.is_late(settings.late_grain),
            **calendar.calendar_parts(settings.weekday_base),
        }
    )
    return filter_delivery_range(timed, settings)


def clean_items(items: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return items.transform(drop_incomplete, "order_items").transform(filter_price, settings)


def items_by_order(items: DataFrame) -> DataFrame:
    """One row per order. The main seller and product are those of the first item,
    ties settled by seller and product, so the choice does not depend on row order.

    Every aggregate combines before its shuffle, and sellers are counted per (order,
    seller) first, so an order holding a large share of all items is spread over tasks.
    """
    per_order = items.groupBy("order_id").agg(
        F.count("*").alias("nb_items"),
        money(F.sum(cents("price"))).alias("total_price"),
        money(F.sum(cents("freight_value"))).alias("total_freight"),
        F.countDistinct("seller_id").alias("nb_sellers"),
        F.min(F.struct("order_item_id", "seller_id", "product_id")).alias("first_item"),
    )
    return per_order.select(
        "order_id",
        "nb_items",
        "total_price",
        "total_freight",
        "nb_sellers",
        F.col("first_item.seller_id").alias("main_seller_id"),
        F.col("first_item.product_id").alias("main_product_id"),
    )


def main_by_order(items: DataFrame) -> DataFrame:
    """Representative seller and product of each order."""
    first = F.min(F.struct("order_item_id", "seller_id", "product_id")).alias("first_item")
    return items.groupBy("order_id").agg(first).select(
        "order_id",
        F.col("first_item.seller_id").alias("main_seller_id"),
        F.col("first_item.product_id").alias("main_product_id"),
    )


def payments_by_order(payments: DataFrame) -> DataFrame:
    """Amount paid, most instalments, and the type of the first payment of each order."""
    usable = drop_incomplete(payments, "payments")
    first = F.min(F.struct("payment_sequential", "payment_type"))
    return usable.groupBy("order_id").agg(
        money(F.sum(cents("payment_value"))).alias("total_payment_value"),
        F.max("payment_installments").alias("max_installments"),
        first.getField("payment_type").alias("payment_type"),
    )


def dedup_reviews(reviews: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One valid score per order: the one answered last, ties settled by review id."""
    valid = reviews.transform(drop_incomplete, "reviews").transform(filter_score, settings)
    last = F.max(F.struct("review_answer_timestamp", "review_id", "review_score"))
    return valid.groupBy("order_id").agg(last.getField("review_score").alias("review_score"))


def items_with_weight(items: DataFrame, products: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Items with their product's weight; an unknown product leaves it null."""
    columns = {c: c for c in ("product_id", "product_weight_g")}
    return left_by_key(items, products, "product_id", columns, settings.join_salts)


def items_weight_by_order(items: DataFrame, products: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Per order over all items, unfiltered: counts, sums, and the weight of every item."""
    per_order = items_with_weight(items, products, settings).groupBy("order_id").agg(
        F.count("order_item_id").alias("nb_items"),
        F.countDistinct("seller_id").alias("nb_sellers"),
        money(F.sum(cents("price"))).alias("total_price"),
        money(F.sum(cents("freight_value"))).alias("total_freight"),
        F.coalesce(F.sum(cents("product_weight_g")), F.lit(0)).alias("centigrams"),
        F.min(F.struct("order_item_id", "seller_id")).getField("seller_id").alias("main_seller_id"),
    )
    kilograms = F.bround(F.col("centigrams") / 100000.0, 2).alias("estimated_weight_kg")
    return per_order.select("*", kilograms).drop("centigrams")


def max_installments_by_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(F.max("payment_installments").alias("max_installments"))
