"""The eight order tables derived from a star schema of orders, line items and events.

The star schema lacks freight, payments and reviews, so they come from neighbouring
columns: line items stand in for items and payments, events for reviews.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS
from orderlens.schemas import SOURCES

SETTINGS = DEFAULTS.but(
    max_price=90000.0,
    reliable_min_orders=20,
    reference_years=(1995, 1997),
    current_years=(1998, 2001),
)

# Five of the six part types have an English name, one has none.
TRANSLATION = {
    "LARGE": "large_goods",
    "STANDARD": "standard_goods",
    "SMALL": "small_goods",
    "MEDIUM": "medium_goods",
    "ECONOMY": "economy_goods",
}

PROMISED_DAYS = 180


# Declared, so that opening a table costs no look into its files; only columns used here.
RAW = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_type string, p_size int",
    "events": "event_id bigint, ts timestamp_ntz, value double",
}


class RetailTables(Mapping):
    """The eight tables by name, each built when asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RAW[name]).parquet(f"{self.folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name == "category_translation":
            return _translation(self.spark)
        return _fit(self._source(name), name)

    def _source(self, name: str) -> DataFrame:
        if name == "orders":
            return _with_first_ship(self.raw("orders"), self.raw("lineitem"))
        if name in ("order_items", "payments"):
            return self.raw("lineitem")
        if name == "reviews":
            return self.raw("events")
        if name == "products":
            return self.raw("part")
        people, nation_key = ("customer", "c_nationkey") if name == "customers" else ("supplier", "s_nationkey")
        nations = self.raw("nation")
        people = self.raw(people)
        return people.join(nations, people[nation_key] == nations["n_nationkey"], "left")

    def __iter__(self) -> Iterator[str]:
        return iter(SOURCES)

    def __len__(self) -> int:
        return len(SOURCES)


# How each declared column is derived; columns not named are null.
DERIVED = {
    "orders": {
        "order_id": "order_id",
        "customer_id": "o_custkey",
        "order_status": "CASE WHEN o_orderstatus = 'P' THEN 'shipped' ELSE 'delivered' END",
        "order_purchase_timestamp": "timestampadd(HOUR, int(o_orderkey % 24), o_orderdate)",
        "order_delivered_customer_date": "timestampadd(HOUR, int(o_orderkey % 7), first_ship)",
        "order_estimated_delivery_date": f"timestampadd(DAY, {PROMISED_DAYS}, o_orderdate)",
    },
    "order_items": {
        "order_id": "l_orderkey",
        "order_item_id": "l_linenumber",
        "product_id": "l_partkey",
        "seller_id": "l_suppkey",
        "shipping_limit_date": "l_shipdate",
        "price": "l_extendedprice",
        "freight_value": "l_extendedprice * l_tax",
    },
    "payments": {
        "order_id": "l_orderkey",
        "payment_sequential": "l_linenumber",
        "payment_type": "l_returnflag",
        "payment_installments": "l_linenumber",
        "payment_value": "l_extendedprice * (1 - l_discount)",
    },
    # Every fifth event repeats its predecessor's order; scores 0 and 6 are out of range.
    "reviews": {
        "review_id": "event_id",
        "order_id": "event_id - CASE WHEN event_id % 5 = 4 THEN 1 ELSE 0 END",
        "review_score": "floor(value) % 7",
        "review_creation_date": "ts",
        "review_answer_timestamp": "ts",
    },
    "customers": {
        "customer_id": "c_custkey",
        "customer_unique_id": "c_name",
        "customer_city": "n_name",
        "customer_state": "n_name",
    },
    "sellers": {"seller_id": "s_suppkey", "seller_city": "n_name", "seller_state": "n_name"},
    "products": {
        "product_id": "p_partkey",
        "product_category_name": "p_type",
        "product_photos_qty": "p_size % 7",
        "product_weight_g": "p_size * 100",
    },
}


def _fit(df: DataFrame, name: str) -> DataFrame:
    """The declared columns in order and type."""
    derived = DERIVED[name]
    return df.selectExpr(
        *[f"CAST({derived.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in SOURCES[name].fields]
    )


def _with_first_ship(orders: DataFrame, lines: DataFrame) -> DataFrame:
    # Delivery is the first shipment not before the order. Joined and grouped on the same
    # key, so both sides are shuffled once and later joins on the order reuse that layout;
    # AQE splits an order that holds a large share of the lines.
    placed = orders.selectExpr("CAST(o_orderkey AS string) AS order_id", "*")
    shipped = lines.selectExpr("CAST(l_orderkey AS string) AS line_order", "l_shipdate")
    in_time = F.expr("order_id = line_order AND l_shipdate >= o_orderdate")
    return placed.join(shipped, in_time, "left").groupBy(*placed.columns).agg(F.min("l_shipdate").alias("first_ship"))


def _translation(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{name}', '{english}')" for name, english in TRANSLATION.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(product_category_name, product_category_name_english)")
