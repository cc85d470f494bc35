from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS
from orderlens.operators import cleaning

ORDERS = (
    "order_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp"
)
ITEMS = "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double"
PAYMENTS = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"
REVIEWS = "review_id string, order_id string, review_score int, review_answer_timestamp timestamp"


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_late_by_day_and_by_instant(table):
    order = table(ORDERS, ("a", "delivered", "2018-01-01 08:00:00", "2018-01-02 00:00:01", "2018-01-02 00:00:00"))
    assert rows(cleaning.clean_orders(order), "is_late", "delay_days") == [(False, 0)]
    assert rows(cleaning.clean_orders(order, DEFAULTS.but(late_grain="instant")), "is_late") == [(True,)]
    with pytest.raises(ValueError):
        cleaning.clean_orders(order, DEFAULTS.but(late_grain="week"))


def test_weekday_numbering(table):
    orders = table(
        ORDERS,
        ("sunday", "delivered", "2018-01-07 22:00:00", "2018-01-09 00:00:00", "2018-01-20 00:00:00"),
        ("monday", "delivered", "2018-01-08 00:00:00", "2018-01-09 00:00:00", "2018-01-20 00:00:00"),
    )
    columns = ("order_id", "purchase_weekday", "purchase_hour")
    assert rows(cleaning.clean_orders(orders), *columns) == [("monday", 2, 0), ("sunday", 1, 22)]
    monday0 = cleaning.clean_orders(orders, DEFAULTS.but(weekday_base="monday0"))
    assert rows(monday0, *columns) == [("monday", 0, 0), ("sunday", 6, 22)]


def test_delivery_range_status_and_missing_dates(table):
    bought = "2018-01-02 10:00:00"
    kept = cleaning.clean_orders(
        table(
            ORDERS,
            ("before", "delivered", bought, "2018-01-01 23:00:00", bought),
            ("same day", "delivered", bought, "2018-01-02 09:00:00", bought),
            ("200", "delivered", bought, "2018-07-21 00:00:00", bought),
            ("201", "delivered", bought, "2018-07-22 00:00:00", bought),
            ("shipped", "shipped", bought, "2018-01-03 00:00:00", bought),
            ("no delivery", "delivered", bought, None, bought),
            ("no promise", "delivered", bought, "2018-01-03 00:00:00", None),
        )
    )
    assert rows(kept, "order_id", "delivery_days") == [("200", 200), ("same day", 0)]


def test_delivery_range_can_be_lifted(table):
    slow = table(ORDERS, ("a", "delivered", "2018-01-02 10:00:00", "2019-01-03 00:00:00", "2018-02-01 00:00:00"))
    assert rows(cleaning.clean_orders(slow), "order_id") == []
    assert rows(cleaning.clean_orders(slow, DEFAULTS.but(max_delivery_days=None)), "order_id") == [("a",)]


def test_price_bounds(table):
    items = table(
        ITEMS,
        *[(f"p{p}", 1, "x", "s", p, 0.0) for p in (0.0, -1.0, 7000.0, 7000.01)],
        ("freight", 1, "x", "s", 10.0, -0.01),
        ("no seller", 1, "x", None, 10.0, 1.0),
    )
    assert rows(cleaning.clean_items(items), "order_id") == [("p7000.0",)]


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_main_item_ignores_row_order(spark, table, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    data = [("o", 2, "p1", "s1", 5.0, 0.5), ("o", 1, "p9", "s2", 1.10, 0.1), ("o", 1, "p3", "s2", 2.2, 0.2)]
    for order in (data, data[::-1], [data[1], data[2], data[0]]):
        got = cleaning.items_by_order(table(ITEMS, *order).repartition(3)).first()
        assert (got.main_seller_id, got.main_product_id) == ("s2", "p3")
        assert (got.nb_items, got.nb_sellers) == (3, 2)
        assert (got.total_price, got.total_freight) == (Decimal("8.30"), Decimal("0.80"))


def test_money_adds_exactly(table):
    items = table(ITEMS, *[("o", i, "p", "s", 0.1, 0.2) for i in range(1, 11)])
    assert cleaning.items_by_order(items).first().total_price == Decimal("1.00")


def test_first_payment_type_with_shared_sequence(table):
    payments = table(
        PAYMENTS,
        ("o", 1, "voucher", 1, 10.0),
        ("o", 1, "card", 8, 5.55),
        ("o", 2, "boleto", 2, 1.0),
        ("o", 3, None, 99, 1.0),
    )
    got = cleaning.payments_by_order(payments).first()
    assert (got.payment_type, got.max_installments, got.total_payment_value) == ("card", 8, Decimal("16.55"))


def test_last_valid_review_wins(table):
    reviews = table(
        REVIEWS,
        ("r1", "o", 5, "2018-01-01 00:00:00"),
        ("r2", "o", 3, "2018-01-02 00:00:00"),
        ("r3", "o", 1, "2018-01-02 00:00:00"),
        ("r4", "o", 6, "2018-01-09 00:00:00"),
        ("r5", "p", 0, "2018-01-01 00:00:00"),
        ("r6", "p", None, "2018-01-01 00:00:00"),
        ("r7", "q", 1, None),
    )
    assert rows(cleaning.dedup_reviews(reviews), "order_id", "review_score") == [("o", 1), ("q", 1)]


def test_weight_of_all_items(table):
    products = table("product_id string, product_weight_g double", ("a", 500.0), ("b", 700.0), ("c", None))
    items = table(
        ITEMS,
        ("o", 1, "a", "s", 1.0, 0.0),
        ("o", 2, "b", "s", 1.0, 0.0),
        ("n", 1, "c", "s", -5.0, 0.0),
        ("u", 1, "unknown", "s", 1.0, 0.0),
    )
    got = cleaning.items_weight_by_order(items, products)
    assert rows(got, "order_id", "estimated_weight_kg", "nb_items") == [("n", 0.0, 1), ("o", 1.2, 2), ("u", 0.0, 1)]


def test_hot_order_is_not_gathered(spark, table):
    """One order with a third of all items: counted the same as by brute force."""
    hot = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS string) END AS order_id",
        "CAST(id % 50 AS int) AS order_item_id",
        "CAST(id % 7 AS string) AS product_id",
        "CAST(id % 400 AS string) AS seller_id",
        "1.5D AS price",
        "0.25D AS freight_value",
    )
    got = cleaning.items_by_order(hot).where("order_id = 'hot'").first()
    assert (got.nb_items, got.nb_sellers, got.total_price) == (1000, 400, Decimal("1500.00"))
    plan = cleaning.items_by_order(hot)._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan and "hashpartitioning(order_id" in plan


def test_timestamps_are_read_in_utc(spark, table):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    one = table("t timestamp", ("2018-03-25 02:30:00",)).select(F.col("t").cast("timestamp_ntz")).first()[0]
    assert one == datetime(2018, 3, 25, 2, 30)
