"""Dates of an order: how long, how late, when bought."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOUGHT = "order_purchase_timestamp"
DELIVERED = "order_delivered_customer_date"
PROMISED = "order_estimated_delivery_date"


def delivery_days() -> Column:
    return F.date_diff(DELIVERED, BOUGHT)


def delay_days() -> Column:
    return F.date_diff(DELIVERED, PROMISED)


def is_late(grain: str = "day") -> Column:
    if grain == "day":
        return delay_days() > 0
    if grain == "instant":
        return F.col(DELIVERED) > F.col(PROMISED)
    raise ValueError(f"unknown late grain {grain!r}")


def weekday(base: str = "sunday1") -> Column:
    if base == "sunday1":
        return F.dayofweek(BOUGHT)
    if base == "monday0":
        return F.weekday(BOUGHT)
    raise ValueError(f"unknown weekday base {base!r}")


def calendar_parts(base: str = "sunday1") -> dict[str, Column]:
    return {
        "purchase_year": F.year(BOUGHT),
        "purchase_month": F.month(BOUGHT),
        "purchase_weekday": weekday(base),
        "purchase_hour": F.hour(BOUGHT),
    }


def year_month() -> Column:
    return F.date_format(BOUGHT, "yyyy-MM")


def period(year: str, reference: tuple[int, int], current: tuple[int, int]) -> Column:
    """'reference', 'current' or null for a year column."""
    return F.when(F.col(year).between(*reference), "reference").when(
        F.col(year).between(*current), "current"
    )
