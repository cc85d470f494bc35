"""Money, ratios and averages that come out the same in whatever order rows are added."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def cents(amount: Column | str) -> Column:
    """Whole cents of a floating amount, halves up; adds exactly as a long."""
    return F.floor(_col(amount) * 100 + 0.5)


def money(total_cents: Column | str) -> Column:
    return (_col(total_cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY)


def mean(value: str) -> Column:
    """Average of the non-null values from an exact sum. Decimals keep their scale in the sum."""
    return F.try_divide(F.sum(value).cast("double"), F.count(value).cast("double"))


def percent(part: str, whole: str) -> Column:
    """``part`` of ``whole`` in percent with two decimals, halves up, in integer arithmetic."""
    return (F.expr(f"({part} * 20000 + {whole}) div nullif(2 * {whole}, 0)") / F.lit(100.0)).cast("double")


def half_up(value: Column, digits: int) -> Column:
    """Round a non-negative double, halves up."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5).cast("double") / scale


def count_of(condition: Column) -> Column:
    """Number of rows for which the condition holds."""
    return F.coalesce(F.sum(condition.cast("int")), F.lit(0)).cast("bigint")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
