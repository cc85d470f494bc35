"""The seven KPI tables over Silver.

Each table is one spec: its group columns and the averages it shows. Tables are built
unsorted; ``present`` sorts one for reading.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, Settings
from orderlens.functions import calendar
from orderlens.functions.measures import count_of, mean, percent
from orderlens.operators.cleaning import filter_delivered
from orderlens.session import staged


@dataclass(frozen=True)
class LateRateTable:
    keys: tuple[str, ...]
    averages: dict[str, str] = field(default_factory=dict)  # shown name -> Silver column

    def __call__(self, silver: DataFrame) -> DataFrame:
        totals = silver.groupBy(*self.keys).agg(
            F.count("*").alias("total_orders"),
            count_of(F.col("is_late")).alias("late_orders"),
            *[mean(column).alias(name) for name, column in self.averages.items()],
        )
        return totals.withColumn("late_rate_pct", percent("late_orders", "total_orders"))


BY_STATE = LateRateTable(
    ("customer_state",), {"avg_delivery_days": "delivery_days", "avg_review_score": "review_score"}
)
BY_CATEGORY = LateRateTable(
    ("product_category_name_english",), {"avg_price": "total_price", "avg_review_score": "review_score"}
)
BY_SELLER = LateRateTable(
    ("main_seller_id", "seller_state"),
    {
        "avg_delivery_days": "delivery_days",
        "avg_review_score": "review_score",
        "avg_order_value": "total_price",
    },
)
BY_CROSSING = LateRateTable(
    ("cross_state_delivery",), {"avg_delivery_days": "delivery_days", "avg_review_score": "review_score"}
)
BY_MONTH = LateRateTable(
    ("purchase_year", "purchase_month"), {"avg_order_value": "total_price", "avg_review_score": "review_score"}
)
BY_WEEKDAY = LateRateTable(("purchase_weekday",), {"avg_delivery_days": "delivery_days"})


def min_support(kpi: DataFrame, orders: int) -> DataFrame:
    """Groups with at least that many orders."""
    return kpi.where(F.col("total_orders") >= orders)


def late_rate_by_state(silver: DataFrame) -> DataFrame:
    return BY_STATE(silver)


def late_rate_by_category(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return min_support(BY_CATEGORY(silver), settings.min_group_orders)


def rank_topn(df: DataFrame, measure: str, n: int, name: str) -> DataFrame:
    """Rows whose ``rank()`` by ``measure`` descending is at most ``n``, ties kept.

    The ranks hang on the measure's ``n`` largest distinct values and how often each
    occurs, so the window runs over at most ``n`` rows however many rows tie, and that
    table of at most ``n`` rows goes back by broadcast. Reads ``df`` twice.
    """
    levels = df.groupBy(measure).agg(F.count("*").alias("_ties")).orderBy(F.desc(measure)).limit(n)
    above = F.sum("_ties").over(
        Window.orderBy(F.desc(measure)).rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = levels.select(measure, (F.coalesce(above, F.lit(0)) + 1).cast("int").alias(name))
    return df.join(F.broadcast(ranks.where(F.col(name) <= n)), measure).select(*df.columns, name)


def seller_performance(
    silver: DataFrame, settings: Settings = DEFAULTS, stage: Callable[[DataFrame], DataFrame] = staged
) -> DataFrame:
    """The sellers with the most orders. The per-seller totals are read twice by the
    ranking, so they are staged first and Silver is aggregated once."""
    return rank_topn(stage(BY_SELLER(silver)), "total_orders", settings.top_sellers, "seller_rank")


def cross_state_impact(silver: DataFrame) -> DataFrame:
    return BY_CROSSING(silver)


def reviewed_only(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("review_score").isNotNull())


def bad_review(settings: Settings = DEFAULTS) -> Column:
    """1 for a low score, else 0, also for a missing one."""
    return F.coalesce((F.col("review_score") <= settings.bad_review_max).cast("int"), F.lit(0))


def delay_review_impact(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Scores of late against punctual orders, reviewed orders only."""
    totals = (
        reviewed_only(silver)
        .groupBy("is_late")
        .agg(
            F.count("*").alias("total_orders"),
            mean("review_score").alias("avg_review_score"),
            F.sum(bad_review(settings)).alias("bad_reviews"),
        )
    )
    return totals.withColumn("bad_review_rate_pct", percent("bad_reviews", "total_orders"))


def monthly_trend(silver: DataFrame) -> DataFrame:
    return BY_MONTH(silver)


def weekday_pattern(silver: DataFrame) -> DataFrame:
    return BY_WEEKDAY(silver)


def gold_tables(
    silver: DataFrame, settings: Settings = DEFAULTS, stage: Callable[[DataFrame], DataFrame] = staged
) -> dict[str, DataFrame]:
    return {
        "late_rate_by_state": late_rate_by_state(silver),
        "late_rate_by_category": late_rate_by_category(silver, settings),
        "seller_performance": seller_performance(silver, settings, stage),
        "cross_state_impact": cross_state_impact(silver),
        "delay_review_impact": delay_review_impact(silver, settings),
        "monthly_trend": monthly_trend(silver),
        "weekday_pattern": weekday_pattern(silver),
    }


GROUPINGS = {
    "late_rate_by_state": BY_STATE.keys,
    "late_rate_by_category": BY_CATEGORY.keys,
    "seller_performance": BY_SELLER.keys,
    "cross_state_impact": BY_CROSSING.keys,
    "delay_review_impact": ("is_late",),
    "monthly_trend": BY_MONTH.keys,
    "weekday_pattern": BY_WEEKDAY.keys,
}
GROUP_COLUMNS = tuple(column for keys in GROUPINGS.values() for column in keys)


def gold_in_one_pass(
    silver: DataFrame, settings: Settings = DEFAULTS, stage: Callable[[DataFrame], DataFrame] = staged
) -> dict[str, DataFrame]:
    """The same seven tables from a single read of Silver.

    One aggregation over seven grouping sets, combined before its shuffle, holds every
    total; it has one row per state, category, seller and so on, is staged, and each
    table picks its own rows from it.
    """
    measured = _measured(silver, settings)
    sets = [[F.col(c) for c in keys] for keys in GROUPINGS.values()]
    grouped = measured.groupingSets(sets, *[F.col(c) for c in GROUP_COLUMNS]).agg(
        F.grouping_id(*GROUP_COLUMNS).alias("_grouping"),
        F.count("*").alias("_orders"),
        count_of(F.col("_late")).alias("late_orders"),
        F.count("review_score").alias("_reviewed"),
        F.sum("_bad").alias("bad_reviews"),
        mean("delivery_days").alias("avg_delivery_days"),
        mean("review_score").alias("avg_review_score"),
        mean("total_price").alias("avg_order_value"),
    )
    return _gold_of(stage(grouped), settings, stage)


def _measured(silver: DataFrame, settings: Settings) -> DataFrame:
    return silver.select(
        *GROUP_COLUMNS,
        F.col("is_late").alias("_late"),
        "delivery_days",
        "review_score",
        "total_price",
        bad_review(settings).alias("_bad"),
    )


#: Of a state: what is averaged, and the name its average is shown by.
AVERAGED = {"delivery_days": "avg_delivery_days", "review_score": "avg_review_score", "total_price": "avg_order_value"}
#: The purchase month that a state belongs to; its rows are stored by it.
STATE_MONTH = ("state_year", "state_month")


def month_states(silver: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Counts and exact sums of every group of the seven tables, by purchase month: what ``gold_of_states`` adds up.

    Has a row for each month and state, category, seller and so on, however many orders these have.
    """
    year, month = STATE_MONTH
    measured = _measured(silver, settings).withColumns({year: F.col("purchase_year"), month: F.col("purchase_month")})
    columns = (*STATE_MONTH, *GROUP_COLUMNS)
    sets = [[F.col(c) for c in (*STATE_MONTH, *keys)] for keys in GROUPINGS.values()]
    return measured.groupingSets(sets, *[F.col(c) for c in columns]).agg(
        # The months are in all sets: the bits of the other columns are those of ``gold_in_one_pass``.
        F.grouping_id(*columns).alias("_grouping"),
        F.count("*").alias("_orders"),
        count_of(F.col("_late")).alias("late_orders"),
        F.sum("_bad").alias("bad_reviews"),
        *[F.sum(c).alias(f"_sum_{c}") for c in AVERAGED],
        *[F.count(c).alias(f"_n_{c}") for c in AVERAGED],
    )


def in_months(months: Iterable[tuple[int | None, int | None]], year: str, month: str) -> Column:
    """Whether a row is of one of the months; a month without a date is (None, None). Prunes storage partitions."""
    inside = F.lit(False)
    for y, m in months:
        inside = inside | (F.col(year).eqNullSafe(F.lit(y)) & F.col(month).eqNullSafe(F.lit(m)))
    return inside


def gold_of_states(
    states: DataFrame, settings: Settings = DEFAULTS, stage: Callable[[DataFrame], DataFrame] = staged
) -> dict[str, DataFrame]:
    """The tables of ``gold_in_one_pass`` from the states of all months; no order is read."""
    added = ["_orders", "late_orders", "bad_reviews", *[f"_{kind}_{c}" for kind in ("sum", "n") for c in AVERAGED]]
    sums = states.groupBy("_grouping", *GROUP_COLUMNS).agg(*[F.sum(c).alias(c) for c in added])
    averages = {
        shown: F.try_divide(F.col(f"_sum_{c}").cast("double"), F.col(f"_n_{c}").cast("double")) for c, shown in AVERAGED.items()
    }
    totals = sums.withColumns(averages).withColumn("_reviewed", F.col("_n_review_score"))
    return _gold_of(stage(totals), settings, stage)


def _gold_of(totals: DataFrame, settings: Settings, stage: Callable[[DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """Each table's own rows of the totals of all groupings."""

    def rows(table: str, count: str = "_orders") -> DataFrame:
        # A set bit in the grouping id marks a column that is not grouped by.
        bits = ["0" if c in GROUPINGS[table] else "1" for c in GROUP_COLUMNS]
        picked = totals.where(F.col("_grouping") == int("".join(bits), 2))
        return picked.withColumn("total_orders", F.col(count))

    def rates(table: str, *shown: Column | str) -> DataFrame:
        rate = percent("late_orders", "total_orders").alias("late_rate_pct")
        return rows(table).select(*GROUPINGS[table], "total_orders", "late_orders", *shown, rate)

    by_category = rates("late_rate_by_category", F.col("avg_order_value").alias("avg_price"), "avg_review_score")
    by_seller = rates("seller_performance", "avg_delivery_days", "avg_review_score", "avg_order_value")
    reviewed = rows("delay_review_impact", "_reviewed").where("total_orders > 0")
    return {
        "late_rate_by_state": rates("late_rate_by_state", "avg_delivery_days", "avg_review_score"),
        "late_rate_by_category": min_support(by_category, settings.min_group_orders),
        "seller_performance": rank_topn(by_seller, "total_orders", settings.top_sellers, "seller_rank"),
        "cross_state_impact": rates("cross_state_impact", "avg_delivery_days", "avg_review_score"),
        "delay_review_impact": reviewed.select(
            "is_late",
            "total_orders",
            "avg_review_score",
            "bad_reviews",
            percent("bad_reviews", "total_orders").alias("bad_review_rate_pct"),
        ),
        "monthly_trend": rates("monthly_trend", "avg_order_value", "avg_review_score"),
        "weekday_pattern": rates("weekday_pattern", "avg_delivery_days"),
    }


def sort_rate_desc(kpi: DataFrame, key: str) -> DataFrame:
    """Highest late rate first, ties by key."""
    return kpi.orderBy(F.desc("late_rate_pct"), F.asc_nulls_last(key))


def sort_keys(kpi: DataFrame, *keys: str) -> DataFrame:
    return kpi.orderBy(*[F.asc_nulls_last(k) for k in keys])


_ORDER = {
    "late_rate_by_state": lambda kpi: sort_rate_desc(kpi, "customer_state"),
    "late_rate_by_category": lambda kpi: sort_rate_desc(kpi, "product_category_name_english"),
    "seller_performance": lambda kpi: sort_keys(kpi, "seller_rank", "main_seller_id"),
    "cross_state_impact": lambda kpi: sort_keys(kpi, "cross_state_delivery"),
    "delay_review_impact": lambda kpi: sort_keys(kpi, "is_late"),
    "monthly_trend": lambda kpi: sort_keys(kpi, "purchase_year", "purchase_month"),
    "weekday_pattern": lambda kpi: sort_keys(kpi, "purchase_weekday"),
}


def present(kpi: DataFrame, table: str) -> DataFrame:
    """A KPI table in its reading order."""
    return _ORDER[table](kpi)


def monthly_change(trend: DataFrame) -> DataFrame:
    """Late rate of each month against the month before. One row per month, so the
    single-partition window stays tiny."""
    before = F.lag("late_rate_pct").over(Window.orderBy("purchase_year", "purchase_month"))
    return trend.select(
        "purchase_year",
        "purchase_month",
        "late_rate_pct",
        before.alias("previous_rate_pct"),
        F.round(F.col("late_rate_pct") - before, 2).alias("change_points"),
    )


def late_rate_by_year(orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Late rate per purchase year of delivered orders, straight from the order table,
    a delivery being late when its timestamp is past the promised one."""
    rates = _delivered(orders, settings).groupBy("purchase_year").agg(
        F.count("*").alias("total_orders"), count_of(F.col("late")).alias("late_orders")
    )
    return rates.withColumn("late_rate_pct", percent("late_orders", "total_orders"))


def late_rate_shift(orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Current against reference late rate: points gained and relative change."""
    rows = _delivered(orders, settings)

    def rate(years: tuple[int, int]) -> Column:
        inside = F.col("purchase_year").between(*years)
        late = count_of(inside & F.col("late")).cast("double")
        return F.try_divide(late, count_of(inside).cast("double")) * 100

    rates = rows.agg(
        rate(settings.reference_years).alias("reference_rate_pct"),
        rate(settings.current_years).alias("current_rate_pct"),
    )
    change = F.try_divide("current_rate_pct", "reference_rate_pct") - 1
    return rates.select(
        "reference_rate_pct",
        "current_rate_pct",
        (F.col("current_rate_pct") - F.col("reference_rate_pct")).alias("shift_points"),
        (change * 100).alias("relative_change_pct"),
    )


def _delivered(orders: DataFrame, settings: Settings) -> DataFrame:
    usable = filter_delivered(orders, settings).where(F.col(calendar.DELIVERED).isNotNull())
    late = F.coalesce(calendar.is_late("instant"), F.lit(False))
    return usable.select(F.year(calendar.BOUGHT).alias("purchase_year"), late.alias("late"))
