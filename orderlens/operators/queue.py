"""The order queue: recent orders as payloads, scores attached, riskiest first."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, Settings
from orderlens.functions import calendar
from orderlens.functions.measures import count_of, half_up
from orderlens.functions.risk import PRIORITIES, feature_columns, reward, risk_level, risk_to_action
from orderlens.operators import cleaning, silver

# A short list of orders is broadcast up to this length, and joined beyond it.
SHORT_LIST = 100_000


def having_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.join(items.select("order_id"), "order_id", "left_semi")


def recent_orders(orders: DataFrame, items: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """The latest orders, of any status, that have items: a semi-join on the key, then a limit per task."""
    newest = [F.desc_nulls_last(calendar.BOUGHT), F.asc("order_id")]
    return having_items(orders, items).orderBy(*newest).limit(settings.recent_orders)


def payloads(
    orders: DataFrame,
    tables: Mapping[str, DataFrame],
    settings: Settings = DEFAULTS,
    chosen: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Orders in the shape the scoring job takes, with state for display and the order
    columns named in ``keep``.

    Weekday numbering and the cross-state rule are those of Silver; items are counted and
    weighed unfiltered. ``dataset.training_set_of_orders`` trains on the same columns.
    ``chosen`` says the orders are ``recent_orders`` ones: only their items and payments are then
    aggregated, found by a semi-join, which broadcasts the list if the setting keeps it short.
    """
    items, payments = tables["order_items"], tables["payments"]
    if chosen:
        ids = orders.select("order_id")
        ids = F.broadcast(ids) if settings.recent_orders <= SHORT_LIST else ids
        items, payments = (t.join(ids, "order_id", "left_semi") for t in (items, payments))
    joined = (
        orders.join(cleaning.items_weight_by_order(items, tables["products"], settings), "order_id")
        .join(cleaning.max_installments_by_order(payments), "order_id", "left")
        .transform(silver.with_customers, tables["customers"], settings)
        .transform(silver.with_sellers, tables["sellers"], settings)
    )
    return payload_projection(joined, settings, keep)


def payload_projection(joined: DataFrame, settings: Settings = DEFAULTS, keep: tuple[str, ...] = ()) -> DataFrame:
    return joined.select(
        "order_id",
        F.col("nb_items").cast("int").alias("nb_items"),
        F.col("nb_sellers").cast("int").alias("nb_sellers"),
        F.col("total_price").cast("double").alias("total_price"),
        F.col("total_freight").cast("double").alias("total_freight"),
        silver.cross_state(settings).alias("cross_state_delivery"),
        calendar.weekday(settings.weekday_base).alias("purchase_weekday"),
        F.hour(calendar.BOUGHT).alias("purchase_hour"),
        F.coalesce(F.col("estimated_weight_kg"), F.lit(0.0)).alias("estimated_weight_kg"),
        F.coalesce(F.col("max_installments"), F.lit(1)).alias("max_installments"),
        F.col("customer_state").alias("state"),
        *keep,
    )


def feature_defaults(orders: DataFrame) -> DataFrame:
    """Order id and the nine model inputs, defaults filled in, anything else dropped."""
    return orders.select("order_id", *feature_columns(set(orders.columns)))


def describe_risk(scored: DataFrame, probability: str = "probability", settings: Settings = DEFAULTS) -> DataFrame:
    """Rounded probability and percentage, and the advice for the unrounded probability."""
    p = F.col(probability)
    return scored.select(
        "order_id",
        half_up(p, 4).alias("risk_proba"),
        half_up(p * 100, 1).alias("risk_pct"),
        risk_to_action(p, settings).alias("risk"),
    )


def risk_level_counts(scored: DataFrame, probability: str = "probability", settings: Settings = DEFAULTS) -> DataFrame:
    """Orders, and how many at each level, in one row."""
    level = risk_level(F.col(probability), settings)
    return scored.agg(
        F.count("*").alias("n_orders"),
        *[count_of(level == name).alias(f"n_{name}") for name in ("high", "medium", "low")],
    )


def scores_to_orders(scores: DataFrame, orders: DataFrame) -> DataFrame:
    """State and amount of each scored order; an unknown order shows a dash and zero."""
    shown = orders.select("order_id", "state", "total_price")
    return scores.join(shown, "order_id", "left").select(
        "order_id",
        F.coalesce("state", F.lit("—")).alias("state"),
        F.coalesce("total_price", F.lit(0.0)).alias("total_price"),
        "risk_pct",
    )


def priority_queue(scored: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Riskiest orders first, ties by id."""
    return scored.orderBy(F.desc("risk_pct"), "order_id").limit(settings.queue_length)


def priority_policy(scored: DataFrame, risk: str = "risk", value: str = "value", urgency: str = "urgency") -> DataFrame:
    """Best priority (0 low, 1 normal, 2 high) of each order and its reward.

    Orders do not influence each other, so the best choice per order is the best policy.
    A tie goes to the cheaper priority.
    """
    rewards = {p: reward(p, F.col(risk), F.col(value), F.col(urgency)) for p in PRIORITIES}
    valued = scored.withColumns({f"reward_{p}": column for p, column in rewards.items()})
    best = F.greatest(*[F.col(f"reward_{p}") for p in PRIORITIES])
    choice: Column = F.when(F.col("reward_0") == best, 0).when(F.col("reward_1") == best, 1).otherwise(2)
    return valued.withColumns({"best_reward": best, "priority": choice})
