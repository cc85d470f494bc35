"""Scoring rules as column expressions: feature defaults, risk levels, priority rewards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, FEATURES, Settings

# What a missing feature becomes, and the type the model sees.
FEATURE_DEFAULTS = {
    "nb_items": (1, "int"),
    "nb_sellers": (1, "int"),
    "total_price": (0.0, "double"),
    "total_freight": (0.0, "double"),
    "cross_state_delivery": (0, "int"),
    "purchase_weekday": (1, "int"),
    "purchase_hour": (12, "int"),
    "estimated_weight_kg": (1.0, "double"),
    "max_installments": (1, "int"),
}

# Label, colour and advice of each risk level.
RISK_LEVELS = {
    "high": ("Risque eleve", "red", "Relancer le vendeur immediatement + prevenir le client"),
    "medium": ("Risque modere", "orange", "Surveiller l'expedition"),
    "low": ("Risque faible", "green", "Aucune action requise"),
}

# Text and colour of the badge shown for a risk percentage.
RISK_BADGES = {
    "high": ("Risque elevé", "danger"),
    "medium": ("Risque modéré", "warning"),
    "low": ("Risque faible", "success"),
}

# Per priority (0 low, 1 normal, 2 high) the share of risk it removes and its cost.
PRIORITIES = {0: (0.0, 0.0), 1: (0.3, 0.05), 2: (0.7, 0.15)}
URGENT_BELOW, RISKY_ABOVE, URGENT_BONUS = 0.2, 0.15, 0.3


def feature_columns(present: set[str] | None = None) -> list[Column]:
    """The nine features in training order; a null or absent one takes its default."""
    out = []
    for name in FEATURES:
        default, kind = FEATURE_DEFAULTS[name]
        given = F.col(name).cast(kind) if present is None or name in present else F.lit(None).cast(kind)
        out.append(F.coalesce(given, F.lit(default).cast(kind)).alias(name))
    return out


def _tiered(value: Column, high: float, medium: float, by_level) -> Column:
    return (
        F.when(value >= high, by_level("high"))
        .when(value >= medium, by_level("medium"))
        .otherwise(by_level("low"))
    )


def risk_level(probability: Column, settings: Settings = DEFAULTS) -> Column:
    return _tiered(probability, settings.risk_high, settings.risk_medium, F.lit)


def risk_to_action(probability: Column, settings: Settings = DEFAULTS) -> Column:
    """struct(level, label, color, action) from the unrounded probability."""

    def describe(level: str) -> Column:
        label, color, action = RISK_LEVELS[level]
        return F.struct(
            F.lit(level).alias("level"),
            F.lit(label).alias("label"),
            F.lit(color).alias("color"),
            F.lit(action).alias("action"),
        )

    return _tiered(probability, settings.risk_high, settings.risk_medium, describe)


def risk_badge(percentage: Column) -> Column:
    """struct(text, color) from a risk percentage."""

    def describe(level: str) -> Column:
        text, color = RISK_BADGES[level]
        return F.struct(F.lit(text).alias("text"), F.lit(color).alias("color"))

    return _tiered(percentage, 20, 10, describe)


def short_id(identifier: str = "order_id") -> Column:
    """Display form only; joins use the whole identifier."""
    return F.substring(identifier, 1, 10)


def reward(priority: int, risk: Column, value: Column, urgency: Column) -> Column:
    relief, cost = PRIORITIES[priority]
    gain = risk * relief * value * 2.0 - cost
    if priority == 2:
        urgent = (urgency < URGENT_BELOW) & (risk > RISKY_ABOVE)
        gain = gain + F.when(urgent, URGENT_BONUS).otherwise(0.0)
    return gain
