"""Every threshold the operators use, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# The model's inputs, in training order.
FEATURES = (
    "nb_items",
    "nb_sellers",
    "total_price",
    "total_freight",
    "cross_state_delivery",
    "purchase_weekday",
    "purchase_hour",
    "estimated_weight_kg",
    "max_installments",
)

# The columns watched for drift.
WATCHED = (
    "nb_items",
    "total_price",
    "total_freight",
    "cross_state_delivery",
    "purchase_weekday",
    "purchase_hour",
    "estimated_weight_kg",
)


@dataclass(frozen=True)
class Settings:
    # cleaning
    statuses: tuple[str, ...] = ("delivered",)
    max_delivery_days: int | None = 200  # None keeps every delivery time
    max_price: float = 7000.0
    score_range: tuple[int, int] = (1, 5)
    late_grain: str = "day"  # "day": whole days late; "instant": timestamp comparison
    weekday_base: str = "sunday1"  # "sunday1": Sunday=1..Saturday=7; "monday0": Monday=0..Sunday=6
    unknown_state_crosses: bool = False
    # joins
    join_salts: int = 1  # >1 spreads each hot dimension key over that many sub-keys
    # KPI tables
    min_group_orders: int = 30
    top_sellers: int = 50
    top_states: int = 10
    reliable_min_orders: int = 50
    reliable_sellers: int = 10
    bad_review_max: int = 2
    # scoring
    risk_high: float = 0.20
    risk_medium: float = 0.10
    recent_orders: int = 40
    queue_length: int = 15
    # learning
    train_percent: int = 80
    seed: int = 42
    decision_threshold: float = 0.5
    class_weight: str = "none"  # or "balanced"
    min_precision: float = 0.60
    min_recall: float = 0.65
    # monitoring
    reference_years: tuple[int, int] = (2016, 2017)
    current_years: tuple[int, int] = (2018, 2018)
    small_domain: int = 5  # at most this many distinct values: compared as categories
    column_drift: float = 0.1
    dataset_drift_share: float = 0.5
    max_drifted_columns: int = 3
    max_drifted_share: float = 0.3
    watched: tuple[str, ...] = field(default=WATCHED)

    def but(self, **changes) -> "Settings":
        return replace(self, **changes)

    def period_label(self, years: tuple[int, int]) -> str:
        return str(years[0]) if years[0] == years[1] else f"{years[0]}-{years[1]}"


DEFAULTS = Settings()
