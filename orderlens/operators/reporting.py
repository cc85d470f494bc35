"""Reporting views and the five validation questions over the KPI tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, Settings
from orderlens.functions.measures import percent


def executive_dashboard(trend: DataFrame) -> DataFrame:
    """One row over all months. The two averages are plain means of the monthly means,
    not weighted by orders; with no order every figure but the totals is null."""
    totals = trend.agg(
        F.coalesce(F.sum("total_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.coalesce(F.sum("late_orders"), F.lit(0)).cast("bigint").alias("total_late_orders"),
        F.round(F.avg("avg_review_score"), 6).alias("avg_review_score"),
        F.round(F.avg("avg_order_value"), 6).alias("avg_order_value"),
    )
    return totals.withColumn("global_late_rate_pct", percent("total_late_orders", "total_orders"))


def top_risk_states(by_state: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return (
        by_state.select("customer_state", "total_orders", "late_rate_pct", "avg_review_score")
        .orderBy(F.desc("late_rate_pct"), F.asc_nulls_last("customer_state"))
        .limit(settings.top_states)
    )


def reliable_sellers(sellers: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Least late first among sellers with enough orders."""
    return (
        sellers.where(F.col("total_orders") >= settings.reliable_min_orders)
        .select("main_seller_id", "seller_state", "total_orders", "late_rate_pct", "avg_review_score")
        .orderBy("late_rate_pct", "main_seller_id")
        .limit(settings.reliable_sellers)
    )


def late_label(flag: str = "is_late") -> Column:
    return F.when(F.col(flag), "En retard").otherwise("A l'heure")


def crossing_label(flag: str = "cross_state_delivery") -> Column:
    return F.when(F.col(flag), "Inter-etats").otherwise("Meme etat")


def review_by_lateness(impact: DataFrame) -> DataFrame:
    return impact.select(
        late_label().alias("statut"), "total_orders", "avg_review_score", "bad_review_rate_pct"
    )


def cross_vs_same_state(impact: DataFrame) -> DataFrame:
    return impact.select(
        crossing_label().alias("type_livraison"), "total_orders", "late_rate_pct", "avg_delivery_days"
    )


def register_views(gold: Mapping[str, DataFrame], settings: Settings = DEFAULTS) -> None:
    """KPI tables and the two reporting views as temporary views, for SQL users."""
    for name, df in gold.items():
        df.createOrReplaceTempView(name)
    executive_dashboard(gold["monthly_trend"]).createOrReplaceTempView("v_executive_dashboard")
    top_risk_states(gold["late_rate_by_state"], settings).createOrReplaceTempView("v_top_risk_states")
