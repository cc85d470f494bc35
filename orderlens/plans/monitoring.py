"""Drift and performance of two periods in one pass over scored Silver rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, Settings
from orderlens.operators import drift
from orderlens.session import staged

OUTCOME = "outcome"


def run_monitoring(
    scored: DataFrame, settings: Settings = DEFAULTS, stage: Callable[[DataFrame], DataFrame] = staged
) -> dict[str, DataFrame]:
    """Reports from Silver rows with a ``probability``.

    The outcome of each prediction is counted as one more column next to the watched ones,
    so features and performance come from a single aggregation of the rows.
    """
    predicted = (F.col("probability") >= settings.decision_threshold).cast("int")
    rows = drift.with_period(scored, settings).withColumn(OUTCOME, F.col("is_late").cast("int") * 2 + predicted)
    counts = stage(drift.value_counts(rows, (*settings.watched, OUTCOME)))
    columns = drift.judge(drift.distances(counts.where(F.col("column_name") != OUTCOME)), settings)
    dataset = drift.dataset_drift(columns, settings)
    by_period = drift.outcome_metrics(counts.where(F.col("column_name") == OUTCOME))
    return {
        "columns": columns,
        "dataset": dataset,
        "by_period": by_period,
        "tests": drift.drift_tests(dataset, settings),
        "summary": drift.monitoring_summary(dataset, by_period, settings),
    }
