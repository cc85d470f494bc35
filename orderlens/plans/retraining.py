"""The monthly job: Silver, Gold, training, promotion decision, monitoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, Settings
from orderlens.functions.risk import feature_columns
from orderlens.operators import dataset, model
from orderlens.plans import medallion, monitoring
from orderlens.schemas import SOURCES
from orderlens.session import staged
from orderlens.sources import lake


@dataclass
class Training:
    model: PipelineModel
    report: DataFrame
    predicted_test: DataFrame


@dataclass
class MonthlyRun:
    quality: DataFrame
    gold: dict[str, DataFrame]
    training: Training
    queue: Training
    monitoring: dict[str, DataFrame]


def train_and_evaluate(
    silver: DataFrame, params: model.TreeParams = model.MONTHLY, settings: Settings = DEFAULTS
) -> Training:
    """Fit on the training share of Silver, judge on the rest. The rows are staged: the split
    and every tree read them again."""
    return fit_and_judge(dataset.training_set(silver), params, settings)


def fit_and_judge(labelled: DataFrame, params: model.TreeParams, settings: Settings) -> Training:
    """The same for any labelled rows, cut off where the preset says. They are staged before the split too, which reads
    them three times: joins behind them run once."""
    settings = settings.but(decision_threshold=params.threshold)
    rows = staged(dataset.with_split(staged(labelled), settings))
    train = rows.where("is_train")
    fitted = model.train(train, params, settings)
    predicted = staged(model.predict(fitted, rows.where("NOT is_train")))
    return Training(fitted, model.training_report(train, predicted, settings), predicted)


def monthly_job(
    spark: SparkSession,
    lakehouse: str,
    params: model.TreeParams = model.MONTHLY,
    settings: Settings = DEFAULTS,
) -> MonthlyRun:
    """From stored Bronze on. Two models are trained: one on Silver rows, and that of the order queue and
    the stream, on orders as these send them. Each is saved if it passes the gate. Monitoring runs either
    way, on the Silver rows the model was not fitted to."""
    quality = medallion.refine(spark, lakehouse, settings)
    gold = medallion.publish(spark, lakehouse, settings)
    silver = lake.read_silver(spark, f"{lakehouse}/silver/orders_consolidated")
    training = train_and_evaluate(silver, params, settings)
    report = staged(training.report)
    training.report = report
    lake.write_json(report, f"{lakehouse}/reports/training")
    lake.write_json(model.feature_importance(training.model, spark), f"{lakehouse}/reports/feature_importance")
    if report.where("decision = 'deploy_model'").take(1):
        model.save(training.model, f"{lakehouse}/models/late_delivery")
    bronze = {name: lake.read_bronze(spark, f"{lakehouse}/bronze", name) for name in SOURCES}
    waiting = fit_and_judge(dataset.training_set_of_orders(bronze, settings), params, settings)
    waiting.report = staged(waiting.report)
    lake.write_json(waiting.report, f"{lakehouse}/reports/queue_training")
    if waiting.report.where("decision = 'deploy_model'").take(1):
        model.save(waiting.model, f"{lakehouse}/models/order_queue")
    fresh = silver.join(training.predicted_test.select("order_id"), "order_id", "left_semi")
    judged = settings.but(decision_threshold=params.threshold)
    watched = monitoring.run_monitoring(_scored(fresh, training.model), judged)
    record = watched["summary"].withColumn("generated_at", F.current_timestamp())
    lake.write_json(record, f"{lakehouse}/reports/monitoring")
    return MonthlyRun(quality, gold, training, waiting, watched)


def _scored(silver: DataFrame, fitted: PipelineModel) -> DataFrame:
    """Silver rows with a probability. The model reads a copy of the features with defaults,
    so the watched columns keep their nulls."""
    features = F.struct(*feature_columns())
    keep = F.struct(*[F.col(c) for c in silver.columns])
    rows = silver.select(keep.alias("kept"), features.alias("given")).select("kept", "given.*")
    return model.predict(fitted, rows).select("kept.*", "probability")
