from dataclasses import replace
from itertools import groupby

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, FEATURES
from orderlens.operators import blocks, dataset, evaluation, model, queue, rounds
from orderlens.plans import retraining
from orderlens.registry import queries
from orderlens.registry.inputs import SETTINGS
from orderlens.registry.queries import QUICK
from orderlens.session import staged


@pytest.fixture(scope="module")
def rows(silver):
    return staged(dataset.training_set(silver))


@pytest.fixture(scope="module")
def split(rows):
    return staged(dataset.with_split(rows))


@pytest.fixture(scope="module")
def fitted(split):
    return model.train(split.where("is_train"), QUICK)


def test_training_and_scoring_see_the_same_vector(silver):
    """Train and serve agree, for every order."""
    trained = dataset.training_set(silver).drop("label")
    served = queue.feature_defaults(silver)
    assert trained.columns == served.columns == ["order_id", *FEATURES]
    assert trained.exceptAll(served).count() == 0


def test_queue_and_its_training_set_share_features(inputs):
    """What the queue sends is what its model was trained on, order by order."""
    trained = dataset.training_set_of_orders(inputs.tables, SETTINGS)
    delivered = inputs["orders"].where("order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL")
    served = queue.feature_defaults(queue.payloads(delivered, inputs.tables, SETTINGS))
    assert trained.columns == [*served.columns, "label"]
    assert trained.drop("label").exceptAll(served).count() == 0
    assert trained.count() == served.count() > 262


def test_split_is_exact_per_class(rows, split):
    per_class = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    taken = {r.label: r["count"] for r in split.where("is_train").groupBy("label").count().collect()}
    assert taken == {label: n * 80 // 100 for label, n in per_class.items()}
    assert split.count() == rows.count()


def test_split_ignores_row_order_and_depends_on_the_seed(rows, split):
    again = dataset.with_split(rows.orderBy(F.rand(3)).repartition(5))
    assert again.select("order_id", "is_train").exceptAll(split.select("order_id", "is_train")).count() == 0
    other = dataset.with_split(rows, DEFAULTS.but(seed=7))
    assert other.select("order_id", "is_train").exceptAll(split.select("order_id", "is_train")).count() > 0


@pytest.mark.parametrize("percent", [0, 33, 100])
def test_split_shares(spark, percent):
    rows = spark.range(5000).selectExpr("CAST(id AS string) AS order_id", "CAST(id % 17 = 0 AS int) AS label")
    got = dataset.with_split(rows, DEFAULTS.but(train_percent=percent)).where("is_train")
    assert got.where("label = 1").count() == 295 * percent // 100
    assert got.where("label = 0").count() == 4705 * percent // 100


def test_split_of_a_single_row(spark):
    rows = spark.range(1).selectExpr("CAST(id AS string) AS order_id", "1 AS label")
    assert [r.is_train for r in dataset.with_split(rows).collect()] == [False]


def test_weights(table):
    labelled = table("label int", (1,), (0,), (0,), (0,))
    assert dataset.class_weight(labelled).first().positive_weight == 3.0
    assert {r.weight for r in dataset.with_weight(labelled).collect()} == {1.0}
    balanced = dataset.with_weight(labelled, DEFAULTS.but(class_weight="balanced"))
    assert sorted(r.weight for r in balanced.collect()) == [1.0, 1.0, 1.0, 3.0]
    assert dataset.class_weight(labelled.where("label = 0")).first().positive_weight is None
    with pytest.raises(ValueError):
        dataset.with_weight(labelled, DEFAULTS.but(class_weight="other"))


def test_scores_are_probabilities(split, fitted):
    scored = model.predict(fitted, split)
    assert scored.where("probability < 0 OR probability > 1 OR probability IS NULL").count() == 0
    assert scored.select("probability").distinct().count() > 1


def test_saved_model_scores_alike(spark, split, fitted, tmp_path):
    model.save(fitted, f"{tmp_path}/model")
    loaded = model.load(f"{tmp_path}/model")
    one = model.predict(fitted, split).select("order_id", "probability")
    assert one.exceptAll(model.predict(loaded, split).select("order_id", "probability")).count() == 0


def test_score_batch_fills_defaults(spark, table, fitted):
    got = model.score_batch(fitted, table("order_id string, nb_items int", ("a", None), ("b", 3))).collect()
    assert {r.order_id for r in got} == {"a", "b"}
    assert all(r.risk.level in ("low", "medium", "high") for r in got)


def test_importances(spark, fitted):
    got = model.feature_importance(fitted, spark).collect()
    assert {r.feature for r in got} == set(FEATURES)
    assert sum(r.importance for r in got) == pytest.approx(1.0)
    assert [r.importance for r in got] == sorted((r.importance for r in got), reverse=True)


def test_validation_rows_are_reported(split):
    held = split.withColumn("held_out", ~F.col("is_train"))
    fitted = model.train(held, QUICK, validation="held_out")
    losses = {r.is_train: r for r in model.validation_losses(model.predict(fitted, held)).collect()}
    assert set(losses) == {True, False}
    assert all(0 < r.logloss < 1 and 0 <= r.error <= 1 for r in losses.values())


def test_grid_search_returns_the_best(split):
    grid = {"maxIter": (2,), "maxDepth": (1, 3), "stepSize": (0.1,)}
    best, results = model.tune(split, DEFAULTS.but(class_weight="balanced"), grid, folds=2)
    scores = {r.maxDepth: r.avg_recall for r in results.collect()}
    assert best.stages[-1].getMaxDepth() == max(scores, key=scores.get)
    assert model.GRID == {"maxIter": (200, 400, 600), "maxDepth": (4, 5, 6), "stepSize": (0.03, 0.05, 0.1)}


SCORES = "label int, probability double"


def test_metrics_by_hand(table):
    scored = table(SCORES, (1, 0.9), (1, 0.3), (0, 0.8), (0, 0.1), (0, 0.5))
    got = evaluation.classification_metrics(scored).first()
    assert (got.tp, got.fp, got.fn, got.tn) == (1, 2, 1, 1)
    assert (got.precision, got.recall, got.f1_score) == (1 / 3, 0.5, 0.4)
    low = evaluation.classification_metrics(scored, 0.2).first()
    assert (low.precision, low.recall) == (0.5, 1.0)


def test_metrics_of_nothing_are_zero(table):
    got = evaluation.classification_metrics(table(SCORES, (0, 0.1)).limit(0)).first()
    assert (got.n_rows, got.precision, got.recall, got.f1_score) == (0, 0.0, 0.0, 0.0)


def test_auc_against_all_pairs(table):
    rng = np.random.default_rng(5)
    data = [(int(rng.random() < 0.3), float(round(rng.random(), 2))) for _ in range(120)]
    late = [p for y, p in data if y]
    punctual = [p for y, p in data if not y]
    wins = sum((a > b) + (a == b) / 2 for a in late for b in punctual)
    got = evaluation.roc_auc(table(SCORES, *data)).first()
    assert got.roc_auc == pytest.approx(wins / (len(late) * len(punctual)))
    assert evaluation.roc_auc(table(SCORES, (1, 0.5))).first().roc_auc is None


def test_roc_auc_ranks_scores_as_they_are(spark):
    """Forty scores within 4e-5, the late ones above the others."""
    rows = spark.range(40).selectExpr("CAST(id >= 20 AS int) AS label", "0.3 + id * 1e-6 AS probability")
    assert evaluation.roc_auc(rows.withColumn("probability", rows.probability.cast("double"))).first().roc_auc == 1.0


def test_close_scores_are_spread_over_all_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(40_000).selectExpr("CAST(id * 7919 % 11 = 0 AS int) AS label", "0.25D + (id * 7907 % 30011) * 3e-10D AS probability")
    sizes = [r["count"] for r in blocks.in_blocks(rows.select("probability").distinct(), "probability").groupBy("block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / 8
    data = [(r.label, r.probability) for r in rows.collect()]
    order = sorted(data, key=lambda x: x[1])
    wins = below = 0.0
    for _, tied in groupby(order, key=lambda x: x[1]):
        tied = list(tied)
        punctual = sum(1 - y for y, _ in tied)
        wins += (len(tied) - punctual) * (below + punctual / 2)
        below += punctual
    got = evaluation.roc_auc(rows).first()
    assert got.roc_auc == pytest.approx(wins / (got.n_late * got.n_punctual))


def test_calibration_bands(table):
    got = {r.band: (r.n_rows, r.mean_predicted, r.observed_rate)
           for r in evaluation.calibration_check(table(SCORES, (1, 0.05), (0, 0.09), (1, 1.0))).collect()}
    assert got == {"0": (2, 0.07, 0.5), "9": (1, 1.0, 1.0), "all": (3, 0.38, 0.666667)}


@pytest.mark.parametrize(
    "precision, recall, decision",
    [(0.60, 0.65, "deploy_model"), (0.59, 0.99, "alert_low_metrics"), (0.99, 0.64, "alert_low_metrics")],
)
def test_gate(table, precision, recall, decision):
    metrics = table("precision double, recall double", (precision, recall))
    assert evaluation.promotion_gate(metrics).first().decision == decision


def test_report(silver):
    report = retraining.train_and_evaluate(silver, QUICK, SETTINGS).report.first()
    assert report.n_train + report.n_test == silver.count()
    assert report.decision in ("deploy_model", "alert_low_metrics")
    assert 0 < report.base_rate < 1 and 0 <= report.roc_auc <= 1


def test_rounds_are_the_smaller_models(split):
    """Two of six rounds are the model of two trees, with rows and columns drawn for each tree."""
    params = replace(model.MONTHLY, trees=6, depth=4)
    train = split.where("is_train")
    six, two = (model.train(train, replace(params, trees=n)) for n in (6, 2))
    got = {(r.is_train, r["round"]): r for r in rounds.by_round(six, split).collect()}
    assert sorted(got) == [(side, n) for side in (False, True) for n in range(1, 7)]
    for fitted, n in ((six, 6), (two, 2)):
        predicted = model.predict(fitted, split)
        for r in model.validation_losses(predicted).collect():
            mine = got[r.is_train, n]
            assert (mine.n_rows, mine.error) == (r.n_rows, pytest.approx(r.error))
            assert mine.logloss == pytest.approx(r.logloss, abs=1e-12)
            counts = evaluation.classification_metrics(predicted.where(F.col("is_train") == r.is_train)).first()
            assert (mine.tp, mine.fp, mine.fn, mine.tn) == (counts.tp, counts.fp, counts.fn, counts.tn)
    assert [r["round"] for r in rounds.by_round(six, split, by=(), at=(2, 5)).orderBy("round").collect()] == [2, 5]
    assert rounds.by_round(six, split.limit(0)).count() == 0
    with pytest.raises(ValueError, match="6 rounds"):
        rounds.by_round(six, split, at=(7,))


def test_stopped_training_has_the_rounds_that_helped(split):
    held = split.withColumn("held_out", ~F.col("is_train"))
    fitted = model.train(held, replace(QUICK, trees=40, depth=5, rate=0.9), validation="held_out")
    losses = model.losses_by_round(fitted, held).where("NOT is_train").orderBy("round").collect()
    assert 1 <= len(losses) < 40
    assert min(losses, key=lambda r: r.logloss)["round"] == len(losses)
    last = model.validation_losses(model.predict(fitted, held)).where("NOT is_train").first()
    assert (losses[-1].n_rows, losses[-1].error) == (last.n_rows, last.error)
    assert losses[-1].logloss == pytest.approx(last.logloss)


def test_tuned_points_equal_separate_training(split):
    """Every point of the grid by itself, fold by fold, against the prefixes."""
    rows = split.where("is_train").withColumn("fold", F.expr("CAST(order_id AS BIGINT) % 2"))
    grid = {"stepSize": (0.1, 0.5), "maxIter": (1, 3), "maxDepth": (3,)}
    settings = DEFAULTS.but(class_weight="balanced")
    best, points = model.tune(rows, settings, grid, folds=2, fold="fold")
    weighted = dataset.with_weight(rows, settings)
    base = model.TreeParams(row_share=1.0, column_share=1.0, min_leaf=1)
    for point in points.collect():
        recalls = []
        for fold in (0, 1):
            trees = model._trees(replace(base, trees=int(point.maxIter), depth=3, rate=point.stepSize), settings.seed)
            fitted = Pipeline(stages=[model.assembler(), trees]).fit(weighted.where(F.col("fold") != fold))
            recalls.append(evaluation.classification_metrics(model.predict(fitted, rows.where(F.col("fold") == fold))).first().recall)
        assert point.avg_recall == pytest.approx(sum(recalls) / 2)
    top = points.orderBy(F.desc("avg_recall")).first()
    assert best.stages[-1].getNumTrees in {int(r.maxIter) for r in points.collect() if r.avg_recall == top.avg_recall}


def test_rows_to_learn_from_are_made_once(spark):
    """The split reads its rows three times, what is behind them runs once."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    values = ", ".join(f"CAST(id % {i + 2} AS double) AS {name}" for i, name in enumerate(FEATURES))
    rows = spark.sql(f"SELECT CAST(id AS string) AS order_id, {values}, CAST(id % 5 = 0 AS int) AS label FROM range(400)")
    retraining.fit_and_judge(rows.mapInArrow(count, rows.schema), QUICK, SETTINGS)
    assert made.value == 400


def test_production_presets_in_the_queries(spark, inputs, monkeypatch):
    # The queries ask for all trees and the whole grid; the models themselves would take hours here.
    asked = []

    def stop(*given, **named):
        asked.append((given, named))
        raise InterruptedError

    monkeypatch.setattr(queries.retraining, "monthly_job", stop)
    monkeypatch.setattr(queries.model, "tune", stop)
    for name in ("d06_monthly_job", "m07_grid_of_27_points"):
        with pytest.raises(InterruptedError):
            queries.QUERIES[name](inputs)
    assert asked[0][0][2] == model.MONTHLY and asked[0][0][2].class_weight == "balanced"
    assert asked[1][0][2] == model.GRID
