"""The late-delivery classifier: boosted trees fitted, tuned, stored and applied by Spark ML."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, FEATURES, Settings
from orderlens.functions.measures import half_up
from orderlens.operators import evaluation, rounds
from orderlens.operators.dataset import LABEL, with_weight
from orderlens.operators.queue import describe_risk, feature_defaults
from orderlens.session import shared_folder, staged


@dataclass(frozen=True)
class TreeParams:
    """Trees, and the class weight and cut-off that belong to them: weighted trees are cut at one half."""

    trees: int = 500
    depth: int = 5
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    min_leaf: int = 3
    class_weight: str = "balanced"  # or "none"
    threshold: float = 0.5
    bins: int = 32  # candidate thresholds a feature; all of them if it has no more values


# Settings of the monthly, the local and the scheduled training runs.
MONTHLY = TreeParams()
LOCAL = TreeParams(trees=300, depth=6, rate=0.1, min_leaf=1, class_weight="none", threshold=0.20)
SCHEDULED = TreeParams(trees=400, min_leaf=1)

# The tuning grid.
GRID = {"maxIter": (200, 400, 600), "maxDepth": (4, 5, 6), "stepSize": (0.03, 0.05, 0.1)}


def assembler(features: tuple[str, ...] = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def _trees(params: TreeParams, seed: int) -> GBTClassifier:
    return GBTClassifier(
        labelCol=LABEL,
        featuresCol="features",
        weightCol="weight",
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.rate,
        subsamplingRate=params.row_share,
        featureSubsetStrategy=str(params.column_share),
        minInstancesPerNode=params.min_leaf,
        maxBins=params.bins,
        checkpointInterval=10,
        seed=seed,
    )


def train(
    rows: DataFrame, params: TreeParams = MONTHLY, settings: Settings = DEFAULTS, validation: str | None = None
) -> PipelineModel:
    """Fit on rows of ``training_set``. ``validation`` names a boolean column marking rows
    that only decide when to stop adding trees. The per-tree lineage is cut by checkpoints
    in the shared folder."""
    shared_folder(rows.sparkSession)
    trees = _trees(params, settings.seed)
    if validation:
        trees = trees.setValidationIndicatorCol(validation)
    return Pipeline(stages=[assembler(), trees]).fit(with_weight(rows, settings.but(class_weight=params.class_weight)))


def losses_by_round(fitted: PipelineModel, rows: DataFrame, by: tuple[str, ...] = ("is_train",)) -> DataFrame:
    """Log loss and error rate of each side after every round. A model trained with ``validation`` has as many rounds as
    helped its validation rows, so the last round is where its training stopped."""
    return rounds.by_round(fitted, rows, by).select(*by, "round", "n_rows", "logloss", "error")


def tune(
    rows: DataFrame,
    settings: Settings = DEFAULTS,
    grid: dict[str, tuple] | None = None,
    folds: int = 3,
    parallelism: int = 4,
    params: TreeParams = TreeParams(row_share=1.0, column_share=1.0, min_leaf=1),
    fold: str | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated grid search for recall of late orders: best model, and one row per grid point.

    A boosted ensemble holds those of all smaller numbers of trees as its prefixes. So only the largest ``maxIter`` is
    trained for each fold and each choice of the other parameters, and its rounds are judged in one pass over
    the rows held out. ``fold`` names a column with the number of each row's fold; by default rows are
    dealt by a hash of their contents. Equal recalls go to the first point of the grid.
    """
    spark = rows.sparkSession
    shared_folder(spark)
    grid = dict(grid or GRID)
    others = [name for name in grid if name != "maxIter"]
    sizes = sorted(set(grid.get("maxIter", (params.trees,))))
    number = F.col(fold) if fold else F.pmod(F.xxhash64(*rows.columns, F.lit(settings.seed)), F.lit(folds))
    dealt = staged(with_weight(rows, settings).withColumn("_fold", number.cast("int")), "folds")
    trees = _trees(params, settings.seed)

    def pipeline(point: dict) -> Pipeline:
        return Pipeline(stages=[assembler(), trees.copy({trees.getParam(n): v for n, v in point.items()})])

    def judge(cell: dict, held: int) -> dict[int, float]:
        fitted = pipeline({**cell, "maxIter": sizes[-1]}).fit(dealt.where(F.col("_fold") != held))
        found = rounds.by_round(fitted, dealt.where(F.col("_fold") == held), by=(), at=sizes).collect()
        # A row a number of trees. A fold without late orders has no recall to speak of: zero.
        return {r["round"]: r.tp / (r.tp + r.fn) if r.tp + r.fn else 0.0 for r in found}

    cells = [dict(zip(others, values)) for values in product(*(grid[n] for n in others))]
    tasks = [(cell, held) for cell in cells for held in range(folds)]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        judged = pool.map(inheritable_thread_target(spark)(lambda task: judge(*task)), tasks)
    scores = {}
    for (cell, _), found in zip(tasks, judged):
        for size in sizes:
            point = (*cell.values(), size)
            scores[point] = scores.get(point, 0.0) + found.get(size, 0.0) / folds
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    results = [(p, scores[(*(p[n] for n in others), p.get("maxIter", sizes[-1]))]) for p in points]
    best = max(results, key=lambda r: r[1])[0]
    columns = ", ".join(f"{n} double" for n in grid)
    # One row per grid point: bounded by the grid, not by the data.
    table = spark.createDataFrame([(*map(float, p.values()), s) for p, s in results], f"{columns}, avg_recall double")
    return pipeline(best).fit(dealt), table


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with the probability of being late; no row-wise Python."""
    scored = model.transform(rows)
    late = vector_to_array("probability").getItem(1)
    return scored.withColumn("probability", late).drop("features", "rawPrediction", "prediction")


def score_batch(model: PipelineModel, orders: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Orders in payload shape to rounded probabilities and advice."""
    return describe_risk(predict(model, feature_defaults(orders)), "probability", settings)


def feature_importance(model: PipelineModel, spark) -> DataFrame:
    """Features by importance; nine rows."""
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(w)) for name, w in zip(model.stages[0].getInputCols(), weights)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def validation_losses(predicted: DataFrame) -> DataFrame:
    """Log loss and error rate of predicted rows, by train and validation side."""
    bounded = F.greatest(F.least(F.col("probability"), F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = -F.when(F.col(LABEL) == 1, F.log(bounded)).otherwise(F.log(1 - bounded))
    wrong = ((F.col("probability") >= 0.5).cast("int") != F.col(LABEL)).cast("int")
    return predicted.groupBy("is_train").agg(
        F.count("*").alias("n_rows"), F.avg(loss).alias("logloss"), F.avg(wrong).alias("error")
    )


def training_report(train_rows: DataFrame, predicted_test: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: sizes, base rate, metrics on the test rows, thresholds."""
    sizes = train_rows.agg(F.count("*").alias("n_train"), F.avg(LABEL).alias("base_rate"))
    metrics = evaluation.classification_metrics(predicted_test, threshold=settings.decision_threshold)
    n_train, base_rate = (sizes.select(c).scalar() for c in ("n_train", "base_rate"))
    auc = evaluation.roc_auc(predicted_test).select("roc_auc").scalar()
    return metrics.select(
        n_train.alias("n_train"),
        F.col("n_rows").alias("n_test"),
        half_up(base_rate, 4).alias("base_rate"),
        half_up(F.col("precision"), 4).alias("precision"),
        half_up(F.col("recall"), 4).alias("recall"),
        half_up(F.col("f1_score"), 4).alias("f1_score"),
        half_up(auc, 4).alias("roc_auc"),
        F.lit(settings.decision_threshold).alias("decision_threshold"),
        F.lit(settings.risk_high).alias("action_threshold"),
        F.lit(settings.risk_medium).alias("watch_threshold"),
        evaluation.gate(settings).alias("decision"),
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
