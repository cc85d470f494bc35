"""Quality of predictions: columns ``label`` (0/1) and ``probability``, or a 0/1 prediction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, Settings
from orderlens.functions.measures import count_of, half_up
from orderlens.operators.blocks import in_blocks

LABEL = "label"


def _metrics(
    rows: DataFrame, positive: Column, by: tuple[str, ...] = (), weight: str | None = None
) -> DataFrame:
    """``weight`` names a column saying how many cases a row stands for."""
    late = F.col(LABEL) == 1
    times = F.col(weight) if weight else F.lit(1)

    def cases(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, times)), F.lit(0)).cast("bigint")

    counts = rows.groupBy(*by).agg(
        cases(F.lit(True)).alias("n_rows"),
        cases(positive & late).alias("tp"),
        cases(positive & ~late).alias("fp"),
        cases(~positive & late).alias("fn"),
        cases(~positive & ~late).alias("tn"),
    )

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        *by,
        "n_rows",
        "tp",
        "fp",
        "fn",
        "tn",
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    )


def classification_metrics(rows: DataFrame, threshold: float = 0.5, probability: str = "probability") -> DataFrame:
    """One row: confusion counts, precision, recall and F1 at a cut-off; 0 where undefined."""
    return _metrics(rows, F.col(probability) >= threshold)


def classification_by_period(
    rows: DataFrame, prediction: str = "prediction", weight: str | None = None
) -> DataFrame:
    """The same per ``period``, from a 0/1 prediction."""
    return _metrics(rows.where("period IS NOT NULL"), F.col(prediction) == 1, ("period",), weight)


def confusion_matrix(rows: DataFrame, threshold: float = 0.5, probability: str = "probability") -> DataFrame:
    prediction = (F.col(probability) >= threshold).cast("int").alias("prediction")
    return rows.groupBy(LABEL, prediction).agg(F.count("*").alias("n_rows"))


def roc_auc(rows: DataFrame, probability: str = "probability") -> DataFrame:
    """Area under the ROC curve as the share of (late, punctual) pairs ranked rightly, ties half.

    Rows are first counted per score; running counts are added block by block, blocks holding about as many
    scores each however close these lie, so no task sees all scores. Scores are compared as they are.
    Null with a single class.
    """
    counts = rows.groupBy(F.col(probability).alias("score")).agg(
        count_of(F.col(LABEL) == 1).alias("late"), count_of(F.col(LABEL) == 0).alias("punctual")
    )
    counts = in_blocks(counts, "score")
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.groupBy("block").agg(F.sum("punctual").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    lower = Window.partitionBy("block").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("before") + F.coalesce(F.sum("punctual").over(lower), F.lit(0))
    # Twice the pairs won, so that ties stay whole numbers.
    wins = F.col("late").cast("decimal(20,0)") * (below * 2 + F.col("punctual")).cast("decimal(20,0)")
    placed = counts.join(before, "block")
    totals = placed.select("late", "punctual", wins.cast("decimal(38,0)").alias("wins")).agg(
        F.coalesce(F.sum("wins"), F.lit(0)).alias("wins"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("n_late"),
        F.coalesce(F.sum("punctual"), F.lit(0)).alias("n_punctual"),
    )
    pairs = F.col("n_late").cast("double") * F.col("n_punctual").cast("double") * 2.0
    return totals.select("n_late", "n_punctual", F.try_divide(F.col("wins").cast("double"), pairs).alias("roc_auc"))


def calibration_check(rows: DataFrame, probability: str = "probability") -> DataFrame:
    """Mean predicted against observed rate, over all rows ('all') and per tenth of the
    probability scale."""
    tenth = F.least(F.floor(F.col(probability) * 10), F.lit(9)).cast("int")
    # Eighteen digits of each probability add up to the same whatever the order of rows.
    exact = F.col(probability).cast("decimal(20,18)")
    binned = rows.select(tenth.cast("string").alias("band"), exact.alias("p"), F.col(LABEL))
    counts = binned.rollup("band").agg(
        F.count("*").alias("n_rows"), F.sum("p").alias("p"), F.sum(LABEL).cast("bigint").alias("n_late")
    )
    n = F.col("n_rows").cast("double")
    return counts.select(
        F.coalesce("band", F.lit("all")).alias("band"),
        "n_rows",
        half_up(F.try_divide(F.col("p").cast("double"), n), 6).alias("mean_predicted"),
        half_up(F.try_divide(F.col("n_late").cast("double"), n), 6).alias("observed_rate"),
    )


def calibration_bands(rows: DataFrame, bands: int = 10, probability: str = "probability") -> DataFrame:
    """Predicted against observed rate in bands of equal count, by ascending score; ``gap`` is their distance.

    A row's band hangs on how many rows have a smaller score, so equal scores share a band and a score that very many
    rows have may leave the bands above it smaller or empty. Scores are counted first and ranked block by block,
    as for ``roc_auc``. Rows without a score are left out.
    """
    counts = rows.where(F.col(probability).isNotNull()).groupBy(F.col(probability).alias("score"))
    counts = counts.agg(F.count("*").alias("n"), count_of(F.col(LABEL) == 1).alias("late"))
    counts = in_blocks(counts, "score")
    blocks = Window.orderBy("block")
    before = counts.groupBy("block").agg(F.sum("n").alias("n")).select(
        "block",
        F.coalesce(F.sum("n").over(blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )
    lower = Window.partitionBy("block").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("before") + F.coalesce(F.sum("n").over(lower), F.lit(0))
    placed = counts.join(before, "block").withColumn("below", below)
    return _banded(placed.withColumn("band", F.expr(f"CAST(below * {bands} div total AS INT)")))


def sketched_bands(rows: DataFrame, bands: int = 10, probability: str = "probability", k: int = 4096) -> DataFrame:
    """``calibration_bands`` without a shuffle of scores: the bounds of the bands come from a mergeable quantile sketch.

    Bands hold as many rows as the sketch's ranks allow (within 0.1 % of all rows for k = 4096), the rates are exact."""
    scored = rows.where(F.col(probability).isNotNull())
    ranks = F.array(*[F.lit(i / bands) for i in range(1, bands)])
    sketch = scored.agg(F.kll_sketch_agg_double(F.col(probability).cast("double"), F.lit(k)).alias("s"), F.count("*").alias("n"))
    found = sketch.where("n > 0").select(F.kll_sketch_get_quantile_double("s", ranks).alias("q")).first()
    bounds = found["q"] if found else []  # one number a band
    above = [(F.col(probability) > bound).cast("int") for bound in bounds]
    band = sum(above, F.lit(0)).cast("int")
    return _banded(
        scored.select(F.col(probability).alias("score"), F.lit(1).alias("n"), F.col(LABEL).cast("bigint").alias("late"), band.alias("band"))
    )


def _banded(counts: DataFrame) -> DataFrame:
    """``score, n, late, band`` as one row a band."""
    # As in ``calibration_check``: sums of eighteen digits don't depend on the order of rows.
    predicted = F.col("score").cast("decimal(20,18)") * F.col("n").cast("decimal(18,0)")
    sums = counts.groupBy("band").agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.min("score").alias("lowest"),
        F.max("score").alias("highest"),
        F.sum(predicted).alias("p"),
        F.sum("late").cast("bigint").alias("n_late"),
    )
    mean, rate = (F.try_divide(F.col(c).cast("double"), F.col("n_rows").cast("double")) for c in ("p", "n_late"))
    return sums.select(
        "band",
        "n_rows",
        "lowest",
        "highest",
        half_up(mean, 6).alias("mean_predicted"),
        half_up(rate, 6).alias("observed_rate"),
        half_up(F.abs(mean - rate), 6).alias("gap"),
    )


def expected_calibration_error(banded: DataFrame) -> DataFrame:
    """One row: the mean gap of the bands, weighted by their rows, and the largest."""
    n = F.col("n_rows").cast("double")
    return banded.agg(
        half_up(F.try_divide(F.sum(F.col("gap") * n), F.sum(n)), 6).alias("expected_error"), F.max("gap").alias("largest_gap")
    )


def gate(settings: Settings = DEFAULTS) -> Column:
    """Next step for a row with precision and recall."""
    good = (F.col("precision") >= settings.min_precision) & (F.col("recall") >= settings.min_recall)
    return F.when(good, "deploy_model").otherwise("alert_low_metrics")


def promotion_gate(metrics: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return metrics.select("precision", "recall", gate(settings).alias("decision"))
