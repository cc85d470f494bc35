"""Training rows, their split and their weights."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.config import DEFAULTS, Settings
from orderlens.functions import calendar
from orderlens.functions.risk import feature_columns
from orderlens.operators import cleaning, queue

LABEL = "label"
BUCKET_DIGITS = 4  # hex digits: 65,536 buckets per class


def training_set(silver: DataFrame) -> DataFrame:
    """Features with defaults, as the scoring job builds them, and the label."""
    return silver.select("order_id", *feature_columns(), F.col("is_late").cast("int").alias(LABEL))


def training_set_of_orders(tables: Mapping[str, DataFrame], settings: Settings = DEFAULTS) -> DataFrame:
    """Features as the order queue sends them, for delivered orders straight from the source
    tables, so a model scoring the queue is trained on what it will be given. Late is what
    ``settings.late_grain`` says."""
    delivered = cleaning.filter_delivered(tables["orders"], settings).where(F.col(calendar.DELIVERED).isNotNull())
    sent = queue.payloads(delivered.withColumn(LABEL, _late(settings)), tables, settings, keep=(LABEL,))
    return sent.select("order_id", *feature_columns(), LABEL)


def labelled_payloads(tables: Mapping[str, DataFrame], settings: Settings = DEFAULTS) -> DataFrame:
    """Payloads of all orders and the label, null for orders that ``training_set_of_orders`` leaves out. Stage it where both
    payloads and training rows are needed: the joins behind them then run once."""
    delivered = F.col("order_status").isin(*settings.statuses) & F.col(calendar.DELIVERED).isNotNull()
    orders = tables["orders"].withColumn(LABEL, F.when(delivered, _late(settings)))
    return queue.payloads(orders, tables, settings, keep=(LABEL,))


def training_set_of_payloads(labelled: DataFrame) -> DataFrame:
    """The rows of ``training_set_of_orders`` among ``labelled_payloads``."""
    return labelled.where(F.col(LABEL).isNotNull()).select("order_id", *feature_columns(), LABEL)


def _late(settings: Settings) -> Column:
    return F.coalesce(calendar.is_late(settings.late_grain), F.lit(False)).cast("int")


def with_split(rows: DataFrame, settings: Settings = DEFAULTS, key: str = "order_id") -> DataFrame:
    """Adds ``is_train``: exactly ``train_percent`` of each class, rounded down.

    Rows are ordered within their class by a seeded hash of the key and the first share
    is taken. No class is sorted: counts per hash prefix find the one prefix in which the
    cut falls, and only that prefix (a 65,536th of the class) is ranked. What returns to
    the rows is one cut-off hash per class, compared in a broadcast join of two rows.
    """
    hashed = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(settings.seed))))
    keyed = rows.select(F.col(LABEL), hashed.alias("_hash"))
    prefix = F.substring("_hash", 1, BUCKET_DIGITS)

    ordered = Window.partitionBy(LABEL).orderBy("_prefix")
    whole = Window.partitionBy(LABEL)
    counts = keyed.groupBy(LABEL, prefix.alias("_prefix")).agg(F.count("*").alias("_n"))
    placed = counts.select(
        LABEL,
        "_prefix",
        F.sum("_n").over(ordered).alias("_upto"),
        (F.sum("_n").over(ordered) - F.col("_n")).alias("_before"),
        F.floor(F.sum("_n").over(whole) * settings.train_percent / 100).alias("_take"),
    )
    # The prefix holding the first row past the cut, per class.
    edge = placed.where((F.col("_before") <= F.col("_take")) & (F.col("_take") < F.col("_upto")))

    ranked = (
        keyed.withColumn("_prefix", prefix)
        .join(F.broadcast(edge), [LABEL, "_prefix"])
        .withColumn("_place", F.row_number().over(Window.partitionBy(LABEL).orderBy("_hash")) + F.col("_before"))
    )
    cut = ranked.where(F.col("_place") == F.col("_take") + 1).select(LABEL, F.col("_hash").alias("_cut"))
    split = rows.withColumn("_hash", hashed).join(F.broadcast(cut), LABEL, "left")
    # No cut-off means the whole class is taken.
    taken = F.coalesce(F.col("_hash") < F.col("_cut"), F.lit(True))
    return split.withColumn("is_train", taken).select(*rows.columns, "is_train")


def split_shares(split: DataFrame) -> DataFrame:
    """Rows and late share of each side of the split."""
    late = F.sum(LABEL).cast("bigint")
    return split.groupBy("is_train").agg(F.count("*").alias("n_rows"), late.alias("n_late"))


def class_weight(rows: DataFrame) -> DataFrame:
    """One row: counts of both classes and negatives per positive (null without positives)."""
    counts = rows.agg(
        F.count_if(F.col(LABEL) == 1).alias("positives"), F.count_if(F.col(LABEL) == 0).alias("negatives")
    )
    ratio = F.try_divide(F.col("negatives").cast("double"), F.col("positives").cast("double"))
    return counts.withColumn("positive_weight", ratio)


def with_weight(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Adds ``weight``: 1 everywhere, or for positives the class ratio when balanced."""
    if settings.class_weight == "none":
        return rows.withColumn("weight", F.lit(1.0))
    if settings.class_weight != "balanced":
        raise ValueError(f"unknown class weight {settings.class_weight!r}")
    ratio = class_weight(rows).select("positive_weight").scalar()
    weight = F.when(F.col(LABEL) == 1, F.coalesce(ratio, F.lit(1.0))).otherwise(1.0)
    return rows.withColumn("weight", weight)
