"""Left joins to dimensions whose keys may be hot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_by_key(
    facts: DataFrame, dimension: DataFrame, key: str, columns: Mapping[str, str] | None = None, salts: int = 1
) -> DataFrame:
    """Left join to a dimension with one row per key, pruned to ``columns`` (name -> source).

    No join hint: Spark broadcasts the dimension if it is small and shuffles otherwise,
    and AQE splits skewed partitions. ``salts`` > 1 also spreads every key over that many
    sub-keys, for runs where AQE is off or one key dominates.
    """
    if columns is not None:
        dimension = dimension.select(*[F.col(source).alias(name) for name, source in columns.items()])
    if salts <= 1:
        return facts.join(dimension, key, "left")
    slot = F.pmod(F.xxhash64("order_id"), F.lit(salts)).cast("int")
    copies = dimension.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("_slot", slot).join(copies, [key, "_slot"], "left").drop("_slot")
