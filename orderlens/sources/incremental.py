"""Appending orders to Bronze: by cursor, or every order not stored yet. One way of writing for both."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import calendar
from orderlens.functions.calendar import BOUGHT
from orderlens.schemas import LINEAGE
from orderlens.session import path_exists
from orderlens.sources.lake import CORRUPT, REASON, REFUSED, by_partition, marked, place, unreadable

MONTH = "purchase_ym"
# Storage months are spelt yyyy-mm and sort between these; rows without a date are stored under null.
FIRST_MONTH, LAST_MONTH = "0000-00", "9999-99"


def _unseen(source: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` that ``known`` lacks, one for each key. A row without a key is known by its contents, but for
    when and from where it was taken in."""
    told = [c for c in source.columns if c not in (*LINEAGE, MONTH, REFUSED, REASON, CORRUPT)]
    contents = F.sha2(F.to_json(F.struct(*sorted(told)), {"ignoreNullFields": "false"}), 256)
    keyed = source.where(F.col(key).isNotNull()).dropDuplicates([key])
    keyed = keyed.join(known.where(F.col(key).isNotNull()).select(key), key, "left_anti").select(source.columns)
    nameless = source.where(F.col(key).isNull()).withColumn("_contents", contents).dropDuplicates(["_contents"])
    stored = known.where(F.col(key).isNull()).select(contents.alias("_contents"))
    return keyed.unionByName(nameless.join(stored, "_contents", "left_anti").drop("_contents"))


def new_rows(
    source: DataFrame, target: DataFrame, cursor: str = BOUGHT, key: str = "order_id", month: str | None = None
) -> DataFrame:
    """Rows at or past the target's last cursor value, and rows without one, whose key the target lacks. Doubles come in once;
    rows without a key are told apart by their contents.

    ``>=`` together with the anti-join keeps late rows that share the last cursor value
    and makes a repeated run add nothing. Only target rows at the cursor value, or without
    any, can clash, so the anti-join sees these slices alone. ``month`` names the target's
    storage partition by month of the cursor: the last one, and that of rows without a date,
    are then read. The mark comes from dated rows only.
    """
    dated, undated = target, target.where(F.col(cursor).isNull())
    if month:
        named = target.where(F.col(month).between(FIRST_MONTH, LAST_MONTH))
        dated = target.where(F.col(month) == named.agg(F.max(month)).scalar())
        undated = undated.where(F.col(month).isNull() | ~F.col(month).between(FIRST_MONTH, LAST_MONTH))
    first = F.lit("0001-01-01").cast(target.schema[cursor].dataType)
    mark = dated.agg(F.coalesce(F.max(cursor), first)).scalar()
    # Plain comparisons with the mark, so both scans can skip older row groups.
    fresh = source.where((F.col(cursor) >= mark) | F.col(cursor).isNull())
    return _unseen(fresh, dated.where(F.col(cursor) == mark).unionByName(undated), key)


def missing_rows(source: DataFrame, target: DataFrame, key: str = "order_id", month: str = MONTH) -> DataFrame:
    """Rows whose key the target lacks in the storage months that ``source`` has rows of, wherever the cursor stands.
    Only these months of the target are read."""
    months = [r[0] for r in source.select(month).distinct().collect()]  # bounded by the calendar
    of_these = F.col(month).isin([m for m in months if m is not None])
    if None in months:
        of_these = of_these | F.col(month).isNull()
    return _unseen(source, target.where(of_these), key)


def _refused_too(orders: DataFrame, target: DataFrame, good: DataFrame) -> DataFrame:
    """With the rows that do not parse, each raw text once."""
    bad = marked(orders.where(F.col(CORRUPT).isNotNull()).dropDuplicates([CORRUPT]), unreadable())
    stored = target.where(F.col(REFUSED) == 1).select(CORRUPT)
    return marked(good, F.lit(None).cast("string")).unionByName(bad.join(stored, CORRUPT, "left_anti"))


def _append(spark: SparkSession, orders: DataFrame, path: str, fmt: str, cursor: bool) -> None:
    orders = orders.withColumn(MONTH, calendar.year_month())
    if path_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError(f"{path} is the folder of a file stream, which hides what others write there")
    partition = (MONTH,)
    path = place(spark, path)
    if path_exists(spark, path):
        checked = REFUSED in spark.read.format(fmt).load(path).columns
        if checked and CORRUPT not in orders.columns:
            orders = orders.withColumn(CORRUPT, F.lit(None).cast("string"))
        elif not checked and CORRUPT in orders.columns:
            raise ValueError(f"{path} has no place for rows that do not parse")
        schema = marked(orders, F.lit("")).schema if checked else orders.schema
        target = spark.read.schema(schema).format(fmt).load(path)
        known = target.where(F.col(REFUSED) == 0) if checked else target
        source = orders.where(F.col(CORRUPT).isNull()) if checked else orders
        good = new_rows(source, known, month=MONTH) if cursor else missing_rows(source, known)
        orders = _refused_too(orders, target, good) if checked else good
        partition = (REFUSED, MONTH) if checked else partition
    elif CORRUPT in orders.columns:
        bad = marked(orders.where(F.col(CORRUPT).isNotNull()), unreadable())
        good = _unseen(orders.where(F.col(CORRUPT).isNull()), orders.limit(0), "order_id")
        orders, partition = marked(good, F.lit(None).cast("string")).unionByName(bad), (REFUSED, MONTH)
    else:
        orders = _unseen(orders, orders.limit(0), "order_id")
    by_partition(orders, *partition).write.format(fmt).mode("append").partitionBy(*partition).save(path)


def append_new(spark: SparkSession, orders: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append orders from the last cursor value on to Bronze, stored by purchase month, creating it on the first run."""
    _append(spark, orders, path, fmt, cursor=True)


def append_missing(spark: SparkSession, orders: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append the orders that Bronze does not hold yet, older ones too; a second run adds nothing."""
    _append(spark, orders, path, fmt, cursor=False)
