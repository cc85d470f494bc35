"""Raw files to KPI tables: land, sync, refine, publish, export."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from orderlens.config import DEFAULTS, Settings
from orderlens.operators import kpis, silver
from orderlens.schemas import CONTRACTS, SOURCES
from orderlens.session import size_shuffles
from orderlens.sources import incremental, lake, landing, warehouse

# Tables taken in whole by every sync.
REPLACED = ("order_items", "payments", "reviews")
# Years and months of Silver's storage.
SILVER_MONTH = ("purchase_year", "purchase_month")


def land(
    spark: SparkSession,
    raw: str,
    lakehouse: str,
    files: Mapping[str, str] | None = None,
    refused: dict[str, int] | None = None,
) -> dict[str, int]:
    """Raw CSV to Bronze; good rows per table. Rows that do not parse are kept aside (``lake.read_refused``), their
    numbers go into ``refused``."""
    size_shuffles(spark, raw)
    return lake.write_bronze(landing.ingest_all(spark, raw, files, keep_bad=True), f"{lakehouse}/bronze", refused=refused)


def sync(
    spark: SparkSession,
    raw: str,
    lakehouse: str,
    files: Mapping[str, str] | None = None,
    replaced: Iterable[str] = REPLACED,
) -> None:
    """The periodic intake into an existing Bronze: new orders are appended, the ``replaced`` tables
    taken in whole. Add customers, sellers and products to them where new orders may bring new ones."""
    size_shuffles(spark, raw)
    tables = landing.ingest_all(spark, raw, files, only=("orders", *replaced), keep_bad=True)
    incremental.append_new(spark, tables.pop("orders"), f"{lakehouse}/bronze/orders")
    lake.write_bronze(tables, f"{lakehouse}/bronze")


def arrange(spark: SparkSession, lakehouse: str, buckets: int) -> None:
    """Bronze items, payments and reviews stored once more by order, for ``refine`` to join without a shuffle of theirs.

    Pays where Silver is built more than once from the same intake. ``buckets``: a bucket should be some 256 MB."""
    size_shuffles(spark, f"{lakehouse}/bronze")
    for name in REPLACED:
        rows = lake.read_bronze(spark, f"{lakehouse}/bronze", name)
        lake.write_bucketed(rows, f"{lakehouse}/bronze_by_order/{name}", "order_id", buckets)


def refine(
    spark: SparkSession, lakehouse: str, settings: Settings = DEFAULTS, buckets: int | None = None
) -> DataFrame:
    """Bronze to Silver; the quality report of what was written. ``buckets``: as given to ``arrange`` after the last intake."""
    size_shuffles(spark, f"{lakehouse}/bronze")
    tables = {name: lake.read_bronze(spark, f"{lakehouse}/bronze", name) for name in SOURCES}
    if buckets:
        for name in REPLACED:
            tables[name] = lake.read_bucketed(spark, f"{lakehouse}/bronze_by_order/{name}", "order_id", buckets)
    path = f"{lakehouse}/silver/orders_consolidated"
    lake.write_silver(silver.build_silver(tables, settings), path)
    # Read back: the report scans two columns instead of repeating or caching the joins.
    return silver.quality_report(lake.read_silver(spark, path))


def publish(spark: SparkSession, lakehouse: str, settings: Settings = DEFAULTS) -> dict[str, DataFrame]:
    """Silver to the seven Gold tables, Silver being read once."""
    rows = lake.read_silver(spark, f"{lakehouse}/silver/orders_consolidated")
    for name, table in kpis.gold_in_one_pass(rows, settings).items():
        lake.write_gold(table, f"{lakehouse}/gold", name)
    return {name: lake.read_gold(spark, f"{lakehouse}/gold", name) for name in CONTRACTS}


def publish_months(
    spark: SparkSession,
    lakehouse: str,
    months: Iterable[tuple[int | None, int | None]] | None = None,
    settings: Settings = DEFAULTS,
) -> dict[str, DataFrame]:
    """The seven Gold tables from KPI states stored by month. Of Silver only the ``months`` (year, month) that changed are read,
    without ``months`` all; the other months' states stay. States of other ``settings`` have to be built anew."""
    path = f"{lakehouse}/states/kpis"
    rows = lake.read_silver(spark, f"{lakehouse}/silver/orders_consolidated")
    if months is None:
        states = kpis.month_states(rows, settings)
    else:
        months = list(months)
        kept = lake.read_table(spark, path).where(~kpis.in_months(months, *kpis.STATE_MONTH))
        changed = rows.where(kpis.in_months(months, *SILVER_MONTH))
        states = kpis.month_states(changed, settings).unionByName(kept)
    lake.full_refresh(states, path)
    for name, table in kpis.gold_of_states(lake.read_table(spark, path), settings).items():
        lake.write_gold(table, f"{lakehouse}/gold", name)
    return {name: lake.read_gold(spark, f"{lakehouse}/gold", name) for name in CONTRACTS}


def export(
    spark: SparkSession,
    lakehouse: str,
    database: str = "analytics",
    path: str | None = None,
    widths: Mapping[str, int] | None = None,
) -> None:
    gold = {name: lake.read_gold(spark, f"{lakehouse}/gold", name) for name in CONTRACTS}
    warehouse.export_warehouse(gold, database, path, widths)


def preview(df: DataFrame, rows: int = 5) -> None:
    sample(df, rows).show(truncate=False)


def sample(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows in the order of all columns: the same ones whatever the partitions. Each task keeps
    only as many."""
    return df.orderBy(*df.columns).limit(rows)
