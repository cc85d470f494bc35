"""KPI tables under their warehouse contract, and their export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.schemas import CONTRACTS
from orderlens.sources import lake

UNKNOWN = "unknown"
STAMP = "inserted_at"


def contract_types(table: str, widths: Mapping[str, int] | None = None) -> dict[str, str]:
    """Declared types of a table. ``widths`` replaces the width of text columns."""
    types = dict(CONTRACTS[table])
    for name, width in (widths or {}).items():
        if name in types:
            types[name] = f"varchar({width})" + "!" * types[name].endswith("!")
    return types


def _conform(table: str, name: str, kind: str) -> tuple[Column, Column, Column]:
    """A column in its declared type; whether it cannot be had; and what to say then."""
    kind, required = kind.rstrip("!"), kind.endswith("!")
    given = F.col(name)
    if kind.startswith("varchar"):
        value = given.cast("string")
        fits = F.length(value) <= int(kind[len("varchar(") : -1])
        if required:
            value = F.coalesce(value, F.lit(UNKNOWN))
    else:
        value = given
        if kind.startswith("decimal"):
            value = F.round(given.cast("decimal(38,10)"), int(kind.split(",")[1][:-1]))
        value = value.try_cast(kind)
        fits = value.isNotNull()
    said = F.concat(F.lit(f"{table}.{name} does not fit {kind}: "), F.coalesce(given.cast("string"), F.lit("null")))
    wrong = given.isNotNull() & ~fits
    if required and not kind.startswith("varchar"):
        wrong = given.isNull() | wrong
    return value, wrong, said


def value_type(kind: str) -> str:
    return "string" if kind.startswith("varchar") else kind


def apply_contract(
    df: DataFrame, table: str, stamp: bool = True, widths: Mapping[str, int] | None = None
) -> DataFrame:
    """Project to the declared types; ``inserted_at`` is added. Nothing is cut or lost: text wider than
    its column and numbers that do not fit fail the job, as does a null in a required number. A null
    text key (an unmatched category) becomes 'unknown'."""
    types = contract_types(table, widths)
    columns = []
    for name, kind in types.items():
        value, wrong, said = _conform(table, name, kind)
        refused = F.raise_error(said).cast(value_type(kind.rstrip("!")))
        columns.append(F.when(wrong, refused).otherwise(value).alias(name))
    if stamp:
        columns.append(F.current_timestamp().alias(STAMP))
    return df.select(*columns)


def refusal(table: str, widths: Mapping[str, int] | None = None) -> Column:
    """Why a row does not fit the contract: its first column that does not; null if all do."""
    checks = [_conform(table, name, kind) for name, kind in contract_types(table, widths).items()]
    return F.coalesce(*[F.when(wrong, said) for _, wrong, said in checks])


def split_by_contract(
    df: DataFrame, table: str, path: str, widths: Mapping[str, int] | None = None
) -> dict[str, int]:
    """Write the rows to a checked table at ``path``, as they are: those that fit the contract, and aside those that do not, each
    with the reason. One job; the numbers read, good and refused."""
    return lake.write_checked(df, path, refusal(table, widths))


def table_ddl(table: str, widths: Mapping[str, int] | None = None) -> str:
    columns = [
        f"{name} {kind.rstrip('!')}" + " NOT NULL" * kind.endswith("!")
        for name, kind in contract_types(table, widths).items()
    ]
    return ", ".join([*columns, f"{STAMP} timestamp"])


def export_table(
    df: DataFrame,
    table: str,
    database: str,
    path: str | None = None,
    widths: Mapping[str, int] | None = None,
    refused: str | None = None,
) -> None:
    """Replace the rows of one warehouse table and refresh its statistics.

    The table is created from its contract once; later exports overwrite its rows and leave the
    definition in place, so readers never find it gone. A row that does not fit fails the export; with ``refused``,
    a folder, it is kept aside there (``lake.read_refused``) and the others go on."""
    spark = df.sparkSession
    if refused:
        split_by_contract(df, table, refused, widths)
        df = lake.read_table(spark, refused)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    place = f" LOCATION '{path}/{table}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({table_ddl(table, widths)}) USING parquet{place}")
    apply_contract(df, table, widths=widths).write.insertInto(f"{database}.{table}", overwrite=True)
    spark.sql(f"ANALYZE TABLE {database}.{table} COMPUTE STATISTICS FOR ALL COLUMNS")


def export_warehouse(
    gold: Mapping[str, DataFrame],
    database: str = "analytics",
    path: str | None = None,
    widths: Mapping[str, int] | None = None,
) -> None:
    for table in CONTRACTS:
        export_table(gold[table], table, database, path, widths)


def export_jdbc(gold: Mapping[str, DataFrame], url: str, schema: str, properties: dict[str, str]) -> None:
    """The same tables into a SQL database. ``truncate`` keeps the declared table
    definition in place instead of dropping it; statistics are the database's to refresh."""
    for table in CONTRACTS:
        df = apply_contract(gold[table], table)
        df.write.option("truncate", True).jdbc(url, f"{schema}.{table}", mode="overwrite", properties=properties)


def read_warehouse(spark: SparkSession, table: str, database: str = "analytics") -> DataFrame:
    return spark.table(f"{database}.{table}")
