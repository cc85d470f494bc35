"""Raw files to Bronze: typed CSV reads, lineage columns, JSON order payloads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens import schemas
from orderlens.sources.lake import CORRUPT, place


def read_csv_typed(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False, keep_bad: bool = False
) -> DataFrame:
    """CSV with a header and a declared schema; a cell that does not parse becomes null.

    Gzip files are read as they are. ``multiline`` lets quoted fields span lines at the
    price of one task per file, so only tables that need it ask for it. ``keep_bad`` adds
    the raw text of each row that did not parse.
    """
    if keep_bad:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    # The files quote a quotation mark by doubling it.
    reader = reader.option("escape", '"')
    if keep_bad:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("multiLine", multiline).csv(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """For small lookups whose columns are not declared."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def add_lineage(df: DataFrame, table: str, file: str | None = None) -> DataFrame:
    """When a row was taken in, for which table, from which file.

    Call it directly on a read so the file name of each row is known; pass ``file``
    for rows that do not come from files.
    """
    origin = F.lit(file) if file is not None else F.col("_metadata.file_name")
    return df.withColumns(
        {"ingested_at": F.current_timestamp(), "source_table": F.lit(table), "source_file": origin}
    )


def ingest_all(
    spark: SparkSession,
    folder: str,
    files: Mapping[str, str] | None = None,
    only: Iterable[str] = tuple(schemas.SOURCES),
    keep_bad: bool = False,
) -> dict[str, DataFrame]:
    """The source tables with lineage. ``files`` maps table names to file names or globs. ``keep_bad`` adds the raw
    text of rows that do not parse, by which writers to Bronze keep them aside.

    A missing file raises here, before anything is written.
    """
    tables = {}
    for table in only:
        path = f"{folder.rstrip('/')}/{(files or {}).get(table, table + '.csv')}"
        rows = read_csv_typed(spark, path, schemas.SOURCES[table], table in schemas.MULTILINE, keep_bad)
        tables[table] = add_lineage(rows, table)
    return tables


def ingest_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and a 'total' row, in one job."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in sorted(tables.items())
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.rollup("table_name").agg(F.sum("n_rows").alias("n_rows")).na.fill("total", ["table_name"])


def read_pruned(spark: SparkSession, path: str, columns: list[str], fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(place(spark, path)).select(*columns)


def _order_bodies(raw: DataFrame, body: str) -> DataFrame:
    batch = T.StructType(
        [
            *schemas.PAYLOAD.fields,
            T.StructField("orders", T.ArrayType(schemas.PAYLOAD)),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )
    parsed = F.from_json(body, batch, {"columnNameOfCorruptRecord": CORRUPT})
    return raw.select(F.col(body).alias("text"), parsed.alias("body"))


def _readable() -> Column:
    blank = F.col("text").rlike(r"^\s*(\{\s*\})?\s*$")
    # A list without an order in it, empty or of nulls only, is no better than an empty body.
    nothing = F.coalesce(F.forall("body.orders", lambda o: o.isNull()), F.lit(False))
    return F.col("text").isNotNull() & F.col(f"body.{CORRUPT}").isNull() & ~blank & ~nothing


def parse_order_json(raw: DataFrame, body: str = "value") -> DataFrame:
    """One row per order from JSON text holding one order, or a list under ``orders``.

    Fields outside the payload schema are dropped; absent ones are null. Empty and
    malformed bodies are left out, see ``rejected_order_json``.
    """
    names = schemas.PAYLOAD.fieldNames()
    one = F.struct(*[F.col(f"body.{n}").alias(n) for n in names])
    # A null in a list is no order.
    listed = F.coalesce(F.filter("body.orders", lambda o: o.isNotNull()), F.array(one))
    rows = _order_bodies(raw, body).where(_readable()).select(F.explode(listed).alias("o"))
    return rows.select("o.*").withColumn("order_id", F.coalesce("order_id", F.lit("unknown")))


def rejected_order_json(raw: DataFrame, body: str = "value") -> DataFrame:
    """Bodies that hold no order: null, blank, empty object or list, not JSON, or of a wrong type."""
    return _order_bodies(raw, body).where(~_readable()).select(F.col("text").alias(body))
