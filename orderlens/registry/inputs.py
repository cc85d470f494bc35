"""Inputs shared by the registered queries, derived from one data folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators import cleaning, silver
from orderlens.operators.dataset import LABEL
from orderlens.session import size_shuffles, tune
from orderlens.sources import retail

SETTINGS = retail.SETTINGS


class Inputs:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = tune(spark)
        self.folder = folder
        size_shuffles(spark, *(f"{folder}/{table}.parquet" for table in retail.RAW))

    @cached_property
    def tables(self) -> retail.RetailTables:
        return retail.RetailTables(self.spark, self.folder)

    def __getitem__(self, table: str) -> DataFrame:
        return self.tables[table]

    @cached_property
    def orders(self) -> DataFrame:
        """Clean orders."""
        return cleaning.clean_orders(self["orders"], SETTINGS)

    @cached_property
    def items(self) -> DataFrame:
        """Clean items."""
        return cleaning.clean_items(self["order_items"], SETTINGS)

    @cached_property
    def silver(self) -> DataFrame:
        return silver.build_silver(self.tables, SETTINGS)

    @cached_property
    def scored(self) -> DataFrame:
        """Silver with label and a probability that does not come from a model."""
        return self.silver.withColumns({"probability": bucket_score(), LABEL: F.col("is_late").cast("int")})


def bucket_score(key: str = "order_id") -> Column:
    """A probability from whole-number arithmetic on the order number, most of them low."""
    bucket = F.col(key).cast("bigint") * 7919 % 10000
    return (bucket * bucket).cast("double") / 1e8


def plain(df: DataFrame) -> DataFrame:
    """Results in types any client shows alike: decimals as doubles, instants without zone."""
    out = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.ShortType):
            column = column.cast("int")
        out.append(column.alias(f.name))
    return df.select(*out)
