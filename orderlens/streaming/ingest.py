"""New order files appended to Bronze, each exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderlens.schemas import MULTILINE, SOURCES
from orderlens.session import path_exists, staged
from orderlens.sources import incremental
from orderlens.sources.landing import add_lineage

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_ingest(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    table: str = "orders",
    fmt: str = "csv",
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Take in every file not yet seen, then stop. The checkpoint remembers the files, so a
    second run without new files adds nothing.

    Orders go into Bronze by the same append as the periodic intake, so both may write there in
    any order; a batch run again adds nothing, its orders being stored. The orders that this stream has taken in are
    in its state store: an order that comes twice, in one batch or in later ones, goes on once, also with
    another purchase month. What others have stored is looked up in the months of the batch. An order
    without an id is known by its contents. The state holds a key an order, on disk. Other tables need a folder
    of their own: one that holds files of another writer is refused, since the stream would hide them.
    """
    reader = spark.readStream.schema(SOURCES[table]).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", table in MULTILINE)
    rows = add_lineage(reader.load(folder), table)
    if table == "orders":
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        contents = F.sha2(F.to_json(F.struct(*SOURCES[table].names), {"ignoreNullFields": "false"}), 256)
        key = F.struct("order_id", F.when(F.col("order_id").isNull(), contents).alias("contents"))
        unique = rows.withColumn("_key", key).dropDuplicates(["_key"]).drop("_key")

        def put(batch: DataFrame, _: int) -> None:
            # Written once: the append reads it more than once, and the state is to move on only once.
            incremental.append_missing(batch.sparkSession, staged(batch, "batch"), target)

        sink = unique.writeStream.foreachBatch(put)
    else:
        if path_exists(spark, target) and not path_exists(spark, f"{target}/_spark_metadata"):
            raise ValueError(f"{target} holds files of another writer")
        sink = rows.writeStream.format("parquet").option("path", target).outputMode("append")
    return sink.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
