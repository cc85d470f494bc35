"""JSON orders in, scored orders out; the same steps as the batch job."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from orderlens.config import DEFAULTS, Settings
from orderlens.operators.model import score_batch
from orderlens.sources.landing import parse_order_json, rejected_order_json


def stream_score(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    model: PipelineModel,
    settings: Settings = DEFAULTS,
    files_per_batch: int = 1000,
    rejected: str | None = None,
) -> StreamingQuery:
    """Scored orders under ``target``, bodies that hold no order under ``rejected`` (beside it by default).

    Each batch replaces its own partition ``run`` and ``batch`` of both, so a batch run again leaves nothing twice. The
    run is the stream's id, kept in its checkpoint: with a new checkpoint batches count from 0 again, but replace nothing.
    """
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(folder)
    refused = rejected or f"{target.rstrip('/')}-rejected"

    def put(bodies: DataFrame, number: int) -> None:
        # The checkpoint names the stream before its first batch.
        run = bodies.sparkSession.read.json(f"{checkpoint.rstrip('/')}/metadata").first().id
        outputs = ((score_batch(model, parse_order_json(bodies), settings), target), (rejected_order_json(bodies), refused))
        for rows, path in outputs:
            rows.write.mode("overwrite").parquet(f"{path}/run={run}/batch={number}")

    return raw.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
