"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Left joins on customer, seller and product keys may meet a key holding a
    # third of the rows: let AQE split it even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Dimensions up to this size are broadcast instead of shuffling the orders; beyond it
    # the same joins shuffle.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    # Files count as three times their size when that check is made: they are compressed.
    "spark.sql.sources.fileCompressionFactor": "3.0",
}


# For sessions built here: the Python call site of every column expression is for
# notebooks and costs a job its start-up time.
AT_START = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "orderlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **AT_START, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def size_shuffles(spark: SparkSession, *folders: str, bytes_each: int = 256 * 1024 * 1024) -> None:
    """Start shuffles with enough partitions for the input under ``folders``.

    AQE merges partitions that turn out small but never adds any, so the starting number has
    to fit the data. An input that needs no more than the session's own number gets that: what
    a larger input before it asked for does not stay.
    """
    size = 0
    for folder in folders:
        target = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(target):
            size += system.getContentSummary(target).getLength()
    wanted = size // bytes_each
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL, str(wanted))
    else:
        spark.conf.unset(INITIAL)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode.

    Checkpoints of iterative jobs go there too."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="orderlens-"))
    return (named or context.getCheckpointDir()).rstrip("/")


def scratch_home(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/orderlens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_home(spark)}/{name}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop(spark: SparkSession, path: str) -> None:
    """Delete one ``scratch_path`` that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application staged. Call it when no result still reads from there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(scratch_home(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go as each action ends, not when the driver next collects garbage. Results
    inside are staged or taken once; what is run later, outside, keeps its files as the session says."""
    before = spark.conf.get(DROPPED, None)
    spark.conf.set(DROPPED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROPPED)
        else:
            spark.conf.set(DROPPED, before)


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back: later readers scan the columns they need
    instead of recomputing the plan, and a lost executor costs nothing upstream."""
    return staged_at(df, name)[0]


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``staged``, and the path to ``drop`` when nothing reads from there any more."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path
