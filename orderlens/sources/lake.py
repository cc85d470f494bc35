"""Bronze, Silver and Gold folders.

A table that is replaced is written into a version folder of its own, ``v<number>-<id>`` under the table's path. A version
counts once its job has left ``_SUCCESS``: until then, and for good if the job fails, readers see the one before. The
version before the current one is kept for readers that have already begun. A table that has only ever
been appended to has no versions.

Checked tables keep refused rows beside the good ones, in a storage partition that reads of the table skip.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import calendar
from orderlens.schemas import SILVER

FORMAT = "parquet"
VERSION = re.compile(r"v(\d{8})-[0-9a-f]{8}")
#: Of a checked table: whether a row was refused (0 or 1), and why.
REFUSED, REASON = "_refused", "_reason"
CORRUPT = "_corrupt_record"
UNREADABLE = "does not parse"


def by_partition(df: DataFrame, *columns: str) -> DataFrame:
    """Rows gathered by storage partition. Rebalancing lets AQE split a partition that
    outgrows the advisory size (a month may hold a third of all orders) and merge small ones."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def _versions(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Names of the complete versions, oldest first, and of the others."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return [], []
    names = sorted(s.getPath().getName() for s in system.listStatus(root) if s.isDirectory())
    found = [n for n in names if VERSION.fullmatch(n)]
    done = [n for n in found if system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return done, [n for n in found if n not in done]


def place(spark: SparkSession, path: str) -> str:
    """Where the rows of a table are: its current version, or the path itself."""
    done, _ = _versions(spark, path)
    return f"{path}/{done[-1]}" if done else path


@contextmanager
def _new_version(spark: SparkSession, path: str) -> Iterator[str]:
    """The folder of a new version, which becomes the current one when its job commits; those behind the last two go."""
    done, open_ = _versions(spark, path)
    last = max((int(VERSION.fullmatch(n)[1]) for n in (*done, *open_)), default=0)
    yield f"{path}/v{last + 1:08d}-{uuid.uuid4().hex[:8]}"
    # What did not commit and is older than the current version never will.
    stale = [*done[:-1], *(n for n in open_ if done and n < done[-1])]
    for name in stale:
        target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _replace(df: DataFrame, path: str, partition: tuple[str, ...] = (), fmt: str = FORMAT) -> None:
    with _new_version(df.sparkSession, path) as version:
        df.write.format(fmt).partitionBy(*partition).save(version)


def full_refresh(df: DataFrame, path: str, fmt: str = FORMAT) -> None:
    """Replace a table. Its old rows stay readable until the new ones are all written."""
    _replace(df, path, fmt=fmt)


def read_table(spark: SparkSession, path: str, fmt: str = FORMAT) -> DataFrame:
    """The good rows of a table as it stands."""
    rows = spark.read.format(fmt).load(place(spark, path))
    if REFUSED in rows.columns:
        rows = rows.where(F.col(REFUSED) == 0).drop(REFUSED, REASON, CORRUPT)
    return rows


def read_refused(spark: SparkSession, path: str, fmt: str = FORMAT) -> DataFrame:
    """The refused rows of a checked table, with the reason and, from files, the raw text."""
    return spark.read.format(fmt).load(place(spark, path)).where(F.col(REFUSED) == 1).drop(REFUSED)


def marked(rows: DataFrame, reason: Column) -> DataFrame:
    return rows.withColumn(REASON, reason).withColumn(REFUSED, F.col(REASON).isNotNull().cast("int"))


def unreadable() -> Column:
    """Why a row read with its raw text is refused."""
    return F.when(F.col(CORRUPT).isNotNull(), UNREADABLE)


def write_checked(
    rows: DataFrame, path: str, reason: Column, partition: tuple[str, ...] = (), fmt: str = FORMAT
) -> dict[str, int]:
    """Replace a checked table: one job splits the rows into good ones and those with a ``reason``, and counts both."""
    # Observed in the writing stage, behind any shuffle: a stage run again after a lost
    # executor is not counted twice.
    seen = Observation()
    split = by_partition(marked(rows, reason), REFUSED, *partition)
    counted = split.observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(F.col(REFUSED) == 1).alias("refused"))
    _replace(counted, path, (REFUSED, *partition), fmt)
    found = seen.get
    return {"read": found["read"], "good": found["read"] - found["refused"], "refused": found["refused"]}


def write_bronze(
    tables: Mapping[str, DataFrame], folder: str, fmt: str = FORMAT, refused: dict[str, int] | None = None
) -> dict[str, int]:
    """Replace each Bronze table, orders stored by purchase month, and return the counts of good rows, taken while
    writing. Tables read with the raw text of bad rows keep these aside; ``refused`` is filled with their number."""
    counts = {}
    for table, df in tables.items():
        months = ("purchase_ym",) if table == "orders" else ()
        if months:
            df = df.withColumn("purchase_ym", calendar.year_month())
        if CORRUPT in df.columns:
            found = write_checked(df, f"{folder}/{table}", unreadable(), months, fmt)
            counts[table] = found["good"]
            if refused is not None:
                refused[table] = found["refused"]
            continue
        seen = Observation(table)
        gathered = by_partition(df, *months) if months else df
        _replace(gathered.observe(seen, F.count(F.lit(1)).alias("n_rows")), f"{folder}/{table}", months, fmt)
        counts[table] = seen.get["n_rows"]
    return counts


def read_bronze(spark: SparkSession, folder: str, table: str, fmt: str = FORMAT) -> DataFrame:
    return read_table(spark, f"{folder}/{table}", fmt)


def write_silver(df: DataFrame, path: str, fmt: str = FORMAT) -> None:
    """Replace Silver, stored by year and month."""
    months = ("purchase_year", "purchase_month")
    _replace(by_partition(df, *months), path, months, fmt)


def read_silver(spark: SparkSession, path: str, keep: bool = False, fmt: str = FORMAT) -> DataFrame:
    """Silver; ``keep`` holds it on the executors for the seven KPI tables (unpersist when done)."""
    df = read_table(spark, path, fmt).select(*SILVER)
    return df.persist(StorageLevel.MEMORY_AND_DISK) if keep else df


def write_gold(df: DataFrame, folder: str, name: str, fmt: str = FORMAT) -> None:
    """Replace a KPI table. AQE coalesces these aggregates to few files by their size."""
    full_refresh(df, f"{folder}/{name}", fmt)


def read_gold(spark: SparkSession, folder: str, name: str, fmt: str = FORMAT) -> DataFrame:
    return read_table(spark, f"{folder}/{name}", fmt)


def _by_key(path: str, buckets: int) -> str:
    # The number is part of the path: files can't be taken for those of another number.
    return f"{path}/buckets-{buckets}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Replace a table stored by the hash of ``key``, a sorted file for each bucket: joins and groups by the key need no shuffle."""
    name = f"_bucketed_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    with _new_version(df.sparkSession, _by_key(path, buckets)) as version:
        writer.option("path", version).format("parquet").saveAsTable(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the entry of the catalogue; the files stay


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A table of ``write_bucketed`` as it stands, from any session."""
    version = place(spark, _by_key(path, buckets))
    name = f"_bucketed_{uuid.uuid5(uuid.NAMESPACE_URL, version).hex}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(version).schema.fields)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{version}'"
            f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
        )
    return spark.table(name)


def write_json(record: DataFrame, path: str) -> None:
    """A report of one row (metadata, summary, feature importances) as JSON lines."""
    record.write.mode("overwrite").json(path)
