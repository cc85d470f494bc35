"""Deletion of repeated line runs by a suffix array over line ids, in DataFrame operations only.

Lines that occur more than once get an id; the others end every run. Prefix doubling then ranks all
suffixes by their first 1, 2, 4, ... lines: the rank of 2h lines is that of the pair of ranks at a line
and h lines on. Suffixes of one rank share that prefix, so they are an interval of the suffix array
whose longest common prefix is at least so long. A run counts as repeated from ``min_chars`` characters
(a line end is one), whatever the number of its lines; a window of any number of lines is looked up by
the two ranks, of a power of two, that cover it.

A line is deleted if it lies in a run that also starts at an earlier position, positions being ordered
by document id, then text hash, then line. Two families of windows find exactly these lines: the
shortest one from each line on that reaches ``min_chars``, and the shortest one back from each line.
If the line and what is before it in the run reach ``min_chars``, the second does; else the first,
from the start of the run, reaches over the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from orderlens.llm.common import whole
from orderlens.session import staged

MIN_CHARS = 50
# A null id is one of its own, ahead of all others, and equal to itself in joins.
KEY = ["known", "doc", "hash"]


def _position() -> Column:
    return F.struct(*KEY, "line")


def _key(id_col: str, kind: str, text: Column) -> list[Column]:
    return [
        F.col(id_col).isNotNull().alias("known"),
        F.coalesce(F.col(id_col), F.lit("0").cast(kind)).alias("doc"),
        F.xxhash64(text).alias("hash"),
    ]


def line_table(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``known, doc, hash, line, width, key_a, key_b, before``: every line, and a last row without a key behind the last.

    ``before`` counts the characters ahead of the line. Rows equal in id and text are one document.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    ended = F.concat(F.split(whole(text), "\n"), F.array(F.lit(None).cast("string")))
    lines = docs.select(
        *_key(id_col, kind, whole(text)), F.posexplode(ended).alias("line", "content")
    ).select(
        *KEY,
        "line",
        (F.length("content") + 1).alias("width"),
        # 128 bits: the second hash starts from another state.
        F.when(F.col("content").isNotNull(), F.xxhash64("content")).alias("key_a"),
        F.when(F.col("content").isNotNull(), F.xxhash64(F.lit("line"), "content")).alias("key_b"),
    )
    once = lines.groupBy(*KEY, "line").agg(*(F.max(name).alias(name) for name in ("width", "key_a", "key_b")))
    ahead = W.partitionBy(*KEY).orderBy("line").rowsBetween(W.unboundedPreceding, -1)
    return once.withColumn("before", F.coalesce(F.sum(F.coalesce("width", F.lit(0))).over(ahead), F.lit(0)))


def _windows(lines: DataFrame, min_chars: int) -> DataFrame:
    """``kind, known, doc, hash, line, size``: from each line, and back from each line, the shortest of ``min_chars``."""
    back = W.partitionBy(*KEY).orderBy("before").rangeBetween(W.unboundedPreceding, -min_chars)
    # In falling order the rows ahead are those further on in the text; such a frame only grows.
    on = W.partitionBy(*KEY).orderBy(F.col("before").desc()).rangeBetween(W.unboundedPreceding, -min_chars)
    found = lines.select(*KEY, "line", F.min("line").over(on).alias("end"), F.max("line").over(back).alias("start"))
    both = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("line").alias("line"), (F.col("end") - F.col("line")).alias("size")),
        F.struct(F.lit(1).alias("kind"), F.col("start").alias("line"), (F.col("line") - F.col("start")).alias("size")),
    )
    return found.select(*KEY, F.explode(both).alias("w")).select(*KEY, "w.*").where(F.col("size") > 0)


def _dense_rank(keys: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of distinct keys with their ``rank`` in the order of all of them, from 1.

    Range partitions are numbered within, then moved up by the sizes of those before: one small row
    for each partition meets in a task, never the keys.
    """
    ranged = keys.repartitionByRange(*columns).withColumn("part", F.spark_partition_id())
    within = W.partitionBy("part").orderBy(*columns)
    numbered = staged(ranged.select(*columns, "part", F.row_number().over(within).cast("long").alias("turn")), "ranks")
    sizes = numbered.groupBy("part").agg(F.max("turn").alias("n"))
    below = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shift = sizes.select("part", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("below"))
    return numbered.join(F.broadcast(shift), "part").select(*columns, (F.col("turn") + F.col("below")).alias("rank"))


def suffix_ranks(lines: DataFrame, most_lines: int) -> DataFrame:
    """``known, doc, hash, line, rank_1, rank_2, rank_4, ...`` up to ``most_lines``: the suffix array by prefixes.

    ``rank_h`` orders suffixes by their first h lines and is null where those occur once only.
    """
    repeated = lines.where(F.col("key_a").isNotNull()).groupBy("key_a", "key_b").agg(F.count("*").alias("n")).where("n > 1")
    ids = _dense_rank(repeated.select("key_a", "key_b"), ["key_a", "key_b"]).withColumnRenamed("rank", "rank_1")
    ranks = staged(lines.join(ids, ["key_a", "key_b"]).select(*KEY, "line", "rank_1"), "ranked")
    height = 1
    while 2 * height <= most_lines:
        along = W.partitionBy(*KEY).orderBy("line")
        here = f"rank_{height}"
        # Rows are missing where a line is unique; what is not h lines on is then out of reach.
        behind = F.when(F.lead("line", height).over(along) == F.col("line") + height, F.lead(here, height).over(along))
        paired = ranks.withColumn("behind", behind)
        pairs = (
            paired.where(F.col(here).isNotNull() & F.col("behind").isNotNull())
            .groupBy(here, "behind")
            .agg(F.count("*").alias("n"))
            .where("n > 1")
        )
        ordered = _dense_rank(pairs.select(here, "behind"), [here, "behind"])
        ranks = staged(
            paired.join(ordered.withColumnRenamed("rank", f"rank_{2 * height}"), [here, "behind"], "left").drop("behind"),
            "ranked",
        )
        height *= 2
    return ranks


def repeated_windows(lines: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``kind, known, doc, hash, line, size, first``: windows that occur again, with their first position."""
    if min_chars < 1:
        raise ValueError("a run needs a character")
    windows = _windows(lines, min_chars)
    # A window has min_chars lines at most, every line counting for one character or more.
    most = windows.agg(F.max("size")).first()[0] or 1
    ranks = suffix_ranks(lines, most)
    heights = sorted(int(name[5:]) for name in ranks.columns if name.startswith("rank_"))

    def rank(of: str = "") -> Column:
        found = F.lit(None).cast("long")
        for height in heights:
            found = F.when(F.col("size") >= height, F.col(f"{of}rank_{height}")).otherwise(found)
        return found

    height = F.lit(1)
    for h in heights:
        height = F.when(F.col("size") >= h, F.lit(h)).otherwise(height)
    named = (
        windows.join(ranks, [*KEY, "line"])
        .withColumn("name_a", rank())
        .where(F.col("name_a").isNotNull())
        .select("kind", *KEY, "line", "size", "name_a", (F.col("line") + F.col("size") - height).alias("last"))
    )
    ends = ranks.withColumnRenamed("line", "last")
    named = (
        named.join(ends, [*KEY, "last"])
        .withColumn("name_b", rank())
        .where(F.col("name_b").isNotNull())
        .select("kind", *KEY, "line", "size", "name_a", "name_b")
    )
    named = staged(named, "windows")
    name = ["kind", "size", "name_a", "name_b"]
    groups = named.groupBy(*name).agg(F.min(_position()).alias("first"), F.count("*").alias("n")).where("n > 1")
    return named.join(groups.drop("n"), name).select("kind", *KEY, "line", "size", "first")


def repeated_runs(docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``known, doc, hash, runs``: the maximal runs of lines to delete, ``array<struct<start, n>>`` in order."""
    lines = staged(line_table(docs, id_col, text), "lines")
    later = repeated_windows(lines, min_chars).where(F.col("first") < _position())
    # Windows back from a line vouch for that line; the others for all they hold.
    held = F.when(F.col("kind") == 0, F.sequence("line", F.col("line") + F.col("size") - 1)).otherwise(
        F.array(F.col("line") + F.col("size") - 1)
    )
    gone = later.select(*KEY, F.explode(held).alias("line")).distinct()
    along = W.partitionBy(*KEY).orderBy("line")
    runs = (
        gone.withColumn("run", F.col("line") - F.row_number().over(along))
        .groupBy(*KEY, "run")
        .agg(F.min("line").alias("start"), F.count("*").cast("int").alias("n"))
    )
    return runs.groupBy(*KEY).agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("runs"))


def without_runs(
    docs: DataFrame, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text: str = "text", prefix: str = "dedup_"
) -> DataFrame:
    """``docs`` with the later copies of repeated line runs gone, one row for each row of ``docs``.

    ``text`` is replaced; ``{prefix}lines``, ``{prefix}removed``, ``{prefix}runs`` say how many lines the
    text had, lost, and which runs (columns of these names are replaced). A null text stays null and has
    no lines, an empty one has one. Rows equal in id and text are one document and lose the same lines;
    null ids sort first. Other columns pass through, whatever their names.
    """
    runs = repeated_runs(docs, min_chars, id_col, text).select(
        F.struct(*KEY).alias("__dedup_key"), F.col("runs").alias("__dedup_runs")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.withColumn("__dedup_key_of", F.struct(*_key(id_col, kind, whole(text))))
    joined = keyed.join(runs, F.col("__dedup_key_of") == F.col("__dedup_key"), "left").drop(
        "__dedup_key", "__dedup_key_of"
    )
    found = F.coalesce(F.col("__dedup_runs"), F.array().cast("array<struct<start:int,n:int>>"))
    lines = F.split(F.col(text), "\n")
    count = F.coalesce(F.size(lines), F.lit(0))
    # What stands between the runs, from the end of one to the start of the next.
    starts = F.concat(F.array(F.lit(0)), F.transform(found, lambda run: run["start"] + run["n"]))
    ends = F.concat(F.transform(found, lambda run: run["start"]), F.array(count))
    kept = F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(lines, a + 1, b - a)))
    return (
        joined.withColumn(f"{prefix}lines", F.when(F.col(text).isNull(), F.lit(0)).otherwise(count))
        .withColumn(f"{prefix}removed", F.aggregate(found, F.lit(0), lambda n, run: n + run["n"]))
        .withColumn(f"{prefix}runs", found)
        .withColumn(
            text,
            F.when(F.size(found) == 0, F.col(text)).otherwise(F.array_join(kept, "\n")),
        )
        .drop("__dedup_runs")
    )
