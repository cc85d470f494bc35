"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation, functions as F

from orderlens.session import staged

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
# Words are runs of anything but these; the class must mean the same to Java and Python.
WORD = "[^\\x20\\x09-\\x0D]+"

#: The largest table an operator may broadcast or send to the driver, in rows.
SMALL_ROWS = 200_000


def whole(text: str | Column) -> Column:
    """The text itself; a null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def crc_of(key: str) -> Column:
    """crc32 of a key as text; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def crc_of_value(key) -> int:
    """``crc_of`` of one value."""
    return zlib.crc32(b"" if key is None else str(key).encode())


@contextmanager
def no_cycle_search() -> Iterator[None]:
    """Python's search for reference cycles rests inside. For work that makes none and keeps much: the search would go
    through all that is kept over and over."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of the splitmix generator)."""
    # Shifts and factors of the published generator.
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def one_in(rows: int, wanted: int) -> int:
    """Divisor of a hash that leaves about ``wanted`` of so many rows: a bounded sample that is then put in
    order gets few rows from each task, however many tasks there are."""
    return max(1, rows // max(1, wanted))


def bounded_rows(df: DataFrame, most: int, what: str) -> list:
    """All rows of a table that has to be small. A larger one is refused, never cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what} has more than {most} rows")
    return rows


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: for each end of an edge ``a, b`` (long) the smallest id it is connected to.

    Alternating large-star and small-star contraction: edges and nodes stay distributed, the lineage
    is cut by one written table a round, and each round is two combined aggregations and joins. Whether
    a round changed anything is told by sums observed while its table is written.
    """

    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = staged(edges.distinct(), "edges")
    before = None
    while True:
        # Large star: every larger neighbour is tied to the smallest of the neighbourhood.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: smaller neighbours, and the node itself, to the smallest neighbour.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        seen = Observation()
        told = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        edges = staged(small.where("a <> b").distinct().observe(seen, *told), "small-star")
        if seen.get == before:
            break
        before = seen.get
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def joined_components(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """``roots`` (``node, root``, as ``components`` gives them) after further ``edges``. Only components that these
    tie together are worked on; nodes that ``roots`` lacks stand for themselves."""
    of_a, of_b = (roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in ("a", "b"))
    ends = edges.join(of_a, "a", "left").join(of_b, "b", "left")
    ends = ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")).where("a <> b")
    between = staged(ends.distinct(), "between")
    if not between.limit(1).count():
        return roots
    moved = components(between)
    renamed = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    renamed = renamed.select("node", F.coalesce("to", "root").alias("root"))
    return staged(renamed.unionByName(moved.join(roots, "node", "left_anti").select("node", "root")), "roots")


_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


# A mask for the first so many of eight bytes.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
#: Longer spans are hashed one by one.
LONG_SPAN = 64


def spans_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of marked bytes of joined texts; a run ends where its text does."""
    edge = np.zeros(len(inside) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(inside) + 1, dtype=bool)
    before[1:] = inside
    here = np.zeros(len(inside) + 1, dtype=bool)
    here[:-1] = inside
    return np.flatnonzero(here & (edge | ~before)), np.flatnonzero(before & (edge | ~here))


def word_spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of UTF-8 bytes."""
    return spans_of(~_SPACES[raw], np.array([0, len(raw)]))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each lower-cased (A-Z) word: the same in every process. Eight bytes of all words at a time."""
    low = np.zeros(len(raw) + 8, dtype=np.uint8)
    np.take(_LOWER, raw, out=low[: len(raw)])
    eights = np.ndarray(len(raw) + 1, dtype="<u8", buffer=low.data, strides=(1,))
    left = ends - starts
    out = left.astype(np.uint64)
    long = np.flatnonzero(left > LONG_SPAN)
    open_, at = np.arange(len(starts)), starts
    if len(long):
        open_ = np.flatnonzero(left <= LONG_SPAN)
        at, left = starts[open_], left[open_]
        out[long] = [xxhash.xxh64_intdigest(low[starts[i] : ends[i]].tobytes()) for i in long]
    while len(open_):
        some = eights[at] & _FIRST[np.minimum(left, 8)]
        out[open_] = mix64((out[open_] + some) * np.uint64(0x9E3779B97F4A7C15))
        more = left > 8
        open_, at, left = open_[more], at[more] + 8, left[more] - 8
    return out


def text_parts(column: pa.Array, most: int = 1 << 22):
    """``(first, last, offsets, bytes)`` for runs of rows of a string array of about ``most`` bytes.

    A longer text is a run of its own; nothing is copied.
    """
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        own = offsets[first : last + 1]
        yield first, last, own - own[0], raw[own[0] : own[-1]]
        first = last


def words_of(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and position among the bytes of each word of joined texts; words never cross texts."""
    starts, ends = spans_of(~_SPACES[raw], offsets)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return rows, word_hashes(raw, starts, ends), starts
