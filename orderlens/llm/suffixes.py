"""Removal of byte strings that stand in an earlier document, by suffixes range-partitioned and sorted in buckets.

Every window of ``length`` bytes picks the suffix in it whose leading ``lead`` bytes hash lowest. Equal
windows pick the same suffix, so comparing picked suffixes only, one in fifteen, misses nothing. The
stretch of windows that pick one suffix is one row: leading token (the hash), hash of the stretch's
bytes, document, place.

Splitters sampled from these rows cut them into buckets by leading token, then document, so that a
token which a third of all documents share is spread out. Within a bucket rows are sorted by leading
token, stretch and document; a stretch that also stands in an earlier document goes. What a bucket
can't tell, stretches that differ though their tokens are equal, and the tokens at its boundaries, is
compared window by window in a second step, by 128 bits of each window.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderlens.llm.common import SMALL_ROWS, mix64, one_in, text_parts, whole
from orderlens.session import drop, scratch_path, staged


@dataclass(frozen=True)
class SuffixParams:
    """``length``: bytes of a repeated string. The others change cost, not results: ``lead`` bytes of a leading
    token, ``sample_rows`` to choose splitters from, ``broadcast_tokens`` sent to all tasks at most (8 bytes
    each; more are joined), ``hot_token``: windows of one token that a task compares at most, at some 60 bytes each;
    those of a token with more are compared by a shuffle."""

    length: int = 50
    lead: int = 20
    sample_rows: int = 100_000
    broadcast_tokens: int = 4_000_000
    hot_token: int = 1 << 20


_STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LONGEST = 8192
#: Bytes of stretches compared at a time (those of one token together).
COMPARED = 1 << 20


def _grams(raw: np.ndarray, size: int, step: int) -> np.ndarray:
    """Polynomial hash, modulo 2^64, of each ``size`` bytes, put together from those of powers of two."""
    if len(raw) < size:
        return np.zeros(0, dtype=np.uint64)

    def power(n: int) -> np.uint64:
        return np.uint64(pow(step, n, 1 << 64))

    block, width = raw.astype(np.uint64) + np.uint64(1), 1
    out, done = None, 0
    rest = size
    while rest:
        if rest & 1:
            if out is None:
                out, done = block, width
            else:
                n = len(raw) - done - width + 1
                out = out[:n] * power(width) + block[done : done + n]
                done += width
        rest >>= 1
        if rest:
            n = len(raw) - 2 * width + 1
            block = block[:n] * power(width) + block[width : width + n]
            width *= 2
    return out


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbouring values."""
    out, size = values, 1
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    if size < width:
        out = np.minimum(out[: len(out) - (width - size)], out[width - size :])
    return out


def _stretches(offsets: np.ndarray, raw: np.ndarray, params: SuffixParams):
    """Row, start (among the joined bytes), number of windows and leading token of each stretch of joined texts."""
    length = params.length
    if len(raw) < length:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none.astype(np.uint64)
    token = _lowest(mix64(_grams(raw, params.lead, _STEPS[0])), length - params.lead + 1)
    lengths = np.diff(offsets)
    inside = np.zeros(len(raw), dtype=bool)  # a window starts here and ends within its text
    row = np.repeat(np.arange(len(lengths)), lengths)
    inside[:] = np.arange(len(raw)) + length <= offsets[1:][row]
    inside = inside[: len(token)]
    change = np.ones(len(token), dtype=bool)
    change[1:] = token[1:] != token[:-1]
    change[1:] |= inside[1:] != inside[:-1]
    begins = offsets[:-1][lengths > 0]
    change[begins[begins < len(change)]] = True
    start = np.flatnonzero(change)
    count = np.diff(np.append(start, len(token)))
    keep = inside[start]
    start, count = start[keep], count[keep]
    if len(count) and count.max() > _LONGEST:  # as in a text of one letter
        pieces = -(-count // _LONGEST)
        again = np.repeat(np.arange(len(start)), pieces)
        nth = np.arange(len(again)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        count = np.minimum(count[again] - nth * _LONGEST, _LONGEST)
        start = start[again] + nth * _LONGEST
    return row[start], start, count, token[start]


def _whole_stretches(windows: np.ndarray, start: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Hash of all bytes of each stretch: of the windows that stand end to end in it, and of its last."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    parts = 1 + -(-(count - 1) // length)
    head = np.cumsum(parts) - parts
    number = np.repeat(np.arange(len(start)), parts)
    nth = np.arange(len(number)) - head[number]
    at = start[number] + np.minimum(nth * length, count[number] - 1)
    mixed = mix64(windows[at] + mix64(nth.astype(np.uint64) + np.uint64(1)))
    return mix64(np.add.reduceat(mixed, head) + count.astype(np.uint64))


def _rows(batches: Iterator[pa.RecordBatch], params: SuffixParams):
    for batch in batches:
        for first, last, offsets, raw in text_parts(batch.column(2), 1 << 20):
            doc = batch.column(0).slice(first, last - first).to_numpy()
            key = batch.column(1).slice(first, last - first).to_numpy()
            yield doc, key, offsets, raw, _stretches(offsets, raw, params)


def suffix_rows(docs: DataFrame, params: SuffixParams, splitters: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``token, stretch, doc, key, place, bucket``; ``place`` packs the start in the text and the windows."""
    cut = docs.sparkSession.sparkContext.broadcast(splitters)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, key, offsets, raw, (row, start, count, token) in _rows(batches, params):
            windows = _grams(raw, params.length, _STEPS[1])
            stretch = _whole_stretches(windows, start, count, params.length)
            place = ((start - offsets[row]) << 24) | count
            bucket = _bucket(token, doc[row], cut.value) if cut.value is not None else np.zeros(len(row), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(token.view(np.int64)),
                    pa.array(stretch.view(np.int64)),
                    pa.array(doc[row], pa.int64()),
                    pa.array(key[row], pa.int64()),
                    pa.array(place, pa.int64()),
                    pa.array(bucket.astype(np.int32)),
                ],
                names=["token", "stretch", "doc", "key", "place", "bucket"],
            )

    return docs.mapInArrow(work, "token long, stretch long, doc long, key long, place long, bucket int")


def _bucket(token: np.ndarray, doc: np.ndarray, splitters: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Number of splitters (token, doc) below each row."""
    tokens, docs = splitters
    low = np.searchsorted(tokens, token, side="left")
    high = np.searchsorted(tokens, token, side="right")
    for at in np.flatnonzero(low < high):
        low[at] += np.searchsorted(docs[low[at] : high[at]], doc[at], side="left")
    return low


def _splitters(docs: DataFrame, params: SuffixParams, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Evenly spaced rows of a bounded sample of the suffixes of about a thousand documents."""
    divisor = one_in(docs.count(), params.sample_rows // 100)
    some = docs.where(F.pmod(F.xxhash64("key", "doc"), F.lit(divisor)) == 0)
    sample = (
        suffix_rows(some, params)
        .select("token", "doc", F.xxhash64("token", "doc", "place").alias("turn"))
        .orderBy("turn")
        .limit(params.sample_rows)
        .toArrow()
    )
    token = sample.column("token").to_numpy().view(np.uint64)
    doc = sample.column("doc").to_numpy()
    order = np.lexsort((doc, token))
    at = order[(np.arange(1, buckets) * len(order)) // buckets] if len(order) else order
    return token[at], doc[at]


FOUND = "doc long, key long, start long, stop long, token long"


def _bucket_repeats(rows: DataFrame, params: SuffixParams) -> DataFrame:
    """``FOUND``: byte ranges that go (``token`` null), and tokens that have to be compared further."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        whole_part = pa.Table.from_batches(parts)
        token, stretch, doc, key, place, bucket = (whole_part.column(i).to_numpy() for i in range(6))
        del whole_part, parts
        order = np.lexsort((doc, stretch, token, bucket))
        token, stretch, doc, key, place, bucket = (a[order] for a in (token, stretch, doc, key, place, bucket))
        new_bucket = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        new_token = new_bucket | np.concatenate([[True], token[1:] != token[:-1]])
        new_stretch = new_token | np.concatenate([[True], stretch[1:] != stretch[:-1]])
        begin = np.flatnonzero(new_stretch)
        # Sorted by document: the first row of a stretch has the earliest.
        gone = doc > doc[begin][np.cumsum(new_stretch) - 1]
        start = place >> 24
        stop = start + (place & 0xFFFFFF) + params.length - 1
        heads = np.flatnonzero(new_token)
        ends = np.append(heads[1:], len(token))
        stretches = np.add.reduceat(new_stretch.astype(np.int64), heads)
        several = np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)
        edge = new_bucket[heads].copy()
        edge[np.append(np.flatnonzero(new_bucket[heads])[1:] - 1, len(heads) - 1)] = True
        further = ((stretches > 1) & several) | edge
        del ends
        asked = token[heads][further]
        columns = [
            np.concatenate([a[gone], np.zeros(len(asked), dtype=np.int64)]) for a in (doc, key, start, stop)
        ]
        tokens = np.concatenate([np.zeros(int(gone.sum()), dtype=np.int64), asked])
        empty = np.arange(len(tokens)) < int(gone.sum())
        for at in range(0, len(tokens), 200_000):
            s = slice(at, at + 200_000)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c[s], pa.int64()) for c in columns), pa.array(tokens[s], pa.int64(), mask=empty[s])],
                names=["doc", "key", "start", "stop", "token"],
            )

    return rows.mapInArrow(work, FOUND)


OPEN = "token long, doc long, key long, start long, content binary"


def _open_stretches(docs: DataFrame, params: SuffixParams, tokens: DataFrame) -> DataFrame:
    """``OPEN``: the bytes of every stretch whose token has to be compared window by window."""
    few = tokens.limit(params.broadcast_tokens + 1).toArrow().column("token").to_numpy()
    known = None
    if len(few) <= params.broadcast_tokens:  # of checked size; beyond it the stretches are joined
        known = docs.sparkSession.sparkContext.broadcast(np.sort(few.view(np.uint64)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, key, offsets, raw, (row, start, count, token) in _rows(batches, params):
            if known is not None and len(known.value) and len(token):
                at = np.minimum(np.searchsorted(known.value, token), len(known.value) - 1)
                wanted = known.value[at] == token
                row, start, count, token = (a[wanted] for a in (row, start, count, token))
            elif known is not None:
                continue
            data = raw.tobytes()
            content = [data[a : a + n + params.length - 1] for a, n in zip(start.tolist(), count.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(token.view(np.int64)),
                    pa.array(doc[row], pa.int64()),
                    pa.array(key[row], pa.int64()),
                    pa.array(start - offsets[row], pa.int64()),
                    pa.array(content, pa.binary()),
                ],
                names=["token", "doc", "key", "start", "content"],
            )

    found = docs.mapInArrow(work, OPEN)
    return found if known is not None else found.join(tokens, "token", "left_semi")


def _windows(starts: np.ndarray, contents: list[bytes], params: SuffixParams):
    """Stretch number, place in the text and 128-bit hash of every window of the given stretches."""
    sizes = np.array([len(c) for c in contents], dtype=np.int64)
    raw = np.frombuffer(b"".join(contents), dtype=np.uint8)
    begin = np.cumsum(sizes) - sizes
    count = sizes - params.length + 1
    number = np.repeat(np.arange(len(sizes)), count)
    nth = np.arange(len(number)) - np.repeat(np.cumsum(count) - count, count)
    at = begin[number] + nth
    first, second = (_grams(raw, params.length, step)[at] for step in _STEPS)
    return number, starts[number] + nth, first, second


def _intervals(doc, key, at, params: SuffixParams) -> pa.RecordBatch:
    """``FOUND`` rows of windows that go, neighbouring ones joined."""
    order = np.lexsort((at, key, doc))
    doc, key, at = doc[order], key[order], at[order]
    fresh = np.ones(len(at), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]) | (at[1:] > at[:-1] + 1)
    head = np.flatnonzero(fresh)
    last = np.append(head[1:], len(at)) - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc[head], pa.int64()),
            pa.array(key[head], pa.int64()),
            pa.array(at[head], pa.int64()),
            pa.array(at[last] + params.length if len(at) else at, pa.int64()),
            pa.nulls(len(head), pa.int64()),
        ],
        names=["doc", "key", "start", "stop", "token"],
    )


def _window_repeats(rows: DataFrame, params: SuffixParams) -> DataFrame:
    """``FOUND`` of stretches whose tokens lie whole in a partition, window by window."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        token, doc, key, start = (table.column(i).to_numpy() for i in range(4))
        contents = table.column(4).to_pylist()
        del table, parts
        # Equal windows have equal tokens: parts of the token range can be compared one after the other.
        order = np.argsort(token, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], token[order][1:] != token[order][:-1]]))
        sizes = np.cumsum(np.array([len(contents[i]) for i in order]))
        cut = 0
        while cut < len(order):
            done = sizes[cut - 1] if cut else 0
            stop = int(np.searchsorted(sizes, done + COMPARED))
            after = heads[np.searchsorted(heads, min(stop, len(order) - 1), side="right") :]
            stop = int(after[0]) if len(after) else len(order)
            some = order[cut:stop]
            cut = stop
            number, at, first, second = _windows(start[some], [contents[i] for i in some], params)
            whose = doc[some][number]
            by = np.lexsort((whose, second, first))
            fresh = np.ones(len(by), dtype=bool)
            fresh[1:] = (first[by][1:] != first[by][:-1]) | (second[by][1:] != second[by][:-1])
            earliest = whose[by][np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
            gone = by[whose[by] > earliest]
            if len(gone):
                yield _intervals(whose[gone], key[some][number[gone]], at[gone], params)

    return rows.mapInArrow(work, FOUND)


def _hot_repeats(rows: DataFrame, params: SuffixParams, home: str) -> DataFrame:
    """The same for tokens with very many rows: windows are combined before they meet, whatever their token."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, key, start = (batch.column(i).to_numpy() for i in range(1, 4))
            number, at, first, second = _windows(start, batch.column(4).to_pylist(), params)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(first.view(np.int64)),
                    pa.array(second.view(np.int64)),
                    pa.array(doc[number], pa.int64()),
                    pa.array(key[number], pa.int64()),
                    pa.array(at, pa.int64()),
                ],
                names=["first", "second", "doc", "key", "at"],
            )

    windows = _written(rows.mapInArrow(explode, "first long, second long, doc long, key long, at long"), f"{home}/windows")
    earliest = windows.groupBy("first", "second").agg(F.min("doc").alias("earliest"), F.max("doc").alias("latest"))
    gone = windows.join(earliest.where("earliest < latest").drop("latest"), ["first", "second"]).where("doc > earliest")
    return gone.select("doc", "key", F.col("at").alias("start"), (F.col("at") + params.length).alias("stop"))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeated_ranges(docs: DataFrame, params: SuffixParams, home: str) -> DataFrame:
    """``doc, key, start, stop``: byte ranges (they may overlap) that earlier documents hold. ``docs``: doc, key, text.

    The result reads what is written under ``home``, which the caller may drop with it."""
    spark = docs.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = suffix_rows(docs, params, _splitters(docs, params, buckets))
    found = _written(_bucket_repeats(rows.repartition("bucket"), params), f"{home}/found")
    tokens = found.where(F.col("token").isNotNull()).select("token").distinct()
    opened = _written(_open_stretches(docs, params, tokens), f"{home}/opened")
    windows = F.sum(F.octet_length("content") - (params.length - 1))
    hot = opened.groupBy("token").agg(windows.alias("n")).where(F.col("n") > params.hot_token).select("token")
    hot = _written(hot, f"{home}/hot")
    if hot.count() <= SMALL_ROWS:
        hot = F.broadcast(hot)
    near = _window_repeats(opened.join(hot, "token", "left_anti").repartition("token"), params)
    far = _hot_repeats(opened.join(hot, "token", "left_semi"), params, home)
    ranges = ["doc", "key", "start", "stop"]
    return found.where(F.col("token").isNull()).select(ranges).unionByName(near.select(ranges)).unionByName(far)


def _text_key(plain: DataFrame) -> Column:
    """What tells the texts of one id apart: their hash, or nothing if no id has several, as every suffix carries it."""
    key = F.xxhash64("text")
    several = plain.groupBy("doc").agg(F.min(key).alias("least"), F.max(key).alias("most")).where("least < most")
    return key if several.take(1) else F.lit(0).cast("long")


def without_repeats(
    docs: DataFrame, params: SuffixParams = SuffixParams(), id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, removed array<struct<start, stop>>, kept binary`` for every row of ``docs``.

    Strings are judged on the input. A null text counts as empty; a null id as smaller than any other; rows
    of one id are not earlier than each other, so repeated rows lose the same bytes. Bytes are counted in
    UTF-8, so ``kept`` may cut characters. Further columns of ``docs`` are not looked at.
    """
    least = F.lit(-(1 << 63)).cast("long")
    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), least).alias("doc"), whole(text).alias("text"))
    plain = plain.select("doc", _text_key(plain).alias("key"), "text")
    home = scratch_path(docs.sparkSession, "suffixes")
    ranges = repeated_ranges(plain, params, home)
    by_doc = staged(
        ranges.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "stop")).alias("ranges")), "removed-ranges"
    )
    drop(docs.sparkSession, home)
    # Ranges grow with the documents: joined by a shuffle at every size, so that it costs the same a GB.
    joined = plain.join(by_doc.hint("merge"), ["doc", "key"], "left").select("doc", "text", "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            texts, ranges = batch.column(1), batch.column(2)
            sizes, removed, kept = [], [], []
            for i in range(batch.num_rows):
                raw = texts[i].as_py().encode("utf-8")
                merged: list[list[int]] = []
                if ranges[i].is_valid:
                    flat = ranges[i].values.flatten()
                    spans = np.stack([np.asarray(f) for f in flat], axis=1)
                    for start, stop in spans[np.lexsort((spans[:, 1], spans[:, 0]))].tolist():
                        if merged and start <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], stop)
                        else:
                            merged.append([start, stop])
                parts, at = [], 0
                for start, stop in merged:
                    parts.append(raw[at:start])
                    at = stop
                parts.append(raw[at:])
                sizes.append(len(raw))
                removed.append([{"start": start, "stop": stop} for start, stop in merged])
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "removed", "kept"],
            )

    out = joined.mapInArrow(
        cut, "doc_id long, n_bytes long, removed array<struct<start: long, stop: long>>, kept binary"
    )
    return out.withColumn("doc_id", F.when(F.col("doc_id") != least, F.col("doc_id")))


def removal_report(docs: DataFrame, params: SuffixParams = SuffixParams()) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of ``without_repeats``."""
    out = without_repeats(docs, params)
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
