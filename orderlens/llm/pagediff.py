"""Main text of web pages by differencing pages of neighbouring URLs.

Pages of a host are put in the order of their URL paths, so that a page stands beside those that share the longest
path with it. The text lines of neighbours are aligned by a longest common subsequence: lines that both
hold are the site's, not the article's, and are deleted. Lines that the markup names as menu, header,
footer, advert and so on are taken out as well (neighbours need not repeat them word for word).

Two things stay though shared: a neighbour that is a copy of the page tells nothing of it, and prose inside a
declared article element is the article's whoever repeats it. A shared line of links in it goes.

Neighbours are found by a range partitioning over host and path, so a host with most of the pages is spread over
all tasks; where a partition ends, its last page is aligned with the first of the next one. Lines
travel as hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from orderlens.llm.common import whole
from orderlens.llm.markup import ARTICLE, MAIN, Line, lines_of
from orderlens.session import staged

#: A neighbour that shares this part of a page's unmarked text is a copy of it.
COPY_SHARE = 0.9

URL = re.compile(r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]+)([^?#]*)")


def place_of(url: str | None) -> tuple[str, str] | None:
    """Host and path, written so that order goes by path segments; query and fragment do not count."""
    found = URL.match(url or "")
    if not found:
        return None
    return found[1].rpartition("@")[2].lower(), found[2].strip("/").replace("/", "\x01")


def digest_of(lines: list[Line]) -> bytes:
    state = xxhash.xxh3_128()
    for line in lines:
        state.update(f"{line.marked:d}{line.region}{line.linked:d}{line.text}\n")
    return state.digest()


def article_lines(lines: list[Line]) -> list[tuple[int, bool]]:
    """Numbers of the lines that may belong to the article by their markup, and whether one stays though shared."""
    open_ = [n for n, line in enumerate(lines) if not line.marked]
    region = max((lines[n].region for n in open_), default=0)
    if region in (ARTICLE, MAIN):
        open_ = [n for n in open_ if lines[n].region == region]
    return [(n, region == ARTICLE and not lines[n].linked) for n in open_]


def increasing(places: list[int]) -> list[int]:
    """Positions of a longest increasing subsequence of distinct numbers."""
    tops, ends, back = [], [], []
    for n, x in enumerate(places):
        k = bisect_left(tops, x)
        if k == len(tops):
            tops.append(x)
            ends.append(n)
        else:
            tops[k], ends[k] = x, n
        back.append(ends[k - 1] if k else -1)
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(n)
        n = back[n]
    return out[::-1]


def prefix_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``, a row of the table in one number's bits."""
    where: dict[int, int] = {}
    for n, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << n
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits[: len(b)].astype(np.int64))])


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions of one longest common subsequence of two sequences, in memory proportional to their length."""
    out = []
    tasks = [(0, len(a), 0, len(b))]
    while tasks:
        i, j, k, m = tasks.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        here, there = set(a[i:j]), set(b[k:m])
        both = here & there
        if not both:
            continue
        left = [n for n in range(i, j) if a[n] in both]
        right = [n for n in range(k, m) if b[n] in both]
        if len(left) == len(right) == len(both):
            at = {b[n]: n for n in right}
            places = [at[a[n]] for n in left]
            out += [(left[n], places[n]) for n in increasing(places)]
            continue
        first, second = [a[n] for n in left], [b[n] for n in right]
        if len(left) == 1:
            out.append((left[0], right[0]))
            continue
        half = len(first) // 2
        ways = prefix_lengths(first[:half], second) + prefix_lengths(first[half:][::-1], second[::-1])[::-1]
        cut = int(np.argmax(ways))
        middle, border = left[half], right[cut] if cut < len(right) else m
        tasks += [(i, middle, k, border), (middle, j, border, m)]
    return sorted(out)


def shared(a: list[int], a_sizes: list[int], b: list[int], b_sizes: list[int]) -> tuple[list[int], list[int]]:
    """Lines that two pages have in common; none if one of them is a copy of the other."""
    pairs = aligned(a, b)
    common = sum(a_sizes[i] for i, _ in pairs), sum(b_sizes[j] for _, j in pairs)
    for part, sizes in zip(common, (a_sizes, b_sizes)):
        if part and part >= COPY_SHARE * sum(sizes):
            return [], []
    return [i for i, _ in pairs], [j for _, j in pairs]


FEATURES = "host string, path string, digest binary, lines array<long>, sizes array<int>"


def features(pages: DataFrame, url: str, page: str) -> DataFrame:
    """Each distinct page of a host: its place among the paths (the first, where copies have several), hashes and sizes
    of its lines. Marked lines have no size."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for address, content in zip(batch.column(0), batch.column(1)):
                place = place_of(address.as_py())
                if place:
                    lines = lines_of(content.as_py())
                    hashes = [xxhash.xxh3_64_intdigest(line.text) - (1 << 63) for line in lines]
                    rows.append((*place, digest_of(lines), hashes, [0 if line.marked else len(line.text) for line in lines]))
            kinds = (pa.string(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()))
            columns = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "path", "digest", "lines", "sizes"]
            )

    rows = pages.select(F.col(url).alias("url"), whole(page).alias("page")).mapInArrow(work, FEATURES)
    first = rows.groupBy("host", "digest").agg(F.min(F.struct("path", "lines", "sizes")).alias("x"))
    return staged(first.select("host", "x.path", "digest", "x.lines", "x.sizes"), "page-lines")


COMPARED = "host string, digest binary, shared array<int>, part int, edge string, lines array<long>, sizes array<int>"


def compared(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Pages in order, each with the lines it shares with either neighbour. The first and the last keep their lines:
    their other neighbour is elsewhere."""
    part = TaskContext.get().partitionId()
    before, marks, edge = None, set(), "first"
    for row in rows:
        now: set = set()
        if before:
            if before[0] == row[0]:
                mine, its = shared(before[2], before[3], row[2], row[3])
                marks.update(mine)
                now.update(its)
            lines = before[2:4] if edge else (None, None)
            yield before[0], before[1], sorted(marks), part, edge, *lines
            edge = None
        before, marks = row, now
    if before:
        yield before[0], before[1], sorted(marks), part, "both" if edge else "last", *before[2:4]


def in_batches(rows: Iterator[tuple], most: int = 2000) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.binary(), pa.list_(pa.int32()), pa.int32(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()))
    names = ["host", "digest", "shared", "part", "edge", "lines", "sizes"]
    some: list = []
    for row in rows:
        some.append(row)
        if len(some) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names)
            some = []
    if some:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds)], names)


def site_lines(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``host, digest, shared``: for each distinct page that shares lines with a neighbour, which (numbers from 0)."""

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (tuple(x.as_py() for x in row) for batch in batches for row in zip(*batch.columns))
        yield from in_batches(compared(rows))

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for row in zip(*batch.columns):
                    host, one, other, a, a_sizes, b, b_sizes = (x.as_py() for x in row)
                    mine, its = shared(a, a_sizes, b, b_sizes)
                    for digest, lines in ((one, mine), (other, its)):
                        yield host, digest, lines, None, None, None, None

        yield from in_batches(rows())

    ordered = features(pages, url, page).repartitionByRange("host", "path", "digest").sortWithinPartitions("host", "path", "digest")
    inner = staged(ordered.select("host", "digest", "lines", "sizes").mapInArrow(neighbours, COMPARED), "page-neighbours")
    edges = inner.where("edge is not null").select("host", "digest", "part", "edge", "lines", "sizes")
    # A row a partition at most: which one with rows comes next.
    parts = edges.select("part").distinct().withColumn("next", F.lead("part").over(Window.orderBy("part")))
    last = edges.where("edge in ('last', 'both')").join(parts, "part")
    first = edges.where("edge in ('first', 'both')").select(
        F.col("host").alias("host_b"), F.col("digest").alias("digest_b"), F.col("part").alias("next"),
        F.col("lines").alias("lines_b"), F.col("sizes").alias("sizes_b"),
    )
    met = last.join(first, "next").where("host = host_b")
    met = met.select("host", "digest", "digest_b", "lines", "sizes", "lines_b", "sizes_b").mapInArrow(borders, COMPARED)
    both = inner.unionByName(met).where(F.size("shared") > 0)
    return both.groupBy("host", "digest").agg(F.array_distinct(F.flatten(F.collect_list("shared"))).alias("shared"))


def is_shared(number: Column) -> Column:
    return F.coalesce(F.array_contains("shared", number), F.lit(False))


def main_text(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``pages`` without the html column's markup: all other columns, and ``text``, ``n_chars``, ``n_lines`` (lines of text in the
    page), ``n_marked`` (not of the article by their markup) and ``n_shared`` (of the rest, deleted because a neighbour has them).

    Whole pages of any length. Null and empty pages, and pages without text, have an empty text. A page without a host
    (null or odd URL) has no neighbours: its markup alone decides. Repeated rows give equal results, and copies
    of a page in one host are one page to their neighbours. Further columns are kept; a column whose name is one of
    the new ones is replaced. An empty table gives an empty result.
    """
    made = ("text", "n_chars", "n_lines", "n_marked", "n_shared")
    kept = [c for c in pages.columns if c not in (*made, page)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            addresses = batch.column(batch.schema.get_field_index("__url"))
            for address, content in zip(addresses, batch.column(batch.schema.get_field_index("__page"))):
                lines = lines_of(content.as_py())
                place = place_of(address.as_py())
                mine = article_lines(lines)
                rows.append((
                    place[0] if place else None, digest_of(lines) if place else None, len(lines),
                    [lines[n].text for n, _ in mine], [-1 if stays else n for n, stays in mine],
                ))
            kinds = (pa.string(), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()))
            columns = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-2] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                [f"c{n}" for n in range(len(kept))] + ["host", "digest", "n_lines", "lines", "numbers"],
            )

    narrow = pages.select(
        *[F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(kept)], F.col(url).alias("__url"), whole(page).alias("__page")
    )
    kinds = "".join(f"c{n} {narrow.schema[f'c{n}'].dataType.simpleString()}, " for n in range(len(kept)))
    parsed = narrow.mapInArrow(work, kinds + "host string, digest binary, n_lines long, lines array<string>, numbers array<int>")
    site = site_lines(pages, url, page)
    joined = parsed.join(site, ["host", "digest"], "left")
    numbered = F.arrays_zip("lines", "numbers")
    left = F.filter(numbered, lambda x: ~is_shared(x["numbers"]))
    joined = joined.withColumn("left", left["lines"])
    return joined.select(
        *[F.col(f"c{n}").alias(c) for n, c in enumerate(kept)],
        F.array_join("left", " ").alias("text"),
        F.length(F.array_join("left", " ")).cast("long").alias("n_chars"),
        "n_lines",
        (F.col("n_lines") - F.size("lines")).alias("n_marked"),
        (F.size("lines") - F.size("left")).cast("long").alias("n_shared"),
    )
