"""Ranked lexical search over hashed max-sketches.

A document's sketch is an array of cells. Each of its terms is hashed to three cells, and a cell holds the largest
impact that fell into it. A query term's impact is at most the smallest of its three cells, so a lookup
of all terms of all items gives an upper bound of every score. Within one document the impact grows
with the number of occurrences alone, so the cell holds that number, and the index does not depend on
statistics of the corpus or on the items.

Documents are rescored exactly in the order of their bounds: first the best few of each item, whose exact scores
give a threshold; then all whose bound reaches it. What stays below cannot be among the best.

Terms are known by 64-bit hashes. Items are searched in blocks of bounded size, each against all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from orderlens.llm.common import spans_of, text_parts, whole, word_hashes
from orderlens.session import scratch_path, staged

# Scale and parameters of the score.
SCALE, K1, B = 1_000_000_000, 12, 25

#: Cells a distinct term, about; the number of cells is the next power of two.
CELLS_PER_TERM = 8
HASHES = 3
#: A hash has bits for as many cells. A document with more terms than fit gets looser bounds, not other results.
MOST_CELLS_LOG2 = 21
#: So many documents of each item are rescored for the first threshold, for each one wanted.
FIRST_SHARE = 5
#: Item texts that are searched together, in characters.
BLOCK_CHARS = 4 << 20
#: Numbers that a task works on at a time.
WORK = 1 << 21

_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each term of joined texts: runs of digits, letters and characters beyond ASCII, A-Z lower-cased."""
    starts, ends = spans_of(_INSIDE[raw], offsets)
    return np.searchsorted(offsets, starts, side="right") - 1, word_hashes(raw, starts, ends)


def term_counts(offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of each text with repeats; then row, hash and count of its distinct terms, row by row."""
    rows, hashes = terms_of(offsets, raw)
    lengths = np.bincount(rows, minlength=len(offsets) - 1)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    first = np.flatnonzero(np.append(True, (np.diff(rows) != 0) | (np.diff(hashes) != 0))[: len(rows)])
    return lengths, rows[first], hashes[first], np.diff(np.append(first, len(rows)))


def cells(hashes: np.ndarray, log2: int) -> list[np.ndarray]:
    """The cells of each hash among so many."""
    mask = np.uint64((1 << log2) - 1)
    return [((hashes >> np.uint64(MOST_CELLS_LOG2 * n)) & mask).astype(np.int64) for n in range(HASHES)]


def sketch(hashes: np.ndarray, counts: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Size (as a power of two), unit and cells of one document. A count is at most its cells times the unit."""
    log2 = min(MOST_CELLS_LOG2, max(6, (CELLS_PER_TERM * len(hashes) - 1).bit_length()))
    unit = -(-int(counts.max()) // 255)
    folded = np.zeros(1 << log2, dtype=np.uint8)
    rounded = (-(-counts // unit)).astype(np.uint8)
    for place in cells(hashes, log2):
        np.maximum.at(folded, place, rounded)
    return log2, unit, folded


INDEXED = "key long, n long, log2 int, unit int, cells binary"


def index(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, a key of id and text, number of terms and sketch of every document with a term, written once."""
    kind = dict(docs.dtypes)[id_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for start, stop, offsets, raw in text_parts(batch.column(2)):
                lengths, rows, hashes, counts = term_counts(offsets, raw)
                bounds = np.searchsorted(rows, np.arange(len(lengths) + 1))
                at = np.flatnonzero(lengths)
                built = [sketch(hashes[bounds[i] : bounds[i + 1]], counts[bounds[i] : bounds[i + 1]]) for i in at]
                picked = pa.array(start + at)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(picked),
                        batch.column(1).take(picked),
                        pa.array(lengths[at], pa.int64()),
                        pa.array([x[0] for x in built], pa.int32()),
                        pa.array([x[1] for x in built], pa.int32()),
                        pa.array([pack(x[2].data) for x in built], pa.binary()),
                    ],
                    ["id", "key", "n", "log2", "unit", "cells"],
                )

    keyed = docs.select(F.col(id_col).alias("id"), key_of(id_col, text), whole(text).alias("text"))
    return staged(keyed.mapInArrow(work, f"id {kind}, {INDEXED}"), "sketches")


def key_of(id_col: str, text: str):
    """Names a row by its id and text. Should two rows share a key, both are rescored, each by its own text."""
    return F.xxhash64(F.col(id_col), whole(text)).alias("key")


class Block:
    """Items of one block: their distinct terms, and each item's terms as places among these."""

    def __init__(self, texts: list[str]):
        offsets = np.cumsum([0, *(len(t.encode("utf-8")) for t in texts)])
        raw = np.frombuffer("".join(texts).encode("utf-8"), dtype=np.uint8)
        _, self.item, hashes, self.repeats = term_counts(offsets, raw)
        self.terms, self.place = np.unique(hashes, return_inverse=True)
        self.items = len(texts)

    def weigh(self, df: np.ndarray, documents: int, terms: int) -> None:
        """Corpus statistics: in how many documents each term is, documents and terms in all."""
        weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(x) + 1))) for x in df]
        self.weights = np.array(weight, dtype=np.int64)[self.place] * self.repeats
        self.documents, self.all_terms = documents, terms
        # Items without a term have no sum; the others' terms stand side by side.
        self.scored = np.unique(self.item)
        self.starts = np.searchsorted(self.item, self.scored)

    def impacts(self, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``counts`` (documents x terms) as impacts; zero stays zero."""
        m = 100 - B + (B * lengths * self.documents) // self.all_terms
        out = np.zeros(counts.shape, dtype=np.int64)
        row, column = np.nonzero(counts)
        tf = counts[row, column].astype(np.int64)
        out[row, column] = SCALE * tf // (1000 * tf + K1 * m[row])
        return out

    def sums(self, impacts: np.ndarray) -> np.ndarray:
        """Documents x items: sums of weight and impact."""
        out = np.zeros((len(impacts), self.items), dtype=np.int64)
        if len(self.scored):
            out[:, self.scored] = np.add.reduceat(impacts[:, self.place] * self.weights, self.starts, axis=1)
        return out

    def at_a_time(self) -> int:
        return max(1, WORK // max(1, len(self.place), len(self.terms)))


class Best:
    """The best ``k`` rows seen so far of each item."""

    def __init__(self, items: int, k: int):
        self.k, self.items, self.waiting, self.size = k, items, [], 0
        self.least = np.zeros(items, dtype=np.int64)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores (rows x items) above zero. What is below the k-th best so far cannot stay; what equals it may."""
        row, item = np.nonzero((scores >= self.least) & (scores > 0))
        self.waiting.append((item, scores[row, item], ids[row]))
        self.size += len(row)
        if self.size > 4 * self.k * self.items + (1 << 16):
            self.reduce()

    def reduce(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.waiting:
            return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
        item, score, ids = (np.concatenate(x) for x in zip(*self.waiting))
        order = np.lexsort((ids, -score, item))
        item, score, ids = item[order], score[order], ids[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.k - 1
        self.least[item[last]] = score[last]
        kept = rank < self.k
        self.waiting = [(item[kept], score[kept], ids[kept])]
        self.size = int(kept.sum())
        return self.waiting[0]


def looked_up(block: Block, batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a batch of the index and the upper bounds of all items for them."""
    unpack = zstandard.ZstdDecompressor().decompress
    log2, unit, n = (batch.column(i).to_numpy() for i in (3, 4, 2))
    for size in np.unique(log2):
        own = np.flatnonzero(log2 == size)
        places = cells(block.terms, int(size))
        step = max(1, min(block.at_a_time(), (8 << 20) >> int(size)))
        for first in range(0, len(own), step):
            rows = own[first : first + step]
            table = np.stack([np.frombuffer(unpack(batch.column(5)[int(i)].as_py()), dtype=np.uint8) for i in rows])
            least = table[:, places[0]]
            for place in places[1:]:
                np.minimum(least, table[:, place], out=least)
            yield rows, block.sums(block.impacts(least * unit[rows, None].astype(np.int64), n[rows]))


def document_frequency(docs: DataFrame, terms: np.ndarray, text: str) -> np.ndarray:
    """In how many rows each term is; tasks add up what they have read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(terms) + 1, dtype=np.int64)
        for batch in batches:
            for _, _, offsets, raw in text_parts(batch.column(0)):
                rows, hashes = terms_of(offsets, raw)
                place = np.searchsorted(terms, hashes)
                place[terms[np.minimum(place, len(terms) - 1)] != hashes] = len(terms)
                pairs = np.unique(rows * (len(terms) + 1) + place)
                found += np.bincount(pairs % (len(terms) + 1), minlength=len(terms) + 1)
        at = np.flatnonzero(found[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at])], ["term", "df"])

    out = np.zeros(len(terms), dtype=np.int64)
    if len(terms):
        counted = docs.select(whole(text).alias("text")).mapInArrow(work, "term int, df long")
        for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # a row a term of the block
            out[row.term] = row.df
    return out


def best_of(rows: DataFrame, k: int, *order) -> DataFrame:
    """The first ``k`` rows of each item. Its rows are dealt out over salts first, so that no task sees them all."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "score"), F.lit(64)))
    for keys in (("item", "salt"), ("item",)):
        window = Window.partitionBy(*keys).orderBy(*order)
        salted = salted.withColumn("place", F.row_number().over(window)).where(F.col("place") <= k)
    return salted.drop("salt")


def search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each distinct item the ``k`` documents of highest score above zero.

    Equal scores stand by ascending id, a null id last; fewer documents with a score give fewer rows. Whole texts of
    any length; null and empty texts have no terms. Every row is a document: repeated rows are ranked
    side by side, also under a null id. An item is a row of items with a text or id of its own; one that
    shares its id has ranks of its own. Empty tables give an empty result, further columns are not looked at.
    """
    sketches = index(docs, id_col, text)
    documents, terms = sketches.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked = items.select(F.col(item_id).alias("item_id"), whole(item_text).alias("text")).distinct()
    asked = staged(asked, "items")
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    kind = dict(docs.dtypes)[id_col]
    schema = f"item_id {dict(items.dtypes)[item_id]}, rank int, `{id_col}` {kind}, score long"
    spark = docs.sparkSession
    out = None
    for number in range(blocks if documents else 0):
        # A block of bounded size: see BLOCK_CHARS.
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        block = Block([row.text for row in rows])
        block.weigh(document_frequency(docs, block.terms, text), documents, terms)
        found = search_block(docs, sketches, block, k, id_col, text)
        names = spark.createDataFrame([(n, row.item_id) for n, row in enumerate(rows)], f"item int, item_id {dict(items.dtypes)[item_id]}")
        found = found.join(F.broadcast(names), "item").select("item_id", F.col("place").alias("rank"), F.col("id").alias(id_col), "score")
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def search_block(docs: DataFrame, sketches: DataFrame, block: Block, k: int, id_col: str, text: str) -> DataFrame:
    """``item, id, score, place`` for the items of one block."""
    kind = dict(docs.dtypes)[id_col]
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(block)  # bounded by the block
    by_score = (F.desc("score"), F.asc_nulls_last("id"))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        best = Best(items.items, FIRST_SHARE * k)
        for batch in batches:
            keys = batch.column(1).to_numpy()
            for rows, sums in looked_up(items, batch):
                best.take(sums, keys[rows])
        item, score, keys = best.reduce()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(score), pa.array(keys)], ["item", "score", "id"]
        )

    def reached(limits: dict) -> callable:
        floor = np.ones(block.items, dtype=np.int64)
        for item, (score, _) in limits.items():
            floor[item] = score
        ids = {item: id_ for item, (_, id_) in limits.items()}

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                names = batch.column(0).to_pylist()
                for rows, sums in looked_up(items, batch):
                    row, item = np.nonzero(sums >= floor)
                    # At the threshold itself only smaller ids can still come in.
                    tied = np.flatnonzero((sums[row, item] == floor[item]) & np.isin(item, list(ids)))
                    away = [t for t in tied.tolist() if not comes_before(names[rows[row[t]]], ids[int(item[t])])]
                    row, item = np.delete(row, away), np.delete(item, away)
                    held, first = np.unique(row, return_index=True)
                    parts = np.split(item, first[1:]) if len(held) else []
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(1).take(pa.array(rows[held])), pa.array(parts, pa.list_(pa.int32()))], ["key", "items"]
                    )

        return work

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        step = items.at_a_time()
        best = Best(items.items, k)
        names: dict = {}
        number = 0
        for batch in batches:
            ids, wanted = batch.column(0).to_pylist(), batch.column(2)
            for start, stop, offsets, raw in text_parts(batch.column(1)):
                lengths, rows, hashes, counts = term_counts(offsets, raw)
                place = np.minimum(np.searchsorted(items.terms, hashes), len(items.terms) - 1)
                known = items.terms[place] == hashes
                rows, place, counts = rows[known], place[known], counts[known]
                for first in range(0, stop - start, step):
                    last = min(first + step, stop - start)
                    i, j = np.searchsorted(rows, (first, last))
                    table = np.zeros((last - first, len(items.terms)), dtype=np.int64)
                    table[rows[i:j] - first, place[i:j]] = counts[i:j]
                    scores = items.sums(items.impacts(table, lengths[first:last]))
                    asked = np.zeros(scores.shape, dtype=bool)
                    own = wanted.slice(start + first, last - first)
                    asked[np.repeat(np.arange(last - first), own.value_lengths().to_numpy()), own.flatten().to_numpy()] = True
                    # Ids in their order stand for themselves; a null id comes last.
                    some = ids[start + first : start + last]
                    best.take(np.where(asked, scores, 0), np.array([LAST if x is None else int(x) for x in some], dtype=np.int64))
        item, score, keys = best.reduce()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(keys, mask=keys == LAST), pa.array(score)], ["item", "id", "score"]
        )

    def rescored(candidates: DataFrame) -> DataFrame:
        candidates = candidates.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        texts = docs.select(F.col(id_col).alias("id"), key_of(id_col, text), whole(text).alias("text"))
        found = texts.join(candidates, "key").select("id", "text", "items").mapInArrow(exact, "item int, id long, score long")
        return best_of(found, k, *by_score)

    # The best few by their bounds, rescored, give each item a threshold.
    few = best_of(sketches.mapInArrow(bounds, "item int, score long, id long"), FIRST_SHARE * k, F.desc("score"))
    first = rescored(few.select(F.col("id").alias("key"), F.array("item").alias("items")))
    # At most a row an item.
    limits = {row.item: (row.score, row.id) for row in first.where(F.col("place") == k).collect()}
    candidates = staged(sketches.mapInArrow(reached(limits), "key long, items array<int>"), "candidates")
    return rescored(candidates).select("item", F.col("id").cast(kind).alias("id"), "score", "place")


#: Stands for a null id where ids are compared.
LAST = np.iinfo(np.int64).max


def comes_before(one, other) -> bool:
    """Whether an id may stand at or before another: ascending, a null last."""
    return other is None or (one is not None and one <= other)
