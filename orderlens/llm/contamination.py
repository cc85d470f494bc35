"""Benchmark passages in documents, found in a latent semantic space.

Documents and benchmark items are cut into passages of words (two neighbouring blocks each, so passages
overlap by half). The TF-IDF matrix has a row for each passage of the corpus and of the benchmark, and a
column for each word of the benchmark that is not both in many of its items and common in the corpus. It gets a randomised singular
value decomposition in one pass: tasks add up ``T' (T R)`` for a random matrix R, and the sums give the
leading right singular vectors (the Nystrom form for positive matrices). The benchmark weighs as much as
the corpus, so that the space holds items that the corpus has once or never. A second pass projects every
passage, takes those as candidates that are within a cosine of an item and have enough of its weight, and
compares the words around them with the whole item: by the longest common subsequence, and, for
paraphrases, by whether the words that make up the item's answer, its rarest ones, are there.

Items of the same words are one. Items left with few columns are searched apart, in a space with a column for
each of their words. Whatever the space shows, items that stand word by word in a document are found;
items of fewer than ``least_words`` words are found in no other way.

Only words of the benchmark have columns, so all matrices but those of a task are as small as it is,
whatever the corpus; items are searched some thousand at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderlens.llm.common import SMALL_ROWS, bounded_rows, mix64, text_parts, whole, words_of


@dataclass(frozen=True)
class LeakParams:
    """``block_words``: half a passage. Words in more than ``stop_items`` items, ``stop_share`` of them and
    ``stop_share`` of the corpus's blocks have no column; items of which less than
    ``column_share`` have one are searched with columns for all words. Candidates have ``weight`` of an item's length along it. A document leaks an item if the common subsequence has ``copy_share``
    of its words, or ``paraphrase_share`` and ``answer_share`` of its ``answer_words`` rarest words are around."""

    block_words: int = 20
    rank: int = 256
    oversample: int = 16
    cosine: float = 0.5
    weight: float = 0.3
    stop_share: float = 0.02
    stop_items: int = 3
    column_share: float = 0.35
    copy_share: float = 0.75
    paraphrase_share: float = 0.5
    answer_words: int = 8
    answer_share: float = 0.7
    least_words: int = 8
    seed_words: int = 8
    items_at_once: int = 250
    seed: int = 7


def places(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The place of each hash in an ascending vocabulary, -1 if it has none. The leading bits of a hash tell where to
    begin; so few words share them that it is found in a step or two."""
    if not len(vocabulary):
        return np.full(len(hashes), -1, dtype=np.int32)
    last = np.int32(len(vocabulary) - 1)
    bits = (4 * len(vocabulary)).bit_length()
    shift = np.uint64(64 - bits)
    first = np.searchsorted(vocabulary >> shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)
    at = np.minimum(first[(hashes >> shift).view(np.int64)], last)
    for _ in range(int(np.diff(first).max()) - 1):
        at += vocabulary[at] < hashes
        np.minimum(at, last, out=at)
    return np.where(vocabulary[at] == hashes, at, np.int32(-1))


@dataclass
class Passages:
    """Words of joined texts that are in the vocabulary, by block."""

    owner: np.ndarray  # text of each block
    first: np.ndarray  # block that each text begins with
    block: np.ndarray  # block of each kept word
    word: np.ndarray  # column of each kept word
    all_words: np.ndarray  # place in the vocabulary of every word, -1 if it has none
    text_start: np.ndarray  # where each text begins among all words

    @classmethod
    def of(
        cls, offsets: np.ndarray, raw: np.ndarray, vocabulary: np.ndarray, columns: np.ndarray, block_words: int
    ) -> Passages:
        text, hashes, _ = words_of(offsets, raw)
        count = len(offsets) - 1
        column = places(vocabulary, hashes)
        words = np.bincount(text, minlength=count)
        text_start = np.concatenate([[0], np.cumsum(words)])
        blocks = -(-words // block_words)
        first = np.concatenate([[0], np.cumsum(blocks)])
        block = first[text] + (np.arange(len(text)) - text_start[text]) // block_words
        own = np.append(columns, -1)[column]
        kept = own >= 0
        return cls(np.repeat(np.arange(count), blocks), first, block[kept], own[kept], column, text_start)

    def joined(self) -> np.ndarray:
        """Whether the block behind each block is of the same text."""
        together = np.zeros(len(self.owner), dtype=bool)
        together[:-1] = self.owner[1:] == self.owner[:-1]
        return together

    def over_passages(self, by_block: np.ndarray) -> np.ndarray:
        """A block's value and that of the one behind it."""
        passages = by_block.copy()
        together = self.joined()
        passages[together] += by_block[1:][together[:-1]]
        return passages

    def sums(self, rows: np.ndarray, wanted: np.ndarray | None = None) -> np.ndarray:
        """Sum of the words' rows over each passage, or over the ``wanted`` ones alone."""
        blocks = np.ones(len(self.owner), dtype=bool)
        if wanted is not None:
            blocks = wanted.copy()
            blocks[1:] |= wanted[:-1]
        place = np.cumsum(blocks) - 1
        out = np.zeros((int(blocks.sum()) + 1, rows.shape[1]), dtype=np.float32)
        kept = blocks[self.block]
        at, word = place[self.block[kept]], self.word[kept]
        if len(at):
            # The first words of all blocks, then the second ones, ...: no block twice in one step.
            fresh = np.concatenate([[True], at[1:] != at[:-1]])
            turn = np.arange(len(at)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            for step in range(int(turn.max()) + 1):
                now = np.flatnonzero(turn == step)
                out[at[now]] += rows[word[now]]
        wanted = np.arange(len(self.owner)) if wanted is None else np.flatnonzero(wanted)
        passages = out[place[wanted]]
        together = self.joined()[wanted]
        passages[together] += out[place[wanted[together] + 1]]
        return passages


@dataclass
class Space:
    """``idf`` of each column and ``axes`` (columns, rank): what a word adds to its passage's projection."""

    idf: np.ndarray
    axes: np.ndarray


@dataclass
class Items:
    """Benchmark items as places in the ``vocabulary`` of hashes; ``columns`` of these, -1 for the common ones.
    ``ids`` are those of all rows with an item's words."""

    ids: list[list[int]]
    words: list[np.ndarray]
    vocabulary: np.ndarray
    columns: np.ndarray

    def pieces(self, number: int, length: int) -> list[np.ndarray]:
        """Columns of the words of an item, cut into overlapping passages."""
        words = self.words[number]
        last = max(0, len(words) - length)
        parts = [words[start : start + length] for start in sorted({0, last, *range(0, last, length // 4)})]
        return [self.columns[part][self.columns[part] >= 0] for part in parts]


Sequence = tuple[list[int], np.ndarray]


def sequences_of(rows: list[tuple[int, str]]) -> list[Sequence]:
    """Ids and word hashes of each distinct sequence of words."""
    found: dict[bytes, Sequence] = {}
    for item_id, text in rows:
        raw = np.frombuffer((text or "").encode("utf-8"), dtype=np.uint8)
        _, words, _ = words_of(np.array([0, len(raw)]), raw)
        if len(words) and item_id is not None:
            found.setdefault(words.tobytes(), ([], words))[0].append(item_id)
    return list(found.values())


def items_of(rows: list[tuple[int, str]], params: LeakParams) -> Items:
    """Items with at least ``least_words`` words, all of which have columns."""
    return _items([one for one in sequences_of(rows) if len(one[1]) >= params.least_words], np.zeros(0, dtype=np.uint64))


def _items(sequences: list[Sequence], common: np.ndarray) -> Items:
    hashes = [own for _, own in sequences]
    vocabulary = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, dtype=np.uint64)
    rare = ~np.isin(vocabulary, common)
    columns = np.where(rare, np.cumsum(rare) - 1, -1)
    return Items([ids for ids, _ in sequences], [np.searchsorted(vocabulary, own) for own in hashes], vocabulary, columns)


def common_words(docs: DataFrame, sequences: list[Sequence], params: LeakParams) -> np.ndarray:
    """Hashes of the words that many items hold and many blocks of the corpus (columns id and ``text``)."""
    if not sequences:
        return np.zeros(0, dtype=np.uint64)
    words, holders = np.unique(np.concatenate([np.unique(own) for _, own in sequences]), return_counts=True)
    shared = words[holders > max(params.stop_items, params.stop_share * len(sequences))]
    size = len(shared)
    if not size:
        return shared
    sent = docs.sparkSession.sparkContext.broadcast(shared)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1)
        for batch in batches:
            for _, _, offsets, raw in text_parts(batch.column(0), 1 << 21):
                part = Passages.of(offsets, raw, sent.value, np.arange(size), params.block_words)
                total[:size] += np.bincount(np.unique(part.block * size + part.word) % size, minlength=size)
                total[size] += len(part.owner)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["value"])

    seen = _total(docs.select("text").mapInArrow(count, "value binary"), size + 1)
    return shared[seen[:size] > params.stop_share * seen[size]]


def _total(rows: DataFrame, size: int) -> np.ndarray:
    """Sum of one vector of doubles (``value binary``) per task: sixteen or so to a task, level by level, the
    last few on the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                one = np.frombuffer(value.as_py(), dtype=np.float64)
                total = one.copy() if total is None else np.add(total, one, out=total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["value"])

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16
    while tasks > 8:
        rows = rows.repartition(tasks).mapInArrow(add, "value binary")
        tasks //= 16
    out = np.zeros(size)
    for row in rows.repartition(8).mapInArrow(add, "value binary").toLocalIterator():
        out += np.frombuffer(row["value"], dtype=np.float64)
    return out


def fit(docs: DataFrame, items: Items, params: LeakParams) -> Space:
    """Decomposition of the TF-IDF matrix of all passages of ``docs`` (column ``text``)."""
    size = int(items.columns.max(initial=-1)) + 1
    width = params.rank + params.oversample
    random = np.random.default_rng(params.seed).standard_normal((size, width)).astype(np.float32)
    sent = docs.sparkSession.sparkContext.broadcast((items.vocabulary, items.columns, random))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, columns, random = sent.value
        total = np.zeros((size, width))
        seen = np.zeros(size)
        passages_in_all = 0
        for batch in batches:
            for _, _, offsets, raw in text_parts(batch.column(0), 1 << 21):
                part = Passages.of(offsets, raw, vocabulary, columns, params.block_words)
                passages_in_all += len(part.owner)
                if not len(part.word):
                    continue
                pairs = np.unique(part.block * size + part.word)
                seen += np.bincount(pairs % size, minlength=size)
                passages = part.sums(random)
                # A word is in the passage that its block begins and in the one that it ends.
                both = passages.copy()
                together = part.joined()
                both[1:][together[:-1]] += passages[:-1][together[:-1]]
                order = np.argsort(part.word, kind="stable")
                for start in range(0, len(order), 8192):
                    some = order[start : start + 8192]
                    word = part.word[some]
                    fresh = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                    total[word[fresh]] += np.add.reduceat(both[part.block[some]], fresh, axis=0, dtype=np.float64)
        value = np.concatenate([total.ravel(), seen, [passages_in_all]])
        yield pa.RecordBatch.from_arrays([pa.array([value.tobytes()], pa.binary())], names=["value"])

    summed = _total(docs.select("text").mapInArrow(sketch, "value binary"), size * width + size + 1)
    found, seen, count = summed[: size * width].reshape(size, width), summed[size * width : -1], summed[-1]
    idf = np.log(1 + (1 + count) / (1 + seen))
    own = np.zeros((size, width))
    for number in range(len(items.ids)):
        for piece in items.pieces(number, 2 * params.block_words):
            np.add.at(own, piece, random[piece].sum(axis=0))
    balance = np.linalg.norm(found) / max(np.linalg.norm(own), 1e-12)
    found = found + max(balance, 1.0) * own
    # T' T R is known for R; with weights D the matrix is D T' T D and the test matrix R / D.
    test = random / idf[:, None]
    image = idf[:, None] * found
    shift = 1e-9 * max(np.linalg.norm(image), 1e-12)
    image = image + shift * test
    core = test.T @ image
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > values.max(initial=0) * 1e-12
    half = image @ (vectors[:, good] / np.sqrt(values[good]))
    axes = np.linalg.svd(half, full_matrices=False)[0][:, : params.rank]
    return Space(idf, (idf[:, None] * axes).astype(np.float32))


def common_length(item: dict[int, int], size: int, region: list[int]) -> int:
    """Length of the longest common subsequence of an item (bit masks of each word's places) and a region."""
    row = full = (1 << size) - 1
    for word in region:
        mask = item.get(word)
        if mask:
            met = row & mask
            row = (row + met) | (row - met)
    return size - (row & full).bit_count()


class Searcher:
    """Items made ready for comparison: pieces in the latent space, bit masks, answers."""

    def __init__(self, space: Space, items: Items, params: LeakParams):
        self.space, self.items, self.params = space, items, params
        pieces, owner = [], []
        for number in range(len(items.ids)):
            for piece in items.pieces(number, 2 * params.block_words):
                pieces.append(space.axes[piece].sum(axis=0))
                owner.append(number)
        self.owner = np.array(owner, dtype=np.int64)
        self.pieces = np.array(pieces, dtype=np.float32).reshape(len(owner), space.axes.shape[1])
        self.lengths = np.maximum(np.linalg.norm(self.pieces, axis=1), 1e-6)
        self.pieces /= self.lengths[:, None]
        self.reach = np.linalg.norm(space.axes, axis=1).astype(np.float64) * (1 + 1e-5)
        weights = np.append(space.idf, 0.0)[items.columns]
        self.masks, self.answers = [], []
        for words in items.words:
            masks: dict[int, int] = {}
            for place, word in enumerate(words.tolist()):
                masks[word] = masks.get(word, 0) | 1 << place
            self.masks.append(masks)
            rare = sorted(masks, key=lambda w: (-weights[w], w))
            self.answers.append(frozenset(rare[: params.answer_words]))
        # Items by their number of leading words to look up: hashes of these in order, and the items.
        self.begins = np.zeros(len(items.vocabulary) + 1, dtype=bool)
        self.begins[[words[0] for words in items.words]] = True
        self.seeds: list[tuple[int, np.ndarray, np.ndarray]] = []
        leading = np.array([min(len(words), params.seed_words) for words in items.words], dtype=np.int64)
        for length in np.unique(leading).tolist():
            own = np.flatnonzero(leading == length)
            seeds = self.sequence_hashes(np.concatenate([items.words[i][:length] for i in own]), np.arange(len(own)) * length, length)
            order = np.argsort(seeds, kind="stable")
            self.seeds.append((length, seeds[order], own[order]))

    @staticmethod
    def sequence_hashes(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        out = np.zeros(len(starts), dtype=np.uint64)
        for nth in range(length):
            out = mix64(out + words[starts + nth].astype(np.uint64) + np.uint64(1))
        return out

    def verbatim(self, part: Passages) -> set[tuple[int, int]]:
        """``(text, item)`` where all words of an item stand in a text one after the other."""
        out = set()
        places = np.flatnonzero(self.begins[part.all_words])
        if not len(places):
            return out
        text = np.searchsorted(part.text_start, places, side="right") - 1
        left = part.text_start[text + 1] - places
        for length, seeds, owners in self.seeds:
            fits = np.flatnonzero(left >= length)
            hashes = self.sequence_hashes(part.all_words, places[fits], length)
            low, high = (np.searchsorted(seeds, hashes, side=side) for side in ("left", "right"))
            for at in np.flatnonzero(low < high).tolist():
                place, whose = int(places[fits[at]]), int(text[fits[at]])
                for item in owners[low[at] : high[at]].tolist():
                    words = self.items.words[item]
                    if (whose, item) not in out and len(words) <= left[fits[at]]:
                        if np.array_equal(part.all_words[place : place + len(words)], words):
                            out.add((whose, item))
        return out

    def candidates(self, part: Passages) -> Iterator[tuple[int, int, float]]:
        """``(passage, item, cosine)``. Passages whose words can't add up to enough are not projected."""
        least = self.params.weight * self.lengths.min(initial=np.inf)
        reach = part.over_passages(np.bincount(part.block, self.reach[part.word], len(part.owner)))
        wanted = reach >= least
        numbers = np.flatnonzero(wanted)
        passages = part.sums(self.space.axes, wanted)
        size = np.linalg.norm(passages, axis=1)
        rows = np.flatnonzero(size >= least)
        for start in range(0, len(rows), 4096):
            some = rows[start : start + 4096]
            along = passages[some] @ self.pieces.T
            near = (along >= self.params.weight * self.lengths) & (along >= self.params.cosine * size[some, None])
            r, c = np.nonzero(near)
            cosines = along[r, c] / size[some[r]]
            yield from zip(numbers[some[r]].tolist(), self.owner[c].tolist(), cosines.tolist(), strict=True)

    def compare(self, item: int, region: np.ndarray) -> tuple[int, int]:
        """Common words in order, and answer words, of an item and the words around a candidate passage."""
        near = region[region >= 0].tolist()
        return (
            common_length(self.masks[item], len(self.items.words[item]), near),
            len(self.answers[item].intersection(near)),
        )

    def leaks(self, offsets: np.ndarray, raw: np.ndarray) -> list[tuple[int, int, float, int, int]]:
        """``(text, item, cosine, common, answer)`` of joined texts, the best passage of each pair."""
        p = self.params
        part = Passages.of(offsets, raw, self.items.vocabulary, self.items.columns, p.block_words)
        best: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for passage, item, cosine in self.candidates(part) if len(part.word) else ():
            best.setdefault((int(part.owner[passage]), item), []).append((cosine, passage))
        out = []
        for (text, item), near in best.items():
            size = len(self.items.words[item])
            answers = len(self.answers[item])
            found = None
            tried = set()
            for cosine, passage in sorted(near, reverse=True):
                if passage in tried:
                    continue
                tried.add(passage)
                begin = part.text_start[text] + (passage - part.first[text]) * p.block_words
                region = part.all_words[
                    max(part.text_start[text], begin - size) : min(part.text_start[text + 1], begin + 2 * p.block_words + size)
                ]
                common, answer = self.compare(item, region)
                if found is None or common > found[3]:
                    found = (text, item, cosine, common, answer)
                if common >= p.copy_share * size:
                    break
            copied = found[3] >= p.copy_share * size
            if copied or (found[3] >= p.paraphrase_share * size and found[4] >= p.answer_share * answers):
                out.append(found)
        # A verbatim item that the space did not show: its words are the item's.
        for text, item in sorted(self.verbatim(part) - {found[:2] for found in out}):
            out.append((text, item, 1.0, len(self.items.words[item]), len(self.answers[item])))
        return out


LEAKS = "item_id long, cosine double, common_words int, item_words int, answer_words int"


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    params: LeakParams = LeakParams(),
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``id_col`` and ``LEAKS``: one row for each document row and item it holds, verbatim or paraphrased.

    Null and empty texts hold none; null and empty items are held by none. Items of fewer than ``least_words``
    words are held only word by word. Repeated rows of
    documents give repeated rows, repeated items of one id one of them each. ``cosine`` is that of the space an
    item is searched in (some thousand items or fewer share one), 1 for verbatim items it did not show. Further columns of either
    table are not looked at.
    """
    rows = bounded_rows(
        benchmark.select(F.col("item_id").cast("long"), F.col("text")).distinct(), SMALL_ROWS, "the benchmark"
    )
    rows = sorted((row["item_id"], row["text"]) for row in rows if row["item_id"] is not None and row["text"])
    plain = docs.select(F.col(id_col), whole(text).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    everything = sequences_of(rows)
    sequences = [one for one in everything if len(one[1]) >= params.least_words]
    short = [one for one in everything if len(one[1]) < params.least_words]
    common = common_words(plain, sequences, params)
    scarce = [np.isin(own, common, invert=True).mean() < params.column_share for _, own in sequences]
    usual = [one for one, few in zip(sequences, scarce, strict=True) if not few]
    others = [one for one, few in zip(sequences, scarce, strict=True) if few]
    found = plain.limit(0).selectExpr(f"`{id_col}`", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in LEAKS.split(", ")])
    for group, without in ((usual, common), (others, common[:0])):
        for start in range(0, len(group), params.items_at_once):
            items = _items(group[start : start + params.items_at_once], without)
            found = found.unionByName(_found(plain, fit(plain, items, params), items, params, id_col, kind))
    if short:  # no columns, so no space: whole sequences only
        items = _items(short, np.concatenate([own for _, own in short]))
        space = Space(np.zeros(0), np.zeros((0, 1), dtype=np.float32))
        found = found.unionByName(_found(plain, space, items, params, id_col, kind))
    return found


def _found(docs: DataFrame, space: Space, items: Items, params: LeakParams, id_col: str, kind: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((space, items))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*sent.value, params)
        for batch in batches:
            for first, last, offsets, raw in text_parts(batch.column(1), 1 << 21):
                hits = searcher.leaks(offsets, raw)
                hits = [(hit, item_id) for hit in hits for item_id in items.ids[hit[1]]]
                if hits:
                    hits, item_ids = zip(*hits, strict=True)
                    text, item, cosine, common, answer = zip(*hits, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).slice(first, last - first).take(pa.array(text, pa.int64())),
                            pa.array(item_ids, pa.int64()),
                            pa.array(cosine, pa.float64()),
                            pa.array(common, pa.int32()),
                            pa.array([len(items.words[i]) for i in item], pa.int32()),
                            pa.array(answer, pa.int32()),
                        ],
                        names=[id_col, "item_id", "cosine", "common_words", "item_words", "answer_words"],
                    )

    return docs.mapInArrow(search, f"`{id_col}` {kind}, {LEAKS}")


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams(), id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with their columns as they were. Each row is judged by
    its own text: of rows that share an id, or have none, only those that hold an item go."""
    key = F.xxhash64(F.col(id_col), whole(text))
    held = leaks(docs.withColumn("__key", key).select("__key", text), benchmark, params, "__key", text)
    held = held.select(F.col("__key").alias("__held")).distinct()
    return docs.join(held, key == F.col("__held"), "left_anti")
