"""N-best segmentation of texts into the pieces of a SentencePiece vocabulary, and back.

A text is a lattice: its characters are the nodes, the vocabulary pieces that match are the arcs, an
arc's weight is the piece's score. Forward Viterbi gives every node the best score from the start;
backward A*, from the end, uses these scores as its heuristic. They are exact, so complete
segmentations leave the agenda best first.

No piece spans two neighbouring characters that no piece holds side by side, so the lattice falls
apart there into chunks. Each distinct chunk is searched once and kept; the n best of the text are
the best combinations of the n best of its chunks.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.llm.common import no_cycle_search, whole

#: SentencePiece writes a space as this character. One that stands in a text goes to byte pieces.
SPACE = "▁"
#: As in SentencePiece: a character without a piece costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Chunks in either generation of what a worker keeps, some 300 bytes each; it changes nothing but time.
CACHE_CHUNKS = 300_000
#: Chunks whose n best are kept: few are searched, the same ones over and over.
CACHE_SEARCHED = 20_000
#: Longer chunks are searched each time they occur.
CACHE_CHARS = 64
#: Texts go through the encoder so many characters at a time (a longer text alone).
BATCH_CHARS = 1 << 18


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, model: bytes):
        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = reader.get_piece_size()
        self.pieces = [reader.id_to_piece(i) for i in range(size)]
        ordinary = [
            i for i in range(size) if not (reader.is_byte(i) or reader.is_control(i) or reader.is_unknown(i) or reader.is_unused(i))
        ]
        self.ids = {self.pieces[i]: i for i in ordinary}
        self.scores = [reader.get_score(i) for i in range(size)]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if reader.is_byte(i)}
        if len(self.bytes) < 256:
            raise ValueError("the vocabulary needs byte pieces: without them a text cannot come back")
        self.unknown = min(self.scores[i] for i in ordinary) - UNKNOWN_PENALTY
        # Pieces character by character: what follows a character, and id and score of the piece that ends there, or None.
        self.tree: dict[str, list] = {}
        self.longest = max(map(len, self.ids))
        self.single = frozenset(piece for piece in self.ids if len(piece) == 1)
        for piece, i in self.ids.items():
            node = self.tree
            for character in piece:
                last = node.setdefault(character, [{}, None, 0.0])
                node = last[0]
            last[1:] = i, self.scores[i]
        self.pairs = {piece[i : i + 2] for piece in self.ids for i in range(len(piece) - 1)}
        self.raw = [piece.replace(SPACE, " ").encode("utf-8") for piece in self.pieces]
        for value, i in self.bytes.items():
            self.raw[i] = bytes((value,))


def lattice(vocabulary: Vocabulary, chunk: str) -> tuple[list[list[tuple[int, float, tuple[int, ...]]]], list[float]]:
    """The arcs that end at each node (start, score, ids from the end), and the best score of each node from the start."""
    tree = vocabulary.tree
    length = len(chunk)
    nodes = range(length + 1)
    ending: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in nodes]
    best = [0.0] + [-np.inf] * length
    for start in range(length):
        here, node, end = best[start], tree, start
        for character in chunk[start : start + vocabulary.longest]:
            if character not in node:
                break
            node, number, score = node[character]
            end += 1
            if number is not None:
                ending[end].append((start, score, (number,)))
                score += here
                if score > best[end]:
                    best[end] = score
        if chunk[start] not in vocabulary.ids:
            # Byte pieces, reversed like everything the backward search strings together.
            raw = tuple(vocabulary.bytes[b] for b in reversed(_literal(chunk[start]).encode("utf-8")))
            ending[start + 1].append((start, vocabulary.unknown, raw))
            if here + vocabulary.unknown > best[start + 1]:
                best[start + 1] = here + vocabulary.unknown
    return ending, best


def best_and_gap(vocabulary: Vocabulary, chunk: str) -> tuple[tuple[int, ...], float, float]:
    """Ids and score of the best segmentation, and how much worse the next one is (infinity: there is none).

    Every node keeps the scores of its two best ways, which are made of the two best ways to the nodes before: one pass
    forward, without a search.
    """
    tree, longest, alone, size = vocabulary.tree, vocabulary.longest, vocabulary.single, len(chunk)
    strange = not alone.issuperset(chunk)
    best, next_best = [0.0] + [-np.inf] * size, [-np.inf] * (size + 1)
    came, last = [0] * (size + 1), [0] * (size + 1)
    for start in range(size):
        here, below, node, end = best[start], next_best[start], tree, start
        for character in chunk[start : start + longest]:
            if character not in node:
                break
            node, number, weight = node[character]
            end += 1
            if number is not None:
                score = here + weight
                if score > best[end]:
                    other = below + weight
                    next_best[end] = best[end] if best[end] > other else other
                    best[end], came[end], last[end] = score, start, number
                elif score == best[end]:
                    next_best[end] = score
                    # Of equal ways to a node, that by the smallest id: ties go by the ids as read from the end.
                    if number < last[end]:
                        came[end], last[end] = start, number
                elif score > next_best[end]:
                    next_best[end] = score
        if strange and chunk[start] not in alone:
            end, score, other = start + 1, here + vocabulary.unknown, below + vocabulary.unknown
            number = vocabulary.bytes[_literal(chunk[start]).encode("utf-8")[-1]]
            if score > best[end] or (score == best[end] and number < last[end]):
                next_best[end] = max(best[end], other)
                best[end], came[end], last[end] = score, start, number
            else:
                next_best[end] = max(next_best[end], score)
    at, ids = size, []
    while at:
        start = came[at]
        if strange and start == at - 1 and chunk[start] not in alone:
            ids += [vocabulary.bytes[b] for b in reversed(_literal(chunk[start]).encode("utf-8"))]
        else:
            ids.append(last[at])
        at = start
    return tuple(ids[::-1]), best[size], best[size] - next_best[size]


def n_best(vocabulary: Vocabulary, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best segmentations of a chunk, or all if fewer: score, ids.

    Order: higher score, then the smaller ids as read from the end.
    """
    ending, best = lattice(vocabulary, chunk)
    # The agenda stands in the order of the ids from the end: minus (score behind + best score before), score behind, node, ids
    # strung together. None is the beginning of another, so what an entry branches into takes its place, and
    # ids need not be compared. Each can be completed at its very score: more than are still wanted are not needed.
    agenda: list[tuple] = [(-best[-1], 0.0, len(chunk), None)]
    done: list[tuple[float, tuple[int, ...]]] = []
    while agenda and len(done) < n:
        at = min(range(len(agenda)), key=lambda i: agenda[i][0])
        cost, score, node, behind = agenda.pop(at)
        if node == 0:
            ids: list[int] = []
            while behind:
                behind, piece = behind
                ids += piece[::-1]
            done.append((-cost, tuple(ids)))
            continue
        branches = sorted((piece, start, weight + score) for start, weight, piece in ending[node])
        agenda[at:at] = [(-(weight + best[start]), weight, start, (behind, piece)) for piece, start, weight in branches]
        if len(agenda) > n - len(done):
            kept = sorted(range(len(agenda)), key=lambda i: agenda[i][0])[: n - len(done)]
            agenda = [agenda[i] for i in sorted(kept)]
    return done


# A literal SPACE character stands in a chunk as this one, so that no piece matches it: half of a surrogate pair, which
# no text can hold.
_HIDDEN = "\ud800"


def _literal(character: str) -> str:
    return SPACE if character == _HIDDEN else character


class Encoder:
    """Segments texts; keeps the best segmentation of the chunks it met, up to a bound."""

    def __init__(self, vocabulary: Vocabulary, n: int):
        if n < 1:
            raise ValueError("at least one segmentation")
        self.vocabulary, self.n = vocabulary, n
        self.cut = _chunk_pattern(vocabulary)
        # Two generations: what is not met again while the younger one fills up is forgotten.
        self.young: dict[str, tuple[bytes, float, float]] = {}
        self.old: dict[str, tuple[bytes, float, float]] = {}
        self.searched: dict[str, list[tuple[float, tuple[int, ...]]]] = {}

    def _entry(self, chunk: str) -> tuple[bytes, float, float]:
        """Ids of the best segmentation, its score, and how much worse the next is (infinity: there is none)."""
        found = self.young.get(chunk) or self.old.get(chunk)
        if found is None:
            ids, score, worse = best_and_gap(self.vocabulary, chunk)
            found = (array("i", ids).tobytes(), score, worse)
        if len(chunk) <= CACHE_CHARS:
            if len(self.young) >= CACHE_CHUNKS:
                self.old, self.young = self.young, {}
            self.young[chunk] = found
        return found

    def _near(self, chunk: str) -> list[tuple[float, tuple[int, ...]]]:
        found = self.searched.get(chunk)
        if found is None:
            found = n_best(self.vocabulary, chunk, self.n)
            if len(chunk) <= CACHE_CHARS:
                if len(self.searched) >= CACHE_SEARCHED:
                    self.searched.clear()
                self.searched[chunk] = found
        return found

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(SPACE, _HIDDEN)
        return self.cut.findall(SPACE + text.replace(" ", SPACE))

    def encode(self, text: str) -> tuple[bytes, list[tuple[float, list[tuple[int, int, tuple[int, ...]]]]]]:
        """Ids of the best segmentation (32 bits each), and all ``n``: score, and edits ``(at, dropped, ids)`` of the best.

        Order: higher score, then fewer changed chunks, then earlier changes.
        """
        chunks = self.chunks(text)
        if not chunks:
            return b"", [(0.0, [])]
        entries = list(map(self.young.get, chunks))
        if None in entries:
            entries = [self._entry(chunk) if entry is None else entry for chunk, entry in zip(chunks, entries, strict=True)]
        ids, scores, gaps = zip(*entries, strict=True)
        total = math.fsum(scores)
        ranked: list = [(total, [])]
        if self.n > 1:
            worse = np.fromiter(gaps, float, len(gaps))
            few = min(self.n - 1, len(worse))
            # The n - 1 best single changes are in chunks whose first change is at most this bad.
            bound = np.partition(worse, few - 1)[few - 1]
            singles = []
            near: dict[str, list] = {}
            order = np.flatnonzero(worse <= bound)
            order = order[np.argsort(worse[order], kind="stable")][: few if np.isfinite(bound) else None]
            for place in order[np.isfinite(worse[order])].tolist():
                chunk = chunks[place]
                if chunk not in near:
                    near[chunk] = self._near(chunk)
                top = near[chunk][0][0]
                singles += [(top - score, place, other) for other, (score, _) in enumerate(near[chunk][1:], 1)]
            singles = sorted(singles)[: self.n - 1]
            for cost, changes in _changes(singles, self.n)[1:]:
                edits = [
                    (len(b"".join(ids[:place])) // 4, len(ids[place]) // 4, near[chunks[place]][other][1]) for place, other in changes
                ]
                ranked.append((total - cost, edits))
        return b"".join(ids), ranked

    @no_cycle_search()
    def encode_all(self, texts: list[str]) -> list[tuple[bytes, list]]:
        """``encode`` of each text."""
        return [self.encode(text) for text in texts]


def _chunk_pattern(vocabulary: Vocabulary) -> re.Pattern:
    """Cuts a text, spaces as SPACE, into chunks that no piece reaches across.

    Letters are one class of characters, with all that pieces hold next to a member of it; the others
    are the second class. Spaces stay with what follows. If pieces hold a space behind another
    character, or the classes can't be parted, a chunk is more than it needs to be, never less.
    """
    neighbours = [pair for pair in vocabulary.pairs if SPACE not in pair]
    if any(pair[1] == SPACE and pair[0] != SPACE for pair in vocabulary.pairs):
        return re.compile("(?s).+")
    sticky = {c for pair in neighbours for c in pair if c.isalpha()}
    grown = True
    while grown:
        more = {c for pair in neighbours if (pair[0] in sticky) != (pair[1] in sticky) for c in pair} - sticky
        sticky |= more
        grown = bool(more)
    extra = "".join(re.escape(c) for c in sorted(c for c in sticky if not c.isalpha()))
    # A letter without neighbours may stand with the others: no piece minds.
    member, other = "[^\\W\\d_]+", f"[^\\w{SPACE}]+|[\\d_]+"
    if extra:
        member, other = f"(?:{member}|[{extra}]+)+", f"(?![{extra}])(?:[^\\w{SPACE}]|[\\d_])"
    return re.compile(f"{SPACE}*{member}|{SPACE}*(?:{other})+|{SPACE}+")


def _changes(singles: list[tuple[float, int, int]], n: int) -> list[tuple[float, tuple]]:
    """The ``n`` cheapest sets of changes, of at most one for each chunk, the empty set first."""
    # A set among the n best stays among them without its dearest change: sets grow by one change at a time.
    ranked: list[tuple[float, int, tuple]] = [(0.0, 0, ())]
    for cost, place, other in singles:
        more = [
            (total + cost, count + 1, tuple(sorted((*places, (place, other)))))
            for total, count, places in ranked
            if all(place != taken for taken, _ in places)
        ]
        ranked = sorted(ranked + more)[:n]
    return [(cost, places) for cost, _, places in ranked]


def decode(vocabulary: Vocabulary, ids) -> str:
    """The text of a sequence of ids, byte pieces joined to characters, without the space put in front."""
    raw = vocabulary.raw
    text = b"".join([raw[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


SEGMENTED = (
    "ids array<int>, n_best array<struct<score: double, edits: array<struct<at: int, dropped: int, ids: array<int>>>>>, "
    "round_trip boolean"
)
_EDIT = pa.struct([("at", pa.int32()), ("dropped", pa.int32()), ("ids", pa.list_(pa.int32()))])
_RANKED = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(_EDIT))]))
_KEPT: dict[tuple[int, int], Encoder] = {}


def kept_encoder(model: bytes, n: int) -> Encoder:
    """The encoder of a model, kept by the Python worker from task to task."""
    key = (hash(model), n)
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Encoder(Vocabulary(model), n)
    return _KEPT[key]


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """A model file of a few hundred KB, through Spark's own readers (any file system it reaches)."""
    url = path if "://" in path else f"file://{path}"
    if url.startswith("file://"):
        with open(url.removeprefix("file://"), "rb") as file:
            return file.read()
    return bytes(spark.read.format("binaryFile").load(url).select("content").first()[0])


def segment(docs: DataFrame, model: bytes, n: int = 4, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col`` and ``SEGMENTED`` for every row: best ids, the ``n`` best as edits of them, round-trip check.

    Whole texts of any length; a null text counts as empty and has one segmentation, without ids, of score 0.
    Repeated rows and equal texts give equal results; further columns of ``docs`` are not looked at.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(model, n)
        for batch in batches:
            start = 0
            texts = batch.column(1)
            while start < batch.num_rows:
                taken, values, chars = start, [], 0
                while taken < batch.num_rows and chars < BATCH_CHARS:
                    values.append(texts[taken].as_py())
                    chars += len(values[-1])
                    taken += 1
                ids, ranked, same = [], [], []
                for value, (raw, best) in zip(values, encoder.encode_all(values), strict=True):
                    ids.append(raw)
                    same.append(decode(encoder.vocabulary, array("i", raw)) == value)
                    ranked.append(
                        [
                            {"score": s, "edits": [{"at": a, "dropped": d, "ids": e} for a, d, e in edits]}
                            for s, edits in best
                        ]
                    )
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32) // 4
                flat = np.frombuffer(b"".join(ids), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, taken - start),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        pa.array(ranked, _RANKED),
                        pa.array(same, pa.bool_()),
                    ],
                    names=[id_col, "ids", "n_best", "round_trip"],
                )
                start = taken

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, whole(text).alias("text")).mapInArrow(work, f"`{id_col}` {kind}, {SEGMENTED}")


def segmentation(ids: list[int], edits: list) -> list[int]:
    """Ids of one of the n best: the best ids with its edits made."""
    out = list(ids)
    for at, dropped, new in sorted(edits, reverse=True):
        out[at : at + dropped] = new
    return out


def decoded(rows: DataFrame, model: bytes, ids: str = "ids", name: str = "text") -> DataFrame:
    """``rows`` with the text of each sequence of ids as ``name``; null ids give null."""
    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = Vocabulary(model)
        for batch in batches:
            yield pd.Series([None if x is None else decode(vocabulary, x.tolist()) for x in batch], dtype="object")

    return rows.withColumn(name, text_of(F.col(ids)))
