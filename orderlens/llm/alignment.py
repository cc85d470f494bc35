"""Two tokenizers on the same texts: which tokens cover the same bytes.

Each token gets the byte range it covers. The libraries' own spans (character offsets of ``tokenizers``,
spans of the SentencePiece proto) are taken where a token covers whole characters; where several tokens
share a character, or a byte piece has no span, the bytes of the vocabulary entry go on from the last
cut. Offsets where tokens of both end cut the text into groups; tokens whose ranges overlap are linked.

Neither vocabulary joins a visible character with a space after it, so a text falls apart there into
chunks that are tokenized alike wherever they stand: a task tokenizes each distinct chunk once, and
a text is put together from its chunks. This is tested on the vocabulary; others go as whole texts.

How many documents hold a linked pair of ids is known only over the whole corpus. Documents are taken in
parts of bounded bytes; a part lists its distinct pairs once, the lists are counted, and each
part gets the counts of its own list back. No task sees the counts of all pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, filterfalse
from operator import attrgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from orderlens.llm.common import no_cycle_search, text_parts, whole
from orderlens.session import staged

#: SentencePiece writes a space as this character.
SPACE = "▁"
#: Documents are taken so many bytes at a time (a longer text alone).
PART_BYTES = 4 << 20
#: A task forgets its chunks when they reach this number or these bytes; it changes nothing but time.
CACHE_CHUNKS = 300_000
CACHE_BYTES = 8 << 20
#: New chunks are tokenized one behind the other, so many characters at a time.
BLOCK_CHARS = 1 << 16

#: Before a space that follows a visible character, unless only spaces are left.
CUT = re.compile(r"(?<=\S)(?= (?! *\Z))")


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for the 256 bytes: a printable Latin-1 character
    stands for itself, the others take the code points from 256 on, in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def byte_ends(begins: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each token ends, in bytes. ``begins`` and ``ends`` are the library's spans: a span that ends where the
    next begins is a cut. Tokens that share a character, and byte pieces, which have empty spans, have no cut
    of their own: their ``lengths`` go on from the last one."""
    cuts = np.append(begins[1:] == ends[:-1], True) & (ends > begins)
    last = np.maximum.accumulate(np.where(cuts, np.arange(len(ends)), -1))
    run = np.cumsum(lengths)
    return run + np.where(last < 0, 0, ends[last] - run[last])


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the tokens that share bytes, pair by pair, and the end of what they share: between two
    neighbouring ends, of whichever tokenizer, there is one token of each."""
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends), ends


class Tokenizers:
    """Both tokenizers and the bytes of their entries."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores of an executor are its tasks'
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_file.decode("utf-8"))
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        letters = byte_letters()
        self.a_bytes = {
            i: bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode("utf-8")
            for entry, i in self.a.get_vocab(with_added_tokens=True).items()
        }
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes((int(piece[3:5], 16),)) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode("utf-8")
            for i, piece in enumerate(pieces)
        ]
        steps = json.loads(a_file).get("pre_tokenizer") or {}
        self.by_chunks = (
            steps.get("type") == "ByteLevel"
            and steps.get("use_regex", True)
            and not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in pieces)
        )

        self.a_lengths = np.zeros(max(self.a_bytes) + 1, dtype=np.int64)
        for i, raw in self.a_bytes.items():
            self.a_lengths[i] = len(raw)
        self.b_lengths = np.array([len(raw) for raw in self.b_bytes], dtype=np.int64)
        self.names = [str(i) for i in range(max(len(self.a_lengths), len(self.b_bytes)))]

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids and byte ends by both, for a text that begins with a space; none where its bytes do not come back."""
        own = text.encode("utf-8")
        first = self.a.encode(text, add_special_tokens=False)
        pieces = self.b.encode(text[1:], num_threads=1, return_type="proto").pieces
        a, b = first.ids, list(map(attrgetter("id"), pieces))
        if b"".join(map(self.a_bytes.__getitem__, a)) != own or b"".join(map(self.b_bytes.__getitem__, b)) != own:
            return None
        spans = np.fromiter(chain.from_iterable(first.offsets), np.int64, 2 * len(a)).reshape(-1, 2)
        if len(own) != len(text):
            raw = np.frombuffer(own, dtype=np.uint8)
            spans = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(own))[spans]
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        a_ends = byte_ends(spans[:, 0], spans[:, 1], self.a_lengths[a])
        # SentencePiece counts from the text without the space it puts before it.
        begins, ends = (np.fromiter(map(attrgetter(n), pieces), np.int64, len(b)) + 1 for n in ("begin", "end"))
        begins[:1] = 0
        b_ends = byte_ends(begins, ends, self.b_lengths[b])
        return a, a_ends, b, b_ends


class Aligner:
    """Aligned chunks, kept from one part to the next."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.links = np.zeros(0, dtype=np.int64)  # of all chunks, one behind the other: both ids in one number
        self.sizes = np.zeros((0, 4), dtype=np.int64)  # tokens of both, groups, links
        self.groups: list[str] = []
        self.bytes = 0

    def add(self, block: list[str]) -> list[int]:
        """The numbers of chunks that may stand behind each other; -1 where the bytes do not come back."""
        tokens = self.tokenizers.tokens("".join(block))
        if tokens is None:
            return [-1] if len(block) == 1 else [n for chunk in block for n in self.add([chunk])]
        a, a_ends, b, b_ends = tokens
        first, second, shared = overlaps(a_ends, b_ends)
        closing = np.flatnonzero((a_ends[first] == shared) & (b_ends[second] == shared))
        bounds = np.cumsum([len(c) if c.isascii() else len(c.encode("utf-8")) for c in block])
        sizes = [np.searchsorted(x, bounds, side="right") for x in (a_ends, b_ends, shared[closing], shared)]
        name = self.tokenizers.names.__getitem__
        a_names, b_names = list(map(name, a.tolist())), list(map(name, b.tolist()))
        ups, tos = (first[closing] + 1).tolist(), (second[closing] + 1).tolist()
        groups = [
            f"{a_names[i]}|{b_names[j]}" if i + 1 == up and j + 1 == to else f"{','.join(a_names[i:up])}|{','.join(b_names[j:to])}"
            for i, up, j, to in zip([0, *ups], ups, [0, *tos], tos)
        ]
        ends = sizes[2].tolist()
        before = len(self.groups)
        self.groups += [";".join(groups[i:j]) for i, j in zip([0, *ends], ends)]
        self.sizes_new.append(np.diff(np.stack(sizes, axis=1), axis=0, prepend=0))
        self.links_new.append(a[first] << 32 | b[second])
        return list(range(before, len(self.groups)))

    def learn(self, chunks: list[str]) -> None:
        """Tokenize new chunks, many at a time."""
        self.links_new, self.sizes_new = [self.links], [self.sizes]
        # A chunk that ends in white space ends its text: nothing may follow it.
        alone = [c for c in chunks if c[-1].isspace() or SPACE in c]
        apart = set(alone)
        joined = [c for c in chunks if c not in apart]
        size = np.cumsum([len(c) for c in joined]) // BLOCK_CHARS
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(joined)] if joined else []
        for block in [joined[i:j] for i, j in zip(cuts, cuts[1:])] + [[c] for c in alone]:
            self.known.update(zip(block, self.add(block)))
        self.bytes += sum(map(len, chunks))
        self.links, self.sizes = np.concatenate(self.links_new), np.concatenate(self.sizes_new)

    @no_cycle_search()
    def align(self, texts: list[str]) -> dict:
        """Tokens, groups and links of each text; the distinct pairs of all of them."""
        if len(self.known) > CACHE_CHUNKS or self.bytes > CACHE_BYTES:
            self.clear()
        cut = CUT.split if self.tokenizers.by_chunks else lambda text: [text]
        chunks = [cut(" " + text) if text else [] for text in texts]
        self.learn(list(dict.fromkeys(filterfalse(self.known.__contains__, chain.from_iterable(chunks)))))
        of = [list(map(self.known.__getitem__, own)) for own in chunks]
        # Bytes are the whole text's: what one chunk loses another could in principle add.
        lost = [n for n, own in enumerate(of) if -1 in own]
        if lost and self.tokenizers.by_chunks:
            self.learn([c for c in dict.fromkeys(" " + texts[n] for n in lost) if c not in self.known])
            of = [[self.known[" " + texts[n]]] if -1 in own else own for n, own in enumerate(of)]
        of = [[] if -1 in own else own for own in of]

        counts = np.array([len(own) for own in of], dtype=np.int64)
        flat = np.fromiter(chain.from_iterable(of), np.int64, int(counts.sum()))
        row = np.repeat(np.arange(len(of)), counts)
        sizes = self.sizes[flat]
        ends = np.cumsum(self.sizes[:, 3])
        each = sizes[:, 3]
        at = np.repeat(ends[flat] - np.cumsum(each), each) + np.arange(each.sum())
        names, place = np.unique(self.links[at], return_inverse=True)
        keys, times = np.unique(np.repeat(row, each) * max(1, len(names)) + place, return_counts=True)
        rows, slots = np.divmod(keys, max(1, len(names)))
        summed = [np.bincount(row, sizes[:, k], len(of)).astype(np.int64) for k in range(4)]
        return {
            "n_a": summed[0],
            "n_b": summed[1],
            "n_groups": summed[2],
            "n_links": summed[3],
            "groups": [";".join([self.groups[i] for i in own]) for own in of],
            "rows": np.searchsorted(rows, np.arange(len(of) + 1)),
            "slots": slots,
            "times": times,
            "pairs": names,
            "documents": np.bincount(slots, minlength=len(names)),
        }


def packed(slots: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending slots as differences, then how often each occurs."""
    both = np.concatenate([np.diff(slots, prepend=0), times]).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(both.tobytes())


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype="<u4").astype(np.int64)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


_KEPT: dict = {}


def aligner(a_file: bytes, b_file: bytes) -> Aligner:
    """The aligner of these files, kept by the Python worker from task to task."""
    key = hash((a_file, b_file))
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = Aligner(Tokenizers(a_file, b_file))
    return _KEPT[key]


COUNTS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"


def align(
    docs: DataFrame, a_file: bytes, b_file: bytes, id_col: str = "doc_id", text: str = "text", with_groups: bool = True
) -> DataFrame:
    """``id_col``, ``COUNTS`` and ``groups`` (or, without them, ``groups_sha256``) for every row.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: ids of both tokenizers, group by group. ``n_links`` counts the pairs
    of overlapping tokens, ``n_best`` those whose ids are held linked by as many documents as any pair with the
    same first id, ``count_sum`` adds these numbers of documents over the links.

    Whole texts of any length. A null or empty text, and one whose bytes a tokenizer does not give back, has no
    tokens: zeros and empty groups. Every row counts as a document, also one with a null or repeated id.
    Further columns of ``docs`` are not looked at; an empty table gives an empty result.
    """
    name = "groups" if with_groups else "groups_sha256"
    kind = dict(docs.dtypes)[id_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_file, b_file)
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, last, _, _ in text_parts(batch.column(1), PART_BYTES):
                found = both.align(batch.column(1).slice(first, last - first).to_pylist())
                groups = found["groups"]
                if not with_groups:
                    groups = [hashlib.sha256(g.encode("ascii")).hexdigest() if g else "" for g in groups]
                bounds = found["rows"]
                links = [packed(found["slots"][i:j], found["times"][i:j]) for i, j in zip(bounds[:-1], bounds[1:])]
                rest = [None] * (last - first - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(np.full(last - first, part)),
                        *[pa.array(found[n]) for n in ("n_a", "n_b", "n_groups", "n_links")],
                        pa.array(groups, pa.string()),
                        pa.array(links, pa.binary()),
                        pa.array([found["pairs"], *rest], pa.list_(pa.int64())),
                        pa.array([found["documents"], *rest], pa.list_(pa.int64())),
                    ],
                    [id_col, "part", "n_a", "n_b", "n_groups", "n_links", name, "links", "pairs", "documents"],
                )
                part += 1

    rows = docs.select(id_col, whole(text).alias("text")).mapInArrow(
        work,
        f"`{id_col}` {kind}, part long, n_a long, n_b long, n_groups long, n_links long, {name} string, "
        "links binary, pairs array<long>, documents array<long>",
    )
    rows = staged(rows, "aligned")
    lists = rows.where("pairs is not null").select("part", F.posexplode(F.arrays_zip("pairs", "documents")).alias("slot", "x"))
    lists = lists.select("part", "slot", F.col("x.pairs").alias("pair"), F.col("x.documents").alias("documents"))
    counts = lists.groupBy("pair").agg(F.sum("documents").alias("count")).withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    counts = counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    wanted = lists.join(counts, "pair").select(F.col("part").alias("of"), "slot", "count", "best")

    def fill(left: pa.Table, right: pa.Table) -> pa.Table:
        count = np.zeros(right.num_rows, dtype=np.int64)
        best = np.zeros(right.num_rows, dtype=np.int64)
        slot = right.column("slot").to_numpy()
        count[slot] = right.column("count").to_numpy()
        best[slot] = right.column("best").to_numpy(zero_copy_only=False)
        n_best, sums = [], []
        for blob in left.column("links").to_pylist():
            slots, times = unpacked(blob)
            n_best.append(int(best[slots] @ times))
            sums.append(int(count[slots] @ times))
        out = left.select([id_col, "n_a", "n_b", "n_groups", "n_links"])
        return out.append_column("n_best", pa.array(n_best, pa.int64())).append_column(
            "count_sum", pa.array(sums, pa.int64())
        ).append_column(name, left.column(name))

    left = rows.select(id_col, "part", "n_a", "n_b", "n_groups", "n_links", name, "links")
    return (
        left.groupBy("part").cogroup(wanted.groupBy("of")).applyInArrow(fill, f"`{id_col}` {kind}, {COUNTS}, {name} string")
    )
