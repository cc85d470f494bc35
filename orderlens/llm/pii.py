"""Personal data in texts: exact patterns, and a linear-chain conditional random field over word shapes.

The field is trained on the driver from a small labelled table: lines of a bounded sample of documents,
labelled with what the patterns find in them. It sees shapes only (case, length, digits, punctuation,
spacing) of a word and its neighbours, and so marks look-alikes the patterns refuse: other lengths, failed
check digits, unusual separators. Decoding is Viterbi over numpy batches. A word whose margin no
transition can outweigh is outside for certain and cuts the sequence, so little is left to search.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderlens.llm.common import one_in, whole

#: In this order wherever spans are listed. The label of a word outside is 0, of kind k is k + 1.
KINDS = ("email", "ip", "card", "phone")


@dataclass(frozen=True)
class CrfParams:
    """Bounds of the labelled table and of training; texts to be searched have no bound."""

    sample_documents: int = 2000
    sample_bytes: int = 1 << 16
    sequences: int = 2000
    sequence_words: int = 48
    rounds: int = 50
    rate: float = 0.15
    ridge: float = 1e-4


# --- the patterns ---------------------------------------------------------------------------------

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # Anchored at each @: the leftmost match starts where the run of allowed characters before it does.
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    # In a run of dotted numbers the matches are each next four of them.
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        start = run.start()
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            stop = start + sum(map(len, four)) + 3
            if all(len(value) <= 3 and int(value or 0) <= 255 for value in (part.lstrip("0") for part in four)):
                yield start, stop
            start = stop + 1


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _CARD.finditer(text):
        if found.end() - found.start() <= 40:
            digits = "".join(_DIGIT.findall(found.group()))
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(found.group())) <= 15:
            yield found.span()


def base_spans(text: str, has_digit: bool | None = None) -> list[tuple[int, int, int]]:
    """``(start, stop, kind)`` by start, then kind: leftmost matches, failing ones dropped without a retry."""
    found = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    if has_digit is None:
        has_digit = _DIGIT.search(text) is not None
    if has_digit:
        found += [(a, b, 1) for a, b in _ips(text)]
        found += [(a, b, 2) for a, b in _cards(text)]
        if "+" in text:
            found += [(a, b, 3) for a, b in _phones(text)]
    return sorted(found, key=lambda span: (span[0], span[2]))


# --- words and shapes -------------------------------------------------------------------------------

_SPACE, _LOW, _UP, _DIG, _OTHER, _BREAK = 0, 1, 2, 3, 4, 5
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _classes() -> np.ndarray:
    """Class of each code point of the basic plane; punctuation of ASCII one class each from 6 on."""
    table = np.full(1 << 16, _OTHER, dtype=np.uint8)
    for code in range(1 << 16):
        character = chr(code)
        if character.isspace():
            table[code] = _SPACE
        elif character.isalpha():
            table[code] = _UP if character.isupper() else _LOW
    table[ord("0") : ord("9") + 1] = _DIG
    for number, character in enumerate(_PUNCTUATION):
        table[ord(character)] = 6 + number
    table[[0x0A, 0x0D]] = _BREAK
    return table


_CLASS = _classes()
_LETTER_SHAPES, _DIGIT_SHAPES = 16, 12
SHAPES = 2 * (_LETTER_SHAPES + _DIGIT_SHAPES + 1 + len(_PUNCTUATION)) + 1
EDGE = SHAPES - 1  # beyond the line
_LENGTH_OF_LETTERS = np.array([0, 0, 1, 2, 2, 2, 3])
_LENGTH_OF_DIGITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 9, 9, 10, 10, 10, 10, 10, 10, 11])


def words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, shape of each word of code points, and whether a line begins with it.

    A word is a run of letters, a run of digits, or any other character but space.
    """
    kind = _CLASS[np.minimum(codes, 0xFFFF)]
    group = np.where(kind == _UP, _LOW, kind)
    change = np.ones(len(kind) + 1, dtype=bool)
    change[1:-1] = (group[1:] != group[:-1]) | (group[1:] >= _OTHER)
    edge = np.flatnonzero(change)
    start, stop = edge[:-1], edge[1:]
    of = kind[start]
    inside = (of != _SPACE) & (of != _BREAK)
    lines = np.cumsum(of == _BREAK)
    start, stop, of, lines = start[inside], stop[inside], of[inside], lines[inside]
    if not len(start):
        return start, stop, of.astype(np.int64), np.zeros(0, dtype=bool)
    size = stop - start
    upper = np.concatenate([[0], np.cumsum(kind == _UP)])
    capitals = upper[stop] - upper[start]
    case = np.where(capitals == 0, 0, np.where(capitals == size, 1, np.where((capitals == 1) & (of == _UP), 2, 3)))
    letters = case * 4 + _LENGTH_OF_LETTERS[np.minimum(size, 6)]
    digits = _LETTER_SHAPES + _LENGTH_OF_DIGITS[np.minimum(size, 20)]
    other = _LETTER_SHAPES + _DIGIT_SHAPES + np.where(of >= 6, of.astype(np.int64) - 5, 0)
    shape = np.where((of == _LOW) | (of == _UP), letters, np.where(of == _DIG, digits, other))
    fresh = np.ones(len(start), dtype=bool)
    fresh[1:] = lines[1:] != lines[:-1]
    glued = np.zeros(len(start), dtype=bool)
    glued[1:] = start[1:] == stop[:-1]
    return start, stop, 2 * shape + glued, fresh


def _context(shape: np.ndarray, fresh: np.ndarray) -> list[np.ndarray]:
    """Shapes two before to two behind each word, ``EDGE`` beyond its line."""
    line = np.cumsum(fresh)
    out = []
    for shift in (-2, -1, 0, 1, 2):
        moved = np.full(len(shape), EDGE, dtype=np.int64)
        size = len(shape) - abs(shift)
        if size > 0:
            to, of = (slice(-shift, None), slice(0, size)) if shift < 0 else (slice(0, size), slice(shift, None))
            moved[to] = np.where(line[to] == line[of], shape[of], EDGE)
        out.append(moved)
    return out


# --- the field --------------------------------------------------------------------------------------

LABELS = len(KINDS) + 1


@dataclass
class Crf:
    """``single`` (5, shapes, labels), ``pairs`` (2, shapes * shapes, labels), ``moves`` (labels, labels)."""

    single: np.ndarray
    pairs: np.ndarray
    moves: np.ndarray

    def emissions(self, context: list[np.ndarray]) -> np.ndarray:
        out = self.single[0][context[0]]
        for place in range(1, 5):
            out += self.single[place][context[place]]
        out += self.pairs[0][context[1] * SHAPES + context[2]]
        out += self.pairs[1][context[2] * SHAPES + context[3]]
        return out

    def decode(self, shape: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """Best label of each word; lines are sequences of their own."""
        if not len(shape):
            return np.zeros(0, dtype=np.int8)
        scores = self.emissions(_context(shape, fresh))
        # What another label than 0 can gain by its neighbours at most, whatever these are.
        gain = (self.moves - self.moves[:, :1]).max(axis=0) + (self.moves - self.moves[:1]).max(axis=1)
        gain = np.maximum(gain, 0)[1:]
        outside = ((scores[:, :1] - scores[:, 1:]) > gain).all(axis=1)
        labels = np.zeros(len(shape), dtype=np.int8)
        rest = np.flatnonzero(~outside)
        if not len(rest):
            return labels
        cut = np.ones(len(rest), dtype=bool)
        cut[1:] = (rest[1:] != rest[:-1] + 1) | fresh[rest[1:]]
        begin = np.flatnonzero(cut)
        length = np.diff(np.append(begin, len(rest)))
        # A stretch between two words that are outside has these as its neighbours.
        before = rest[begin] - 1
        after = rest[begin + length - 1] + 1
        left = (before >= 0) & ~fresh[rest[begin]]
        right = after < len(shape)
        right[right] &= ~fresh[after[right]]
        labels[rest] = self._viterbi(scores[rest], begin, length, left, right)
        return labels

    def _viterbi(self, scores, begin, length, left, right) -> np.ndarray:
        order = np.argsort(-length, kind="stable")
        begin, length, left, right = begin[order], length[order], left[order], right[order]
        back = np.zeros((len(scores), LABELS), dtype=np.int8)
        best = scores[begin] + np.where(left[:, None], self.moves[0], 0)
        final = np.zeros((len(begin), LABELS))
        active = len(begin)
        for step in range(1, int(length[0]) + 1):
            going = int(np.searchsorted(-length, -step, side="left"))  # longer than step
            final[going:active] = best[going:active]
            active = going
            if not active:
                break
            paths = best[:active, :, None] + self.moves[None]
            at = begin[:active] + step
            back[at] = paths.argmax(axis=1)
            best[:active] = paths.max(axis=1) + scores[at]
        final += np.where(right[:, None], self.moves[:, 0], 0)
        labels = np.zeros(len(scores), dtype=np.int8)
        here = final.argmax(axis=1)
        active = 0
        for step in range(int(length[0]) - 1, -1, -1):
            active = int(np.searchsorted(-length, -step, side="left"))
            at = begin[:active] + step
            labels[at] = here[:active]
            here[:active] = back[at, here[:active]]
        return labels


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(table: list[tuple[list[np.ndarray], np.ndarray]], params: CrfParams = CrfParams()) -> Crf:
    """Fit by gradient ascent on the penalised likelihood. ``table``: context shapes and labels of each sequence.

    An empty table, or one without any marked word, gives a field that marks nothing.
    """
    model = Crf(
        np.zeros((5, SHAPES, LABELS)), np.zeros((2, SHAPES * SHAPES, LABELS)), np.zeros((LABELS, LABELS))
    )
    model.single[2][:, 0] = 1.0
    table = [(context, labels) for context, labels in table if len(labels)]
    if not any(labels.any() for _, labels in table):
        return model
    model.single[:] = 0
    table.sort(key=lambda pair: -len(pair[1]))
    length = np.array([len(labels) for _, labels in table])
    most, count = int(length[0]), len(table)
    used = np.arange(most)[:, None] < length
    features = np.zeros((7, most, count), dtype=np.int64)
    truth = np.zeros((most, count), dtype=np.int64)
    for i, (context, labels) in enumerate(table):
        for place in range(5):
            features[place, : len(labels), i] = context[place]
        features[5, : len(labels), i] = context[1] * SHAPES + context[2]
        features[6, : len(labels), i] = context[2] * SHAPES + context[3]
        truth[: len(labels), i] = labels
    flat = [features[k][used] for k in range(7)]
    # Only the features that occur have a gradient.
    compact = [np.unique(f, return_inverse=True) for f in flat]
    target = np.eye(LABELS)[truth]
    inner = used[1:]
    real_moves = np.zeros((LABELS, LABELS))
    np.add.at(real_moves, (truth[:-1][inner], truth[1:][inner]), 1)
    weights = [np.zeros((len(values), LABELS)) for values, _ in compact] + [model.moves]
    square = [np.full_like(w, 1e-6) for w in weights]
    for _ in range(params.rounds):
        scores = np.zeros((most, count, LABELS))
        scores[used] = sum(w[inverse] for w, (_, inverse) in zip(weights, compact, strict=False))
        moves = weights[7]
        forward = np.zeros_like(scores)
        forward[0] = scores[0]
        for t in range(1, most):
            forward[t] = _log_sum(forward[t - 1][:, :, None] + moves, 1) + scores[t]
        backward = np.zeros_like(scores)
        for t in range(most - 2, -1, -1):
            step = _log_sum(moves + (scores[t + 1] + backward[t + 1])[:, None, :], 2)
            backward[t] = np.where(used[t + 1][:, None], step, 0)
        total = _log_sum(forward[length - 1, np.arange(count)], 1)
        chance = np.exp(np.where(used[:, :, None], forward + backward - total[:, None], -np.inf))
        wrong = (target - chance)[used]
        gradients = []
        for values, inverse in compact:
            gradients.append(
                np.stack([np.bincount(inverse, wrong[:, label], len(values)) for label in range(LABELS)], axis=1)
            )
        expected = np.zeros((LABELS, LABELS))
        for t in range(1, most):
            joint = forward[t - 1][:, :, None] + moves + (scores[t] + backward[t])[:, None, :] - total[:, None, None]
            expected += np.exp(joint[used[t]]).sum(axis=0)
        gradients.append(real_moves - expected)
        for w, g, s in zip(weights, gradients, square, strict=True):
            g = g - params.ridge * len(table) * w
            s += g * g
            w += params.rate * g / np.sqrt(s)
    for k, (values, _) in enumerate(compact):
        (model.single[k] if k < 5 else model.pairs[k - 5])[values] = weights[k]
    # A shape never seen speaks for nothing but being outside.
    known = np.zeros(SHAPES, dtype=bool)
    known[compact[2][0]] = True
    model.single[2][~known, 0] += 4.0
    return model


def labelled_table(texts: list[str], params: CrfParams = CrfParams()) -> list[tuple[list[np.ndarray], np.ndarray]]:
    """Sequences of up to ``sequence_words``: those that hold a marked word first, then others."""
    marked, plain = [], []
    for text in texts:
        codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
        start, stop, shape, fresh = words(codes)
        labels = np.zeros(len(start), dtype=np.int64)
        for first, last, kind in base_spans(text):
            labels[(start < last) & (stop > first)] = kind + 1
        context = _context(shape, fresh)
        cuts = np.flatnonzero(fresh).tolist() + [len(start)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            for at in range(a, b, params.sequence_words):
                part = slice(at, min(b, at + params.sequence_words))
                (marked if labels[part].any() else plain).append(([c[part] for c in context], labels[part]))
    half = params.sequences // 2
    marked = marked[:half]
    return marked + plain[: params.sequences - len(marked)]


def fit(docs: DataFrame, params: CrfParams = CrfParams(), id_col: str = "doc_id", text: str = "text") -> Crf:
    """Train on a bounded sample of ``docs`` chosen by a hash: mostly texts that hold a digit or an @."""
    rows = docs.select(F.col(id_col).alias("id"), whole(text).alias("text")).where(
        F.octet_length("text").between(1, params.sample_bytes)
    )
    turn = F.xxhash64("id", "text")
    telling, plain = params.sample_documents * 3 // 4, params.sample_documents // 4
    count = docs.count()

    def about(wanted: int) -> DataFrame:
        return rows.where(F.pmod(turn, F.lit(one_in(count, wanted))) == 0)

    # Texts with a digit are about one in ten.
    telling = about(10 * telling).where(F.col("text").rlike("[0-9@]")).orderBy(turn).limit(telling)
    any_rows = about(2 * plain).orderBy(turn).limit(plain)
    texts = [row["text"] for row in telling.collect()] + [row["text"] for row in any_rows.collect()]
    return train(labelled_table(texts, params), params)


# --- on Spark ---------------------------------------------------------------------------------------

SPAN = "array<struct<start: long, stop: long, kind: int>>"


def _model_spans(labels, start, stop, fresh) -> list[tuple[int, int, int]]:
    at = np.flatnonzero(labels)
    if not len(at):
        return []
    cut = np.ones(len(at), dtype=bool)
    cut[1:] = (at[1:] != at[:-1] + 1) | (labels[at][1:] != labels[at][:-1]) | fresh[at[1:]]
    head = np.flatnonzero(cut)
    last = np.append(head[1:], len(at)) - 1
    return list(
        zip(start[at[head]].tolist(), stop[at[last]].tolist(), (labels[at[head]] - 1).tolist(), strict=True)
    )


def find(docs: DataFrame, model: Crf, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, base, more`` for every row: pattern spans, and spans of the field that touch none of them.

    Offsets are code points, ends exclusive; both lists are by start, then kind. A null text counts as empty
    and has no spans. Repeated rows give repeated results; further columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(
        Crf(*(a.astype(np.float32) for a in (model.single, model.pairs, model.moves)))
    )
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.int32())]))

    def listed(spans):
        return [{"start": a, "stop": b, "kind": k} for a, b, k in spans]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        for batch in batches:
            base, more = [], []
            texts = batch.column(1)
            row = 0
            while row < batch.num_rows:
                group, size = [], 0
                while row < batch.num_rows and size < 1 << 19:
                    group.append(texts[row].as_py())
                    size += len(group[-1])
                    row += 1
                # Texts of a group are parted by a line end, which is where sequences end too.
                codes = np.frombuffer("\n".join(group).encode("utf-32-le", "replace"), dtype=np.uint32)
                start, stop, shape, fresh = words(codes)
                labels = field.decode(shape, fresh)
                spans = _model_spans(labels, start, stop, fresh)
                digit = (codes >= 0x30) & (codes <= 0x39)
                places = np.flatnonzero(digit)
                offset, at = 0, 0
                for value in group:
                    end = offset + len(value)
                    has_digit = bool(np.searchsorted(places, end) > np.searchsorted(places, offset))
                    own = base_spans(value, has_digit)
                    extra = []
                    while at < len(spans) and spans[at][0] < end:
                        a, b, k = spans[at]
                        a, b = a - offset, b - offset
                        if all(b <= x or a >= y for x, y, _ in own):
                            extra.append((a, b, k))
                        at += 1
                    base.append(listed(own))
                    more.append(listed(extra))
                    offset = end + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, kind), pa.array(more, kind)], names=[id_col, "base", "more"]
            )

    of = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, whole(text).alias("text")).mapInArrow(work, f"`{id_col}` {of}, base {SPAN}, more {SPAN}")


def spelt(spans: Column) -> Column:
    """``kind:start:end`` of spans by start, then kind, joined by commas."""
    names = F.array(*(F.lit(kind) for kind in KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["stop"])))
    return F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])), ","
    )


def report(docs: DataFrame, params: CrfParams = CrfParams()) -> DataFrame:
    found = find(docs, fit(docs, params))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)),
        F.sha2(spelt(F.col("base")), 256).alias("base_sha256"),
        spelt(F.concat("base", "more")).alias("spans"),
        F.size("more").cast("long").alias("n_model"),
    )
