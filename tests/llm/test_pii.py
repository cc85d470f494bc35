"""Patterns against regular expressions applied naively, and the field against brute-force search."""

import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings as checks, strategies as st

from orderlens.llm import pii


def naive(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(a, b, kind) for a, kind, b in sorted(found)]


@checks(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1230.@+-() _%é\n", max_size=40))
def test_patterns_agree_with_naive_search(text):
    assert pii.base_spans(text) == naive(text)


def test_patterns_on_planted_data():
    text = "x a.b@c.example.org, 10.0.0.256 1.2.3.4.5.6.7.8 card 4111 1111 1111 1111 call +1 (743) 555-3824 or 00012.0.0.1"
    assert pii.base_spans(text) == naive(text)
    assert {kind for _, _, kind in pii.base_spans(text)} == {0, 1, 2, 3}


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def random_field(seed):
    random = np.random.default_rng(seed)
    return pii.Crf(
        random.normal(size=(5, pii.SHAPES, pii.LABELS)),
        random.normal(size=(2, pii.SHAPES**2, pii.LABELS)) * 0.3,
        random.normal(size=(pii.LABELS, pii.LABELS)),
    )


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("bias", [0.0, 2.5, 6.0])
def test_viterbi_finds_the_best_path(seed, bias):
    field = random_field(seed)
    field.single[2][:, 0] += bias  # so that some words are outside for certain
    text = "Call +1 (743) a@b.c\n12.3 x\nY"
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    _, _, shape, fresh = pii.words(codes)
    labels = field.decode(shape, fresh)
    scores = field.emissions(pii._context(shape, fresh))
    lines = np.split(np.arange(len(shape)), np.flatnonzero(fresh)[1:])
    for line in lines:
        line = line[:7]  # 5^7 paths; a prefix's best value is checked by dynamic programming below
        value = lambda path, at: sum(scores[i, l] for i, l in zip(at, path)) + sum(
            field.moves[a, b] for a, b in zip(path, path[1:])
        )
        if len(line) < 7:
            best = max(itertools.product(range(pii.LABELS), repeat=len(line)), key=lambda p: value(p, line))
            assert value(labels[line], line) == pytest.approx(value(best, line))
    whole = [line for line in lines if len(line) >= 7]
    for line in whole:
        best = scores[line[0]].copy()
        for i in line[1:]:
            best = (best[:, None] + field.moves).max(axis=0) + scores[i]
        got = scores[line, labels[line]].sum() + field.moves[labels[line][:-1], labels[line][1:]].sum()
        assert got == pytest.approx(best.max())


def sample():
    lines = []
    for i in range(80):
        lines.append(f"write to user{i}.x@mail{i}.example.com or call +1 ({100 + i}) 555-{1000 + i} now")
        lines.append(f"the host 10.{i}.3.{i} of order {i} is down since {i} days, see page {i * 7}")
    return lines


def test_training_learns_and_generalises(spark):
    field = pii.train(pii.labelled_table(sample()))
    text = "please call +1 (999) 555-7777 or 300.300.300.300 today"  # the last is no valid address
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    start, stop, shape, fresh = pii.words(codes)
    spans = pii._model_spans(field.decode(shape, fresh), start, stop, fresh)
    assert (12, 29, 3) in spans
    assert any(text[a:b] == "300.300.300.300" for a, b, _ in spans) and pii.base_spans(text) == [(12, 29, 3)]


def test_nothing_to_learn_marks_nothing():
    for table in ([], pii.labelled_table(["plain words only"])):
        field = pii.train(table)
        codes = np.frombuffer("a 1 +2 b@c.d".encode("utf-32-le"), dtype=np.uint32)
        _, _, shape, fresh = pii.words(codes)
        assert not field.decode(shape, fresh).any()


def test_rows_of_any_kind(spark):
    texts = [*sample(), None, "", "1.2.3.4", "1.2.3.4", "é 1.2.3.4\nnext 1.2.3.4 " * 3000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    got = {r.doc_id: r for r in pii.report(docs).collect()}
    n = len(texts)
    assert (got[n - 5].n_ip, got[n - 5].spans, got[n - 4].spans) == (0, "", "")
    assert got[n - 3].spans == got[n - 2].spans == "ip:0:7"
    assert got[n - 1].n_ip == 6000
    for i, text in enumerate(texts):
        listed = [s.split(":") for s in got[i].spans.split(",") if s]
        assert [(int(a), pii.KINDS.index(k)) for k, a, _ in listed] == sorted((int(a), pii.KINDS.index(k)) for k, a, _ in listed)
        assert {(int(a), int(b), pii.KINDS.index(k)) for k, a, b in listed} >= set(naive(text or ""))
    assert pii.report(docs.limit(0)).count() == 0
