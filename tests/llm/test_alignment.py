"""Alignment of two tokenizers, against whole texts tokenized one by one."""

import gc
import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from orderlens.llm import alignment

A, B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def files():
    with open(A, "rb") as a, open(B, "rb") as b:
        return a.read(), b.read()


def brute(rows):
    """Every text whole, ranges from the tokens' bytes alone, all pairs of tokens compared."""
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = alignment.byte_letters()
    done = []
    for key, text in rows:
        own = (" " + (text or "")).encode()
        ids = [], []
        if text:
            ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids[0]], [
            bytes((int(b.id_to_piece(i)[3:5], 16),)) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]
        ]
        if any(b"".join(r) != own for r in raw):
            ids = raw = [], []
        ends = [[len(b"".join(r[: n + 1])) for n in range(len(r))] for r in raw]
        begins = [[0, *e[:-1]] for e in ends]
        links = [
            (ids[0][i], ids[1][j])
            for i in range(len(ids[0]))
            for j in range(len(ids[1]))
            if max(begins[0][i], begins[1][j]) < min(ends[0][i], ends[1][j])
        ]
        groups, was = [], (0, 0)
        for end in sorted({*ends[0]} & {*ends[1]}):
            now = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append("|".join(",".join(map(str, x[i:j])) for x, i, j in zip(ids, was, now)))
            was = now
        done.append((key, ids, groups, links))
    count = Counter(pair for *_, links in done for pair in set(links))
    most = {}
    for (i, _), n in count.items():
        most[i] = max(most.get(i, 0), n)
    return sorted(
        (
            (key, len(ids[0]), len(ids[1]), len(groups), len(links), sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links), ";".join(groups))
            for key, ids, groups, links in done
        ),
        key=str,
    )


HARD = [
    (1, "The quick brown fox, don't you think?  Two  spaces\tand a tab\nnew line"),
    (2, "The quick brown fox, don't you think?  Two  spaces\tand a tab\nnew line"),
    (2, "naïve café 中文字符 😀😃 ﷽ ́combining é"),
    (None, "byte \x00 fallback  \U0010ffff end"),
    (4, None),
    (5, ""),
    (6, " "),
    (7, "   leading and trailing   "),
    (8, "a▁b holds the mark of a space"),
    (9, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (10, "x" * 3000 + " " + "中" * 500),
    (11, " no-break em ​zero \x1c sep\n\n  \n end \n"),
    (12, "\n"),
    (13, "😀"),
]


def found(spark, rows, files, **more):
    docs = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, text string, links string, part int")
    return sorted((tuple(r) for r in alignment.align(docs, *files, **more).collect()), key=str)


def test_against_whole_texts(spark, files):
    assert found(spark, HARD, files) == brute(HARD)


def test_small_parts_and_whole_texts_give_the_same(spark, files, monkeypatch):
    rows = HARD + [(n, f"The number {n % 7} and the word café {n % 3}") for n in range(20, 60)]
    want = brute(rows)
    assert found(spark, rows, files) == want
    hashed = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in want]
    assert found(spark, rows, files, with_groups=False) == sorted(hashed, key=str)
    aligner = alignment.Aligner(alignment.Tokenizers(*files))
    assert aligner.tokenizers.by_chunks
    by_chunks = aligner.align([t or "" for _, t in rows])
    aligner.clear()
    aligner.tokenizers.by_chunks = False
    whole_texts = aligner.align([t or "" for _, t in rows])
    assert by_chunks["groups"] == whole_texts["groups"]
    assert sorted(by_chunks["pairs"]) == sorted(whole_texts["pairs"])


def test_empty_table(spark, files):
    assert found(spark, [], files) == []


def test_refined_ranges():
    # Two tokens share a three-byte character: its span is no cut, their bytes decide. Byte pieces have empty spans.
    ends = alignment.byte_ends(np.array([0, 1, 1, 4]), np.array([1, 4, 4, 5]), np.array([1, 2, 1, 1]))
    assert ends.tolist() == [1, 3, 4, 5]
    assert alignment.byte_ends(np.array([0, 0, 0]), np.array([0, 0, 3]), np.array([1, 1, 1])).tolist() == [1, 2, 3]
    first, second, shared = alignment.overlaps(np.array([1, 3, 4, 5]), np.array([1, 4, 5]))
    assert list(zip(first, second, shared)) == [(0, 0, 1), (1, 1, 3), (2, 1, 4), (3, 2, 5)]


def test_no_search_for_cycles_while_texts_are_aligned(files, monkeypatch):
    aligner, seen = alignment.Aligner(alignment.Tokenizers(*files)), []
    learn = aligner.learn
    monkeypatch.setattr(aligner, "learn", lambda chunks: seen.append(gc.isenabled()) or learn(chunks))
    assert aligner.align(["some words", "", "some more"])["n_links"][1] == 0
    assert seen == [False] and gc.isenabled()
