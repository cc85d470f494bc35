"""Repeated byte strings against a set of all windows."""

import hashlib
import random

import pytest

from orderlens.llm import suffixes
from orderlens.llm.suffixes import SuffixParams
from orderlens.session import path_exists


def brute(docs, length):
    """Digest columns of (id, text) documents; rows of one id are judged against smaller ids only."""
    holders = {}
    for doc, text in docs:
        raw = (text or "").encode()
        for at in range(len(raw) - length + 1):
            window = raw[at : at + length]
            holders[window] = min(holders.get(window, doc), doc)
    out = []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            if holders[raw[at : at + length]] < doc:
                gone[at : at + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def report(spark, docs, params):
    rows = suffixes.removal_report(spark.createDataFrame(docs, "doc_id long, text string"), params)
    return sorted(tuple(r) for r in rows.collect())


def documents(seed, count=60):
    random.seed(seed)
    word = lambda: "".join(random.choice("abcdeé") for _ in range(random.randint(1, 9)))
    shared = [" ".join(word() for _ in range(random.randint(8, 30))) for _ in range(6)]
    docs = []
    for i in range(count):
        parts = [" ".join(word() for _ in range(random.randint(0, 25)))]
        for _ in range(random.randint(0, 3)):
            passage = random.choice(shared)
            cut = random.randint(0, len(passage) // 2)
            parts += [passage[cut:], word()]
        docs.append((i * 3 % 61, " ".join(parts)))
    return docs + [(100, "a" * 3000), (101, "b" + "a" * 2500), (102, "ab" * 700), (103, docs[5][1]), (104, ""), (105, None)]


@pytest.mark.parametrize("seed", range(3))
def test_agrees_with_all_windows(spark, seed):
    docs = documents(seed)
    assert report(spark, docs, SuffixParams()) == brute(docs, 50)


def test_the_other_ways_give_the_same(spark):
    """Joined instead of broadcast tokens, hot tokens by a shuffle, a small sample of splitters."""
    docs = documents(9)
    ways = (SuffixParams(broadcast_tokens=0), SuffixParams(hot_token=1), SuffixParams(sample_rows=3), SuffixParams(lead=8))
    assert all(report(spark, docs, way) == brute(docs, 50) for way in ways)


def test_one_passage_in_every_document(spark):
    passage = "this very passage stands in each of the many documents of the table, word by word"
    docs = [(i, f"{i} starts differently {passage} and {i * 7919} ends so") for i in range(400)]
    got = report(spark, docs, SuffixParams(hot_token=200))
    assert got == brute(docs, 50)
    assert all(removed >= len(passage) for _, _, removed, _, _ in got[1:])


def test_rows_of_any_kind(spark):
    text = "a passage of more than fifty bytes that stands in several rows of this table"
    rows = [(1, text, "k"), (1, text, "k"), (1, f"{text} again", "k"), (2, text, "k"), (3, None, "k"), (4, "", "k"), (None, text, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in suffixes.removal_report(docs).collect()), key=str)
    n = len(text)
    # The null id is smaller than any other, so its row alone keeps the passage.
    assert got == sorted([(1, n, n), (1, n, n), (1, n + 6, n), (2, n, n), (3, 0, 0), (4, 0, 0), (None, n, 0)], key=str)
    assert suffixes.removal_report(docs.limit(0)).count() == 0


def test_a_very_long_text(spark):
    random.seed(3)
    long = "".join(random.choice("abcdefgh ") for _ in range(300_000))
    docs = [(1, long), (2, "x" + long[1000:200_000]), (3, long[299_960:] + "y" * 60)]
    got = {r.doc_id: r for r in suffixes.removal_report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert (got[1].n_removed, got[2].n_removed, got[3].n_removed) == (0, 199_000, 0)


def test_near_copies_of_equal_lines(spark):
    """Equal lines make stretches of many windows; a digit changed anywhere in them keeps the bytes around it."""
    random.seed(5)
    docs = []
    for size in range(22, 32):
        line = "".join(random.choice("abcdefghij |-") for _ in range(size - 1)) + "\n"
        text = line * 40
        docs.append((len(docs), text))
        for digit in "01234567":
            at = random.randrange(len(text))
            docs.append((len(docs), text[:at] + digit + text[at + 1 :]))
    assert report(spark, docs, SuffixParams()) == brute(docs, 50)


def test_one_letter_in_very_many_windows(spark, monkeypatch):
    """Lines of one letter, in many documents: more windows than are compared at a time, and more than a task may hold."""
    docs = [(i, "a" * (2000 + 37 * i) + f" {i} " + "-" * (500 + i)) for i in range(40)]
    want = brute(docs, 50)
    monkeypatch.setattr(suffixes, "COMPARED", 1 << 12)
    assert report(spark, docs, SuffixParams()) == want
    assert report(spark, docs, SuffixParams(hot_token=5000)) == want


def test_hashes_of_texts_only_where_an_id_has_several(spark, monkeypatch):
    """Every suffix carries them through the shuffle; what the steps wrote is gone when the result is there."""
    seen, homes = [], []
    key, path = suffixes._text_key, suffixes.scratch_path
    monkeypatch.setattr(suffixes, "_text_key", lambda plain: seen.append(key(plain)) or seen[-1])
    monkeypatch.setattr(suffixes, "scratch_path", lambda spark, name: homes.append(path(spark, name)) or homes[-1])
    for docs in (documents(4), [*documents(4), (100, "b" * 200), (None, "a" * 90)]):
        rows = spark.createDataFrame(docs, "doc_id long, text string")
        suffixes.removal_report(rows, SuffixParams()).collect()
    alone, several = (str(column) for column in seen)
    assert "xxhash64" not in alone and "xxhash64" in several
    assert len(homes) == 2 and not any(path_exists(spark, home) for home in homes)
