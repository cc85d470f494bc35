"""Ranked search, against scores of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np

from orderlens.llm import lexical

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    bags = [(i, terms(t)) for i, t in docs]
    bags = [(i, Counter(x), len(x)) for i, x in bags if x]
    n_docs, all_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, bag, n in bags:
            m = 100 - 25 + 25 * n * n_docs // all_terms
            score = 0
            for t in terms(text):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=str)


def found(spark, docs, items, k=20):
    docs = spark.createDataFrame([(*r, 0, "clash") for r in docs], "doc_id long, text string, key int, items string")
    items = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, item int")
    return sorted((tuple(r) for r in lexical.search(docs.repartition(5), items, k).collect()), key=str)


def made(seed, n, words):
    rng = random.Random(seed)
    return [" ".join(f"w{int(rng.paretovariate(0.7))}" for _ in range(rng.randint(1, words))) for _ in range(n)]


def test_random_texts(spark):
    docs = list(enumerate(made(1, 300, 60)))
    items = list(enumerate(made(2, 25, 12)))
    assert found(spark, docs, items) == brute(docs, items, 20)
    assert found(spark, docs, items, k=1) == brute(docs, items, 1)


def test_hard_rows(spark):
    docs = [
        (1, "Apple apple-PIE, naïve ÉCLAIR 中文 x1"),
        (2, "apple pie"), (3, "apple pie"), (3, "apple pie"), (None, "apple pie"), (None, None),
        (4, None), (5, ""), (6, " .,;:!? "),
        (7, "apple " * 30_000 + "pie"),
        (8, "y" * 100_000 + " apple"),
        (9, "É é"),
        *[(n, "the same copy of an apple") for n in range(100, 160)],
    ]
    items = [
        (1, "apple pie"), (1, "apple pie"), (2, "Apple apple pie"), (3, None), (4, ""), (5, "nowhere found"),
        (None, "naïve éclair"), (6, "É"), (7, "中文 X1"), (8, "copy"), (9, "y" * 100_000),
    ]
    assert found(spark, docs, items) == brute(docs, items, 20)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs = list(enumerate(made(3, 120, 30)))
    items = list(enumerate(made(4, 12, 8)))
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 100)
    assert found(spark, docs, items) == brute(docs, items, 20)


def test_empty_tables(spark):
    assert found(spark, [], [(1, "apple")]) == []
    assert found(spark, [(1, "apple")], []) == []
    assert found(spark, [(1, None)], [(1, "apple")]) == []


def test_bounds_hold_and_are_tight():
    texts = made(5, 200, 200)
    offsets = np.cumsum([0, *map(len, texts)])
    lengths, rows, hashes, counts = lexical.term_counts(offsets, np.frombuffer("".join(texts).encode(), dtype=np.uint8))
    loose = 0
    for row in range(len(texts)):
        own = hashes[rows == row], counts[rows == row]
        log2, unit, folded = lexical.sketch(*own)
        least = np.min([folded[place] for place in lexical.cells(hashes, log2)], axis=0).astype(int) * unit
        held = np.isin(hashes, own[0])
        truth = np.zeros(len(hashes), dtype=int)
        truth[held] = own[1][np.searchsorted(own[0], hashes[held])]
        assert (least >= truth).all()
        loose += ((least > 0) & ~held).sum()
    assert loose < 0.05 * len(texts) * len(hashes)
