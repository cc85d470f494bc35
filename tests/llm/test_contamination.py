"""Benchmark leaks: planted copies and paraphrases are found, clean documents are left alone."""

import random

import numpy as np
import pytest

from orderlens.llm import contamination
from orderlens.llm.contamination import LeakParams, common_length

FUNCTION = "the of and to in a is that for it".split()


def word(rng):
    return "".join(rng.choice(("ka", "lo", "mi", "re", "tu", "sha", "ven", "dor", "pli", "qua")) for _ in range(rng.randint(2, 4)))


def prose(rng, n):
    return " ".join(rng.choice(FUNCTION) if rng.random() < 0.4 else word(rng) for _ in range(n))


def paraphrase(rng, text):
    """A sixth of the words replaced, some dropped."""
    out = []
    for w in text.split():
        roll = rng.random()
        if roll < 0.12:
            out.append(rng.choice(FUNCTION))
        elif roll > 0.04:
            out.append(w)
    return " ".join(out)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(16, 60))) for i in range(60)]
    docs, truth = [], set()
    for i in range(300):
        text = prose(rng, rng.randint(0, 400))
        if i % 5 == 0:
            item, passage = rng.choice(items)
            passage = passage.upper() if i % 2 else paraphrase(rng, passage)
            text = f"{text[: len(text) // 2]} {passage} {text[len(text) // 2 :]}"
            truth.add((i, item))
        docs.append((i, text))
    return docs, items, truth


def found(spark, docs, items, params=LeakParams()):
    rows = contamination.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), params
    )
    return {(r.doc_id, r.item_id) for r in rows.collect()}


def test_planted_leaks_and_nothing_else(spark, planted):
    docs, items, truth = planted
    assert found(spark, docs, items) == truth


def test_items_by_portions(spark, planted):
    docs, items, truth = planted
    assert found(spark, docs, items, LeakParams(items_at_once=25)) == truth


def test_common_length_is_the_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        item = [rng.randrange(5) for _ in range(rng.randint(1, 12))]
        region = [rng.randrange(6) for _ in range(rng.randint(0, 15))]
        table = np.zeros((len(item) + 1, len(region) + 1), dtype=int)
        for i, a in enumerate(item):
            for j, b in enumerate(region):
                table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
        masks = {}
        for place, w in enumerate(item):
            masks[w] = masks.get(w, 0) | 1 << place
        assert common_length(masks, len(item), region) == table[-1, -1]


def test_singular_vectors(spark, planted):
    """With every direction kept, the space's axes are those of the exact decomposition."""
    docs, items, _ = planted
    params = LeakParams(rank=400, oversample=400)
    few = contamination.items_of(items[:12], params)
    space = contamination.fit(spark.createDataFrame(docs, "doc_id long, text string"), few, params)
    axes = space.axes / space.idf[:, None]
    rank = axes.shape[1]
    assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-4)
    # All passages of the items lie within the space.
    for number in range(12):
        for piece in few.pieces(number, 40):
            row = np.bincount(piece, minlength=len(space.idf)) * space.idf
            assert np.linalg.norm(axes.T @ row) == pytest.approx(np.linalg.norm(row), rel=1e-3)


def test_rows_of_any_kind(spark, planted):
    _, items, _ = planted
    passage = items[0][1]
    rows = [(1, passage, "c"), (1, passage, "c"), (2, None, "c"), (3, "", "c"), (None, passage, "c"), (4, "filler " * 60_000 + passage, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([*items, items[0], (None, passage), (900, None), (901, ""), (902, "of the")], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in contamination.leaks(docs, bench).collect()), key=str)
    assert got == sorted([(1, 0), (1, 0), (None, 0), (4, 0)], key=str)
    kept = contamination.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert contamination.leaks(docs.limit(0), bench).count() == 0
    assert contamination.leaks(docs, bench.limit(0)).count() == 0
    assert contamination.without_leaks(docs, bench.limit(0)).count() == len(rows)


def test_copies_of_items_and_items_on_one_passage(spark, planted):
    """Words that many items share have columns all the same: verbatim and near copies are found under every id."""
    docs, _, _ = planted
    rng = random.Random(8)
    copy, passage = prose(rng, 30), prose(rng, 50)
    items = [(i, copy if i % 2 else copy.upper()) for i in range(8)]
    items += [(i, f"{passage} {word(rng)} {word(rng)}") for i in range(10, 18)]
    near = " ".join(w for n, w in enumerate(passage.split()) if n % 9)
    own = [(1000, f"{prose(rng, 60)} {copy} {prose(rng, 60)}"), (1001, f"{prose(rng, 60)} {near} {prose(rng, 60)}")]
    truth = {(1000, i) for i in range(8)} | {(1001, i) for i in range(10, 18)}
    assert found(spark, docs + own, items) == truth


def test_items_of_common_words(spark):
    """Items made of words that most items and documents hold have no columns but in a space of their own."""
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice(FUNCTION) for _ in range(24))) for i in range(12)]
    docs = [(i, prose(rng, 200)) for i in range(80)]
    docs += [(100 + i, f"{prose(rng, 40)} {text} {prose(rng, 40)}") for i, (_, text) in enumerate(items)]
    got = found(spark, docs, items)
    assert {(100 + i, i) for i in range(12)} <= got


def test_short_items_are_found_word_by_word(spark, planted):
    _, items, _ = planted
    short = [(500, "Quavenlo karetu"), (501, "who wrote the shadorpli of venka"), (502, "shadorpli"), (503, "quavenlo karetu")]
    docs = [
        (1, "so quavenlo KARETU it is"),
        (2, "quavenlo of karetu"),
        (3, "and who wrote the shadorpli of venka"),
        (4, "quavenlo"),
        (5, "karetu"),
    ]
    assert found(spark, docs, items + short) == {(1, 500), (1, 503), (3, 501), (3, 502)}
    assert found(spark, docs, short) == {(1, 500), (1, 503), (3, 501), (3, 502)}


def test_common_words_are_counted_in_all_rows(spark):
    """A word of most rows is common, also where no row that a hash of it would draw holds it."""
    ids = spark.range(150_000).withColumnRenamed("id", "doc_id")
    drawn = "pmod(xxhash64(doc_id, text), 6)"
    held = ids.selectExpr("doc_id", "'quavenlo' as text").where(f"{drawn} IN (1, 5)")
    rest = ids.selectExpr("doc_id", "'karetu' as text").where(f"{drawn} = 0")
    items = contamination.sequences_of([(i, f"quavenlo item{i}") for i in range(8)])
    shared = contamination.sequences_of([(0, "quavenlo")])[0][1]
    assert contamination.common_words(held.unionByName(rest), items, LeakParams()).tolist() == shared.tolist()


@pytest.mark.parametrize("size", [0, 1, 2, 5000])
def test_places_are_those_of_a_search(size, monkeypatch):
    rng = np.random.default_rng(size)
    vocabulary = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
    ends = np.array([0, 1, (1 << 64) - 1], dtype=np.uint64)
    if size > 2:  # many words that share their leading bits, and both ends of the range
        vocabulary = np.unique(np.concatenate([vocabulary, vocabulary[7] + np.arange(50, dtype=np.uint64), ends]))
    hashes = np.concatenate([vocabulary, vocabulary + np.uint64(1), vocabulary - np.uint64(1), ends, rng.integers(0, 1 << 64, 9000, dtype=np.uint64)])
    wanted = {h: n for n, h in enumerate(vocabulary.tolist())}
    searched, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *rest: searched.append(v) or search(a, v, *rest))
    assert contamination.places(vocabulary, hashes).tolist() == [wanted.get(h, -1) for h in hashes.tolist()]
    assert not any(v is hashes for v in searched)
