"""Neighbours against an exact search."""

import numpy as np
import pytest

from orderlens.llm import hnsw
from orderlens.llm.hnsw import GraphParams
from orderlens.session import staged

SCHEMA = "vec_id long, embedding array<float>, score int"


def search(spark, rows, params=GraphParams(), k=10, every=10):
    table = hnsw.usable(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA))
    graphs = staged(hnsw.index(table, params, k), "graphs")
    found = hnsw.search(graphs, table.where(f"vec_id % {every} = 0"), k, params).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return got


def exact(rows, query_id, k=10):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], dtype=np.float32).astype(float)
    apart = np.sqrt(((vectors - vectors[ids == query_id][0]) ** 2).sum(axis=1))
    keep = ids != query_id
    order = np.lexsort((ids[keep], apart[keep]))[:k]
    return ids[keep][order].tolist(), apart[keep][order]


@pytest.fixture(scope="module")
def vectors():
    random = np.random.default_rng(2)
    centres = random.normal(size=(12, 24))
    return [(i, (centres[i % 12] + random.normal(size=24) * 0.4).astype(np.float32).tolist()) for i in range(2500)]


@pytest.mark.parametrize("shard_rows", [400, 10_000])
def test_recall_and_exact_scores(spark, vectors, shard_rows):
    got = search(spark, vectors, GraphParams(shard_rows=shard_rows, query_block=37))
    assert len(got) == 250
    hits = 0
    by_id = dict(vectors)
    for query, found in got.items():
        ids, _ = exact(vectors, query)
        assert [rank for rank, _, _ in found] == list(range(1, 11))
        hits += len({v for _, v, _ in found} & set(ids))
        keys = [(score, vec) for _, vec, score in found]
        assert keys == sorted(keys)
        for _, vec, score in found[:2]:
            a, b = (np.array(by_id[x], dtype=np.float32).astype(float) for x in (query, vec))
            assert score == pytest.approx(np.sqrt(((a - b) ** 2).sum()), rel=1e-12)
    assert hits / 2500 > 0.95


def test_equal_vectors_go_by_id(spark):
    random = np.random.default_rng(0)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(200)] + [(i, random.normal(size=4).tolist()) for i in range(200, 260)]
    got = search(spark, rows)
    assert [v for _, v, _ in got[0]] == list(range(1, 11)) and {s for _, _, s in got[0]} == {0.0}
    assert [v for _, v, _ in got[10]] == list(range(10))


def test_rows_of_any_kind(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, []), (8, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]), (10, [2.0, 0.0]), (10, [2.0, 0.0])]
    got = search(spark, rows)
    assert got == {
        0: [(1, 10, 1.0), (2, 1, pytest.approx(2**0.5))],
        10: [(1, 0, 1.0), (2, 1, pytest.approx(5**0.5))],
    }
    assert search(spark, rows[:1]) == {}
    assert search(spark, []) == {}


@pytest.mark.parametrize("scale", [1e20, 1e-25, 1e150])
def test_any_magnitude(spark, scale):
    """Vectors in double precision whose squares leave the range of single precision."""
    random = np.random.default_rng(3)
    rows = [(i, (random.normal(size=6) * scale).tolist()) for i in range(60)]
    table = hnsw.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    found = hnsw.search(staged(hnsw.index(table)), table.where("vec_id % 10 = 0")).collect()
    vectors = np.array([v for _, v in rows])
    for query in range(0, 60, 10):
        apart = np.sqrt((((vectors - vectors[query]) / scale) ** 2).sum(axis=1))
        want = [i for i in np.argsort(apart, kind="stable") if i != query][:10]
        got = sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])
        assert [r.vec_id for r in got] == want
        assert [r.score for r in got] == pytest.approx((apart[want] * scale).tolist(), rel=1e-9)
