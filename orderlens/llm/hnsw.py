"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are one node. Nodes are dealt to shards of bounded size; a task builds the graph of its
shard in batches of insertions and stores it as flat arrays: neighbour ids of the ground layer and of
each upper layer. Blocks of queries visit every shard, and the shards' nearest are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from orderlens.llm.common import mix64


@dataclass(frozen=True)
class GraphParams:
    """``links`` per node on upper layers, twice as many on the ground; ``build_beam`` and
    ``search_beam`` are the candidates kept while inserting and searching."""

    links: int = 12
    build_beam: int = 48
    search_beam: int = 128
    shard_rows: int = 8192
    query_block: int = 512
    batch: int = 256


class Graph:
    """Graph of one shard: ``vectors`` (n, d), ``layers`` of flat neighbour arrays (-1: none), ``entry``."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int):
        self.vectors, self.layers, self.entry = vectors, layers, entry

    def nearest(self, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Node numbers and squared distances, (q, beam) each, nearest first; -1 and inf where there are fewer."""
        start = np.full((len(queries), 1), self.entry, dtype=np.int64)
        for layer in self.layers[:0:-1]:
            start = _beam(self.vectors, layer, queries, start, 1)[0]
        return _beam(self.vectors, self.layers[0], queries, start, max(beam, k))


def _distances(vectors: np.ndarray, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own row of nodes; inf for -1."""
    apart = vectors[np.maximum(nodes, 0)] - queries[:, None, :]
    found = np.einsum("qnd,qnd->qn", apart, apart)
    found[nodes < 0] = np.inf
    return found


def _beam(vectors, links, queries, start, beam: int, expand: int = 4):
    """Best-first search on one layer for all queries at once, ``expand`` nodes of each beam at a time."""
    q = len(queries)
    rows = np.arange(q)[:, None]
    seen = np.zeros((q, len(vectors) + 1), dtype=bool)  # the last column takes the -1
    seen[rows, start] = True
    nodes = np.full((q, beam), -1, dtype=np.int64)
    far = np.full((q, beam), np.inf, dtype=vectors.dtype)
    open_ = np.zeros((q, beam), dtype=bool)
    first = start[:, :beam]
    width = first.shape[1]
    nodes[:, :width] = first
    far[:, :width] = _distances(vectors, queries, first)
    open_[:, :width] = first >= 0
    order = np.argsort(far, axis=1, kind="stable")
    nodes, far, open_ = (np.take_along_axis(a, order, 1) for a in (nodes, far, open_))
    expand = min(expand, beam)
    active = np.arange(q)
    while len(active):
        # The nearest unexpanded nodes of every query that still has some.
        waiting = open_[active]
        rank = np.cumsum(waiting, axis=1)
        pick = waiting & (rank <= expand)
        alive = pick.any(axis=1)
        active, pick = active[alive], pick[alive]
        if not len(active):
            break
        own = np.full((len(active), expand), -1, dtype=np.int64)
        r, c = np.nonzero(pick)
        own[r, rank[alive][r, c] - 1] = nodes[active[r], c]
        open_[active[r], c] = False
        near = np.where(own[:, :, None] >= 0, links[np.maximum(own, 0)], -1).reshape(len(active), -1)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[active[:, None], near]] = -1
        seen[active[:, None], near] = True
        seen[:, -1] = False
        there = _distances(vectors, queries[active], near)
        all_nodes = np.concatenate([nodes[active], near], axis=1)
        all_far = np.concatenate([far[active], there], axis=1)
        all_open = np.concatenate([open_[active], near >= 0], axis=1)
        order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
        nodes[active] = np.take_along_axis(all_nodes, order, 1)
        far[active] = np.take_along_axis(all_far, order, 1)
        open_[active] = np.take_along_axis(all_open, order, 1)
    nodes[~np.isfinite(far)] = -1
    return nodes, far


def _diverse(vectors, base, candidates, far, most: int) -> np.ndarray:
    """Of each row's candidates, nearest first, those nearer to the base than to any chosen before; then the rest."""
    count, width = candidates.shape
    points = vectors[np.maximum(candidates, 0)]
    squares = np.einsum("cnd,cnd->cn", points, points)
    between = squares[:, :, None] + squares[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
    chosen = np.zeros((count, width), dtype=bool)
    taken = np.zeros(count, dtype=int)
    for j in range(width):
        blocked = (chosen & (between[:, j, :] < far[:, j, None])).any(axis=1)
        good = (candidates[:, j] >= 0) & (candidates[:, j] != base) & ~blocked & (taken < most)
        chosen[:, j] = good
        taken += good
    usable = (candidates >= 0) & (candidates != base[:, None])
    rank = np.where(chosen, 0, np.where(usable, 1, 2)) * width + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :most]
    kept = np.take_along_axis(candidates, order, 1)
    kept[np.take_along_axis(rank, order, 1) >= 2 * width] = -1
    if kept.shape[1] < most:
        kept = np.pad(kept, ((0, 0), (0, most - kept.shape[1])), constant_values=-1)
    return kept


def _link_back(vectors, links, new: np.ndarray, most: int) -> None:
    """Add the reverse of the new nodes' links; a full list is chosen anew from old and new together."""
    source = np.repeat(new, links.shape[1])
    target = links[new].ravel()
    there = target >= 0
    source, target = source[there], target[there]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    touched, begin, count = np.unique(target, return_index=True, return_counts=True)
    if not len(touched):
        return
    added = np.full((len(touched), int(count.max())), -1, dtype=np.int64)
    slot = np.arange(len(target)) - np.repeat(begin, count)
    added[np.repeat(np.arange(len(touched)), count), slot] = source
    both = np.sort(np.concatenate([links[touched], added], axis=1), axis=1)
    both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
    for part in range(0, len(touched), 512):  # bounds the distances held at once
        rows = slice(part, part + 512)
        far = _distances(vectors, vectors[touched[rows]], both[rows])
        order = np.argsort(far, axis=1, kind="stable")[:, : most + most // 2]
        links[touched[rows]] = _diverse(
            vectors,
            touched[rows],
            np.take_along_axis(both[rows], order, 1),
            np.take_along_axis(far, order, 1),
            most,
        )


def build(vectors: np.ndarray, params: GraphParams = GraphParams(), seed: int = 0) -> Graph:
    """Insert all vectors, batch by batch. Nodes of one batch meet through a direct comparison of the batch."""
    n = len(vectors)
    draws = (mix64(np.arange(n, dtype=np.uint64) + np.uint64(seed * 2**20 + 1)) >> np.uint64(11)).astype(float) / 2**53
    level = np.floor(-np.log(np.maximum(draws, 1e-18)) / np.log(params.links)).astype(int)
    if n:
        level[0] = max(level.max(), 0)
    widths = [2 * params.links] + [params.links] * (int(level[0]) if n else 0)
    layers = [np.full((n, width), -1, dtype=np.int64) for width in widths]
    done = min(1, n)
    while done < n:
        new = np.arange(done, min(n, done + min(params.batch, max(1, done))))
        queries = vectors[new]
        start = np.zeros((len(new), 1), dtype=np.int64)
        for number in range(len(layers) - 1, -1, -1):
            on = level[new] >= number
            wide = params.build_beam if on.any() else 1
            nodes, far = _beam(vectors, layers[number], queries, start, wide)
            if on.any():
                own = new[on]
                same = np.broadcast_to(own, (len(own), len(own)))
                apart = _distances(vectors, vectors[own], same)
                apart[np.arange(len(own)), np.arange(len(own))] = np.inf
                close = np.argsort(apart, axis=1, kind="stable")[:, : params.build_beam]
                mates = np.take_along_axis(same, close, 1).copy()
                mates_far = np.take_along_axis(apart, close, 1)
                mates[~np.isfinite(mates_far)] = -1
                all_nodes = np.concatenate([nodes[on], mates], axis=1)
                all_far = np.concatenate([far[on], mates_far], axis=1)
                order = np.argsort(all_far, axis=1, kind="stable")[:, : params.build_beam]
                most = widths[number]
                layers[number][own] = _diverse(
                    vectors,
                    own,
                    np.take_along_axis(all_nodes, order, 1),
                    np.take_along_axis(all_far, order, 1),
                    most,
                )
                _link_back(vectors, layers[number], own, most)
            start = np.where(nodes[:, :4] >= 0, nodes[:, :4], 0)
            start = np.sort(start, axis=1)
        done += len(new)
    return Graph(vectors, layers, 0)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, vec``: vectors that are not null, not all zero, and have finite components only.

    Each keeps its own length; vectors of different lengths never meet. Rows without an id are left out.
    """
    vec = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"))
    own = F.col("vec")
    finite = F.forall(own, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("vec_id").isNotNull() & own.isNotNull()).where(
        finite & F.exists(own, lambda x: x != F.lit(0.0))
    )


def nodes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector with its ``k + 1`` smallest ids.

    No answer of ``k`` neighbours, ties to the smaller id and the query itself left out, needs more of
    them. The limit is applied in each task before the shuffle, so a common vector stays small.
    """
    same = W.partitionBy("vec").orderBy("vec_id")
    first = rows.withColumn("turn", F.row_number().over(same)).where(F.col("turn") <= k + 1)
    return first.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


INDEX = "shard long, dim int, ids binary, offsets binary, vectors binary, layers array<binary>, entry long, n long"


def scaled(some: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """``some`` in single precision, with the largest component of ``vectors`` as the unit: neither squares of
    large components overflow nor do those of small ones vanish. What lies far outside is put at the rim."""
    unit = np.abs(vectors).max()
    with np.errstate(over="ignore"):
        return np.clip(some / unit, -1e15, 1e15).astype(np.float32)


def index(rows: DataFrame, params: GraphParams = GraphParams(), k: int = 10) -> DataFrame:
    """``INDEX``: a row per shard, the graph in flat arrays. ``rows`` as ``usable`` gives them."""
    distinct = nodes(rows, k).withColumn("dim", F.size("vec"))
    # About shard_rows nodes to a shard at any size; one small count per vector length.
    counts = {row["dim"]: row["n"] for row in distinct.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    shards = F.lit(1)
    for dim, n in counts.items():
        shards = F.when(F.col("dim") == dim, -(-n // params.shard_rows)).otherwise(shards)
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64("vec"), shards.cast("long")))

    def of_shard(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        lists = table.column("vec").combine_chunks()
        dim = int(key[1].as_py())
        vectors = np.asarray(lists.flatten()).reshape(-1, dim)
        ids = table.column("ids").combine_chunks()
        flat, offsets = np.asarray(ids.flatten()), np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths()))])
        # The order of insertion must not depend on how rows arrived.
        order = np.argsort(flat[offsets[:-1]], kind="stable")
        groups = [flat[offsets[i] : offsets[i + 1]] for i in order]
        vectors = vectors[order]
        graph = build(scaled(vectors, vectors), params)
        return pa.table(
            {
                "shard": pa.array([key[0].as_py()], pa.int64()),
                "dim": pa.array([dim], pa.int32()),
                "ids": [np.concatenate(groups).astype(np.int64).tobytes()],
                "offsets": [np.concatenate([[0], np.cumsum([len(g) for g in groups])]).astype(np.int64).tobytes()],
                "vectors": [vectors.tobytes()],
                "layers": pa.array([[layer.astype(np.int32).tobytes() for layer in graph.layers]], pa.list_(pa.binary())),
                "entry": pa.array([graph.entry], pa.int64()),
                "n": pa.array([len(vectors)], pa.int64()),
            }
        )

    return dealt.select("shard", "dim", "vec", "ids").groupBy("shard", "dim").applyInArrow(of_shard, INDEX)


def _blocks(queries: DataFrame, params: GraphParams) -> DataFrame:
    """Queries in blocks: ``dim, block, query_ids, vectors`` (flat)."""
    counts = {
        row["dim"]: row["n"]
        for row in queries.withColumn("dim", F.size("vec")).groupBy("dim").agg(F.count("*").alias("n")).collect()
    }
    blocks = F.lit(1)
    for dim, n in counts.items():
        blocks = F.when(F.col("dim") == dim, -(-n // params.query_block)).otherwise(blocks)
    return (
        queries.withColumn("dim", F.size("vec"))
        # By id and vector: not even a third of the queries with one id or vector fall into one block.
        .withColumn("block", F.pmod(F.xxhash64("vec_id", "vec"), blocks.cast("long")))
        .groupBy("dim", "block")
        .agg(F.collect_list(F.struct("vec_id", "vec")).alias("queries"))
        .select(
            "dim", "block", F.col("queries.vec_id").alias("query_ids"), F.flatten(F.col("queries.vec")).alias("asked")
        )
    )


def search(
    graphs: DataFrame, queries: DataFrame, k: int = 10, params: GraphParams = GraphParams()
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found, by distance in double precision, then id.

    ``graphs`` (see ``index``) is read for the list of shards and again for the search: stage it.
    """
    shards = graphs.groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    # Every block goes to every shard of its length: one small row per block and shard.
    visits = _blocks(queries, params).join(shards, "dim").withColumn("shard", F.explode("shards")).drop("shards")
    pairs = visits.join(graphs, ["dim", "shard"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row] for name in batch.schema.names}
                found = _answer(one, k, params)
                if found is not None:
                    yield found

    nearest = pairs.select(
        "dim", "query_ids", "asked", "ids", "offsets", "vectors", "layers", "entry", "n"
    ).mapInArrow(visit, "query_id long, vec_id long, score double")
    best = W.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        nearest.distinct()
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _answer(one: dict, k: int, params: GraphParams) -> pa.RecordBatch | None:
    dim, n = one["dim"].as_py(), one["n"].as_py()
    flat = np.frombuffer(one["ids"].as_py(), dtype=np.int64)
    offsets = np.frombuffer(one["offsets"].as_py(), dtype=np.int64)
    vectors = np.frombuffer(one["vectors"].as_py(), dtype=np.float64).reshape(n, dim)
    layers = [np.frombuffer(layer.as_py(), dtype=np.int32).reshape(n, -1) for layer in one["layers"]]
    asked = np.asarray(one["asked"].values).reshape(-1, dim)
    graph = Graph(scaled(vectors, vectors), layers, one["entry"].as_py())
    reached, _ = graph.nearest(scaled(asked, vectors), k + 1, params.search_beam)
    query_ids = np.asarray(one["query_ids"].values)
    # Only the nodes found count, but in double precision, with all their ids.
    out_q, out_v, out_s = [], [], []
    for number, query in enumerate(query_ids):
        near = reached[number][reached[number] >= 0]
        apart = vectors[near] - asked[number]
        score = np.sqrt(np.einsum("nd,nd->n", apart, apart))
        sizes = offsets[near + 1] - offsets[near]
        ids = np.concatenate([flat[offsets[i] : offsets[i + 1]] for i in near]) if len(near) else flat[:0]
        score = np.repeat(score, sizes)
        other = ids != query
        ids, score = ids[other], score[other]
        order = np.lexsort((ids, score))[:k]
        out_q.append(np.full(len(order), query))
        out_v.append(ids[order])
        out_s.append(score[order])
    if not out_q:
        return None
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate(out_q), pa.int64()),
            pa.array(np.concatenate(out_v), pa.int64()),
            pa.array(np.concatenate(out_s), pa.float64()),
        ],
        names=["query_id", "vec_id", "score"],
    )


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact answers that were found, by query and id."""
    hits = exact.select("query_id", "vec_id").intersect(found.select("query_id", "vec_id")).count()
    return hits / max(1, exact.select("query_id", "vec_id").distinct().count())
