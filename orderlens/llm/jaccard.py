"""Set-similarity join of documents on word shingles: size-aware, small sets by subsets, large ones by lists.

Two sets of n and m shingles reach the similarity only if they share c(n, m) shingles. Small sets are
listed under each of their subsets of that size, so any two on one list are linked. Large sets are
listed under their first shingles in one global order: enough of them that two similar sets meet on a
list. The size up to which a set counts as small is the one at which the estimated rows of both ways
cost least. Any global order gives the same links; here shingles that very many sets hold come last,
so that what thousands of documents have in common does not bring them together.

Equal sets are one set, known by a 64-bit signature (10^8 sets agree by chance with odds of 3 in
10,000; a clash of sizes or second signatures is an error, not a wrong link). A candidate pair is
counted by its shared list entries, dropped if even the most it could share is too little, and else
compared whole.

Lists longer than ``long_list``, as a large group of near copies makes them, and those of common shingles
are not paired off. Each member is compared with one central set, then with a few drawn ones, and connected
sets become one component; of the pairs that are left every one is looked at that two bounds allow. Sets
that meet on the list of a common shingle have all their other shingles listed too, so a pair that shares
one of those is already known, and any other shares no more than common shingles: those up to the place
where they meet, and those behind. And what both have at different distances from the central set, by more
than similar sets can differ, is not similar (the Jaccard distance is a metric).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from orderlens.llm.common import SMALL_ROWS, components, joined_components, mix64, text_parts, whole, words_of
from orderlens.session import drop, shuffles_dropped, staged, staged_at


@dataclass(frozen=True)
class JoinParams:
    """``percent`` is the similarity; ``common_from`` about how many sets must hold a shingle for it to come
    last in the order; ``most_common`` bounds the number of such shingles, which every task gets (8 bytes
    each): with more, the number of sets asked for rises. Neither changes a result."""

    words: int = 5
    percent: int = 80
    common_from: int = 64
    most_common: int = 2_000_000
    long_list: int = 256
    largest_small: int = 12


def needed(n, m, percent: int):
    """Least shared shingles of similar sets of n and m."""
    return -(-percent * (n + m) // (100 + percent))


def shortest(n, percent: int):
    """Least size of a set similar to one of n."""
    return -(-percent * n // 100)


def light_rows(n: int, percent: int, largest: int) -> int:
    """List entries of a small set of n under subsets, for partners of up to ``largest``."""
    top = min(largest, n * 100 // percent)
    return sum(comb(n, needed(n, m, percent)) for m in range(shortest(n, percent), top + 1))


def boundary(sizes: dict[int, int], list_length: float, params: JoinParams) -> int:
    """Largest size that is cheaper by subsets. A list entry by its first shingles costs its list's length too."""
    best, at = None, 0
    for largest in range(params.largest_small + 1):
        cost = 0.0
        for n, count in sizes.items():
            listed = n - shortest(n, params.percent) + 1
            if n <= largest:
                cost += count * light_rows(n, params.percent, largest)
            if n > largest or n >= shortest(largest + 1, params.percent):
                cost += count * listed * (1 + list_length)
        if best is None or cost < best:
            best, at = cost, largest
    return at


class Sets:
    """Distinct shingle hashes of joined texts: ``values`` ordered by row and hash, ``edges`` by row."""

    def __init__(self, offsets: np.ndarray, raw: np.ndarray, words: int):
        count = len(offsets) - 1
        rows, hashes, _ = words_of(offsets, raw)
        per_row = np.bincount(rows, minlength=count)
        step = np.uint64(0xD6E8FEB86659FD93)
        total = np.zeros(max(0, len(rows) - words + 1), dtype=np.uint64)
        for k in range(words):
            total = total * step + hashes[k : k + len(total)]
        whole_row = rows[: len(total)] == rows[words - 1 : words - 1 + len(total)]
        values, owner = mix64(total[whole_row]), rows[: len(total)][whole_row]
        short = np.flatnonzero((per_row > 0) & (per_row < words))
        for length in range(1, words):
            some = short[per_row[short] == length]
            begin = np.searchsorted(rows, some)
            extra = np.full(len(some), length, dtype=np.uint64)
            for k in range(length if len(some) else 0):
                extra = extra * step + hashes[begin + k]
            values, owner = np.concatenate([values, mix64(extra)]), np.concatenate([owner, some])
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        fresh = np.ones(len(values), dtype=bool)
        fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        self.values, self.owner = values[fresh], owner[fresh]
        self.sizes = np.bincount(self.owner, minlength=count)
        self.edges = np.concatenate([[0], np.cumsum(self.sizes)])
        self.signature, self.second = (
            mix64(self._sums(mix64(self.values ^ np.uint64(salt))) + self.sizes.astype(np.uint64)).view(np.int64)
            for salt in (0x243F6A8885A308D3, 0x13198A2E03707344)
        )

    def _sums(self, values: np.ndarray) -> np.ndarray:
        running = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])
        return running[self.edges[1:]] - running[self.edges[:-1]]


def _each(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.Array, Sets]]:
    for batch in batches:
        for first, last, offsets, raw in text_parts(batch.column(1)):
            yield batch.column(0).slice(first, last - first), Sets(offsets, raw, words)


def _counted_sets(params: JoinParams) -> int:
    """Shingles are counted over one set in so many, known by its signature: one of ``common_from`` sets is met about
    four times, however many documents there are."""
    return max(1, params.common_from // 4)


def signatures(docs: DataFrame, params: JoinParams) -> DataFrame:
    """``doc_id, n_shingles, signature, second, shingles``; ``shingles``: the set, where it is to be counted (see
    ``_counted_sets``), once in a block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = np.uint64(_counted_sets(params))
        for ids, sets in _each(batches, params.words):
            once = np.zeros(len(ids), dtype=bool)
            once[np.unique(sets.signature, return_index=True)[1]] = True
            counted = once & (sets.sizes > 0) & (sets.signature.view(np.uint64) % share == 0)
            ends = np.concatenate([[0], np.cumsum(np.where(counted, sets.sizes, 0))]).astype(np.int32)
            flat = sets.values[counted[sets.owner]].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(sets.sizes, pa.int64()),
                    pa.array(sets.signature),
                    pa.array(sets.second),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                names=["doc_id", "n_shingles", "signature", "second", "shingles"],
            )

    return docs.mapInArrow(work, "doc_id long, n_shingles long, signature long, second long, shingles array<long>")


def _common_shingles(light: DataFrame, params: JoinParams) -> tuple[np.ndarray, float]:
    """Shingles of about ``common_from`` sets or more (sorted), and the mean length of a list of first shingles.

    The order they are put in is all that the counted sets decide: any order gives the same links. Which number of
    sets makes a shingle common depends on how many shingles have it, not on the size of the input.
    """
    share = _counted_sets(params)
    counted = light.where(F.size("shingles") > 0).select("signature", "shingles").dropDuplicates(["signature"])
    found = counted.select(F.explode("shingles").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    counts = staged(found.where("n > 1"), "shared-shingles")
    by_count = sorted(map(tuple, counts.groupBy("n").agg(F.count("*").alias("tokens")).collect()), reverse=True)
    least, taken = -(-params.common_from // share), 0
    for n, tokens in by_count:
        taken += tokens
        if taken > params.most_common:
            least = max(least, n + 1)
            break
    common = counts.where(F.col("n") >= least).select("token").toArrow()
    total = counted.agg(F.sum(F.size("shingles")).alias("n")).first()["n"] or 0
    # For each shingle of a counted set, the other sets that hold it.
    others = share * sum(tokens * n * (n - 1) for n, tokens in by_count if n < least)
    found = np.asarray(common.column("token").combine_chunks(), dtype=np.int64) if common.num_rows else np.zeros(0, np.int64)
    return np.sort(found.view(np.uint64)), others / max(1, total)


def entries(docs: DataFrame, params: JoinParams, common: np.ndarray, small: int, on_common: bool) -> DataFrame:
    """``token, signature, n, place, full, early``: the list entries of every set, each set once in a task.

    ``place`` is the shingle's position in the set's order, 0 for a subset of a small set; ``early`` how many
    uncommon shingles the set has. ``full``: all its first shingles are uncommon. Entries under common
    shingles, or the others, as asked.
    """
    shared = docs.sparkSession.sparkContext.broadcast(common.tobytes())
    percent = params.percent

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = np.frombuffer(shared.value, dtype=np.uint64)
        seen: set[int] = set()
        for _, sets in _each(batches, params.words):
            fresh = np.zeros(len(sets.sizes), dtype=bool)
            for row, (signature, n) in enumerate(zip(sets.signature.tolist(), sets.sizes.tolist(), strict=True)):
                if n and signature not in seen:
                    seen.add(signature)
                    fresh[row] = True
            # A bounded memory of what was seen: a copy listed twice only costs a row.
            if len(seen) > 1_000_000:
                seen.clear()
            sizes = sets.sizes
            listed = np.where(sizes > 0, sizes - shortest(sizes, percent) + 1, 0)
            listed[(sizes < shortest(small + 1, percent)) | ~fresh] = 0
            late = np.zeros(len(sets.values), dtype=bool)
            if len(common):
                at = np.searchsorted(common, sets.values)
                late = common[np.minimum(at, len(common) - 1)] == sets.values
            order = np.lexsort((sets.values, late, sets.owner))
            owner, late = sets.owner[order], late[order]
            place = np.arange(len(order)) - sets.edges[owner] + 1
            early = np.bincount(owner[~late], minlength=len(sizes))
            take = (place <= listed[owner]) & (late == on_common)
            token = sets.values[order][take]
            owner, place = owner[take], place[take]
            if small and not on_common:
                subset, whose = _subsets(sets, np.flatnonzero(fresh & (sizes <= small)), small, percent)
                token, owner = np.concatenate([token, subset]), np.concatenate([owner, whose])
                place = np.concatenate([place, np.zeros(len(subset), dtype=place.dtype)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(token.view(np.int64)),
                    pa.array(sets.signature[owner]),
                    pa.array(sizes[owner].astype(np.int32)),
                    pa.array(place.astype(np.int32)),
                    pa.array((early >= listed)[owner]),
                    pa.array(early[owner].astype(np.int32)),
                ],
                names=["token", "signature", "n", "place", "full", "early"],
            )

    return docs.mapInArrow(work, "token long, signature long, n int, place int, full boolean, early int")


def _subsets(sets: Sets, rows: np.ndarray, small: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    keys, owners = [], []
    for row in rows:
        values = sets.values[sets.edges[row] : sets.edges[row + 1]]
        n = len(values)
        for m in range(shortest(n, percent), min(small, n * 100 // percent) + 1):
            sizes = np.uint64(min(n, m) << 32 | max(n, m))
            for some in combinations(range(n), needed(n, m, percent)):
                with np.errstate(over="ignore"):
                    key = mix64(values[list(some)] + sizes).sum(dtype=np.uint64)
                keys.append(key)
                owners.append(row)
    return mix64(np.array(keys, dtype=np.uint64)), np.array(owners, dtype=np.int64)


PAIRS = "a long, b long, na int, nb int, shared int, place_a int, place_b int, full boolean, long_token long"


def _list_pairs(rows: DataFrame, params: JoinParams) -> DataFrame:
    """``PAIRS`` of the lists, and the entries of long lists as they are (``long_token``, ``a``, ``na``, ``place_a``).

    Lists lie whole in a partition of entries. A pair is counted with the last shingle it shares.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [batch for batch in batches if batch.num_rows]
        if not parts:
            return
        whole_part = pa.Table.from_batches(parts)
        token, who, n, place, full = (whole_part.column(i).to_numpy() for i in range(5))
        order = np.lexsort((who, n, token))
        again = np.zeros(len(order), dtype=bool)
        t, w = token[order], who[order]
        again[1:] = (t[1:] == t[:-1]) & (w[1:] == w[:-1])  # a set that two tasks listed
        order = order[~again]
        t = token[order]
        fresh = np.concatenate([[True], t[1:] != t[:-1]])
        begin = np.flatnonzero(fresh)
        length = np.diff(np.append(begin, len(t)))
        far = np.repeat(length > params.long_list, length)
        rows = order[far]
        empty = np.zeros(len(rows), dtype=np.int64)
        for start in range(0, len(rows), 100_000):
            some = rows[start : start + 100_000]
            none = empty[: len(some)]
            yield _pairs_batch(who[some], none, n[some], none, none, place[some], none, none > 0, token[some])
        keep = np.repeat((length > 1) & (length <= params.long_list), length)
        order, number = order[keep], np.repeat(np.arange(len(begin)), length)[keep]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        step = 1
        while True:  # members of a list that are ``step`` apart
            left = np.flatnonzero(number[:-step] == number[step:]) if len(number) > step else np.zeros(0, dtype=np.int64)
            if not len(left):
                break
            a, b = order[left], order[left + step]
            fit = n[a] >= shortest(n[b].astype(np.int64), params.percent)
            fit &= who[a] != who[b]
            found.append((a[fit], b[fit]))
            held += int(fit.sum())
            if held > 1_000_000:
                yield from _counted(found, who, n, place, full, whole=False)
                found, held = [], 0
            step += 1
        if found:
            yield from _counted(found, who, n, place, full, whole=True)

    return rows.mapInArrow(work, PAIRS)


def _pairs_batch(a, b, na, nb, shared, place_a, place_b, full, token) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.bool_(), pa.int64()]
    columns = [a, b, na, nb, shared, place_a, place_b, full]
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(columns, kinds, strict=False)]
        + [pa.nulls(len(a), pa.int64()) if token is None else pa.array(token, pa.int64())],
        names=["a", "b", "na", "nb", "shared", "place_a", "place_b", "full", "long_token"],
    )


def _counted(found, who, n, place, full, whole: bool) -> Iterator[pa.RecordBatch]:
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    turn = who[a] > who[b]
    a, b = np.where(turn, b, a), np.where(turn, a, b)
    order = np.lexsort((place[a], who[b], who[a]))
    a, b = a[order], b[order]
    if not len(a):
        return
    fresh = np.concatenate([[True], (who[a][1:] != who[a][:-1]) | (who[b][1:] != who[b][:-1])])
    begin = np.flatnonzero(fresh)
    last = np.append(begin[1:], len(a)) - 1
    shared = last - begin + 1
    a, b = a[last], b[last]
    for start in range(0, len(a), 100_000):
        s = slice(start, start + 100_000)
        yield _pairs_batch(
            who[a[s]], who[b[s]], n[a[s]], n[b[s]], shared[s], place[a[s]], place[b[s]], full[a[s]] & full[b[s]], None
        )


def _could_link(pairs: DataFrame, params: JoinParams) -> DataFrame:
    """Pairs that may share enough: what they share on lists, and what may follow.

    After the last shared entry no more can follow than either set has left. And after the earlier end of
    both sets' first shingles no more than that set's rest; of two complete listings, the larger rest.
    """
    counted = pairs.groupBy("a", "b", "na", "nb").agg(
        F.sum("shared").alias("shared"),
        F.max("place_a").alias("place_a"),
        F.max("place_b").alias("place_b"),
        F.min("place_a").alias("least"),
        F.min("full").alias("full"),
    )
    rest = F.least(F.col("na") - F.col("place_a"), F.col("nb") - F.col("place_b"))
    behind = F.greatest(*(F.floor(F.col(n) * params.percent / 100) for n in ("na", "nb")))
    most = F.col("shared") + F.when(F.col("full"), F.least(rest, behind)).otherwise(rest)
    need = F.ceil((F.col("na") + F.col("nb")) * params.percent / (100 + params.percent) - 1e-9)
    # Pairs from subsets of small sets (place 0) are as good as linked.
    return counted.where((F.col("least") == 0) | (most >= need)).select("a", "b")


def shingle_sets(docs: DataFrame, params: JoinParams) -> DataFrame:
    """``signature, shingles``: the whole set of each document, equal sets of a block once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _each(batches, params.words):
            _, rows = np.unique(sets.signature, return_index=True)
            rows = rows[sets.sizes[rows] > 0]
            for start in range(0, len(rows), 2000):
                some = rows[start : start + 2000]
                values = [sets.values[sets.edges[r] : sets.edges[r + 1]] for r in some]
                ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
                flat = np.concatenate(values) if values else np.zeros(0, dtype=np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(sets.signature[some]),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))),
                    ],
                    names=["signature", "shingles"],
                )

    return docs.mapInArrow(work, "signature long, shingles array<long>")


def _sets_of(wanted: DataFrame, docs: DataFrame, light: DataFrame, params: JoinParams) -> tuple[DataFrame, str]:
    """``signature, shingles`` of the distinct signatures ``wanted``, written once, and the path to be dropped."""
    holders = staged(
        light.join(wanted, "signature", "left_semi").groupBy("signature").agg(F.min("doc_id").alias("doc_id")), "holders"
    )
    ids = holders.select("doc_id").distinct()
    if holders.count() <= SMALL_ROWS:
        ids = F.broadcast(ids)  # of checked size; beyond it the texts are joined by a shuffle
    texts = docs.join(ids, "doc_id", "left_semi").select("doc_id", "text")
    if holders.where(F.col("doc_id").isNull()).limit(1).count():  # sets that only rows without an id hold
        texts = texts.unionByName(docs.where(F.col("doc_id").isNull()).select("doc_id", "text"))
    sets = shingle_sets(texts, params).join(wanted, "signature", "left_semi")
    return staged_at(sets.dropDuplicates(["signature"]), "sets")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, same, all``: what the whole sets of each pair share, and their sizes added."""
    return (
        pairs.join(sets.select(F.col("signature").alias("a"), F.col("shingles").alias("left")), "a")
        .join(sets.select(F.col("signature").alias("b"), F.col("shingles").alias("right")), "b")
        .select("a", "b", F.size(F.array_intersect("left", "right")).alias("same"), (F.size("left") + F.size("right")).alias("all"))
    )


def _similar(measured: DataFrame, params: JoinParams) -> DataFrame:
    return measured.where(100 * F.col("same") >= params.percent * (F.col("all") - F.col("same"))).select("a", "b")


def _with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    named = roots.withColumnRenamed("node", "signature")
    return rows.join(named, "signature", "left").withColumn("root", F.coalesce("root", "signature"))


def _in_order(left: str, right: str) -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


#: Members of a long list, drawn by hashes, that all others are compared with before the rest is.
DRAWN = 8


def _long_list_roots(rows: DataFrame, docs: DataFrame, light: DataFrame, links: DataFrame, params: JoinParams) -> DataFrame:
    """``node, root`` of the components by ``links`` and by those of sets that share a long list. ``rows``: ``token, signature, n, before, behind``, the
    places up to this entry and those behind it that can hold shared shingles.

    The central set of a list is the one on most lists, which is nearest to what they have in common. Sets
    already in one component are not compared again.
    """
    # What cannot share enough even with the smallest partner is similar to nothing here.
    some = rows.where(100 * (F.col("before") + F.col("behind")) >= params.percent * F.col("n"))
    rows = staged(some.distinct(), "long-lists")
    if not rows.limit(1).count():
        return components(links)
    sets, path = _sets_of(rows.select("signature").distinct(), docs, light, params)
    lists = rows.groupBy("signature").agg(F.count("*").alias("lists"))
    central = F.max(F.struct("lists", "signature", "n")).alias("c")  # combined before the shuffle
    centres = rows.join(lists, "signature").groupBy("token").agg(central).select("token", "c.signature", "c.n")
    centres = centres.withColumnsRenamed({"signature": "centre", "n": "nc"})
    rows = staged(rows.join(centres, "token"), "long-lists")
    near = rows.where((F.col("signature") != F.col("centre")) & _sizes_fit(F.col("n"), F.col("nc"), params))
    tried = staged(near.select(*_in_order("signature", "centre")).distinct(), "tried")
    measured = staged(_measured(tried, sets), "measured")
    roots = components(links.unionByName(_similar(measured, params)))
    distance = (1 - F.col("same") / (F.col("all") - F.col("same"))).alias("distance")
    both = measured.select(F.col("a").alias("signature"), F.col("b").alias("centre"), distance).unionByName(
        measured.select(F.col("b").alias("signature"), F.col("a").alias("centre"), distance)
    )
    apart = F.when(F.col("signature") == F.col("centre"), 0.0).otherwise(F.col("distance"))
    rows = staged(rows.join(both, ["signature", "centre"], "left").withColumn("distance", apart), "long-lists")

    for drawn in (DRAWN, None):
        rooted = staged(_with_roots(rows, roots), "rooted")
        sizes = rooted.groupBy("token", "root").agg(F.count("*").alias("members"))
        open_ = sizes.groupBy("token").agg(F.max_by("root", F.struct("members", "root")).alias("main"), F.count("*").alias("roots"))
        rooted = rooted.join(open_.where("roots > 1").select("token", "main"), "token")
        entry = ["signature", "n", "before", "behind", "distance", "root"]
        if drawn:
            # Each by an order of its own, so that tasks send one row a list and draw.
            draws = [F.max(F.struct(F.xxhash64(F.lit(i), "signature"), *entry)) for i in range(drawn)]
            side = rooted.groupBy("token").agg(F.array_distinct(F.array(*draws)).alias("x"))
            side = side.select("token", F.explode("x").alias("x"))
        else:
            side = rooted.where(F.col("root") != F.col("main")).select("token", F.struct(*entry).alias("x"))
        met = rooted.join(side, "token").where((F.col("root") != F.col("x.root")) & _may_link(params))
        pairs = met.select(*_in_order("signature", "x.signature")).distinct()
        pairs = staged(pairs.join(tried, ["a", "b"], "left_anti"), "open-pairs")
        if not pairs.limit(1).count():
            continue
        tried = tried.unionByName(pairs)
        roots = joined_components(roots, _similar(_measured(pairs, sets), params))
    drop(docs.sparkSession, path)
    return roots


def _may_link(params: JoinParams) -> Column:
    """Whether the bounds let the entry of a list and the entry ``x`` of the same list be similar."""
    n, m = F.col("n"), F.col("x.n")
    most = F.least("before", "x.before") + F.least("behind", "x.behind")
    enough = most * (100 + params.percent) >= params.percent * (n + m)
    # Distances are quotients of small integers: far more exact than the tolerance.
    gap = F.abs(F.col("distance") - F.col("x.distance")) <= 1 - params.percent / 100 + 1e-9
    return _sizes_fit(n, m, params) & enough & F.coalesce(gap, F.lit(True))


def _sizes_fit(n, m, params: JoinParams):
    return F.least(n, m) * 100 >= F.greatest(n, m) * params.percent


def near_duplicates(
    docs: DataFrame, params: JoinParams = JoinParams(), id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id that links lead to. Null and empty texts, and texts without words,
    have no shingle and are linked with nothing; shorter texts are one shingle of all their words. Rows with
    equal sets, repeated rows among them, are linked; a null id is never the smallest while there is another.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(text).alias("text"))
    with shuffles_dropped(docs.sparkSession):
        light, roots = _linked(docs, params)
    rooted = _with_roots(light.where("n_shingles > 0"), roots)
    # The smallest id of each group; combined before the shuffle, however many copies a group has.
    names = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    grouped = rooted.join(names, "root").select("doc_id", "n_shingles", "component_id")
    alone = light.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone)


def _linked(docs: DataFrame, params: JoinParams) -> tuple[DataFrame, DataFrame]:
    """The signatures of ``docs`` and ``node, root`` of the linked ones, both written."""
    light = staged(signatures(docs, params), "signatures")
    common, list_length = _common_shingles(light, params)
    light = light.drop("shingles")
    clash = light.where("n_shingles > 0").groupBy("signature").agg(F.count_distinct("n_shingles", "second").alias("n"))
    if clash.where("n > 1").limit(1).count():
        raise RuntimeError("two sets share a signature")
    sizes = {
        row["n_shingles"]: row["n"]
        for row in light.where(F.col("n_shingles").between(1, 4 * params.largest_small))
        .groupBy("n_shingles")
        .agg(F.count_distinct("signature").alias("n"))
        .collect()
    }
    small = boundary(sizes, list_length, params)
    paired = staged(
        _list_pairs(entries(docs, params, common, small, on_common=False).repartition("token"), params), "pairs"
    )
    candidates = staged(_could_link(paired.where(F.col("long_token").isNull()), params), "candidates")
    wanted = candidates.select(F.explode(F.array("a", "b")).alias("signature")).distinct()
    sets, path = _sets_of(wanted, docs, light, params)
    links = staged(_similar(_measured(candidates, sets), params), "links")
    drop(docs.sparkSession, path)
    n, place = F.col("n").cast("long").alias("n"), F.col("place").cast("long")
    rows = paired.where(F.col("long_token").isNotNull()).select(
        F.col("long_token").alias("token"), F.col("a").alias("signature"), F.col("na").alias("n"), F.col("place_a").alias("place")
    )
    rows = rows.select("token", "signature", n, place.alias("before"), (n - place).alias("behind"))
    if len(common):
        more = entries(docs, params, common, small, on_common=True)
        before = (place - F.col("early")).alias("before")
        rows = rows.unionByName(more.select("token", "signature", n, before, (n - place).alias("behind")))
    return light, _long_list_roots(rows, docs, light, links, params)
