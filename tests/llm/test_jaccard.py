"""Set-similarity components against a comparison of all pairs."""

import os
import random
import re

import pytest

from orderlens.llm import jaccard
from orderlens.llm.common import components, joined_components
from orderlens.llm.jaccard import JoinParams
from orderlens.session import scratch_home


def shingles(text, words=5):
    found = [w for w in re.split("[ \t-\r]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    if not found:
        return frozenset()
    if len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def brute(docs):
    sets = [shingles(text) for _, text in docs]
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted((doc, len(sets[i]), least[top(i)]) for i, (doc, _) in enumerate(docs))


def found(spark, docs, params=JoinParams()):
    rows = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), params)
    return sorted(tuple(r) for r in rows.select("doc_id", "n_shingles", "component_id").collect())


def documents(seed, groups=12, copies=8, common=""):
    random.seed(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(groups):
        base = [random.choice(words) for _ in range(random.choice((3, 5, 6, 8, 9, 12, 20, 60, 140)))]
        for _ in range(copies):
            text = list(base)
            for _ in range(random.choice((0, 0, 1, 1, 2, 4))):
                at = random.randrange(len(text))
                text[at : at + random.randint(0, 1)] = [random.choice(words)] * random.randint(0, 2)
                text = text or ["left"]
            docs.append(" ".join(text).replace("w1", "W1") + common)
    random.shuffle(docs)
    return [(i * 7 % 1009, text) for i, text in enumerate(docs)] + [(2000, None), (2001, ""), (2002, " \t ")]


@pytest.mark.parametrize("seed", range(3))
def test_agrees_with_all_pairs(spark, seed):
    docs = documents(seed)
    assert found(spark, docs) == brute(docs)


def test_common_passages_and_long_lists(spark):
    """Shingles that many sets hold come last; long lists are contracted, then compared in full."""
    docs = documents(7, groups=6, copies=30, common=" one passage that a great many of these documents end with in common")
    for params in (JoinParams(common_from=5, long_list=4), JoinParams(common_from=10**6, long_list=3), JoinParams(common_from=2)):
        assert found(spark, docs, params) == brute(docs)


@pytest.mark.parametrize("seed", range(2))
def test_large_groups_of_near_copies(spark, seed):
    """Members too far from the central set, two families with one passage, and bridges between members."""
    random.seed(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = random.sample(words, 30)
    docs = []
    for base in ([*random.sample(words, 50), *passage], [*passage, *random.sample(words, 40)]):
        for edits in [0, *[random.randint(1, 4) for _ in range(60)]]:
            text = list(base)
            for at in random.sample(range(len(text)), edits):
                text[at] = random.choice(words) + "x"
            docs.append((len(docs) + 1, " ".join(text)))
    docs += [(300 + i, " ".join([*passage, *random.sample(words, i)])) for i in range(0, 12)]
    for params in (JoinParams(common_from=5), JoinParams(common_from=10**6, long_list=10)):
        assert found(spark, docs[1:], params) == brute(docs[1:])


@pytest.mark.parametrize("largest", [0, 4, 12])
def test_any_boundary_gives_the_same(spark, monkeypatch, largest):
    docs = documents(11, groups=20, copies=6)
    monkeypatch.setattr(jaccard, "boundary", lambda *_: largest)
    assert found(spark, docs) == brute(docs)


def test_boundary_follows_cost():
    params = JoinParams()
    assert jaccard.boundary({5: 100}, 1000.0, params) >= 5 > jaccard.boundary({12: 100}, 0.0, params)


def test_needed_overlap_is_the_similarity():
    for n in range(1, 40):
        for m in range(1, 40):
            for same in range(min(n, m) + 1):
                similar = 100 * same >= 80 * (n + m - same)
                assert similar == (same >= jaccard.needed(n, m, 80))
                if similar:
                    assert m >= jaccard.shortest(n, 80)


def test_rows_of_any_kind(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    rows = [(3, "a b c d e f", 1), (3, "a b c d e f", 1), (2, "A b  c\td e F", 1), (9, "a b", 1), (8, "b a", 1), (None, "a b", 1),
            (10, long, 1), (11, long + " more", 1), (12, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(3, 2), (3, 2), (2, 2), (9, 9), (8, 8), (None, 9), (10, 10), (11, 10), (12, 12)], key=str)
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_a_set_without_an_id_links_others(spark):
    """Only a row without an id holds the set between two documents that are too far from each other."""
    words = [f"w{i}" for i in range(100)]
    rows = [(5, " ".join(words[:88])), (None, " ".join(words[6:94])), (3, " ".join(words[12:])), (9, "other words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(shingles(rows[0][1]) & shingles(rows[2][1])) * 100 < 80 * len(shingles(rows[0][1]) | shingles(rows[2][1]))
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3), (None, 3), (3, 3), (9, 9)], key=str)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    random.seed(seed)
    edges = [(random.randrange(200), random.randrange(200)) for _ in range(130)] + [(300 + i, 301 + i) for i in range(60)]
    root = {}

    def top(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    want = {x: top(x) for edge in edges if edge[0] != edge[1] for x in edge}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(want) and {r.node: r.root for r in got} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components_after_more_edges(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(-20, 60), draw.randrange(-20, 60)) for _ in range(30)]
    more = [(draw.randrange(-20, 80), draw.randrange(-20, 80)) for _ in range(25)]
    first, second = (spark.createDataFrame(e, "a long, b long") for e in (edges, more))
    loops = {a for a, b in more if a == b}
    got = sorted(map(tuple, joined_components(components(first), second).collect()))
    want = sorted(map(tuple, components(first.unionByName(second)).collect()))
    assert [r for r in got if r[0] not in loops] == [r for r in want if r[0] not in loops]
    nothing = spark.createDataFrame([], "a long, b long")
    assert sorted(joined_components(components(first), nothing).collect()) == sorted(components(first).collect())


def test_common_shingles_are_known_at_any_size(spark):
    # The bound on their number is far above the number there is: a larger input alone must not raise the count asked for.
    shared = "one line that every eighth text of these holds"
    docs = [(i, " ".join(f"w{i}x{j}" for j in range(60)) + (f" {shared}" if i % 8 == 0 else "")) for i in range(160)]
    params = JoinParams(common_from=8, most_common=100)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    light = jaccard.signatures(table, params)
    common, _ = jaccard._common_shingles(light, params)
    assert len(common) == len(shingles(shared))
    # Of more than the bound the most frequent stay.
    few = JoinParams(common_from=8, most_common=3)
    assert len(jaccard._common_shingles(light, few)[0]) <= 3
    # Equal sets count once, however many blocks they stand in.
    again = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(60))) for i in range(64)], "doc_id long, text string")
    assert len(jaccard._common_shingles(jaccard.signatures(again.repartition(32), params), params)[0]) == 0


def test_fetched_sets_do_not_stay(spark):
    home = scratch_home(spark).removeprefix("file:")
    before = set(os.listdir(home)) if os.path.isdir(home) else set()
    line = " ".join(f"w{j}" for j in range(60))
    assert {r[2] for r in found(spark, [(i, f"{line} end{i}") for i in range(4)])} == {0}
    assert not [name for name in set(os.listdir(home)) - before if name.startswith("sets-")]
