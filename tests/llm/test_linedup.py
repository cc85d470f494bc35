"""Line runs against a search of all pairs of lines."""

import random

import pytest

from orderlens.llm import linedup


def brute(docs, min_chars):
    """Lines of (id, text) documents to delete: in a maximal run that also starts earlier."""
    lines = [(doc, n, line) for doc, text in docs for n, line in enumerate(text.split("\n"))]
    place = {(doc, n): line for doc, n, line in lines}
    gone = set()
    for doc, n, _ in lines:
        for other, m, _ in lines:
            if (other, m) >= (doc, n):
                continue
            size, k = 0, 0
            while (doc, n + k) in place and place.get((other, m + k)) == place[doc, n + k]:
                size += len(place[doc, n + k]) + 1
                k += 1
            if size >= min_chars:
                gone |= {(doc, n + i) for i in range(k)}
    return gone


@pytest.mark.parametrize("seed", range(6))
def test_agrees_with_all_pairs(spark, seed):
    random.seed(seed)
    pool = ["", "a", "bb", "ccc ccc", "a long line of words", "another quite long line"]
    docs = [(i, "\n".join(random.choice(pool) for _ in range(random.randint(1, 9)))) for i in range(14)]
    docs.append((14, "\n".join(line for _, text in docs[:4] for line in text.split("\n"))))
    for min_chars in (1, 7, 25):
        gone = brute(docs, min_chars)
        rows = linedup.without_runs(spark.createDataFrame(docs, "doc_id long, text string"), min_chars).collect()
        got = {
            (r.doc_id, run.start + k) for r in rows for run in r.dedup_runs for k in range(run.n)
        }
        assert got == gone
        for r in rows:
            kept = [line for n, line in enumerate(dict(docs)[r.doc_id].split("\n")) if (r.doc_id, n) not in gone]
            assert r.text == "\n".join(kept)
            assert (r.dedup_removed, r.dedup_lines) == (len(kept) * -1 + r.dedup_lines, len(dict(docs)[r.doc_id].split("\n")))


def test_ranks_are_a_suffix_array(spark):
    """The rank of h lines orders suffixes as sorting their first h line ids does."""
    random.seed(1)
    docs = [(i, "\n".join(random.choice("abc") for _ in range(12))) for i in range(5)]
    lines = linedup.line_table(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = linedup.suffix_ranks(lines, 8).collect()
    ids = {(r.doc, r.line): r.rank_1 for r in rows}
    for height in (1, 2, 4, 8):
        ranked = {(r.doc, r.line): r[f"rank_{height}"] for r in rows}
        prefix = {
            at: tuple(ids[at[0], at[1] + k] for k in range(height))
            for at in ids
            if all((at[0], at[1] + k) in ids for k in range(height))
        }
        counts = {}
        for p in prefix.values():
            counts[p] = counts.get(p, 0) + 1
        order = {p: n for n, p in enumerate(sorted(p for p, n in counts.items() if n > 1), 1)}
        if height > 1:
            assert {at: r for at, r in ranked.items() if r} == {at: order[p] for at, p in prefix.items() if p in order}


PASSAGE = "\n".join(f"line {i} of a passage that many documents share" for i in range(4))


def test_rows_of_any_kind(spark):
    rows = [
        (1, PASSAGE, 7, "d1"), (2, f"own start\n{PASSAGE}\nown end", 7, "d2"), (3, None, 7, "d3"), (4, "", 7, "d4"),
        (5, PASSAGE, 7, "d5"), (5, PASSAGE, 7, "d5"), (None, f"{PASSAGE}\nof nobody", 7, "d6"), (6, "\n" * 200, 7, "d7"),
        (7, "word " * 100_000, 7, "d8"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, dedup_lines int, doc string")
    out = linedup.without_runs(docs)
    assert set(out.columns) == {*docs.columns, "dedup_removed", "dedup_runs"} and out.count() == len(rows)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    # The null id sorts first and so keeps the passage.
    assert got[None][0].dedup_removed == 0 and got[1][0].text == "" and got[1][0].dedup_removed == 4
    assert got[2][0].text == "own start\nown end"
    assert [r.text for r in got[5]] == ["", ""] and got[5][0].doc == "d5"
    assert got[3][0].text is None and got[3][0].dedup_lines == 0 and got[4][0].dedup_lines == 1
    assert got[7][0].dedup_removed == 0
    assert linedup.without_runs(docs.limit(0)).count() == 0


def test_a_line_in_most_documents(spark):
    rows = [(i, f"own {i}\n" + "the very same long line in every document here") for i in range(300)]
    out = linedup.without_runs(spark.createDataFrame(rows, "doc_id long, text string"), 40).collect()
    assert sum(r.dedup_removed for r in out) == 299 and next(r for r in out if r.doc_id == 0).dedup_removed == 0


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, PASSAGE), (2, PASSAGE)], "doc_id long, text string")
    plan = linedup.without_runs(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
