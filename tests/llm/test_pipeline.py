"""The pipeline's stages on planted documents, and the registry."""

import random

import corpus_pipeline
import pytest

from orderlens.llm import registry
from orderlens.llm.quality import fit, with_score

SMALL = "/root/testdata/sf0.01"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "n-gram Jaccard join", "benchmark decontamination",
        "SentencePiece encoding and decoding",
    ]


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES)
    assert numbers == list(range(1, 14)) and set(registry.ORACLE_SQL) <= set(registry.QUERIES)


@pytest.fixture(scope="module")
def documents(spark):
    return registry.table(spark, SMALL, "documents")


def prose(seed, n=80):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(("an", "the", "or", "ti", "es", "re", "wh")) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_quality_stage_keeps_what_scores(spark, documents):
    kept = corpus_pipeline.quality_classifier(spark, documents, SMALL)
    model = fit(documents, registry.table(spark, SMALL, "labels"))
    want = with_score(documents.select("doc_id", "text"), model).where("score >= 0.3")
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in want.collect())


def test_line_stage_edits_and_drops(spark):
    shared = "\n".join(f"line number {i} of a longer passage shared by documents" for i in range(3))
    rows = [(1, shared, "en", "s", len(shared)), (2, f"mine {prose(1)}\n{shared}", "en", "s", 0), (3, shared, "en", "s", 0),
            (4, "", "en", "s", 0), (5, None, "en", "s", None), (6, prose(2), "en", "s", -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in corpus_pipeline.line_dedup(spark, docs, SMALL).collect()}
    assert set(out) == {1, 2, 4, 5, 6}
    assert out[2].text == f"mine {prose(1)}" and out[2].n_chars == len(out[2].text) and out[6].n_chars == -1


def test_duplicate_stage_leaves_one_of_each_group(spark):
    base = prose(3).split()
    near = " ".join([*base[:-1], "changed"])
    rows = [(4, " ".join(base), 1), (2, near, 1), (9, prose(4), 1), (7, "", 1), (8, "", 1), (None, prose(5), 1), (2, near, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    out = corpus_pipeline.near_duplicates(spark, docs, SMALL)
    assert out.columns == docs.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == [2, 7, 8, 9, None]


def test_duplicate_stage_decides_by_id_and_text(spark):
    """Texts under one id are documents of their own; a row that stands there twice stays once."""
    rows = [(1, prose(3)), (7, prose(3)), (7, prose(4)), (1, prose(5)), (1, prose(5)), (3, prose(5)), (1, None), (1, ""), (9, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()]
    assert sorted(out, key=str) == sorted([(1, prose(3)), (7, prose(4)), (1, prose(5)), (1, None), (1, ""), (9, None), (9, None)], key=str)


def test_leak_stage_decides_by_the_text(spark, documents):
    item = registry.table(spark, SMALL, "benchmark").first().text
    rows = [(5, f"{prose(6)} {item}"), (5, prose(8)), (None, f"{item} {prose(7)}"), (None, prose(9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.benchmark_decontamination(spark, docs, SMALL)
    assert sorted(tuple(r) for r in out.fillna(-1).collect()) == sorted([(5, prose(8)), (-1, prose(9))])


@pytest.mark.parametrize("number", range(1, 5))
def test_stages_on_an_empty_table(spark, documents, number):
    stage = corpus_pipeline.STAGES[number][1]
    assert stage(spark, documents.limit(0), SMALL).count() == 0


def test_leak_stage_drops_holders(spark, documents):
    item = registry.table(spark, SMALL, "benchmark").first().text
    rows = [(1, f"{prose(6)} {item} {prose(7)}", 1), (2, prose(8), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cosine int")
    out = corpus_pipeline.benchmark_decontamination(spark, docs, SMALL)
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [2]


def test_run_is_the_stages_one_after_the_other(spark, documents, tmp_path):
    docs = documents
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SMALL)
        if number < 4:
            assert docs.columns == documents.columns
            docs.write.parquet(f"{tmp_path}/{number}")
            docs = spark.read.parquet(f"{tmp_path}/{number}")
    want = {r.doc_id: r.ids for r in docs.collect()}
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: r.ids for r in rows} == want and all(r.round_trip for r in rows)
