"""Held-out accuracy of the compression classifier, and its edge cases."""

import pytest
from pyspark.sql import functions as F

from orderlens.llm import quality
from orderlens.llm.common import crc_of_value

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_held_out_accuracy(spark, documents):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = quality.quality_report(documents, labels)
    got = rows.join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    good = [r.predicted for r in got if r.quality == 1]
    bad = [r.predicted for r in got if r.quality == 0]
    assert len(good) > 50 and sum(good) / len(good) > 0.97
    assert bad and sum(bad) / len(bad) < 0.2
    shown = {r.doc_id: r for r in rows.collect()}
    assert len(shown) == documents.count()
    for doc_id, row in shown.items():
        assert row.held_out == (crc_of_value(doc_id) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)


def test_held_out_labels_are_not_learnt_from(spark, documents):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = quality.quality_report(documents, labels)
    turned = labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    again = quality.quality_report(documents, turned)
    assert rows.select("doc_id", "score").exceptAll(again.select("doc_id", "score")).count() == 0


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


def test_rows_of_any_kind(spark):
    good = [(i, f"the quiet river number {i} runs to the sea and the town " * 8, "s") for i in range(40)]
    bad = [(100 + i, f"BUY!! NOW!! {i}### $$$ CLICK!! " * 12, "s") for i in range(40)]
    odd = [(200, None, "s"), (201, "", "s"), (202, "x", "s"), (202, "x", "s"), (None, "y", "s"), (203, "the river " * 100_000, "s")]
    table = docs(spark, good + bad + odd)
    labels = spark.createDataFrame(
        [(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(40)] + [(None, 1, 0), (5, None, 0), (999, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    model = quality.fit(table, labels)
    scored = quality.with_score(table, model)
    assert scored.columns == table.columns and scored.count() == table.count()
    got = {r.doc_id: r.score for r in scored.collect()}
    assert min(got[i] for i in range(40)) > 0.5 > max(got[100 + i] for i in range(40))
    assert got[200] == got[201]
    kept = quality.keep_good(table, model)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} >= set(range(40))
    assert not {r.doc_id for r in kept.collect()} & set(range(100, 140))


@pytest.mark.parametrize("marks, expected", [([], 0.5), ([(1, 1, 0)], 1.0), ([(1, 0, 0)], 0.0)])
def test_too_few_classes(spark, marks, expected):
    table = docs(spark, [(1, "some words", "s"), (2, None, "s")])
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = quality.fit(table, labels)
    assert {r.score for r in quality.with_score(table, model).collect()} == {expected}


def test_empty_table(spark):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.quality_report(docs(spark, []), labels).count() == 0
