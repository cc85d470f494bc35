"""Cleaning of a training corpus: quality, repeated lines, near duplicates, benchmark passages, tokens.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and sees all that the one before kept. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.llm import contamination, jaccard, linedup, pieces, quality
from orderlens.llm.registry import PIECE_MODEL, table
from orderlens.session import staged


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold; the rejected ones go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted, and documents of which nothing is left.

    ``n_chars`` follows the text. A text that was empty or null before stays.
    """
    cleaned = linedup.without_runs(docs)
    emptied = (F.col("dedup_removed") > 0) & (F.col("dedup_removed") == F.col("dedup_lines"))
    if "n_chars" in docs.columns:
        changed = F.when(F.col("dedup_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", changed)
    return cleaned.where(~emptied).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id, a row that stands there twice once.

    A document is an id with a text: another text under the same id is judged by itself. Rows without an id
    have nothing to stand for them in a group, and stay; so do texts without words.
    """
    key = F.xxhash64("doc_id", F.coalesce("text", F.lit("")))
    named = docs.where(F.col("doc_id").isNotNull()).withColumn("__key", key)
    groups = jaccard.near_duplicates(named.select(F.col("__key").alias("doc_id"), "text")).where("n_shingles > 0")
    # A row a document, however often its row is repeated.
    groups = groups.groupBy(F.col("doc_id").alias("__key"), "component_id").agg(F.count("*").alias("n"))
    members = staged(groups.join(named.select("__key", "doc_id").distinct(), "__key"), "near-duplicates")
    first = members.groupBy("component_id").agg(F.min(F.struct("doc_id", "__key")).alias("first"))
    placed = members.join(first, "component_id").select("__key", "n", (F.col("__key") != F.col("first.__key")).alias("away"))
    away = placed.where("away").select(F.col("__key").alias("__away"))
    twice = placed.where("NOT away AND n > 1").select(F.col("__key").alias("__twice"))
    kept = docs.withColumn("__key", key).join(away, (F.col("__key") == F.col("__away")) & F.col("doc_id").isNotNull(), "left_anti")
    again = (F.col("__key") == F.col("__twice")) & F.col("doc_id").isNotNull()
    once = kept.join(twice, again, "left_semi").dropDuplicates(["__key"])
    return kept.join(twice, again, "left_anti").unionByName(once).select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def sentencepiece_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best segmentation and the four best of each document, and whether decoding gives the text back."""
    return pieces.segment(docs, pieces.model_bytes(spark, PIECE_MODEL))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_tokens),
]

#: The quality score, the latent search and the token search are not SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, f"corpus-{number}")
    return docs
