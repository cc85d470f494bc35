"""The queries of this subpackage and their SQL: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderlens.llm import (
    alignment,
    contamination,
    hnsw,
    jaccard,
    lexical,
    linedup,
    pagediff,
    pieces,
    pii,
    pitmanyor,
    quality,
    suffixes,
    warc,
)
from orderlens.session import scratch_path, staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: A SentencePiece model on the machine; any path Spark can read may be given instead.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: A byte-level vocabulary in the format of the tokenizers library.
BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


def op1_sentencepiece_n_best(spark: SparkSession, sf_dir: str, model_path: str = PIECE_MODEL) -> DataFrame:
    """Best ids, the four best segmentations as edits of them, and whether decoding gives the text back."""
    model = pieces.model_bytes(spark, model_path)
    return pieces.segment(table(spark, sf_dir, "documents"), model).select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "n_best", "round_trip"
    )


def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op3_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, a row for each pair."""
    return contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = staged(warc.read_records(spark, folder, with_payload=False), "warc-records")
    captures = warc.assemble(records)
    return captures.select(
        F.col("metadata.page_id").alias("page_id"),
        F.col("first.payload_bytes").alias("payload_bytes"),
        F.col("first.payload_digest").alias("payload_digest"),
        F.col("exchange.record_type").alias("record_type"),
        F.when(F.col("exchange.record_type") == "revisit", F.col("first.page_id")).alias("refers_to"),
    )


OP5_SQL = """
WITH page AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
owner AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS owner
  FROM page)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN owner <> page_id THEN owner END AS refers_to
FROM owner
"""


def op6_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linedup.without_runs(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id",
        F.col("dedup_lines").cast("long").alias("n_lines"),
        F.col("dedup_removed").cast("long").alias("n_removed"),
        F.size("dedup_runs").cast("long").alias("n_runs"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


# Equal lines at two positions are on a diagonal; a maximal stretch of one is a repeated run.
OP6_SQL = """
WITH line AS (
  SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS content
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
pair AS (
  SELECT a.doc_id, a.line_no, b.doc_id AS other, a.line_no - b.line_no AS shift, len(a.content) + 1 AS width
  FROM line a JOIN line b ON a.content = b.content AND (b.doc_id, b.line_no) < (a.doc_id, a.line_no)),
stretch AS (
  SELECT *, line_no - row_number() OVER (PARTITION BY doc_id, other, shift ORDER BY line_no) AS stretch FROM pair),
long AS (
  SELECT doc_id, other, shift, stretch FROM stretch GROUP BY ALL HAVING sum(width) >= 50),
gone AS (
  SELECT DISTINCT doc_id, line_no FROM stretch JOIN long USING (doc_id, other, shift, stretch)),
marked AS (
  SELECT line.*, gone.line_no IS NOT NULL AS away,
         line.line_no - row_number() OVER (PARTITION BY line.doc_id, gone.line_no IS NOT NULL ORDER BY line.line_no) AS run
  FROM line LEFT JOIN gone USING (doc_id, line_no))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE away) AS n_removed,
       count(DISTINCT run) FILTER (WHERE away) AS n_runs,
       sha256(coalesce(string_agg(content, chr(10) ORDER BY line_no) FILTER (WHERE NOT away), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op7_suffix_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_report(table(spark, sf_dir, "documents"))


def op8_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.report(table(spark, sf_dir, "documents"))


def op9_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hnsw.usable(table(spark, sf_dir, "embeddings"))
    graphs = staged(hnsw.index(rows), "hnsw")
    return hnsw.search(graphs, rows.where(F.col("vec_id") % 100 == 0))


def op10_shingle_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op11_token_spans(
    spark: SparkSession, sf_dir: str, a_path: str = BYTE_VOCABULARY, b_path: str = PIECE_MODEL
) -> DataFrame:
    files = pieces.model_bytes(spark, a_path), pieces.model_bytes(spark, b_path)
    return alignment.align(table(spark, sf_dir, "documents"), *files, with_groups=False)


def op12_page_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagediff.main_text(table(spark, sf_dir, "pages"))


def op13_max_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = """
WITH document AS (
  SELECT row_number() OVER () AS row_no, doc_id, text FROM documents),
token AS (
  SELECT row_no, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM document),
size AS (SELECT row_no, count(*) AS n FROM token GROUP BY row_no),
corpus AS (SELECT count(*) AS docs, sum(n) AS terms FROM size),
wanted AS (
  SELECT item_id, term, count(*) AS repeats
  FROM (SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark)
  GROUP BY item_id, term),
held AS (
  SELECT row_no, term, count(*) AS tf FROM token WHERE term IN (SELECT term FROM wanted) GROUP BY row_no, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * docs + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term, docs),
impact AS (
  SELECT row_no, term, w * ((1000000000 * tf) // (1000 * tf + 12 * CAST(75 + (25 * n * docs) // terms AS BIGINT))) AS worth
  FROM held JOIN weight USING (term) JOIN size USING (row_no), corpus),
score AS (
  SELECT item_id, row_no, CAST(sum(repeats * worth) AS BIGINT) AS score
  FROM wanted JOIN impact USING (term) GROUP BY item_id, row_no),
ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM score JOIN document USING (row_no) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece_n_best": op1_sentencepiece_n_best,
    "op2_pii_crf": op2_pii_crf,
    "op3_quality_compression": op3_quality_compression,
    "op4_latent_leaks": op4_latent_leaks,
    "op5_warc_transactions": op5_warc_transactions,
    "op6_line_runs": op6_line_runs,
    "op7_suffix_buckets": op7_suffix_buckets,
    "op8_pitman_yor": op8_pitman_yor,
    "op9_hnsw_neighbours": op9_hnsw_neighbours,
    "op10_shingle_jaccard": op10_shingle_jaccard,
    "op11_token_spans": op11_token_spans,
    "op12_page_differences": op12_page_differences,
    "op13_max_sketches": op13_max_sketches,
}

ORACLE_SQL: dict[str, str] = {
    "op5_warc_transactions": OP5_SQL,
    "op6_line_runs": OP6_SQL,
    "op13_max_sketches": OP13_SQL,
}
