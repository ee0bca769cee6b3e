"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.llm import (
    ann,
    audit_sql,
    divergence,
    embed_dedup,
    html_extract,
    licenses,
    line_dedup,
    merkle,
    packing,
    quality,
    sentence_pieces,
    simhash,
    token_counts,
    toxicity,
)
from clicktide.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "path")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that every distinct text is encoded."""
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        scratch_path(spark, "token-cache"),
        normalise=token_counts.without_extra_space,
    )


def op3_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of the text they decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentence_pieces.digest(sentence_pieces.encode(table(spark, sf_dir, "documents"), path), path)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), remembered=2_000_000)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``; one whose whole text is a licence or notice is its folder's licence file."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.col("doc_id").cast("string"))
    files = table(spark, sf_dir, "documents").select(path.alias("path"), "text", F.col("doc_id").cast("long").alias("doc_id"))
    return licenses.scan(files, keep=["doc_id"], by_text=True)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"), least_docs=10, least_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"), least_docs=30, top=50)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.audit(table(spark, sf_dir, "documents"), tampered, fanout=16)


def queries() -> dict[str, Query]:
    return {
        "op1_html_text": op1_html_text,
        "op2_token_counts": op2_token_counts,
        "op3_sentence_pieces": op3_sentence_pieces,
        "op4_nearest": op4_nearest,
        "op5_packing": op5_packing,
        "op6_toxicity": op6_toxicity,
        "op7_licenses": op7_licenses,
        "op8_quality": op8_quality,
        "op9_simhash": op9_simhash,
        "op10_embedding_duplicates": op10_embedding_duplicates,
        "op11_line_dedup": op11_line_dedup,
        "op12_source_divergence": op12_source_divergence,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


OP10_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
),
ok AS (
    SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v
    WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
),
reach AS (
    SELECT vec_id AS node, vec_id AS seen FROM embeddings
    UNION
    SELECT reach.node, links.b FROM reach JOIN links ON reach.seen = links.a
),
groups AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN groups ON node = vec_id LEFT JOIN counts ON a = vec_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op10_embedding_duplicates": OP10_SQL,
        "op11_line_dedup": audit_sql.LINES,
        "op12_source_divergence": audit_sql.DIVERGENCE,
        "op13_merkle_manifest": audit_sql.manifest(),
    }
