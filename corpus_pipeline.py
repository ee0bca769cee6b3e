"""Corpus pipeline: quality, toxicity, near-duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of
``documents``; what a stage returns is written as Parquet and read again as the
next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from clicktide.llm import packing, quality, simhash, toxicity
from clicktide.llm.common import small_batches
from clicktide.session import scratch_path, scratch_scope


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    small_batches(spark)
    return quality.keep_good(docs, _labels(spark, sf_dir))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go."""
    small_batches(spark)
    return toxicity.keep_clean(docs, _labels(spark, sf_dir))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs, words=3, max_bits=3)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048)


STAGES = [("quality", good_quality), ("toxicity", not_toxic), ("simhash", one_of_each), ("packing", packed)]

# Trained classifiers, tokenizers and fingerprints are not to be had in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each from the Parquet that the one before wrote to the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        with scratch_scope(spark):  # what the stage itself wrote goes with it
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
