"""Token counts through a cache keyed by content digest and tokenizer version.

Counts are stored in a Parquet table by the digests of normalised content, in a
folder per tokenizer version. A run looks its digests up, encodes one text for
each distinct miss, appends the new counts to the table and joins all counts back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from importlib.metadata import version

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clicktide.llm.common import ready, text_of
from clicktide.llm.token_ids import token_ids
from clicktide.session import settle
from clicktide.sources.tables import path_exists

CACHED = "digest binary, n_tokens long"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    with open(path, "rb") as file:
        found = hashlib.sha256(file.read())
    found.update(f"tokenizers {version('tokenizers')}".encode())
    return found.hexdigest()[:32]


def as_written(text: Column) -> Column:
    return text


def without_extra_space(text: Column) -> Column:
    """One blank for each run of blanks, tabs and line ends: for tokenizers that drop white space."""
    return F.trim(F.regexp_replace(text, "[ \t\r\n]+", " "))


def _counter(path: str):
    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = token_ids(path)
        for part in texts:
            yield pd.Series([len(ids) // 4 for ids in encode(part.tolist())], dtype="int64")

    return count


def _cached(spark: SparkSession, folder: str) -> DataFrame | None:
    """Stored counts, one per digest: runs at the same time may both have stored one."""
    if not path_exists(spark, folder):
        return None
    return spark.read.schema(CACHED).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def add_misses(contents: DataFrame, path: str, folder: str) -> None:
    """Count the texts of ``digest, content`` whose digests are not stored, and append them.

    Each distinct text is encoded once. Copies are dropped within each task
    before the shuffle, so that a text with very many copies costs no more.
    """
    once = Window.partitionBy("digest").orderBy("digest")
    distinct = contents.withColumn("nth", F.row_number().over(once)).where("nth = 1").drop("nth")
    known = _cached(contents.sparkSession, folder)
    if known is not None:
        distinct = distinct.join(known.select("digest"), "digest", "left_anti")
    distinct.select("digest", _counter(path)("content").alias("n_tokens")).write.mode("append").parquet(folder)


def token_counts(
    docs: DataFrame, path: str, cache: str, limit: int = 2048, normalise: Callable[[Column], Column] = as_written
) -> DataFrame:
    """Bytes and tokens of every text: ``doc_id, n_bytes, n_tokens, over_limit``.

    Counts are those of the tokenizers library without added special tokens and
    without truncation. ``cache`` is a folder all executors can reach;
    ``normalise`` must not change counts. Every input row gives one row, repeated
    rows and NULL ids too; a NULL text counts as empty: 0 bytes, 0 tokens.
    Columns other than ``doc_id`` and ``text`` are not looked at.
    """
    spark = ready(docs.sparkSession)
    folder = f"{cache.rstrip('/')}/version={tokenizer_version(path)}"
    content = normalise(text_of())
    digest = F.unhex(F.sha2(content, 256))
    add_misses(docs.select(digest.alias("digest"), content.alias("content")), path, folder)
    rows = docs.select("doc_id", F.octet_length(text_of()).cast("long").alias("n_bytes"), digest.alias("digest"))
    # Written first, so that Spark may split a digest with very many rows in the join.
    counted = rows.join(settle(_cached(spark, folder), "counts"), "digest")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
