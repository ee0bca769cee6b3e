"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


# Rows of a batch sent to Python where workers hold large models as well: a batch has whole texts.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Send Python workers no more than ``BATCH_ROWS`` rows at a time from now on."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package wherever the driver was started."""
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in known:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, known)])
    return spark


def text_of(column: str | Column = "text") -> Column:
    """A text column with NULL read as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def batches(found: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Column dictionaries as Arrow batches of one schema."""
    for columns in found:
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def fold_of(doc_id: str | Column = "doc_id") -> Column:
    """0 to 4 by the CRC-32 of the id as text; rows of fold 0 are held out of all learning.

    A NULL id falls into fold 0: such a row has no label to learn from.
    """
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5, F.lit(0))


def learning_sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids outside fold 0, in hash order: ``doc_id, y``.

    Ids labelled twice count as positive when any label is; NULL ids and labels are left out.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold_of("doc_id") != 0))
    once = usable.groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
