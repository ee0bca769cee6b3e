"""Flat event and item sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.schemas import EVENTS_CSV, EXTRACTED_EVENTS, ITEMS, ITEMS_CSV, OPTIONAL
from clicktide.sources.tables import path_exists


def read_flat(spark: SparkSession, path: str, csv_schema: T.StructType, schema: T.StructType) -> DataFrame:
    """CSV with a header row when the path says so, otherwise Parquet; columns are bound by name."""
    return read_csv(spark, path, csv_schema) if path.endswith(".csv") else spark.read.schema(schema).parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV columns in any order, typed by ``schema``.

    Optional columns that are missing become NULL; other missing columns, and
    columns the schema does not know, are an error that names them.
    """
    header = spark.read.option("header", True).csv(path).columns
    unknown, missing = set(header) - set(schema.names), set(schema.names) - set(header) - OPTIONAL
    if unknown or missing:
        raise ValueError(f"{path}: unknown columns {sorted(unknown)}, missing columns {sorted(missing)}")
    there = T.StructType([schema[name] for name in header])
    # enforceSchema off: a file whose header differs from the first one's is an error.
    reader = spark.read.schema(there).option("header", True).option("enforceSchema", False)
    rows = reader.option("mode", "FAILFAST").csv(path)
    return rows.select(*[F.col(f.name) if f.name in header else F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Events; a missing path raises Spark's PATH_NOT_FOUND."""
    return read_flat(spark, path, EVENTS_CSV, EXTRACTED_EVENTS)


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Items; a missing path gives an empty table with the item schema."""
    return read_flat(spark, path, ITEMS_CSV, ITEMS) if path_exists(spark, path) else empty_items(spark)


def empty_items(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ITEMS)


def items_beside(events_path: str) -> str:
    """Where the items of an event source lie: same folder, ``events`` in the name read as ``items``."""
    folder, slash, name = events_path.rstrip("/").rpartition("/")
    return folder + slash + (name.replace("events", "items") if "events" in name else "items")
