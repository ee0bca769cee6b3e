"""Parquet table writes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from clicktide.schemas import DATE

# Folder name Spark gives to a NULL partition value.
EMPTY_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# Folders a task writes at once; with more of them Spark sorts the task's rows by folder.
OPEN_FOLDERS = 64

# Tables other systems may rely on, and the column each is foldered by.
CONTRACT = {
    "events": DATE,
    "items": DATE,
    "daily_kpi": DATE,
    "funnel": None,
    "channel_summary": None,
    "user_value": None,
    "product_summary": None,
}


def writer(df: DataFrame, partition: str | None = None) -> DataFrameWriter:
    """ZSTD Parquet in files of about the advisory partition size.

    ``rebalance`` gathers a partition's rows so that few files are written per
    day, merges small tables into one file and still splits an oversized day.
    """
    if partition is None:
        return df.hint("rebalance").write.option("compression", "zstd")
    return df.hint("rebalance", F.col(partition)).write.option("compression", "zstd").partitionBy(partition)


def write_table(df: DataFrame, path: str, partition: str | None = None) -> DataFrame:
    """Replace the table at ``path`` and return it as read back."""
    out = writer(df, partition).mode("overwrite").option("partitionOverwriteMode", "static")
    # Rebalanced rows of a task lie in few folders: files kept open spare a sort of whole rows.
    with open_folders(df.sparkSession):
        out.parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def is_foldered(spark: SparkSession, path: str, partition: str) -> bool:
    """Whether the files at ``path`` lie in folders of ``partition``, so that each holds one of its values."""
    return any(name.startswith(f"{partition}=") for name in subfolders(spark, path))


@contextmanager
def open_folders(spark: SparkSession) -> Iterator[None]:
    """Writes inside keep a file open per folder instead of sorting the task's rows, up to ``OPEN_FOLDERS``."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN_FOLDERS)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def rewrite_table(df: DataFrame, path: str, partition: str) -> DataFrame:
    """``write_table`` for rows read from files that hold one folder's rows each, and kept in their folder.

    Nothing is shuffled, and a task has no more files open than it reads: what it
    buffers is at most its input split. As many files are written as are read, or fewer.
    """
    out = df.write.option("compression", "zstd").mode("overwrite").option("partitionOverwriteMode", "static")
    with open_folders(df.sparkSession):
        out.partitionBy(partition).parquet(path)
    return read_table(df.sparkSession, path, df.schema)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def replace_partitions(df: DataFrame, path: str, partition: str, values: Iterable) -> None:
    """Replace the folders of ``values`` by the rows of ``df``; other folders stay.

    ``df`` is read twice and must not be computed from ``path``. A value without
    rows loses its folder. Repeating the call gives the same table.
    """
    _replace(df, writer(df, partition), path, partition, values)


def rewrite_partitions(df: DataFrame, path: str, partition: str, values: Iterable) -> None:
    """``replace_partitions`` for rows that lie by folder already, see ``rewrite_table``."""
    with open_folders(df.sparkSession):
        _replace(df, df.write.option("compression", "zstd").partitionBy(partition), path, partition, values)


def _replace(df: DataFrame, out: DataFrameWriter, path: str, partition: str, values: Iterable) -> None:
    # At most one row per value.
    present = {row[0] for row in df.select(partition).distinct().collect()}
    out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for value in set(values) - present:
        _drop_folder(df.sparkSession, f"{path}/{partition}={EMPTY_FOLDER if value is None else value}")


def _drop_folder(spark: SparkSession, folder: str) -> None:
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    files, where = _file_system(spark, path)
    return [status.getPath().getName() for status in files.listStatus(where)] if files.exists(where) else []


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def export_contract(tables: Mapping[str, DataFrame], folder: str, prefix: str = "") -> dict[str, DataFrame]:
    """Write the contract tables below ``folder``; ``prefix`` goes before each name."""
    return {
        name: write_table(tables[name], f"{folder.rstrip('/')}/{prefix}{name}", partition)
        for name, partition in CONTRACT.items()
    }
