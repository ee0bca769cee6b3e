"""Landing of extracts, with a manifest of what was written."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.schemas import DATE

# Rows of a range, the unit of a file's digest.
RANGE_ROWS = 1 << 16


def land(df: DataFrame, path: str, require_rows: bool = True, partition: str | None = DATE) -> int:
    """Write an extract as ZSTD Parquet and return its row count, taken from the written files.

    Nothing is shuffled: the source is foldered by day, so a task holds one day
    or few and writes as many files, each of no more than one input split.
    """
    out = df.write.mode("overwrite").option("compression", "zstd")
    if partition is not None:
        out = out.partitionBy(partition)
    out.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path).count()
    if require_rows and rows == 0:
        raise RuntimeError(f"the extract for {path} has no rows")
    return rows


def manifest(
    spark: SparkSession, outputs: Mapping[str, str], source: str, start: str, end: str
) -> DataFrame:
    """One row per landed file: output, rows, bytes and digest, with source, range and time.

    ``digest`` is the SHA-256 over the digests of the file's row ranges, in order
    (see ``file_ranges``); it is made alike for files of every size.
    """
    files = reduce(DataFrame.unionByName, [_files(spark, name, path) for name, path in outputs.items()])
    return files.select(
        F.lit(source).alias("source"),
        F.lit(start).alias("start"),
        F.lit(end).alias("end"),
        F.current_timestamp().alias("recorded_at"),
        "output",
        "file",
        "rows",
        "bytes",
        "digest",
    )


def file_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Digest of every ``RANGE_ROWS`` rows of each file below ``path``: ``file, part, rows, digest``.

    A row is hashed with its place in the file, with which of its columns are NULL,
    and under two keys; sums of these hashes are added up within a task, so that a
    range is one row of the shuffle and no file is ever held as a value. A changed,
    moved, missing or added row changes the digest of its range.
    """
    landed = spark.read.parquet(path)
    place = F.col("_metadata.row_index")
    values = [F.to_json(F.struct(c)) if _nested(landed, c) else F.col(c) for c in landed.columns]
    # Hashing skips NULLs, so their places are hashed as well.
    row = [place, *values, *[F.col(c).isNull() for c in landed.columns]]
    wide = "decimal(38,0)"
    sums = [F.sum(F.xxhash64(F.lit(key), *row).cast(wide)).cast("string") for key in ("first", "second")]
    part = F.call_function("div", place, F.lit(RANGE_ROWS)).alias("part")
    found = landed.groupBy(F.col("_metadata.file_path").alias("file"), part).agg(
        F.count(F.lit(1)).alias("rows"), F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums).alias("sums")
    )
    return found.select("file", "part", "rows", F.sha2("sums", 256).alias("digest"))


def changed_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """``file, part`` of the ranges whose digests differ, or that only one of two ``file_ranges`` has."""
    old = before.select("file", "part", F.col("digest").alias("was"))
    both = old.join(after.select("file", "part", "digest"), ["file", "part"], "full")
    return both.where(~F.col("was").eqNullSafe(F.col("digest"))).select("file", "part")


def _files(spark: SparkSession, name: str, path: str) -> DataFrame:
    file = F.col("_metadata.file_path").alias("file")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    sizes = found.select(file, F.col("length").alias("bytes"))  # reads no content
    ranges = F.sort_array(F.collect_list(F.struct("part", "digest")))  # one entry per RANGE_ROWS rows of a file
    root = F.sha2(F.array_join(F.transform(ranges, lambda x: x["digest"]), ""), 256)
    rows = file_ranges(spark, path).groupBy("file").agg(F.sum("rows").alias("rows"), root.alias("digest"))
    both = sizes.join(rows, "file", "left")
    empty = F.sha2(F.lit(""), 256)
    return both.select(F.lit(name).alias("output"), "file", F.coalesce("rows", F.lit(0)).alias("rows"), "bytes", F.coalesce("digest", empty).alias("digest"))


def _nested(df: DataFrame, column: str) -> bool:
    return not isinstance(df.schema[column].dataType, T.AtomicType)
