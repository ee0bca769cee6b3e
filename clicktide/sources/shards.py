"""Day-sharded nested events."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.schemas import DATE, NESTED_EVENTS


def _day(text: str) -> date:
    if len(text) != 8 or not text.isdigit():
        raise ValueError(f"not a yyyymmdd date: {text!r}")
    return datetime.strptime(text, "%Y%m%d").date()


def validate_range(start: str, end: str, first: str, last: str) -> tuple[date, date]:
    """Check ``start <= end`` within ``first .. last``; all are yyyymmdd calendar days."""
    lo, hi = _day(start), _day(end)
    if lo > hi:
        raise ValueError(f"start {start} is after end {end}")
    if lo < _day(first) or hi > _day(last):
        raise ValueError(f"{start}..{end} is outside {first}..{last}")
    return lo, hi


def scan_days(
    spark: SparkSession,
    path: str,
    start: str,
    end: str,
    first: str,
    last: str,
    schema: T.StructType = NESTED_EVENTS,
) -> DataFrame:
    """Nested events of the days ``start .. end`` (inclusive).

    The folder is partitioned as ``event_date=yyyymmdd``; other days' folders
    are never opened.
    """
    validate_range(start, end, first, last)
    return spark.read.schema(schema).parquet(path).where(F.col(DATE).between(start, end))
