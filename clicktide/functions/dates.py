"""Calendar helpers. Weeks start on Monday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(day: Column) -> Column:
    return F.trunc(day, "week")


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def weeks_between(start: Column, end: Column) -> Column:
    """Whole weeks between two week starts."""
    return (F.datediff(end, start) / 7).cast("bigint")
