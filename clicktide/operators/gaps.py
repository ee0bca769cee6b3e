"""Sessions from time gaps, for sources without a session id.

Two events of a user within one cell of the gap's width are never further apart
than the gap, so each task first folds its events into one row per user and cell.
Cells are cut into islands within time slices of a user, and the slices are
stitched with one row each: whether its first island goes on from the slice
before, and how many sessions begin in it. A user with very many events is
neither sorted nor held by one task; what meets per user is a row per slice.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktide.operators.visits import is_event
from clicktide.schemas import PURCHASE, REVENUE, SESSION, TIME, USER

# Cells of a user's slice: the most rows that are sorted together.
CELLS = 4096


def _cells(events: DataFrame, width: int) -> DataFrame:
    """One row per user and cell. Channels apart at first: those buffers are fixed-width and hash-aggregated."""
    moment = F.unix_micros(F.col(TIME).cast("timestamp"))
    cell = F.call_function("div", moment - F.pmod(moment, F.lit(width)), F.lit(width))
    timed = events.where(F.col(TIME).isNotNull() & F.col(USER).isNotNull())
    by_channel = timed.groupBy(USER, cell.alias("cell"), "source", "medium", "campaign").agg(
        F.min(moment).alias("lo"),
        F.max(moment).alias("hi"),
        F.count(F.lit(1)).alias("events"),
        F.max(is_event(PURCHASE).cast("int")).alias("purchased"),
        F.sum(REVENUE).alias("revenue"),
    )
    return _folded(by_channel, "cell", F.struct("lo", "source", "medium", "campaign"))


def _folded(rows: DataFrame, key: str, first, *more: str) -> DataFrame:
    return rows.groupBy(USER, *more, key).agg(
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.min(first).alias("first"),
        F.sum("events").alias("events"),
        F.max("purchased").alias("purchased"),
        F.sum("revenue").alias("revenue"),
    )


def gap_sessions(events: DataFrame, gap: timedelta = timedelta(minutes=30), cells: int = CELLS) -> DataFrame:
    """Sessions of each user, split where two events in a row lie more than ``gap`` apart.

    Takes cleansed events. Returns the columns of the session theme and
    ``session_number`` (from 1 per user) and ``session_end``. The id is the user and
    the start in microseconds. Source, medium and campaign come together from the
    earliest event (of several, the smallest channel). Events without a time or a
    user are in no session. ``cells`` is the length of a slice in gaps.
    """
    width = gap // timedelta(microseconds=1)
    if width < 1 or cells < 1:
        raise ValueError(f"gap {gap} and slice of {cells} gaps must be positive")
    sliced = _cells(events, width).withColumn("slice", F.floor(F.col("cell") / cells))
    in_slice = Window.partitionBy(USER, "slice").orderBy("cell")
    breaks = F.coalesce((F.col("lo") - F.lag("hi").over(in_slice) > width).cast("int"), F.lit(0))
    numbered = sliced.withColumn("breaks", breaks).withColumn("island", F.sum("breaks").over(in_slice))
    islands = _folded(numbered, "island", F.col("first"), "slice")

    # One row a slice; its first island goes on from the last one before if they are close.
    ends = islands.groupBy(USER, "slice").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("island").alias("last"))
    slices = Window.partitionBy(USER).orderBy("slice")
    goes_on = F.coalesce((F.col("lo") - F.lag("hi").over(slices) <= width).cast("int"), F.lit(0))
    ends = ends.withColumn("goes_on", goes_on).withColumn("begun", F.col("last") + 1 - F.col("goes_on"))
    before = F.coalesce(F.sum("begun").over(slices.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = ends.select(USER, "slice", (before + 1 - F.col("goes_on")).alias("shift"))

    stitched = islands.join(shift, [USER, "slice"]).withColumn("session_number", F.col("island") + F.col("shift"))
    found = _folded(stitched, "session_number", F.col("first"))
    return found.select(
        F.concat(USER, F.lit("-"), F.col("lo").cast("string")).alias(SESSION),
        USER,
        "session_number",
        F.timestamp_micros("lo").alias("session_start"),
        F.timestamp_micros("hi").alias("session_end"),
        "first.source",
        "first.medium",
        "first.campaign",
        "events",
        "purchased",
        "revenue",
    )
