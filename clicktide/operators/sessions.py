"""Session theme table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.operators.visits import condense, is_visits
from clicktide.schemas import SESSION, USER


def session_summary(events: DataFrame) -> DataFrame:
    """One row per (session, user); events without a session are left out.

    Source, medium and campaign come together from the session's earliest event.
    Takes cleansed events or visits. Events are condensed first: the earliest of a
    session is a struct, which Spark aggregates by sorting.
    """
    parts = events.where(F.col(SESSION).isNotNull())
    parts = parts if is_visits(parts) else condense(parts)
    undated = F.col("first_at").isNull()  # false sorts first
    first = F.min(F.struct(undated.alias("undated"), "first_at", "source", "medium", "campaign"))
    grouped = parts.groupBy(SESSION, USER).agg(
        first.alias("first"),
        F.sum("events").alias("events"),
        F.max(F.col("bought").cast("int")).alias("purchased"),
        F.sum("revenue").alias("revenue"),
    )
    return grouped.select(
        SESSION,
        USER,
        F.col("first.first_at").alias("session_start"),
        "first.source",
        "first.medium",
        "first.campaign",
        "events",
        "purchased",
        "revenue",
    )
