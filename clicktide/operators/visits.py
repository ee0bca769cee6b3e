"""Events in the shape the marts count, one row each or condensed.

Nearly all marts ask for counts of users, sessions and orders with a few sums;
none needs single events. A visit row says what happened on a day, in a session,
from a channel, in an order: number of events, revenue, first time and two flags.
Each event is such a row by itself, so the marts run on events directly. A build
that needs many marts condenses the events once: in click data a session has many
events but one channel, which leaves a table several times smaller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.schemas import DATE, FIRST_VISIT, NAME, ORDER, PURCHASE, REVENUE, SESSION, TIME, USER

ORDER_ID = "order_id"
GRAIN = (DATE, USER, SESSION, "source", "medium", "campaign", ORDER_ID)


def is_event(name: str) -> Column:
    return F.col(NAME) == name


def is_visits(df: DataFrame) -> bool:
    return {"first_at", "is_new", "bought", *GRAIN} <= set(df.columns)


def visits(events: DataFrame, first_visit: str = FIRST_VISIT) -> DataFrame:
    """One row per event, or the table itself when it holds visits already.

    ``order_id`` is the transaction of a purchase and NULL on other events.
    """
    if is_visits(events):
        return events
    return events.select(
        *GRAIN[:-1],
        F.when(is_event(PURCHASE), F.col(ORDER)).alias(ORDER_ID),
        F.lit(1).cast("bigint").alias("events"),
        F.col(REVENUE).alias("revenue"),
        F.col(TIME).alias("first_at"),
        is_event(first_visit).alias("is_new"),
        is_event(PURCHASE).alias("bought"),
    )


def condense(events: DataFrame, first_visit: str = FIRST_VISIT) -> DataFrame:
    """One row per ``GRAIN``. Buffers are fixed-width, so this is a hash aggregation."""
    folded = [F.sum("events"), F.sum("revenue"), F.min("first_at"), F.max("is_new"), F.max("bought")]
    names = ["events", "revenue", "first_at", "is_new", "bought"]
    return visits(events, first_visit).groupBy(*GRAIN).agg(*[f.alias(n) for f, n in zip(folded, names)])
