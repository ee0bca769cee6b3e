"""Channel performance at event level: a user may appear in several channels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions.numeric import pct, r2
from clicktide.operators.profile import profile
from clicktide.operators.visits import ORDER_ID, visits
from clicktide.schemas import SESSION, USER


def channel_summary(events: DataFrame) -> DataFrame:
    """Takes cleansed events or visits."""
    p = profile(
        visits(events),
        ["source", "medium"],
        {"sessions": F.col(SESSION), "users": F.col(USER), "orders": F.col(ORDER_ID)},
        flags={"buying_sessions": ("sessions", F.col("bought"))},
        folds={"revenue": ("sum", F.col("revenue"))},
    )
    return p.select(
        "source",
        "medium",
        "sessions",
        "users",
        "orders",
        r2(F.col("revenue")).alias("revenue"),
        pct(F.col("buying_sessions"), F.col("sessions")).alias("session_conversion_pct"),
    )
