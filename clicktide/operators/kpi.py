"""Daily, overall and build-level key figures.

Each takes cleansed events or visits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.functions.numeric import pct, r2
from clicktide.operators.profile import profile
from clicktide.operators.visits import ORDER_ID, visits
from clicktide.schemas import DATE, FIRST_VISIT, SESSION, USER


def daily_kpi(events: DataFrame, first_visit: str = FIRST_VISIT) -> DataFrame:
    p = profile(
        visits(events, first_visit),
        [DATE],
        {"users": F.col(USER), "sessions": F.col(SESSION), "orders": F.col(ORDER_ID)},
        flags={"new_users": ("users", F.col("is_new")), "purchasers": ("users", F.col("bought"))},
        folds={"events": ("sum", F.col("events")), "revenue": ("sum", F.col("revenue"))},
    )
    return p.select(
        DATE, "events", "users", "sessions", "new_users", "purchasers", "orders", r2(F.col("revenue")).alias("revenue")
    )


def summary(events: DataFrame, mode: str | None = None, first_visit: str = FIRST_VISIT) -> DataFrame:
    """One row over all events; with ``mode`` the build's data mode is a last column."""
    p = profile(
        visits(events, first_visit),
        [],
        {"users": F.col(USER), "sessions": F.col(SESSION), "orders": F.col(ORDER_ID)},
        flags={
            "new_users": ("users", F.col("is_new")),
            "purchasers": ("users", F.col("bought")),
            "buying_sessions": ("sessions", F.col("bought")),
        },
        folds={
            "events": ("sum", F.col("events")),
            "revenue": ("sum", F.col("revenue")),
            "start_date": ("min", F.col(DATE)),
            "end_date": ("max", F.col(DATE)),
        },
    )
    out = p.select(
        F.coalesce(F.col("events"), F.lit(0)).alias("events"),
        "users",
        "sessions",
        "new_users",
        "purchasers",
        "orders",
        r2(F.col("revenue")).alias("revenue"),
        pct(F.col("buying_sessions"), F.col("sessions")).alias("session_conversion_pct"),
        "start_date",
        "end_date",
    )
    return out if mode is None else out.withColumn("data_mode", F.lit(mode))


def build_summary(events: DataFrame, items: DataFrame, mode: str) -> DataFrame:
    """Size of a build: rows, users, days, orders and revenue."""
    p = profile(
        visits(events),
        [],
        {"users": F.col(USER), "days": F.col(DATE), "orders": F.col(ORDER_ID)},
        folds={"events": ("sum", F.col("events")), "revenue": ("sum", F.col("revenue"))},
    )
    counted = items.agg(F.count(F.lit(1)).alias("item_rows"))
    # Two one-row results, folded into one row.
    both = p.unionByName(counted, allowMissingColumns=True)
    return both.agg(
        F.lit(mode).alias("mode"),
        F.coalesce(F.max("events"), F.lit(0)).alias("events"),
        F.max("item_rows").alias("item_rows"),
        F.max("users").alias("users"),
        F.max("days").alias("days"),
        F.max("orders").alias("orders"),
        r2(F.max("revenue")).alias("revenue"),
    )


def build_metadata(spark: SparkSession, mode: str) -> DataFrame:
    """Data mode and build time, one row."""
    return spark.range(1).select(F.lit(mode).alias("data_mode"), F.current_timestamp().alias("built_at"))
