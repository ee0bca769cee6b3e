"""User value: recency, frequency, money scores and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions.dates import days_between
from clicktide.functions.numeric import r2
from clicktide.operators.profile import profile
from clicktide.operators.ranking import ntile_columns
from clicktide.operators.visits import ORDER_ID, visits
from clicktide.schemas import DATE, SESSION, USER
from clicktide.session import settle

# Segment names.
HIGH_VALUE = "高价值"
ACTIVE_NO_ORDER = "活跃未购"
TO_WIN_BACK = "待唤回"
BUYER = "已购用户"
VISITOR = "普通访客"

SCORES = 5


def user_base(events: DataFrame) -> DataFrame:
    """Takes cleansed events or visits."""
    p = profile(
        visits(events),
        [USER],
        {"sessions": F.col(SESSION), "orders": F.col(ORDER_ID)},
        folds={"last_active": ("max", F.col(DATE)), "revenue": ("sum", F.col("revenue"))},
    )
    return p.select(USER, "last_active", "sessions", "orders", r2(F.col("revenue")).alias("revenue"))


def user_value(events: DataFrame) -> DataFrame:
    """Scores 1-5 per user (5 = most recent, most orders, most revenue) and a segment.

    Users with equal figures are ranked by id, so repeated runs agree. The users
    are written to scratch, a table that a ``scratch_scope`` around the caller's
    write removes, and read again in a few passes for the borders of the scores.
    """
    return scored_users(user_base(events))


def scored_users(base: DataFrame) -> DataFrame:
    """``user_value`` from the user base."""
    base = settle(base, "user-base")
    rows, latest = base.agg(F.count(F.lit(1)), F.max("last_active")).first()
    aged = base.withColumn("recency_days", days_between(F.col("last_active"), F.lit(latest).cast("date")))
    ranks = {"r_score": -F.col("recency_days"), "f_score": F.col("orders"), "m_score": F.col("revenue")}
    scored = aged.withColumns(ntile_columns(aged, ranks, USER, SCORES, rows))
    r, bought = F.col("r_score"), F.col("orders") > 0
    top = F.least("r_score", "f_score", "m_score") >= 4
    segment = (
        F.when(top, HIGH_VALUE)
        .when((r >= 4) & ~bought, ACTIVE_NO_ORDER)
        .when((r <= 2) & bought, TO_WIN_BACK)
        .when(bought, BUYER)
        .otherwise(VISITOR)
    )
    return scored.withColumn("segment", segment)


def segment_rollup(users: DataFrame) -> DataFrame:
    return users.groupBy("segment").agg(F.count(F.lit(1)).alias("users"), r2(F.avg("revenue")).alias("avg_revenue"))
