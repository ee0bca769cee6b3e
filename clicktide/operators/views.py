"""Read views over the marts, as an API, dashboard or report would ask for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.operators.ranking import top_k
from clicktide.operators.users import segment_rollup
from clicktide.schemas import DATE


def trend(kpi: DataFrame) -> DataFrame:
    return kpi.orderBy(DATE)


def funnel_steps(steps: DataFrame) -> DataFrame:
    return steps.orderBy("step_order")


def retention(cohorts: DataFrame) -> DataFrame:
    return cohorts.orderBy("cohort_week", "week_number")


def channels(summary: DataFrame, n: int | None = None) -> DataFrame:
    """All channels by revenue, or the top ``n``."""
    if n is not None:
        return top_k(summary, "revenue", ["source", "medium"], n)
    return summary.orderBy(F.col("revenue").desc_nulls_last(), "source", "medium")


def products(summary: DataFrame, n: int = 50) -> DataFrame:
    return top_k(summary, "item_revenue", ["item_id", "item_name", "item_category"], n)


def anomalies(daily: DataFrame) -> DataFrame:
    return daily.where("is_anomaly").orderBy(DATE)


def segments(users: DataFrame) -> DataFrame:
    return segment_rollup(users).orderBy(F.col("users").desc(), "segment")


def week1_recent(cohorts: DataFrame, n: int = 8, max_week: int = 8) -> DataFrame:
    """Week-1 retention of the latest ``n`` cohorts; NULL where nobody came back in week 1."""
    week1 = F.max(F.when(F.col("week_number") == 1, F.col("retention_rate_pct")))
    recent = (
        cohorts.where(F.col("week_number") <= max_week)
        .groupBy("cohort_week")
        .agg(week1.alias("week1_retention_pct"))
        .orderBy(F.col("cohort_week").desc())
        .limit(n)
    )
    return recent.orderBy("cohort_week")
