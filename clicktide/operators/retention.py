"""Weekly cohort retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.dates import week_start, weeks_between
from clicktide.functions.numeric import pct
from clicktide.schemas import DATE, USER


def user_weeks(events: DataFrame) -> DataFrame:
    """Distinct (user, active week), of events or visits, with the user's first week as ``cohort_week``.

    Rows are distinct before the window, so a user's share of one task is at
    most the number of weeks, however many events they have.
    """
    weeks = events.select(USER, week_start(F.col(DATE)).alias("active_week")).distinct()
    first = F.min("active_week").over(Window.partitionBy(USER))
    return weeks.withColumn("cohort_week", first)


def retention_of(weeks: DataFrame) -> DataFrame:
    number = weeks_between(F.col("cohort_week"), F.col("active_week")).alias("week_number")
    counted = weeks.groupBy("cohort_week", number).agg(F.count(F.lit(1)).alias("retained_users"))
    by_week = Window.partitionBy("cohort_week").orderBy(F.col("week_number").asc_nulls_last())
    sized = counted.withColumn("cohort_size", F.first("retained_users").over(by_week))
    rate = pct(F.col("retained_users"), F.col("cohort_size"))
    return sized.withColumn("retention_rate_pct", rate)


def cohort_retention(events: DataFrame) -> DataFrame:
    return retention_of(user_weeks(events))


def weighted_retention(cohorts: DataFrame, low: int = 0, high: int = 4) -> DataFrame:
    """Retention per week over all cohorts that have a row for that week.

    A cohort nobody returned to in a week has no row there and so is missing
    from that week's denominator as well; this is the defined behaviour.
    """
    totals = (
        cohorts.where(F.col("week_number").between(low, high))
        .groupBy("week_number")
        .agg(F.sum("retained_users").alias("retained_users"), F.sum("cohort_size").alias("eligible_users"))
    )
    rate = pct(F.col("retained_users"), F.col("eligible_users"))
    return totals.withColumn("weighted_retention_pct", rate)
