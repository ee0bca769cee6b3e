"""Flat source rows to the cleansed event and item facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.functions.numeric import lenient_long, money
from clicktide.operators.flatten import traffic
from clicktide.schemas import DATE, NAME, ORDER, REVENUE, SESSION, TIME, USER


def bind_events(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Rename or compute the canonical columns of an arbitrary event table.

    ``mapping`` goes from canonical name to a source column name or expression.
    """
    return df.select(
        *[(F.col(src) if isinstance(src, str) else src).alias(name) for name, src in mapping.items()]
    )


def dedupe(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """Keep the first row of each key group; repeatable when ``order`` is total.

    The rank filter lets Spark drop all but one copy per key within each input
    task, before the shuffle, so a group of many copies never meets in one task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_copy", F.row_number().over(first))
    return ranked.where(F.col("_copy") == 1).drop("_copy")


def event_key() -> list[Column]:
    """Identity of an event. A missing and an empty order id count as the same."""
    return [F.col(TIME), F.col(NAME), F.col(USER), F.coalesce(F.col(ORDER), F.lit(""))]


def typed_events(ods: DataFrame) -> DataFrame:
    """Strictly typed, filtered and repaired events, copies still included."""
    present = ods.where(F.col(USER).isNotNull() & F.col(NAME).isNotNull())
    return present.select(
        F.col(DATE).cast("date").alias(DATE),
        F.col(TIME).cast("timestamp").alias(TIME),
        NAME,
        USER,
        SESSION,
        traffic("source", F.col("source")),
        traffic("medium", F.col("medium")),
        traffic("campaign", F.col("campaign")),
        ORDER,
        money(F.col(REVENUE)).alias(REVENUE),
        "device_category",
        "country",
    )


def cleanse_events(ods: DataFrame) -> DataFrame:
    rest = (DATE, SESSION, "source", "medium", "campaign", ORDER, REVENUE, "device_category", "country")
    return dedupe(typed_events(ods), event_key(), [F.col(name) for name in rest])


def cleanse_items(ods: DataFrame) -> DataFrame:
    """Typed items. Copies and incomplete rows stay: they are real basket lines."""
    return ods.select(
        F.col(DATE).cast("date").alias(DATE),
        F.col(TIME).cast("timestamp").alias(TIME),
        NAME,
        USER,
        ORDER,
        "item_id",
        "item_name",
        "item_brand",
        "item_category",
        F.col("price").try_cast("double").alias("price"),
        lenient_long(ods, "quantity").alias("quantity"),
        money(F.col("item_revenue")).alias("item_revenue"),
    )


def raw_defects(ods: DataFrame) -> DataFrame:
    """What cleansing changes, counted on the raw side (rules on the result cannot see it)."""
    amount = F.col(REVENUE).try_cast("double")
    return ods.agg(
        F.count_if(F.col(USER).isNull()).alias("rows_without_user"),
        F.count_if(F.col(USER).isNotNull() & F.col(NAME).isNull()).alias("rows_without_name"),
        F.count_if(amount < 0).alias("negative_amounts"),
        F.count_if(F.col(REVENUE).isNotNull() & amount.isNull()).alias("unreadable_amounts"),
    )
