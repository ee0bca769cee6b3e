"""Nested export rows to flat event and item rows.

Events read the parameter array in place; items explode the item array. The two
are separate projections so parameters and items never multiply each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.functions.nested import has_param, param_int, param_str, repeated_keys, session_key

# Fixed values shown where a source leaves the traffic fields empty.
TRAFFIC_DEFAULTS = {"source": "(direct)", "medium": "(none)", "campaign": "(not set)"}


def traffic(field: str, value: Column) -> Column:
    return F.coalesce(value, F.lit(TRAFFIC_DEFAULTS[field])).alias(field)


def _when_and_who() -> list[Column]:
    return [
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_timestamp"),
        F.col("event_name"),
        F.col("user_pseudo_id"),
    ]


def flatten_events(nested: DataFrame) -> DataFrame:
    params, user = F.col("event_params"), F.col("user_pseudo_id")
    return nested.where(user.isNotNull()).select(
        *_when_and_who(),
        session_key(user, param_int(params, "ga_session_id")).alias("session_id"),
        traffic("source", F.col("traffic_source.source")),
        traffic("medium", F.col("traffic_source.medium")),
        traffic("campaign", F.col("traffic_source.name")),
        param_str(params, "page_location").alias("page_location"),
        F.col("ecommerce.transaction_id"),
        F.col("ecommerce.purchase_revenue"),
        F.col("ecommerce.total_item_quantity"),
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("country"),
        has_param(params, "entrances", 1).alias("is_entrance"),
    )


def flatten_items(nested: DataFrame) -> DataFrame:
    """One row per item; events without items give no row."""
    exploded = nested.select(
        *_when_and_who(),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.explode("items").alias("item"),
    )
    return exploded.select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id", "transaction_id", "item.*"
    )


def repeated_params(nested: DataFrame, keys=("ga_session_id", "page_location")) -> DataFrame:
    """Per key, how many surplus entries the look-ups skipped (they take the first)."""
    params = F.col("event_params")
    totals = nested.agg(
        *[F.coalesce(F.sum(repeated_keys(params, k)), F.lit(0)).alias(k) for k in keys]
    )
    pairs = [F.struct(F.lit(k).alias("key"), F.col(k).cast("bigint").alias("surplus")) for k in keys]
    return totals.select(F.inline(F.array(*pairs)))
