"""Extraction: day shards of nested events to landed flat events and items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clicktide.operators.flatten import flatten_events, flatten_items
from clicktide.schemas import NESTED_EVENTS
from clicktide.session import pin_utc
from clicktide.sources.landing import land, manifest
from clicktide.sources.shards import scan_days
from clicktide.sources.tables import write_table


def extract(
    spark: SparkSession,
    shards: str,
    folder: str,
    start: str,
    end: str,
    first: str,
    last: str,
    schema: T.StructType = NESTED_EVENTS,
) -> DataFrame:
    """Land the days ``start .. end`` below ``folder`` and return the manifest written with them.

    ``folder/events`` and ``folder/items`` can be the sources of a build. The
    two outputs are separate scans: parameters and items are never expanded
    together. Each reads only the nested fields it needs.
    """
    pin_utc(spark)
    nested = scan_days(spark, shards, start, end, first, last, schema)
    outputs = {"events": f"{folder.rstrip('/')}/events", "items": f"{folder.rstrip('/')}/items"}
    land(flatten_events(nested), outputs["events"])
    land(flatten_items(nested), outputs["items"])
    written = manifest(spark, outputs, shards, start, end)
    return write_table(written, f"{folder.rstrip('/')}/manifest")
