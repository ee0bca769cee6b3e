"""Event facts from a file stream, deduplicated in state of bounded size.

The batch job drops copies by a shuffle over all events. Here each key is held in
state from its first arrival until the watermark has passed it by the allowed
delay, so what is kept grows with the events of that time and not with history.
The file sink commits each micro-batch once, also when it is repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clicktide.operators.cleanse import typed_events
from clicktide.schemas import DATE, EVENTS, NAME, ORDER, TIME, USER
from clicktide.session import require_strict
from clicktide.sources.tables import read_table


def first_arrivals(ods: DataFrame, delay: str) -> DataFrame:
    """Cleansed events of a stream, each key once: the copy that arrives first.

    A missing and an empty order id are the same. Copies may arrive up to ``delay``
    apart in event time of what has been seen; a row that is later than that is
    dropped and counted. Rows without a time have no place in a watermark and are
    left out: ``refresh`` takes them.
    """
    order_key = "_order"
    timed = typed_events(ods).where(F.col(TIME).isNotNull()).withColumn(order_key, F.coalesce(ORDER, F.lit("")))
    once = timed.withWatermark(TIME, delay).dropDuplicatesWithinWatermark([TIME, NAME, USER, order_key])
    return once.drop(order_key)


def stream_facts(spark: SparkSession, landed: str, target: str, progress: str, schema: T.StructType, delay: str = "3 days") -> StreamingQuery:
    """Append the events of files not seen yet to the table at ``target``, by day; it stops when they are done.

    ``progress`` is the stream's own checkpoint folder on shared storage. Read the
    table with ``streamed_facts``: files of a micro-batch that did not commit are
    not listed.
    """
    require_strict(spark)
    arrivals = spark.readStream.schema(schema).parquet(landed)
    out = first_arrivals(arrivals, delay).writeStream.format("parquet").option("compression", "zstd").partitionBy(DATE)
    return out.option("checkpointLocation", progress).trigger(availableNow=True).outputMode("append").start(target)


def streamed_facts(spark: SparkSession, target: str) -> DataFrame:
    """The committed events, as ``EVENTS``."""
    return read_table(spark, target, EVENTS)


@dataclass(frozen=True)
class StreamTotals:
    """Rows read, copies dropped, rows too late, and keys held at the end."""

    read: int
    copies: int
    late: int
    held: int


def totals(query: StreamingQuery) -> StreamTotals:
    """What the micro-batches of a run did; days of late rows are for ``refresh``."""
    batches = query.recentProgress
    states = [s for b in batches for s in b.stateOperators]
    copies = sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in states)
    late = sum(s.numRowsDroppedByWatermark for s in states)
    return StreamTotals(sum(b.numInputRows for b in batches), copies, late, states[-1].numRowsTotal if states else 0)
