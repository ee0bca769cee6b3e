"""Refresh driven by newly landed files.

A file stream remembers which landed files it has seen. Each micro-batch only
names the days that got new files; those days are then refreshed from the whole
landing folder. Late and repeated files therefore need no watermark, and a
repeated micro-batch gives the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clicktide.plans.refresh import refresh
from clicktide.plans.warehouse import JobConfig
from clicktide.schemas import DATE


def refresh_arrivals(spark: SparkSession, cfg: JobConfig, schema: T.StructType, progress: str) -> StreamingQuery:
    """Start a run over all files not seen yet; it stops when they are done.

    ``progress`` is the stream's own checkpoint folder on shared storage.
    """

    def on_batch(batch: DataFrame, _: int) -> None:
        days = batch.select(F.col(DATE).cast("date")).distinct().collect()  # one row per day
        if days:
            refresh(batch.sparkSession, cfg, [r[0] for r in days])

    arrivals = spark.readStream.schema(schema).parquet(cfg.events_path).select(DATE)
    return (
        arrivals.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
