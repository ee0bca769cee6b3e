"""Streamed facts: late and repeated files, bounded state, late rows counted."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from clicktide.operators.cleanse import cleanse_events
from clicktide.schemas import EXTRACTED_EVENTS
from clicktide.session import scratch_path
from clicktide.streaming.facts import stream_facts, streamed_facts, totals

START = datetime(2021, 3, 1)


def landing(spark, days, path, users=40, order=None):
    rows = []
    for day in days:
        for k in range(users):
            at = START + timedelta(days=day, minutes=k)
            rows.append({"event_date": at.date(), "event_timestamp": at, "event_name": "purchase", "user_pseudo_id": f"u{k}", "transaction_id": order, "purchase_revenue": 1.5})
    df = spark.createDataFrame([tuple(r.get(c) for c in EXTRACTED_EVENTS.names) for r in rows], EXTRACTED_EVENTS)
    df.coalesce(1).write.mode("append").parquet(path)


def as_rows(df):
    return sorted(map(repr, df.collect()))


def test_late_and_repeated_files_give_the_batch_facts(spark):
    landed, target, progress = (scratch_path(spark, f"facts-{n}") for n in ("landed", "target", "progress"))

    def go():
        query = stream_facts(spark, landed, target, progress, EXTRACTED_EVENTS, "5 days")
        query.awaitTermination()
        return totals(query)

    landing(spark, [0, 1, 3], landed)
    assert go().copies == 0
    landing(spark, [1, 2, 3, 4], landed, order="")  # a repeated file, whose empty order is the missing one, and a late day
    second = go()
    assert (second.copies, second.late) == (80, 0)
    landing(spark, [4, 5], landed)
    landing(spark, [5], landed)
    assert go().copies == 80
    nothing_new = go()
    assert nothing_new.read == 0
    batch = cleanse_events(spark.read.schema(EXTRACTED_EVENTS).parquet(landed)).drop("transaction_id")
    assert as_rows(streamed_facts(spark, target).drop("transaction_id")) == as_rows(batch.select(*streamed_facts(spark, target).drop("transaction_id").columns))


def test_state_behind_the_watermark_is_dropped(spark):
    landed, target, progress = (scratch_path(spark, f"state-{n}") for n in ("landed", "target", "progress"))
    held = []
    for day in range(0, 24, 4):
        landing(spark, range(day, day + 4), landed, users=25)
        query = stream_facts(spark, landed, target, progress, EXTRACTED_EVENTS, "1 day")
        query.awaitTermination()
        held.append(totals(query).held)
    assert streamed_facts(spark, target).count() == 24 * 25
    assert max(held) <= 4 * 25 + 2 * 25 and held[-1] <= held[1]  # days of a landing, and those within twice the delay
    landing(spark, [2], landed, users=25)  # far behind the watermark
    query = stream_facts(spark, landed, target, progress, EXTRACTED_EVENTS, "1 day")
    query.awaitTermination()
    assert totals(query).late == 25 and streamed_facts(spark, target).count() == 24 * 25


def test_rows_without_time_or_user_are_left_out(spark):
    landed, target, progress = (scratch_path(spark, f"odd-{n}") for n in ("landed", "target", "progress"))
    landing(spark, [0], landed, users=3)
    odd = spark.read.schema(EXTRACTED_EVENTS).parquet(landed)
    odd.withColumn("event_timestamp", F.lit(None).cast("timestamp")).write.mode("append").parquet(scratch := scratch_path(spark, "odd"))
    spark.read.schema(EXTRACTED_EVENTS).parquet(scratch).write.mode("append").parquet(landed)
    stream_facts(spark, landed, target, progress, EXTRACTED_EVENTS).awaitTermination()
    assert streamed_facts(spark, target).count() == 3
