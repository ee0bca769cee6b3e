"""Registered queries: name -> function of (session, table folder)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import bindings as b
from clicktide.functions.numeric import r2, to_places
from clicktide.operators import kpi, views
from clicktide.operators.anomaly import daily_anomaly
from clicktide.operators.channels import channel_summary
from clicktide.operators.cleanse import cleanse_events, cleanse_items, dedupe, raw_defects
from clicktide.operators.flatten import flatten_events, flatten_items, repeated_params
from clicktide.operators.funnel import funnel
from clicktide.operators.gaps import gap_sessions
from clicktide.operators.metrics import metrics
from clicktide.operators.products import product_summary
from clicktide.operators.quality import quality_report, step_rises
from clicktide.operators.retention import cohort_retention, weighted_retention
from clicktide.operators.sessions import session_summary
from clicktide.operators.users import user_base, user_value
from clicktide.operators.visits import condense
from clicktide.plans.analysis import analysis_summary
from clicktide.plans.extract import extract
from clicktide.plans.refresh import refresh
from clicktide.plans.warehouse import JobConfig, run, table_path
from clicktide.session import scratch_path, settle
from clicktide.sources.flat import read_events, read_items
from clicktide.sources.landing import land, manifest
from clicktide.sources.shards import scan_days, validate_range
from clicktide.sources.tables import export_contract, read_table, write_table, writer
from clicktide.streaming.facts import stream_facts, streamed_facts

Query = Callable[[SparkSession, str], DataFrame]


def _over_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(b.events(spark, sf))


def _over_items(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(b.items(spark, sf))


def _daily(events: DataFrame) -> DataFrame:
    return kpi.daily_kpi(events, b.FIRST_VISIT)


def _steps(events: DataFrame) -> DataFrame:
    return funnel(events, b.STEPS)


def _sessions(events: DataFrame) -> DataFrame:
    return session_summary(events).withColumn("revenue", r2(F.col("revenue")))


def _gaps(events: DataFrame, gap: timedelta, cells: int) -> DataFrame:
    return gap_sessions(events, gap, cells).withColumn("revenue", r2(F.col("revenue")))


def _streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Events through three landings of a stream: each brings some days late, and the last days before it once more."""
    landed, target, progress = (scratch_path(spark, f"stream-{part}") for part in ("landed", "facts", "progress"))
    rows = b.flat_source(spark, sf)
    day = F.dayofmonth("event_date")
    late = (day % 4 == 0) & (F.minute("event_timestamp") < 20)
    landings = [(day <= 10) & ~late, (day.between(9, 20) & ~late) | ((day <= 10) & late), (day >= 19) | (day.between(11, 20) & late)]
    for chosen in landings:
        rows.where(chosen).write.mode("append").parquet(landed)
        stream_facts(spark, landed, target, progress, rows.schema, delay="12 days").awaitTermination()
    return streamed_facts(spark, target)


def _visits(spark: SparkSession, sf: str) -> DataFrame:
    return condense(b.events(spark, sf), b.FIRST_VISIT).withColumn("revenue", r2(F.col("revenue")))


def _anomaly(events: DataFrame) -> DataFrame:
    """Mean and deviation to six places: engines differ in the last bits."""
    found = daily_anomaly(_daily(events))
    return found.withColumns({c: to_places(F.col(c), 6) for c in ("avg_7d", "sd_7d")})


def _anomalies(events: DataFrame) -> DataFrame:
    """A low threshold, so that the synthetic days hold some."""
    return views.anomalies(daily_anomaly(_daily(events), z=1.0)).select("event_date", "users", "user_zscore")


def _metric_values(spark: SparkSession, sf: str) -> DataFrame:
    on_events = metrics(["users", "sessions", "purchasers", "orders", "revenue"], b.events(spark, sf), ["source"])
    return on_events.withColumn("revenue", r2(F.col("revenue")))


def _conversion(spark: SparkSession, sf: str) -> DataFrame:
    sessions = session_summary(b.events(spark, sf))
    return metrics(["purchase_conversion"], sessions, ["medium"])


def _dedupe_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    lines = b.table(spark, sf, "lineitem", b.LINEITEM)
    keys = ["l_orderkey", "l_linenumber"]
    rest = [F.col(c) for c in lines.columns if c not in keys]
    return dedupe(lines, [F.col(k) for k in keys], rest)


def _build_summary(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.build_summary(b.events(spark, sf), b.items(spark, sf), "fixture")


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    """Facts and visits as written tables, as in a build."""
    events = settle(b.events(spark, sf), "quality-events")
    condensed = settle(condense(events, b.FIRST_VISIT), "quality-visits")
    tables = {
        "events": events,
        "visits": condensed,
        "items": b.items(spark, sf),
        "session_summary": session_summary(condensed),
        "daily_kpi": _daily(condensed),
        "funnel": _steps(events),
        "cohort_retention": cohort_retention(condensed),
        "user_value": user_value(condensed),
    }
    return quality_report(tables, b.BOUNDS)


def _csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Events through CSV text of all 15 columns, in an order of their own, and back into the cleansed table."""
    path = scratch_path(spark, "events") + ".csv"
    source = b.flat_source(spark, sf).withColumns(
        {"page_location": F.lit(None).cast("string"), "total_item_quantity": F.lit("1"), "is_entrance": F.lit(True)}
    )
    order = ["is_entrance", *source.columns[:8], "page_location", "transaction_id", "purchase_revenue", "total_item_quantity"]
    out = source.select(*order, "device_category", "country")
    out.write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path)
    return cleanse_events(read_events(spark, path))


def _landed_nested(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "nested")
    nested = b.nested_events(spark, sf)
    land(nested, path, partition="event_date")
    return path


def _scan_days(spark: SparkSession, sf: str) -> DataFrame:
    path = _landed_nested(spark, sf)
    schema: T.StructType = b.nested_events(spark, sf).schema
    some = scan_days(spark, path, "20240110", "20240120", "20240101", "20240130", schema)
    return flatten_events(some).groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


def _manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per landed day, from the manifest's files; every file must have its digest."""
    outputs = {"events": scratch_path(spark, "land-events"), "items": scratch_path(spark, "land-items")}
    land(flatten_events(b.nested_events(spark, sf)), outputs["events"])
    land(flatten_items(b.nested_baskets(spark, sf)), outputs["items"])
    files = manifest(spark, outputs, "supplied tables", "20240101", "20240130")
    day = F.regexp_extract("file", r"event_date=(\d{4}-\d{2}-\d{2})", 1).alias("day")
    hashed = (F.length("digest") == 64) & (F.col("bytes") > 0)
    return files.groupBy("source", "start", "end", "output", day).agg(
        F.sum("rows").alias("rows"), (F.count_if(hashed) == F.count(F.lit(1))).alias("all_hashed")
    )


def _extract(spark: SparkSession, sf: str) -> DataFrame:
    """Nested day shards landed as flat events and items, then built up to the daily KPI."""
    shards, folder = scratch_path(spark, "shards"), scratch_path(spark, "extract")
    nested = b.nested_events(spark, sf).withColumn("items", F.array(_one_item()))
    land(nested, shards, partition="event_date")
    extract(spark, shards, folder, "20240101", "20240130", "20240101", "20240131", nested.schema)
    landed = read_events(spark, f"{folder}/events")
    things = cleanse_items(read_items(spark, f"{folder}/items"))
    sold = things.groupBy("event_date").agg(F.sum("quantity").alias("quantity"))
    return _daily(cleanse_events(landed)).join(sold, "event_date")


def _one_item() -> Column:
    return F.struct(
        F.col("event_name").alias("item_id"),
        F.lit(None).cast("string").alias("item_name"),
        F.lit(None).cast("string").alias("item_brand"),
        F.lit(None).cast("string").alias("item_category"),
        F.lit(1.0).alias("price"),
        F.lit(2).cast("bigint").alias("quantity"),
        F.lit(1.0).alias("item_revenue"),
    )


TOTALS = {
    "events": "purchase_revenue",
    "items": "item_revenue",
    "daily_kpi": "revenue",
    "funnel": "users",
    "channel_summary": "revenue",
    "user_value": "revenue",
    "product_summary": "item_revenue",
}


def _contract(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, one total and the columns of each exported table, read back from its files."""
    events, items = b.events(spark, sf), b.items(spark, sf)
    folder = scratch_path(spark, "platform")
    done = export_contract(
        {
            "events": events,
            "items": items,
            "daily_kpi": _daily(events),
            "funnel": _steps(events),
            "channel_summary": channel_summary(events),
            "user_value": user_value(events),
            "product_summary": product_summary(items),
        },
        folder,
    )
    parts = [
        df.agg(
            F.lit(n).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            r2(F.sum(F.col(TOTALS[n]).cast("double"))).alias("total"),
            F.lit(" ".join(sorted(df.columns))).alias("column_names"),
        )
        for n, df in done.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _config(spark: SparkSession, source: str, items: str, fixture: bool = False) -> JobConfig:
    base = scratch_path(spark, "base")
    return JobConfig(base, source, b.BOUNDS, items, fixture, first_visit=b.FIRST_VISIT, steps=b.STEPS)


# Builds of this session, by what they were made from: several queries look at one build's tables.
_DONE: dict[tuple, dict[str, DataFrame]] = {}


def _once(make: Callable[..., dict[str, DataFrame]]) -> Callable[..., dict[str, DataFrame]]:
    def tables(spark: SparkSession, sf: str, *args) -> dict[str, DataFrame]:
        key = (make.__name__, spark.sparkContext.applicationId, sf, *args)
        if key not in _DONE:
            _DONE[key] = make(spark, sf, *args)
        return _DONE[key]

    return tables


@_once
def _built(spark: SparkSession, sf: str, fixture: bool = False) -> dict[str, DataFrame]:
    """A whole build of the supplied events and items."""
    source, items = scratch_path(spark, "landed"), scratch_path(spark, "landed-items")
    write_table(b.flat_source(spark, sf), source, "event_date")
    write_table(b.items(spark, sf), items, "event_date")
    return run(spark, _config(spark, source, items, fixture))


def _built_fixture(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the tables of a fixture build, read from the folders that it alone writes to."""
    done = _built(spark, sf, True)
    parts = []
    for name in ("funnel", "user_value", "product_summary", "session_summary", "quality_report"):
        read = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in done[name].inputFiles()})
        place = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
        parts.append(read.groupBy(place.alias("folder"), F.lit(name).alias("table_name")).agg(F.count(F.lit(1)).alias("rows")))
    skipped = done["quality_report"].where("status = 'not_applicable'")
    parts.append(skipped.groupBy(F.lit("warehouse_fixture").alias("folder"), F.col("rule").alias("table_name")).agg(F.count(F.lit(1)).alias("rows")))
    return reduce(DataFrame.unionByName, parts)


def _analysis(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return analysis_summary(_built(spark, sf), 7)


@_once
def _all_refreshed(spark: SparkSession, sf: str, undated: bool) -> dict[str, DataFrame]:
    """Tables built on all but the last week, then refreshed with that week.

    ``undated`` takes the day from a third of that week's rows.
    """
    source, items = scratch_path(spark, "landed"), scratch_path(spark, "landed-items")
    last = b.BOUNDS.last
    week = [last - timedelta(days=d) for d in range(7)]
    rows = b.flat_source(spark, sf)
    new = F.col("event_date") >= min(week)
    if undated:
        rows = rows.withColumn("event_date", F.when(~new | (F.minute("event_timestamp") >= 20), F.col("event_date")))
        new = F.coalesce(new, F.lit(True))
    things = b.dated_items(spark, sf)
    write_table(rows.where(~new), source, "event_date")
    write_table(things.where(F.col("event_date") < min(week)), items, "event_date")
    cfg = _config(spark, source, items)
    schemas = {name: df.schema for name, df in run(spark, cfg).items()}
    # The rest lands beside what is there, as new days do.
    writer(rows.where(F.coalesce(new, F.lit(True))), "event_date").mode("append").parquet(source)
    writer(things.where(F.coalesce(F.col("event_date") >= min(week), F.lit(True))), "event_date").mode("append").parquet(items)
    refresh(spark, cfg, [*week, None] if undated else week)
    return {name: read_table(spark, table_path(cfg, name), schema) for name, schema in schemas.items()}


def _refreshed(spark: SparkSession, sf: str, name: str, undated: bool = False) -> DataFrame:
    return _all_refreshed(spark, sf, undated)[name]


def _refused(spark: SparkSession, sf: str) -> DataFrame:
    """What must be refused or tolerated, tried on the supplied events; one row of flags."""
    events = flatten_events(b.nested_events(spark, sf))

    def fails(attempt: Callable[[], object]) -> bool:
        try:
            attempt()
        except (ValueError, RuntimeError, AnalysisException):
            return True
        return False

    nowhere = scratch_path(spark, "nowhere")
    days = events.select(F.date_format(F.max("event_date"), "yyyyMMdd")).first()[0]
    flags = {
        "missing_events": fails(lambda: read_events(spark, nowhere)),
        "missing_items_are_empty": read_items(spark, nowhere).count() == 0,
        "empty_extract": fails(lambda: land(events.where("event_name = 'nothing'"), nowhere)),
        "days_after_the_last": fails(lambda: validate_range("20240101", "20991231", "20240101", days)),
        "turned_range": fails(lambda: validate_range(days, "20240101", "20240101", days)),
    }
    return events.agg(*[F.lit(flag).alias(name) for name, flag in flags.items()], F.count(F.lit(1)).alias("rows"))


def queries() -> dict[str, Query]:
    return {
        "dwd_events": lambda s, d: b.events(s, d),
        "dwd_events_from_csv": _csv_round_trip,
        "dwd_events_copies": lambda s, d: cleanse_events(b.doubled_source(s, d)),
        "dwd_items": lambda s, d: b.items(s, d),
        "dedupe_lineitem": _dedupe_lineitem,
        "raw_defects": lambda s, d: raw_defects(b.defective_source(s, d)),
        "flatten_events": lambda s, d: flatten_events(b.nested_events(s, d)),
        "flatten_items": lambda s, d: flatten_items(b.nested_baskets(s, d)),
        "repeated_params": lambda s, d: repeated_params(b.nested_events(s, d)),
        "session_summary": _over_events(_sessions),
        "gap_sessions": _over_events(lambda ev: _gaps(ev, timedelta(minutes=30), 4096)),
        "gap_sessions_stitched": _over_events(lambda ev: _gaps(ev, timedelta(hours=12), 3)),
        "streamed_events": _streamed,
        "daily_kpi": _over_events(_daily),
        "trend": _over_events(lambda ev: views.trend(_daily(ev))),
        "summary": _over_events(lambda ev: kpi.summary(ev, "fixture", b.FIRST_VISIT)),
        "build_summary": _build_summary,
        "visits": _visits,
        "metric_values": _metric_values,
        "metric_conversion": _conversion,
        "funnel": _over_events(_steps),
        "funnel_monotone": _over_events(lambda ev: step_rises(_steps(ev))),
        "cohort_retention": _over_events(cohort_retention),
        "retention": _over_events(lambda ev: views.retention(cohort_retention(ev))),
        "weighted_retention": _over_events(lambda ev: weighted_retention(cohort_retention(ev))),
        "week1_recent": _over_events(lambda ev: views.week1_recent(cohort_retention(ev))),
        "channel_summary": _over_events(channel_summary),
        "channels": _over_events(lambda ev: views.channels(channel_summary(ev))),
        "top_channels": _over_events(lambda ev: views.channels(channel_summary(ev), 7)),
        "product_summary": _over_items(product_summary),
        "products": _over_items(lambda it: views.products(product_summary(it))),
        "top_products": _over_items(lambda it: views.products(product_summary(it), 8)),
        "user_base": _over_events(user_base),
        "user_value": _over_events(user_value),
        "user_value_distributed": _over_events(lambda ev: user_value(condense(ev))),
        "segments": _over_events(lambda ev: views.segments(user_value(ev))),
        "daily_anomaly": _over_events(_anomaly),
        "anomalies": _over_events(_anomalies),
        "quality_report": _quality,
        "scan_days": _scan_days,
        "landing_manifest": _manifest,
        "extract_and_build": _extract,
        "contract_export": _contract,
        "incremental_events": lambda s, d: _refreshed(s, d, "events"),
        "incremental_kpi": lambda s, d: _refreshed(s, d, "daily_kpi"),
        "incremental_cohorts": lambda s, d: _refreshed(s, d, "cohort_retention"),
        "incremental_undated": lambda s, d: _refreshed(s, d, "events", undated=True),
        "incremental_undated_kpi": lambda s, d: _refreshed(s, d, "daily_kpi", undated=True),
        "incremental_sessions": lambda s, d: _refreshed(s, d, "session_summary").withColumn("revenue", r2(F.col("revenue"))),
        "incremental_funnel": lambda s, d: _refreshed(s, d, "funnel"),
        "incremental_channels": lambda s, d: _refreshed(s, d, "channel_summary"),
        "incremental_users": lambda s, d: _refreshed(s, d, "user_value"),
        "incremental_anomaly": lambda s, d: _refreshed(s, d, "daily_anomaly").withColumns(
            {c: to_places(F.col(c), 6) for c in ("avg_7d", "sd_7d")}
        ),
        "incremental_summary": lambda s, d: _refreshed(s, d, "summary"),
        "incremental_items": lambda s, d: _refreshed(s, d, "items"),
        "incremental_products": lambda s, d: _refreshed(s, d, "product_summary"),
        "incremental_visits": lambda s, d: _refreshed(s, d, "visits").withColumn("revenue", r2(F.col("revenue"))),
        "incremental_build_summary": lambda s, d: _refreshed(s, d, "build_summary"),
        "incremental_quality": lambda s, d: _refreshed(s, d, "quality_report"),
        "run_summary": lambda s, d: _built(s, d)["summary"],
        "run_items": lambda s, d: _built(s, d)["items"],
        "run_products": lambda s, d: _built(s, d)["product_summary"],
        "run_build_summary": lambda s, d: _built(s, d)["build_summary"],
        "run_quality": lambda s, d: _built(s, d)["quality_report"],
        "run_fixture": _built_fixture,
        "run_metadata": lambda s, d: _built(s, d)["build_metadata"].select("data_mode", F.col("built_at").isNotNull().alias("timed")),
        "analysis_summary": lambda s, d: _analysis(s, d)["summary"],
        "analysis_funnel": lambda s, d: _analysis(s, d)["funnel"],
        "analysis_channels": lambda s, d: _analysis(s, d)["top_channels"],
        "analysis_products": lambda s, d: _analysis(s, d)["top_products"],
        "analysis_anomalies": lambda s, d: _analysis(s, d)["anomaly_dates"],
        "analysis_retention": lambda s, d: _analysis(s, d)["retention_weeks_0_to_4"],
        "refused_input": _refused,
    }
