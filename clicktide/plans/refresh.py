"""Incremental refresh: new or back-filled days without rebuilding the rest.

The result equals a full build over the same source, for every table.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicktide.functions.dates import week_start
from clicktide.operators.cleanse import cleanse_events, cleanse_items, event_key, typed_events
from clicktide.operators.funnel import step_times
from clicktide.operators.kpi import daily_kpi
from clicktide.operators.retention import cohort_retention, retention_of, user_weeks
from clicktide.operators.visits import condense
from clicktide.plans.presence import count_all, count_days
from clicktide.plans.warehouse import INTERNAL, JobConfig, dependent_marts, presence_root, table_path
from clicktide.schemas import DATE, EVENTS, TIME, USER
from clicktide.session import delete_folder, require_strict, scratch_scope, settle
from clicktide.sources.flat import empty_items, read_events, read_items
from clicktide.sources.tables import CONTRACT, is_foldered, read_table, replace_partitions, rewrite_partitions

Span = tuple[datetime, datetime]


def on_days(days: Iterable[date | None], column: str = DATE) -> Column:
    """True for rows of these days, false (never NULL) for all others. None stands for rows without a day."""
    days = set(days)
    known = sorted(days - {None})
    hit = F.coalesce(F.col(column).isin(known), F.lit(False)) if known else F.lit(False)
    return hit | F.col(column).isNull() if None in days else hit


def _time_spans(events: DataFrame, days: set[date | None]) -> tuple[list[Span], bool]:
    """Time ranges of the hours present on these days, adjoining ones joined, and whether any time is missing.

    An event with a wrong clock makes a short range of its own instead of
    widening that of its day.
    """
    per_hour = (
        events.where(on_days(days))
        .groupBy(F.date_trunc("hour", TIME).alias("hour"))
        .agg(F.min(TIME).cast("timestamp_ntz").alias("lo"), F.max(TIME).cast("timestamp_ntz").alias("hi"))
        .collect()  # one row per hour of the refreshed days, and one per odd hour
    )
    merged: list[Span] = []
    for lo, hi in sorted((r.lo, r.hi) for r in per_hour if r.hour is not None):
        if merged and lo - merged[-1][1] <= timedelta(hours=1):
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged, any(r.hour is None for r in per_hour)


def _possible_copies(events: DataFrame, days: set[date | None], spans: list[Span], untimed: bool) -> DataFrame:
    """Rows of other days that may be copies of events of these days.

    A copy has the same event time, so only rows inside the days' time ranges
    matter. The condition holds on its own for the scan, where file statistics
    skip nearly everything else.
    """
    reach = [F.col(TIME).between(_instant(lo), _instant(hi)) for lo, hi in spans]
    if untimed:
        reach.append(F.col(TIME).isNull())
    return events.where(reduce(Column.__or__, reach, F.lit(False))).where(~on_days(days))


def _instant(t: datetime) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast("timestamp")


def _days_sharing_events(ods: DataFrame, old: DataFrame, days: set[date | None]) -> set[date | None]:
    """Other days with a copy of an event that is, or was, dated on one of ``days``."""
    key = [k.alias(f"k{i}") for i, k in enumerate(event_key())]
    names = [f"k{i}" for i in range(len(key))]
    # A key new to these days, or gone from them, may change which copy survives.
    here = typed_events(ods).unionByName(old).where(on_days(days))
    spans, untimed = _time_spans(here, days)
    elsewhere = _possible_copies(typed_events(ods), days, spans, untimed)
    # Combined to one row per key and day before the join, however many copies there are.
    a = elsewhere.select(DATE, *key).distinct().alias("a")
    b = here.select(*key).distinct().alias("b")
    same = reduce(Column.__and__, [F.col(f"a.{n}").eqNullSafe(F.col(f"b.{n}")) for n in names])
    shared = a.join(b, same, "left_semi").select(DATE).distinct()
    return {r[0] for r in shared.collect()}  # one row per day


def cleansed_days(ods: DataFrame, days: set[date | None]) -> DataFrame:
    """The rows of ``days`` in a full cleansing of ``ods``."""
    events = typed_events(ods)
    spans, untimed = _time_spans(events, days)
    rivals = _possible_copies(events, days, spans, untimed)
    return cleanse_events(events.where(on_days(days)).unionByName(rivals)).where(on_days(days))


def _moved_users(weeks: DataFrame, now: DataFrame, touched: set[date | None]) -> DataFrame:
    """Users who gained or lost an active week among ``touched``."""
    before = weeks.where(on_days(touched, "active_week")).select(USER, "active_week", F.lit(-1).alias("side"))
    after = now.select(USER, "active_week", F.lit(1).alias("side"))
    changed = before.unionByName(after).groupBy(USER, "active_week").agg(F.sum("side").alias("side")).where("side != 0")
    return changed.select(USER).distinct()


def _refreshed_weeks(weeks: DataFrame, visits: DataFrame, touched: set[date | None]) -> tuple[DataFrame, DataFrame]:
    """The moved users' week rows as stored and as they are now.

    ``weeks`` is the stored (user, active week, cohort week) table and ``visits``
    the visits in the touched weeks, already refreshed. Only these weeks are
    looked at in visits; all other weeks of a user are taken from ``weeks``.
    """
    now = visits.select(USER, week_start(F.col(DATE)).alias("active_week")).distinct()
    moved = settle(_moved_users(weeks, now, touched), "moved-users")
    stored = settle(weeks.join(moved, USER, "left_semi"), "moved-weeks")
    kept = stored.where(~on_days(touched, "active_week")).select(USER, "active_week")
    come = kept.unionByName(now.join(moved, USER, "left_semi"))
    first = F.min("active_week").over(Window.partitionBy(USER))  # a row per week of a user
    return stored, settle(come.withColumn("cohort_week", first), "new-weeks")


def _monday(day: date | None) -> date | None:
    return None if day is None else day - timedelta(days=day.weekday())


def refresh(spark: SparkSession, cfg: JobConfig, days: Iterable[date | None]) -> None:
    """Bring all written tables up to date for ``days`` of the source; None names rows without a day.

    Facts, visits, step times, daily KPI and cohorts are refreshed by day and by cohort, and
    the stored distinct counts by the days' old and new visits. The marts over all days are then
    made from these counts, step times, items and KPI; the visits of other days
    are read for the sessions only, their events for the row rules only. What
    is derived is replaced before what it is derived from, the event facts last;
    if the job dies in between, running it again ends in the same tables.
    """
    require_strict(spark)
    with scratch_scope(spark):
        _refresh_facts(spark, cfg, set(days))
    done = {name: spark.read.schema(schema).parquet(table_path(cfg, name)).select(*schema.fieldNames()) for name, schema in _schemas(spark, cfg).items()}
    dependent_marts(spark, cfg, done)


def _schemas(spark: SparkSession, cfg: JobConfig) -> dict[str, T.StructType]:
    """Schemas of the tables that the other marts are made from."""
    events = spark.createDataFrame([], EVENTS)
    made = {
        "visits": condense(events),
        "step_times": step_times(events, cfg.steps),
        "daily_kpi": daily_kpi(events),
        "user_weeks": user_weeks(events),
        "cohort_retention": cohort_retention(events),
    }
    return {"events": EVENTS, "items": cleanse_items(empty_items(spark)).schema} | {name: df.schema for name, df in made.items()}


def _refresh_facts(spark: SparkSession, cfg: JobConfig, days: set[date | None]) -> None:
    schemas = _schemas(spark, cfg)
    ods = read_events(spark, cfg.events_path)
    old = read_table(spark, table_path(cfg, "events"), EVENTS)
    affected = days | _days_sharing_events(ods, old, days)

    come = settle(cleansed_days(ods, affected), "refreshed-events")
    come_visits = settle(condense(come, cfg.first_visit), "refreshed-visits")
    come_steps = settle(step_times(come, cfg.steps), "refreshed-steps")
    kpi = settle(daily_kpi(come_visits), "refreshed-kpi")

    # Visits of the touched weeks: the stored days that stay, and the refreshed ones.
    touched = {_monday(d) for d in affected}
    in_weeks = {monday + timedelta(days=n) if monday else None for monday in touched for n in range(7)}
    stored_visits = read_table(spark, table_path(cfg, "visits"), schemas["visits"])
    before = stored_visits.where(on_days(affected))
    counted = count_days(spark, presence_root(cfg), before, come_visits, affected)
    if not counted:
        delete_folder(spark, presence_root(cfg))  # so that no later job takes it for right
    around = stored_visits.where(on_days(in_weeks - affected)).unionByName(come_visits)

    weeks = read_table(spark, table_path(cfg, "user_weeks"), schemas["user_weeks"])
    gone, new_weeks = _refreshed_weeks(weeks, around, touched)
    both = gone.select("cohort_week").unionByName(new_weeks.select("cohort_week")).distinct()
    cohorts = {r[0] for r in both.collect()}  # one row per week
    # Only the folders of these cohorts are read and written.
    stay = weeks.where(on_days(cohorts, "cohort_week")).join(gone.select(USER).distinct(), USER, "left_anti")
    current = settle(stay.select(*new_weeks.columns).unionByName(new_weeks), "cohort-weeks")
    retention = settle(retention_of(current), "refreshed-cohorts")

    items = cleanse_items(read_items(spark, cfg.items_source)).where(on_days(days))
    replace = rewrite_partitions if is_foldered(spark, cfg.items_source, DATE) else replace_partitions
    replace(settle(items, "refreshed-items"), table_path(cfg, "items"), CONTRACT["items"], days)
    replace_partitions(kpi, table_path(cfg, "daily_kpi"), CONTRACT["daily_kpi"], affected)
    replace_partitions(retention, table_path(cfg, "cohort_retention"), INTERNAL["cohort_retention"], cohorts)
    replace_partitions(current, table_path(cfg, "user_weeks"), INTERNAL["user_weeks"], cohorts)
    replace_partitions(come_steps, table_path(cfg, "step_times"), INTERNAL["step_times"], affected)
    replace_partitions(come_visits, table_path(cfg, "visits"), INTERNAL["visits"], affected)
    if not counted:
        count_all(spark, presence_root(cfg), read_table(spark, table_path(cfg, "visits"), schemas["visits"]))
    replace_partitions(come, table_path(cfg, "events"), CONTRACT["events"], affected)
