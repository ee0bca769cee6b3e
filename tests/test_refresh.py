"""Incremental refresh gives the tables a full build would give."""

from __future__ import annotations

import os
import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clicktide import schemas
from clicktide.operators.kpi import daily_kpi
from clicktide.operators.quality import Bounds
from clicktide.plans import refresh as refresh_module
from clicktide.plans.refresh import refresh
from clicktide.plans.warehouse import JobConfig, run, table_path
from clicktide.session import scratch_root
from clicktide.operators.funnel import funnel, funnel_of
from clicktide.sources.flat import read_events
from clicktide.sources.tables import read_table, write_table
from clicktide.streaming.ingest import refresh_arrivals

from conftest import as_set, event, events_of, plan_of

D0 = date(2020, 11, 2)


def on(day: int, **changes):
    at = datetime(2020, 11, 2, 8) + timedelta(days=day)
    return event(**{"event_date": at.date(), "event_timestamp": at, **changes})


def land_rows(spark, path, rows):
    df = events_of(spark, rows)
    write_table(df, path, "event_date")
    return df.schema


def land_items(spark, path, days):
    names = schemas.ITEMS.fieldNames()
    rows = [{**dict.fromkeys(names), "event_date": D0 + timedelta(days=d), "item_id": i, "item_revenue": 1.0} for d, i in days]
    write_table(spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schemas.ITEMS), path, "event_date")


def config(tmp_path) -> JobConfig:
    return JobConfig(str(tmp_path / "out"), str(tmp_path / "in" / "events"), Bounds(D0, D0 + timedelta(days=60)))


def full_tables(spark, cfg):
    """Every table that a build of the source writes elsewhere."""
    return run(spark, replace(cfg, base=f"{cfg.base}-full", items_path=cfg.items_source))


def build(spark, cfg):
    run(spark, cfg)


def check_equals_full(spark, cfg):
    for name, want in full_tables(spark, cfg).items():
        if name != "build_metadata":
            got = read_table(spark, table_path(cfg, name), want.schema)
            assert as_set(got) == as_set(want), name


BEFORE = [on(d, user_pseudo_id=f"u{u}", session_id=f"u{u}-{d}") for d in range(0, 21, 2) for u in range(4)]


def test_refresh_scans_its_days_and_time_ranges_only(spark, tmp_path):
    cfg = config(tmp_path)
    land_rows(spark, cfg.events_path, BEFORE)
    plan = plan_of(refresh_module.cleansed_days(read_events(spark, cfg.events_path), {D0}))
    scans = [line for line in plan[plan.index("== Physical Plan ==") :].splitlines() if "FileScan" in line]
    own, rivals = scans
    assert "PartitionFilters: [coalesce((event_date" in own
    assert "PartitionFilters: [NOT coalesce((event_date" in rivals
    assert "GreaterThanOrEqual" in rivals[rivals.index("PushedFilters") :]  # on the event time


def test_back_fill_moves_cohorts_and_empties_days(spark, tmp_path):
    cfg = config(tmp_path)
    late = [on(15, user_pseudo_id="late"), on(20, user_pseudo_id="late")]
    land_rows(spark, cfg.events_path, BEFORE + late)
    land_items(spark, cfg.items_source, [(0, "a"), (1, "b"), (2, "c")])
    build(spark, cfg)
    # Day 15 loses its only rows, day 1 gains a first visit that moves "late" two weeks
    # back, day 2 changes, day 30 is new.
    after = [r for r in BEFORE if r["event_date"] != D0 + timedelta(days=2)]
    after += [on(20, user_pseudo_id="late"), on(1, user_pseudo_id="late"), on(2, user_pseudo_id="u9"), on(30)]
    land_rows(spark, cfg.events_path, after)
    land_items(spark, cfg.items_source, [(0, "a"), (2, "d")])
    changed = [D0 + timedelta(days=d) for d in (1, 2, 15, 30)]
    refresh(spark, cfg, changed)
    check_equals_full(spark, cfg)
    refresh(spark, cfg, changed)
    check_equals_full(spark, cfg)


def test_copies_dated_on_other_days(spark, tmp_path):
    """The surviving copy of an event may move to or from a day that was not named."""
    cfg = config(tmp_path)
    same = {"event_timestamp": datetime(2020, 11, 5, 0, 10), "user_pseudo_id": "x"}
    untimed = {"event_timestamp": None, "user_pseudo_id": "y"}
    land_rows(spark, cfg.events_path, BEFORE + [on(3, **same), on(5, **untimed)])
    build(spark, cfg)
    land_rows(spark, cfg.events_path, BEFORE + [on(3, **same), on(2, **same), on(5, **untimed), on(2, **untimed)])
    refresh(spark, cfg, [D0 + timedelta(days=2)])
    check_equals_full(spark, cfg)
    land_rows(spark, cfg.events_path, BEFORE + [on(3, **same), on(5, **untimed)])
    refresh(spark, cfg, [D0 + timedelta(days=2)])
    check_equals_full(spark, cfg)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_back_fill(spark, tmp_path, seed):
    rng = random.Random(seed)

    def some(n):
        return [
            on(
                rng.randrange(28),
                user_pseudo_id=f"u{rng.randrange(12)}",
                event_timestamp=datetime(2020, 11, 2, 8) + timedelta(days=rng.randrange(28)),
                event_name=rng.choice(["page_view", "first_visit"]),
                country=rng.choice("AB"),
            )
            for _ in range(n)
        ]

    cfg, rows = config(tmp_path), some(250)
    land_rows(spark, cfg.events_path, rows)
    build(spark, cfg)
    days = {D0 + timedelta(days=d) for d in rng.sample(range(28), 3)}
    fresh = [r for r in some(250) if r["event_date"] in days]
    land_rows(spark, cfg.events_path, [r for r in rows if r["event_date"] not in days] + fresh)
    refresh(spark, cfg, days)
    check_equals_full(spark, cfg)


@pytest.mark.parametrize("table", ["cohort_retention", "user_weeks", "events"])
def test_interrupted_refresh_can_be_repeated(spark, tmp_path, monkeypatch, table):
    cfg = config(tmp_path)
    land_rows(spark, cfg.events_path, BEFORE + [on(15, user_pseudo_id="late")])
    build(spark, cfg)
    land_rows(spark, cfg.events_path, BEFORE + [on(1, user_pseudo_id="late")])
    days, real = [D0 + timedelta(days=d) for d in (1, 15)], refresh_module.replace_partitions

    def fails(df, path, partition, values):
        if path == table_path(cfg, table):
            raise OSError("lost")
        real(df, path, partition, values)

    monkeypatch.setattr(refresh_module, "replace_partitions", fails)
    with pytest.raises(OSError):
        refresh(spark, cfg, days)
    monkeypatch.setattr(refresh_module, "replace_partitions", real)
    refresh(spark, cfg, days)
    check_equals_full(spark, cfg)


def test_arrivals_refresh_their_days(spark, tmp_path):
    cfg = config(tmp_path)
    schema = land_rows(spark, cfg.events_path, BEFORE)
    build(spark, cfg)
    progress = str(tmp_path / "progress")
    refresh_arrivals(spark, cfg, schema, progress).awaitTermination()
    events_of(spark, [on(1, user_pseudo_id="new"), on(40)]).write.mode("append").partitionBy("event_date").parquet(
        cfg.events_path
    )
    refresh_arrivals(spark, cfg, schema, progress).awaitTermination()
    check_equals_full(spark, cfg)
    kpi = read_table(spark, table_path(cfg, "daily_kpi"), daily_kpi(events_of(spark, [])).schema)
    assert kpi.where(F.col("event_date") == D0 + timedelta(days=40)).first().users == 1


def test_rows_without_a_day(spark, tmp_path):
    """They are named by None, arrive by stream, and may have copies on dated days."""
    cfg = config(tmp_path)
    late = on(4, event_date=None, user_pseudo_id="n")
    schema = land_rows(spark, cfg.events_path, BEFORE)
    build(spark, cfg)
    progress = str(tmp_path / "progress")
    refresh_arrivals(spark, cfg, schema, progress).awaitTermination()
    events_of(spark, [late]).write.mode("append").partitionBy("event_date").parquet(cfg.events_path)
    refresh_arrivals(spark, cfg, schema, progress).awaitTermination()
    check_equals_full(spark, cfg)
    land_rows(spark, cfg.events_path, [*BEFORE, late, on(4, user_pseudo_id="n"), on(0, event_date=None)])
    refresh(spark, cfg, [None])
    check_equals_full(spark, cfg)


def test_a_wrong_clock_does_not_widen_the_scan(spark):
    odd = [on(0), on(0, event_timestamp=datetime(1999, 1, 1)), on(0, event_timestamp=datetime(2020, 11, 2, 8, 50))]
    spans, untimed = refresh_module._time_spans(events_of(spark, odd), {D0})
    assert [(a.year, (b - a).seconds) for a, b in spans] == [(1999, 0), (2020, 3000)] and not untimed


def test_cohorts_open_their_own_folders_only(spark, tmp_path):
    cfg = config(tmp_path)
    land_rows(spark, cfg.events_path, BEFORE)
    build(spark, cfg)
    weeks = spark.read.parquet(table_path(cfg, "user_weeks")).where(refresh_module.on_days({D0, None}, "cohort_week"))
    assert "PartitionFilters: [(coalesce((cohort_week" in plan_of(weeks)


def test_refresh_leaves_no_scratch(spark, tmp_path):
    cfg = config(tmp_path)
    land_rows(spark, cfg.events_path, BEFORE[:8])
    build(spark, cfg)
    before = set(os.listdir(scratch_root(spark)))
    refresh(spark, cfg, [D0])
    assert set(os.listdir(scratch_root(spark))) == before


def test_funnel_takes_back_a_day_without_other_days_events(spark, tmp_path):
    """Only the refreshed day's step times are replaced, and the funnel is read from step times alone."""
    cfg = config(tmp_path)
    names = [name for name, _ in cfg.steps]
    rows = [on(d, user_pseudo_id=f"u{u}", session_id=f"u{u}", event_name=names[(d + u) % 5]) for d in range(6) for u in range(7)]
    land_rows(spark, cfg.events_path, rows)
    build(spark, cfg)
    path = table_path(cfg, "step_times")
    files = {day: set(os.listdir(f"{path}/event_date={D0 + timedelta(days=day)}")) for day in range(6)}
    gone, moved = rows[7:14], [on(1, user_pseudo_id=f"u{u}", event_name=names[0]) for u in range(3)]
    land_rows(spark, cfg.events_path, [r for r in rows if r not in gone] + moved)
    refresh(spark, cfg, [D0 + timedelta(days=1)])
    for day, before in files.items():
        now = set(os.listdir(f"{path}/event_date={D0 + timedelta(days=day)}"))
        assert (now == before) == (day != 1)
    times = spark.read.parquet(path)
    assert all("/step_times/" in f for f in funnel_of(times, cfg.steps).inputFiles())
    assert as_set(funnel_of(times, cfg.steps)) == as_set(funnel(read_table(spark, table_path(cfg, "events"), schemas.EVENTS), cfg.steps))
    check_equals_full(spark, cfg)
