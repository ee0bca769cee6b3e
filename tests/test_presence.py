"""Stored distinct counts: days come and go, and the marts equal those made from all visits."""

from __future__ import annotations

import random
import shutil
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clicktide.operators import presence as p
from clicktide.operators.channels import channel_summary
from clicktide.operators.kpi import build_summary, summary
from clicktide.operators.users import user_base
from clicktide.operators.visits import condense
from clicktide.plans import presence as store_module
from clicktide.plans import refresh as refresh_module
from clicktide.plans.presence import count_all, count_days, current
from clicktide.plans.refresh import on_days, refresh
from clicktide.plans.warehouse import presence_root, run, table_path
from clicktide.session import scratch_path
from clicktide.sources.tables import read_table

from conftest import as_set, event, events_of, plan_of
from test_refresh import config, full_tables, land_rows

D0 = date(2021, 3, 1)


def some_visits(spark, seed, days=6, rows=150):
    """Few users, sessions and orders, so that nearly all occur on several days; a third of the rows are one user's."""
    rng = random.Random(seed)
    made = []
    for n in range(rows):
        day = rng.choice([None, *range(days)])
        at = datetime(2021, 3, 1, 8) + timedelta(days=day or 0, seconds=n)
        bought = rng.random() < 0.3
        made.append(
            event(
                event_date=None if day is None else at.date(),
                event_timestamp=at,
                event_name="purchase" if bought else rng.choice(["first_visit", "page_view"]),
                user_pseudo_id="hot" if n % 3 == 0 else f"u{rng.randrange(5)}",
                session_id=rng.choice([None, "s1", "s2", "s3", "s4"]),
                source=rng.choice(["a", "b", None]),
                medium=rng.choice(["x", None]),
                transaction_id=rng.choice([None, "o1", "o2", "o3"]),
                purchase_revenue=rng.choice([0.1, 0.2, 19.99]) if bought else 0.0,
            )
        )
    return condense(events_of(spark, made))


def check_marts(spark, store, visits):
    totals, entities = store.totals(spark), store.entities(spark)
    items = spark.range(3)
    assert as_set(p.channels_of(totals)) == as_set(channel_summary(visits))
    base = user_base(visits)
    assert as_set(p.users_of(totals).select(*base.columns)) == as_set(base)
    whole = summary(visits, "m")
    assert as_set(p.summary_of(totals, entities, "m").select(*whole.columns)) == as_set(whole)
    size = build_summary(visits, items, "m")
    assert as_set(p.build_summary_of(totals, items, "m").select(*size.columns)) == as_set(size)


@pytest.fixture()
def root(spark):
    return scratch_path(spark, "presence")


def test_days_come_change_and_go(spark, root, monkeypatch):
    monkeypatch.setattr(store_module, "MOST_PARTS", 2)  # the second and the third change merge the parts first
    first, second = some_visits(spark, 1).cache(), some_visits(spark, 2).cache()
    store = count_all(spark, root, first)
    check_marts(spark, store, first)
    now = first
    for days, come in [({D0, None}, second), ({D0 + timedelta(days=1)}, second.limit(0)), ({D0, D0 + timedelta(days=5)}, first)]:
        new = come.where(on_days(days))
        assert count_days(spark, root, now.where(on_days(days)), new, days)
        now = now.where(~on_days(days)).unionByName(new)
        check_marts(spark, current(spark, root), now)
    assert current(spark, root).generation == 2


def test_all_days_go(spark, root):
    visits = some_visits(spark, 3, days=2, rows=30).cache()
    days = {None, D0, D0 + timedelta(days=1)}
    count_all(spark, root, visits)
    assert count_days(spark, root, visits, visits.limit(0), days)
    store = current(spark, root)
    assert p.merged_entities(store.entities(spark)).count() == 0
    assert p.channels_of(store.totals(spark)).count() == 0 and p.users_of(store.totals(spark)).count() == 0
    check_marts(spark, store, visits.limit(0))


def test_empty_store(spark, root):
    nothing = some_visits(spark, 4).limit(0)
    check_marts(spark, count_all(spark, root, nothing), nothing)


def test_a_day_is_never_counted_twice(spark, root):
    old, new, other = (some_visits(spark, seed).where(on_days({D0})).cache() for seed in (5, 6, 7))
    count_all(spark, root, old)
    assert count_days(spark, root, old, new, {D0})
    # A run that died before the visits were replaced is repeated: they are still the old ones.
    assert count_days(spark, root, old, new, {D0})
    check_marts(spark, current(spark, root), new)
    # Visits that the store has never seen: it says so.
    assert not count_days(spark, root, old, other, {D0})


def test_a_part_without_its_last_table_does_not_hold(spark, root):
    old, new = (some_visits(spark, seed).where(on_days({D0})).cache() for seed in (8, 9))
    count_all(spark, root, old)
    assert count_days(spark, root, old, new, {D0})
    shutil.rmtree(f"{root}/g0/p1/marks")
    check_marts(spark, current(spark, root), old)
    assert count_days(spark, root, old, new, {D0})
    check_marts(spark, current(spark, root), new)


def test_digest_sees_null_places_but_not_order(spark):
    rows = [event(event_date=D0, source="x", medium=None), event(event_date=D0, source=None, medium="x")]
    one, other = (p.day_digests(condense(events_of(spark, [r]))).first()["digest"] for r in rows)
    assert one != other
    both, turned = (p.day_digests(condense(events_of(spark, r))).first()["digest"] for r in (rows, rows[::-1]))
    assert both == turned


def test_changes_are_combined_before_the_shuffle(spark):
    plan = plan_of(p.entity_changes(p.signed(some_visits(spark, 1), 1)))
    assert "partial_sum" in plan and "partial_max" in plan and "SortAggregate" not in plan


def on(day, **changes):
    at = datetime(2020, 11, 2, 8) + timedelta(days=day)
    return event(**{"event_date": at.date(), "event_timestamp": at, **changes})


ROWS = [on(d, user_pseudo_id=f"u{u}", session_id=f"u{u}-{d}", source=f"c{u % 2}") for d in range(0, 21, 2) for u in range(4)]
MARTS = ("channel_summary", "user_value", "summary", "build_summary")


def test_refresh_leaves_visits_of_other_weeks_unread(spark, tmp_path):
    cfg = config(tmp_path)
    land_rows(spark, cfg.events_path, ROWS)
    run(spark, cfg)
    late = on(20, user_pseudo_id="late", session_id="late", event_name="purchase", transaction_id="o", purchase_revenue=3.0)
    land_rows(spark, cfg.events_path, [*ROWS, late])
    # With the first day's visits gone, only a mart that reads them can be wrong.
    shutil.rmtree(f"{table_path(cfg, 'visits')}/event_date=2020-11-02")
    refresh(spark, cfg, [date(2020, 11, 22)])
    want = full_tables(spark, cfg)
    for name in MARTS:
        assert as_set(read_table(spark, table_path(cfg, name), want[name].schema)) == as_set(want[name]), name


def test_refresh_survives_a_stop_after_counting(spark, tmp_path, monkeypatch):
    cfg = config(tmp_path)
    land_rows(spark, cfg.events_path, ROWS)
    run(spark, cfg)
    land_rows(spark, cfg.events_path, [r for r in ROWS if r["user_pseudo_id"] != "u1" or r["event_date"].day != 2])

    def stop(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(refresh_module, "replace_partitions", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            refresh(spark, cfg, [date(2020, 11, 2)])
    refresh(spark, cfg, [date(2020, 11, 2)])
    want = full_tables(spark, cfg)
    for name in MARTS:
        assert as_set(read_table(spark, table_path(cfg, name), want[name].schema)) == as_set(want[name]), name


def test_refresh_counts_anew_where_the_store_is_missing(spark, tmp_path):
    cfg = config(tmp_path)
    land_rows(spark, cfg.events_path, ROWS)
    run(spark, cfg)
    shutil.rmtree(presence_root(cfg))
    land_rows(spark, cfg.events_path, ROWS[4:])
    refresh(spark, cfg, [date(2020, 11, 2)])
    want = full_tables(spark, cfg)
    for name in MARTS:
        assert as_set(read_table(spark, table_path(cfg, name), want[name].schema)) == as_set(want[name]), name


def test_many_changes_are_added_up_with_the_store_without_a_join(spark, root):
    old, new = some_visits(spark, 10).cache(), some_visits(spark, 11).cache()
    stored = count_all(spark, root, old).entities(spark)
    moved = p.signed(old, -1).unionByName(p.signed(new, 1))
    changes = p.entity_changes(moved).cache()
    few, many = (p.total_changes(moved, changes, stored, most_broadcast=n) for n in (10**6, 0))
    assert "Join" in plan_of(few) and "Join" not in plan_of(many)

    def moves(totals):
        return {r for r in as_set(p.merged_totals(totals)) if any(r[4:])}

    assert moves(few) == moves(many) != set()


def test_a_first_count_compares_with_nothing(spark):
    visits = some_visits(spark, 12).cache()
    changes = p.entity_changes(p.signed(visits, 1)).cache()
    totals = p.total_changes(p.signed(visits, 1), changes, None)
    assert "Join" not in plan_of(totals)
    assert as_set(p.channels_of(totals)) == as_set(channel_summary(visits))


@pytest.mark.parametrize("days", [1, 5, 63, 64, 150])
def test_a_first_count_in_one_aggregation_equals_the_count_by_day(spark, days):
    """Days, flags and rows without a day, on one and several masks; one shuffle, combined before it."""
    visits = some_visits(spark, 13, days=days, rows=400).cache()
    held = [r[0] for r in visits.select("event_date").distinct().collect()]
    found = p.first_entities(visits, held)
    plan = plan_of(found)  # before it runs: afterwards the plan holds its first and its last form
    assert plan.count("hashpartitioning(counted#") == 1 and "partial_bit_or" in plan and "SortAggregate" not in plan
    assert as_set(found) == as_set(p.entity_changes(p.signed(visits, 1)))


def test_a_first_count_of_more_days_than_bits_is_the_same(spark, root, monkeypatch):
    visits = some_visits(spark, 14).cache()
    check_marts(spark, count_all(spark, root, visits), visits)
    few = as_set(current(spark, root).entities(spark))
    monkeypatch.setattr(store_module, "MASKED_DAYS", 1)
    assert as_set(count_all(spark, root, visits).entities(spark)) == few
