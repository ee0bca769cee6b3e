"""Gap sessions against a plain loop, slices, and a user with a third of all events."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clicktide.operators.gaps import _cells, gap_sessions
from clicktide.schemas import EVENTS

START = datetime(2021, 3, 1)


def events(spark, rows):
    """``rows``: user, time, name, source, amount."""
    full = [(None, at, name, user, None, source, "m", "c", None, amount, None, None) for user, at, name, source, amount in rows]
    return spark.createDataFrame(full, EVENTS)


def by_hand(rows, gap):
    out, users = [], {r[0] for r in rows if r[0] is not None}
    for user in sorted(users):
        mine = sorted((r for r in rows if r[0] == user and r[1] is not None), key=lambda r: (r[1], r[3]))
        sessions = []
        for r in mine:
            if not sessions or r[1] - sessions[-1][-1][1] > gap:
                sessions.append([])
            sessions[-1].append(r)
        for n, s in enumerate(sessions, 1):
            bought = int(any(r[2] == "purchase" for r in s))
            out.append((user, n, s[0][1], s[-1][1], s[0][3], len(s), bought, round(sum(r[4] for r in s), 2)))
    return sorted(out)


def found(df):
    names = ("user_pseudo_id", "session_number", "session_start", "session_end", "source", "events", "purchased")
    return sorted((*[r[n] for n in names], round(r["revenue"], 2)) for r in df.collect())


def random_rows(seed, n, span):
    rng = random.Random(seed)
    return [
        (
            "hot" if i % 3 == 0 else f"u{rng.randrange(9)}",
            START + timedelta(seconds=rng.choice((1, 60, 600)) * rng.randrange(span)),
            rng.choice(("page_view", "purchase")),
            rng.choice("abc"),
            rng.randrange(400) / 4,
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("gap, cells", [(timedelta(minutes=30), 4096), (timedelta(minutes=30), 1), (timedelta(seconds=90), 3), (timedelta(hours=9), 2)])
def test_sessions_are_those_of_a_loop(spark, gap, cells):
    rows = random_rows(cells, 1500, 900) + [("before", datetime(1969, 12, 31, 23, 50), "a", "x", 0.0), ("before", datetime(1970, 1, 1, 0, 10), "a", "x", 0.0)]
    assert found(gap_sessions(events(spark, rows).repartition(5), gap, cells)) == by_hand(rows, gap)


def test_ends_of_a_gap(spark):
    """Exactly the gap still belongs; a microsecond more does not. A session may run through whole slices."""
    gap = timedelta(minutes=30)
    rows = [("a", START + k * gap, "page_view", "s", 0.0) for k in range(12)]
    rows += [("b", START, "page_view", "s", 0.0), ("b", START + gap + timedelta(microseconds=1), "page_view", "s", 0.0)]
    got = found(gap_sessions(events(spark, rows), gap, 2))
    assert [r[:2] + r[5:6] for r in got] == [("a", 1, 12), ("b", 1, 1), ("b", 2, 1)]


def test_odd_rows(spark):
    rows = [(None, START, "x", "s", 0.0), ("a", None, "x", "s", 0.0), ("a", START, "purchase", "z", 2.0), ("a", START, "purchase", "b", 2.0), ("a", START, "purchase", "b", 2.0)]
    assert found(gap_sessions(events(spark, rows))) == [("a", 1, START, START, "b", 3, 1, 6.0)]
    assert gap_sessions(events(spark, [])).collect() == []
    for gap, cells in ((timedelta(0), 1), (timedelta(1), 0)):
        with pytest.raises(ValueError):
            gap_sessions(events(spark, []), gap, cells)


def test_no_task_holds_the_events_of_a_user(spark):
    """One user owns a third of 60,000 events of a day: tasks pass on no more than a row per cell and channel."""
    ids = spark.range(0, 60_000, 1, 6)
    user = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("u"), F.col("id") % 5000))
    at = F.timestamp_seconds(F.lit(1_600_000_000) + F.pmod(F.xxhash64("id"), F.lit(86_400)))
    filled = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in EVENTS}
    filled |= {"event_timestamp": at.alias("event_timestamp"), "user_pseudo_id": user.alias("user_pseudo_id"), "source": F.lit("s").alias("source")}
    filled |= {"event_name": F.lit("x").alias("event_name"), "purchase_revenue": F.lit(1.0).alias("purchase_revenue")}
    rows = ids.select(*filled.values())
    cells = _cells(rows, 1_800_000_000)
    below = cells._jdf.queryExecution().executedPlan().toString().rpartition("Exchange hashpartitioning(user_pseudo_id")[2]
    assert "partial_min" in below  # folded by the tasks that read the events
    assert cells.where("user_pseudo_id = 'hot'").count() <= 49
    assert gap_sessions(rows, timedelta(minutes=30)).agg(F.sum("events")).first()[0] == 60_000
