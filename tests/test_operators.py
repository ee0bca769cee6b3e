from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clicktide.operators.anomaly import daily_anomaly
from clicktide.operators.channels import channel_summary
from clicktide.operators.cleanse import bind_events, cleanse_events, cleanse_items, dedupe, raw_defects
from clicktide.operators.flatten import flatten_events, flatten_items, repeated_params
from clicktide.operators.funnel import funnel
from clicktide.operators.kpi import daily_kpi, summary
from clicktide.operators.products import product_summary
from clicktide.operators.profile import profile
from clicktide.operators import ranking
from clicktide.operators.ranking import bucket_starts, ntile_columns, top_k
from clicktide.operators.retention import cohort_retention
from clicktide.operators.sessions import session_summary
from clicktide.operators.users import user_value
from clicktide.operators.visits import condense
from clicktide.schemas import EVENTS, ITEMS, NESTED_EVENTS
from clicktide.session import scratch_root, scratch_scope

from conftest import as_set, event, events_of, plan_of


def random_events(n: int, seed: int = 3, hot: float = 0.3) -> list[dict]:
    """Events with NULL sessions and orders, tied times, and one user with a third of the rows."""
    rng, rows = random.Random(seed), []
    for _ in range(n):
        user = "hot" if rng.random() < hot else f"u{rng.randrange(40)}"
        at = datetime(2020, 11, 1) + timedelta(minutes=rng.randrange(60 * 24 * 40))
        name = rng.choice(["page_view", "view_item", "add_to_cart", "begin_checkout", "purchase", "first_visit"])
        buys = name == "purchase"
        rows.append(
            event(
                event_date=at.date(),
                event_timestamp=at,
                event_name=name,
                user_pseudo_id=user,
                session_id=None if rng.random() < 0.1 else f"{user}-{rng.randrange(5)}",
                source=rng.choice(["search", "letter"]),
                medium=rng.choice(["cpc", "organic"]),
                transaction_id=f"t{rng.randrange(30)}" if buys and rng.random() < 0.8 else None,
                purchase_revenue=round(rng.uniform(0, 90), 2) if buys else 0.0,
            )
        )
    return rows


@pytest.fixture(scope="module")
def events(spark):
    return events_of(spark, random_events(3000)).cache()


# --- cleansing


def test_cleanse_repairs_filters_and_dedupes(spark):
    rows = [
        event(purchase_revenue=-5.0, source=None, medium=None, campaign=None),
        event(user_pseudo_id=None),
        event(event_name=None),
        event(event_name="purchase", transaction_id="", country="B"),
        event(event_name="purchase", transaction_id=None, country="A"),  # same key as ''
        event(event_name="purchase", transaction_id="t1"),
    ]
    got = cleanse_events(events_of(spark, rows)).orderBy("event_name", F.col("transaction_id").asc_nulls_first()).collect()
    assert [(r.event_name, r.transaction_id, r.country) for r in got] == [
        ("page_view", None, "X"),
        ("purchase", None, "A"),
        ("purchase", "t1", "X"),
    ]
    assert tuple(got[0])[5:8] == ("(direct)", "(none)", "(not set)")
    assert got[0].purchase_revenue == 0.0


def test_cleanse_is_idempotent_and_order_free(spark):
    rows = [event(country=c) for c in "CAB" * 20] + random_events(200)
    once = cleanse_events(events_of(spark, rows))
    random.Random(1).shuffle(rows)
    assert as_set(once) == as_set(cleanse_events(events_of(spark, rows)))
    assert as_set(once) == as_set(cleanse_events(once))
    assert once.where("event_name = 'page_view' and user_pseudo_id = 'u'").first().country == "A"


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = plan_of(cleanse_events(events_of(spark, [event()])))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.index("row_number(), 1, Final") < physical.index("Exchange") < physical.index("row_number(), 1, Partial")


def test_raw_defects(spark):
    rows = [event(purchase_revenue=-1.0), event(user_pseudo_id=None), event(event_name=None), event()]
    assert tuple(raw_defects(events_of(spark, rows)).first()) == (1, 1, 1, 0)


def test_dedupe_on_other_tables(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "d"), (None, "c")], "k int, v string")
    assert as_set(dedupe(df, [F.col("k")], [F.col("v")])) == {(1, "a"), (None, "c")}


def test_bind_events(spark):
    df = spark.createDataFrame([("a", 2)], "who string, n int")
    bound = bind_events(df, {"user_pseudo_id": "who", "purchase_revenue": F.col("n") * 1.5})
    assert bound.columns == ["user_pseudo_id", "purchase_revenue"] and bound.first()[1] == 3.0


def test_items_keep_copies_and_gaps(spark):
    names = ITEMS.fieldNames()
    base = dict.fromkeys(names)
    rows = [{**base, "price": "x", "quantity": "2", "item_revenue": "-4"}] * 2
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ", ".join(f"{n} string" for n in names))
    got = cleanse_items(df)
    assert got.dtypes == spark.createDataFrame([], ITEMS).dtypes
    assert [(r.price, r.quantity, r.item_revenue) for r in got.collect()] == [(None, 2, 0.0)] * 2


# --- nested rows


def nested(spark, rows):
    return spark.createDataFrame(rows, NESTED_EVENTS)


def test_flatten(spark):
    def row(user, params, items, traffic=(None, None, None)):
        micros = 1604221200_000001
        return ("20201101", micros, "purchase", user, params, traffic, ("t1", 9.5, 2), ("mobile",), ("Chad",), items)

    item = ("i1", "Shirt", "B", "C", 2.5, 2, 5.0)
    params = [("ga_session_id", (7, None)), ("page_location", (None, "/a")), ("entrances", (1, None))]
    df = nested(
        spark,
        [
            row("u", params, [item, item], ("s", "m", "c")),
            row("u", None, None),
            row("u", [], []),
            row(None, params, [item]),
            row("u", [("ga_session_id", (3, None)), ("ga_session_id", (4, None))], None),
        ],
    )
    flat = flatten_events(df).collect()
    assert len(flat) == 4  # no user: not an event row
    full = next(r for r in flat if r.source == "s")
    assert (str(full.event_date), full.event_timestamp) == ("2020-11-01", datetime(2020, 11, 1, 9, 0, 0, 1))
    assert (full.session_id, full.page_location, full.is_entrance, full.campaign) == ("u-7", "/a", True, "c")
    empty = [r for r in flat if r.session_id is None]
    assert len(empty) == 2 and all(r.source == "(direct)" and r.is_entrance is False for r in empty)
    assert {r.session_id for r in flat} == {"u-7", "u-3", None}
    items = flatten_items(df).collect()
    assert len(items) == 3 and {r.user_pseudo_id for r in items} == {"u", None}
    assert as_set(repeated_params(df)) == {("ga_session_id", 1), ("page_location", 0)}


# --- counting


def test_profile_equals_builtin_distinct_counts(events):
    hit = F.col("event_name") == "purchase"
    got = profile(
        events,
        ["event_date"],
        {"users": F.col("user_pseudo_id"), "sessions": F.col("session_id"), "orders": F.col("transaction_id")},
        flags={"buyers": ("users", hit), "buying": ("sessions", hit)},
        folds={"n": ("sum", F.lit(1)), "last": ("max", F.col("event_timestamp"))},
    )
    want = events.groupBy("event_date").agg(
        F.count_distinct("user_pseudo_id").alias("users"),
        F.count_distinct("session_id").alias("sessions"),
        F.count_distinct("transaction_id").alias("orders"),
        F.count_distinct(F.when(hit, F.col("user_pseudo_id"))).alias("buyers"),
        F.count_distinct(F.when(hit, F.col("session_id"))).alias("buying"),
        F.count(F.lit(1)).alias("n"),
        F.max("event_timestamp").alias("last"),
    )
    assert as_set(got) == as_set(want.select(got.columns))


def test_marts_agree_with_each_other(events):
    kpi = daily_kpi(events)
    total = summary(events).first()
    sums = kpi.agg(F.sum("events"), F.round(F.sum("revenue"), 2)).first()
    assert sums[0] == total.events and sums[1] == total.revenue
    condensed = condense(events).cache()
    for mart in (daily_kpi, channel_summary, session_summary, cohort_retention):
        a, b = mart(events), mart(condensed)
        money = [c for c in a.columns if c == "revenue"]
        for c in money:
            a, b = a.withColumn(c, F.round(c, 2)), b.withColumn(c, F.round(c, 2))
        assert as_set(a) == as_set(b)


def test_empty_input(spark):
    none = events_of(spark, [])
    row = summary(none).first()
    assert (row.events, row.users, row.revenue, row.session_conversion_pct) == (0, 0, None, None)
    assert daily_kpi(none).count() == 0
    assert [r.users for r in funnel(none).collect()] == [0] * 5
    assert cohort_retention(none).count() == 0
    assert user_value(none).count() == 0


def test_null_days_are_a_group(spark):
    rows = [event(event_date=None), event(), event(user_pseudo_id="v", event_date=None)]
    kpi = {r.event_date: (r.events, r.users) for r in daily_kpi(events_of(spark, rows)).collect()}
    assert kpi == {None: (2, 2), date(2020, 11, 2): (1, 1)}
    cohorts = as_set(cohort_retention(events_of(spark, rows)))
    # u: week of 2020-11-02 and an undated row; v: only undated.
    assert cohorts == {
        (date(2020, 11, 2), 0, 1, 1, 100.0),
        (date(2020, 11, 2), None, 1, 1, 100.0),
        (None, None, 1, 1, 100.0),
    }


def test_session_takes_its_first_event(spark):
    t = datetime(2020, 11, 2, 8)
    rows = [
        event(event_timestamp=t + timedelta(minutes=5), source="a"),
        event(event_timestamp=t, source="z", medium="b", campaign="2"),
        event(event_timestamp=t, source="z", medium="b", campaign="1"),
        event(event_timestamp=None, source="0"),
        event(session_id=None),
    ]
    row = session_summary(events_of(spark, rows)).collect()
    assert len(row) == 1
    assert tuple(row[0])[2:7] == (t, "z", "b", "1", 4)


# --- funnel, retention


def funnel_by_hand(rows, names):
    users = {}
    for r in rows:
        seen = users.setdefault(r["user_pseudo_id"], {})
        if r["event_name"] in names:
            seen[r["event_name"]] = min(seen.get(r["event_name"], r["event_timestamp"]), r["event_timestamp"])
    counts = [0] * len(names)
    for seen in users.values():
        last = datetime.min
        for i, n in enumerate(names):
            if n not in seen or seen[n] < last:
                break
            counts[i], last = counts[i] + 1, seen[n]
    return counts


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_funnel_against_brute_force(spark, seed):
    rows = random_events(400, seed)
    names = ["page_view", "view_item", "add_to_cart", "begin_checkout", "purchase"]
    got = [r.users for r in funnel(events_of(spark, rows)).orderBy("step_order").collect()]
    assert got == funnel_by_hand(rows, names)
    assert got == sorted(got, reverse=True)


def test_funnel_ties_count_and_order_matters(spark):
    t = datetime(2020, 11, 2, 8)
    rows = [event(event_timestamp=t, event_name=n) for n in ("page_view", "view_item")]
    rows += [event(user_pseudo_id="v", event_timestamp=t, event_name="page_view")]
    rows += [event(user_pseudo_id="v", event_timestamp=t + timedelta(hours=h), event_name="view_item") for h in (-1, 1)]
    assert [r.users for r in funnel(events_of(spark, rows)).orderBy("step_order").collect()] == [2, 1, 0, 0, 0]


def test_retention_starts_at_100(events):
    rows = cohort_retention(events).collect()
    assert {r.retention_rate_pct for r in rows if r.week_number == 0} == {100.0}
    users = events.select("user_pseudo_id").distinct().count()
    assert sum(r.retained_users for r in rows if r.week_number == 0) == users


# --- ranking


@pytest.mark.parametrize("rows", [0, 1, 2, 4, 5, 6, 9, 103, 1000, 5000])
def test_ntile_by_borders_equals_builtin(spark, monkeypatch, rows):
    """Few kinds of values, NULLs, all different and all equal ones, with a border picked among few rows."""
    monkeypatch.setattr(ranking, "NARROW", 16)
    df = spark.range(rows).select(
        F.concat(F.lit("u"), F.col("id")).alias("u"),
        F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(0).alias("x"),
        F.when(F.col("id") % 7 != 0, F.round(F.rand(5) * 50, 1)).alias("y"),
        F.lit(1.5).alias("z"),
    )
    df = df.cache()
    orders = {"a": F.col("x"), "b": F.col("y"), "c": F.col("z"), "d": -F.col("x")}
    want = df.withColumns({k: F.ntile(5).over(Window.orderBy(v.asc_nulls_last(), "u")).cast("bigint") for k, v in orders.items()})
    got = df.withColumns(ntile_columns(df, orders, "u", 5, rows))
    assert as_set(got) == as_set(want)


def test_ntile_with_odd_values_and_ids(spark, monkeypatch):
    """Quotes, other scripts, control characters and NULL-like texts as ids; NaN, infinities, dates and times as values."""
    monkeypatch.setattr(ranking, "NARROW", 8)
    odd = ['"', "\\", "é", "\u0000", "null", "', {", "漢字", " "]
    values = [float("nan"), float("inf"), float("-inf"), -0.0, 0.1 + 0.2, 1e-310, None, 5.0]
    day = datetime(2024, 1, 1, 10)
    rows = [(f"{odd[i % 8]}{i}", values[i * 7 % 11 % 8], (day + timedelta(days=i % 9)).date(), day + timedelta(seconds=i * 13 % 50)) for i in range(300)]
    df = spark.createDataFrame(rows, "u string, x double, d date, t timestamp").cache()
    orders = {"a": F.col("x"), "b": F.col("d"), "c": F.col("t")}
    want = df.select("u", *[F.ntile(5).over(Window.orderBy(v.asc_nulls_last(), "u")).cast("bigint").alias(k) for k, v in orders.items()])
    got = df.withColumns(ntile_columns(df, orders, "u", 5, 300)).select("u", *orders)
    assert as_set(got) == as_set(want)


def test_many_splitters_are_one_constant(spark):
    df = spark.createDataFrame([("a", 1.0)], "u string, x double")
    keys = ranking._Keys(df, {"m": F.col("x")}, "u")
    cuts = [(False, float(n), f"u{n}") for n in range(64)]
    assert str(keys.below("m", cuts)).count("struct(") == 1  # the row's own key
    assert df.select(keys.below("m", cuts)).first()[0] == 1  # 0.0; of equal values "a" lies below "u1"


def test_bucket_starts():
    for rows in (0, 3, 5, 12, 14):
        starts = [0, *bucket_starts(rows, 5), rows]
        want = [rows // 5 + (1 if i < rows % 5 else 0) for i in range(5)]
        assert [b - a for a, b in zip(starts, starts[1:], strict=False) if b > a] == [w for w in want if w]


def test_ranking_has_no_whole_table_window(events):
    plan = plan_of(user_value(events))
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "ntile(" not in physical and "Window" not in physical and "Join" not in physical and "Exchange" not in physical


def test_scratch_of_a_ranking_goes_with_its_scope(spark, events):
    root = Path(scratch_root(spark))
    before = set(root.iterdir())
    with scratch_scope(spark):
        user_value(events).count()
        assert len(set(root.iterdir()) - before) == 1
    assert set(root.iterdir()) == before


def test_an_order_column_does_not_make_events_visits(events):
    from clicktide.operators.visits import visits

    odd = events.withColumn("order_id", F.lit("x"))
    assert as_set(visits(odd)) == as_set(visits(events))


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None)], "k string, v double")
    assert [r.k for r in top_k(df, "v", ["k"], 2).collect()] == ["a", "b"]


# --- others


def test_products_keep_missing_and_literal_apart(spark):
    names = ITEMS.fieldNames()
    rows = [{**dict.fromkeys(names), "item_id": i, "quantity": q, "item_revenue": 1.0} for i, q in ((None, 2), ("(missing)", None))]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ITEMS)
    assert sorted(tuple(r) for r in product_summary(df).collect()) == [
        ("(missing)", "(not set)", "(not set)", 1, 0, 1.0),
        ("(missing)", "(not set)", "(not set)", 1, 2, 1.0),
    ]


def test_anomaly_flags_a_jump(spark):
    users = [10, 12, 11, 10, 12, 11, 10, 60, 11]
    rows = [(date(2020, 11, 1) + timedelta(days=i), u) for i, u in enumerate(users)]
    got = daily_anomaly(spark.createDataFrame(rows, "event_date date, users bigint")).orderBy("event_date").collect()
    assert [r.is_anomaly for r in got] == [False] * 7 + [True, False]
    flat = daily_anomaly(spark.createDataFrame([(d, 5) for d, _ in rows], "event_date date, users bigint"))
    assert flat.where("user_zscore IS NOT NULL OR is_anomaly").count() == 0


def test_no_events_schema_drift(events):
    assert cleanse_events(events).dtypes == events.dtypes
