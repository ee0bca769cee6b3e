"""The whole build on a small fixture, every table against values worked out from its rows."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from clicktide import schemas
from clicktide.operators import views
from clicktide.operators.kpi import summary
from clicktide.operators.metrics import REGISTRY, metric, registry_table
from clicktide.operators.quality import Bounds, quality_totals
from clicktide.operators.retention import weighted_retention
from clicktide.plans import warehouse
from clicktide.plans.analysis import analysis_summary
from clicktide.plans.warehouse import JobConfig, run, table_path
from clicktide.session import configure
from clicktide.sources.tables import CONTRACT, write_table

from conftest import as_set

BOUNDS = Bounds(date(2021, 3, 1), date(2021, 3, 20))


@pytest.fixture(scope="module")
def built(spark, fixture_csv, tmp_path_factory):
    cfg = JobConfig(str(tmp_path_factory.mktemp("base")), fixture_csv, BOUNDS, fixture=True)
    return cfg, run(spark, cfg)


def day(n):
    return date(2021, 3, n)


def test_build_summary(built):
    row = built[1]["build_summary"].first().asDict()
    assert row == {"mode": "fixture", "events": 16, "item_rows": 4, "users": 5, "days": 4, "orders": 3, "revenue": 38.65}


def test_contract_tables_written_apart(spark, built):
    cfg, tables = built
    for name in CONTRACT:
        assert f"/platform_fixture/{name}" in table_path(cfg, name)
        assert spark.read.parquet(table_path(cfg, name)).count() == tables[name].count()
    assert tables["events"].schema == schemas.EVENTS
    assert tables["items"].schema == schemas.ITEMS


def test_daily_kpi(built):
    assert as_set(built[1]["daily_kpi"]) == {
        (day(3), 7, 2, 2, 1, 1, 1, 30.25),
        (day(4), 3, 2, 2, 0, 1, 0, 0.0),
        (day(12), 3, 2, 2, 0, 2, 2, 8.4),
        (day(20), 3, 2, 1, 1, 0, 0, 0.0),
    }


def test_daily_anomaly(built):
    rows = built[1]["daily_anomaly"].orderBy("event_date").collect()
    assert [(r.avg_7d, r.sd_7d, r.user_zscore, r.is_anomaly) for r in rows] == [
        (None, None, None, False),
        (2.0, None, None, False),
        (2.0, 0.0, None, False),
        (2.0, 0.0, None, False),
    ]


def test_funnel(built):
    steps = views.funnel_steps(built[1]["funnel"]).collect()
    assert [(r.step_order, r.users) for r in steps] == [(1, 5), (2, 2), (3, 1), (4, 1), (5, 1)]


def test_sessions(built):
    got = as_set(built[1]["session_summary"].select("session_id", "source", "events", "purchased", "revenue"))
    assert got == {
        ("a-7", "(direct)", 6, 1, 30.25),
        ("a-8", "radar", 2, 1, 0.0),
        ("b-1", "radar", 2, 0, 0.0),
        ("b-2", "radar", 1, 1, 8.4),
        ("c-2", "post", 2, 1, 0.0),
        ("f-1", "post", 2, 0, 0.0),
    }


def test_retention(built):
    cohorts = built[1]["cohort_retention"]
    early, late = day(1), day(15)
    assert as_set(cohorts.select("cohort_week", "week_number", "retained_users", "cohort_size", "retention_rate_pct")) == {
        (early, 0, 3, 3, 100.0),
        (early, 1, 2, 3, 66.67),
        (late, 0, 2, 2, 100.0),
    }
    assert as_set(weighted_retention(cohorts)) == {(0, 5, 5, 100.0), (1, 2, 3, 66.67)}
    assert [tuple(r) for r in views.week1_recent(cohorts).collect()] == [(early, 66.67), (late, None)]
    assert [tuple(r) for r in views.week1_recent(cohorts, n=1).collect()] == [(late, None)]


def test_channels(built):
    assert as_set(built[1]["channel_summary"]) == {
        ("(direct)", "(none)", 1, 2, 1, 30.25, 100.0),
        ("radar", "paid", 3, 2, 2, 8.4, 66.67),
        ("post", "owned", 2, 2, 0, 0.0, 50.0),
    }
    top = views.channels(built[1]["channel_summary"], 2).collect()
    assert [r.source for r in top] == ["(direct)", "radar"]


def test_user_value(built):
    names = ["user_pseudo_id", "last_active", "recency_days", "sessions", "orders", "revenue", "r_score", "f_score", "m_score", "segment"]
    assert as_set(built[1]["user_value"].select(names)) == {
        ("ana", day(12), 8, 2, 2, 30.25, 2, 5, 5, "待唤回"),
        ("bo", day(12), 8, 2, 1, 8.4, 3, 4, 4, "已购用户"),
        ("cy", day(4), 16, 1, 0, 0.0, 1, 1, 1, "普通访客"),
        ("ed", day(20), 0, 0, 0, 0.0, 4, 2, 2, "活跃未购"),
        ("fay", day(20), 0, 1, 0, 0.0, 5, 3, 3, "活跃未购"),
    }
    assert ("活跃未购", 2, 0.0) in as_set(views.segments(built[1]["user_value"]))


def test_products(built):
    assert [tuple(r) for r in views.products(built[1]["product_summary"]).collect()] == [
        ("k7", "Kettle", "Kitchen", 1, 1, 15.25),
        ("k9", "Cup", "Kitchen", 2, 3, 15.0),
        ("(missing)", "(not set)", "(not set)", 1, 0, 8.4),
    ]


def test_quality(built):
    report = built[1]["quality_report"]
    assert report.count() == 19
    assert {r.rule for r in report.where("status = 'warning'").collect()} == {"订单ID非空", "购买商品数量为正"}
    assert tuple(quality_totals(report, "fixture").first()) == ("fixture", 19, 16, 2, 0, 1)


def test_metadata_and_summary(built):
    meta = built[1]["build_metadata"].first()
    assert meta.data_mode == "fixture" and meta.built_at is not None
    want = (16, 5, 6, 2, 3, 3, 38.65, 66.67, day(3), day(20), "fixture")
    assert tuple(built[1]["summary"].first()) == want
    for source in ("events", "visits"):
        assert tuple(summary(built[1][source], "fixture").first()) == want


def test_analysis_summary(built):
    parts = analysis_summary(built[1])
    assert parts["top_products"].columns == ["item_id", "item_name", "item_category", "quantity", "item_revenue"]
    assert [r.weighted_retention_pct for r in parts["retention_weeks_0_to_4"].collect()] == [100.0, 66.67]
    assert parts["anomaly_dates"].count() == 0
    assert parts["top_channels"].count() == 3
    assert parts["summary"].first().new_users == 2


def test_metric_registry(spark, built):
    events, sessions = built[1]["events"], built[1]["session_summary"]
    values = {n: metric(n, events).first()[0] for n in ("users", "sessions", "purchasers", "orders", "revenue")}
    assert values == {"users": 5, "sessions": 6, "purchasers": 3, "orders": 3, "revenue": 38.65}
    assert metric("purchase_conversion", sessions).first()[0] == pytest.approx(4 / 6)
    by_day = {r.event_date: r.users for r in metric("users", events, ["event_date"]).collect()}
    assert by_day[day(3)] == 2
    assert registry_table(spark).count() == len(REGISTRY) == 6


def test_second_build_replaces_the_first(spark, built, fixture_csv, tmp_path):
    cfg = JobConfig(str(tmp_path), fixture_csv, BOUNDS, fixture=True, prefix="shop_")
    assert table_path(cfg, "funnel").endswith("/platform_fixture/shop_funnel")
    run(spark, cfg)
    before = {n: as_set(df) for n, df in built[1].items() if n != "build_metadata"}
    again = run(spark, cfg)
    assert before == {n: as_set(again[n]) for n in before}


def test_lenient_casts_are_refused(spark, fixture_csv, tmp_path):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="strict casts"):
            run(spark, JobConfig(str(tmp_path), fixture_csv, BOUNDS))
    finally:
        configure(spark)


def test_marts_from_visits_equal_marts_from_events(built):
    from clicktide.operators.channels import channel_summary
    from clicktide.operators.kpi import daily_kpi
    from clicktide.operators.retention import cohort_retention
    from clicktide.operators.sessions import session_summary
    from clicktide.operators.users import user_base

    events, condensed = built[1]["events"], built[1]["visits"]
    for mart in (channel_summary, daily_kpi, cohort_retention, session_summary, user_base):
        assert as_set(mart(events)) == as_set(mart(condensed))


def test_missing_events_are_an_error_and_missing_items_are_not(spark, tmp_path, fixture_csv):
    from pyspark.errors import AnalysisException

    from clicktide.sources.flat import items_beside, read_events, read_items

    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_events(spark, str(tmp_path / "none.csv"))
    items = read_items(spark, str(tmp_path / "none.csv"))
    assert items.schema == schemas.ITEMS and items.count() == 0
    assert items_beside("/a/x_events.parquet") == "/a/x_items.parquet"
    assert items_beside("/a/clicks") == "/a/items"
    assert read_items(spark, items_beside(fixture_csv)).count() == 4


def test_items_in_folders_by_day_are_not_shuffled(spark, built, tmp_path, monkeypatch):
    cfg, tables = built
    folders, flat = str(tmp_path / "items"), str(tmp_path / "flat-items")
    lines = tables["items"].select(*[F.col(f.name).cast(f.dataType) for f in schemas.ITEMS])
    write_table(lines, folders, "event_date")
    write_table(lines, flat)
    shuffled, keep = [], warehouse.write_table
    monkeypatch.setattr(warehouse, "write_table", lambda df, path, partition=None: shuffled.append(path) or keep(df, path, partition))
    for source, base in ((folders, "a"), (flat, "b")):
        here, done = JobConfig(str(tmp_path / base), cfg.events_path, BOUNDS, source), {}
        warehouse.keep_items(spark, here, done)
        assert as_set(done["items"]) == as_set(tables["items"])
        assert as_set(spark.read.parquet(table_path(here, "items")).select(*done["items"].columns)) == as_set(tables["items"])
    assert shuffled == [table_path(here, "items")]  # of the source without folders
