"""Every rule fails on a table made to break it, and only that rule where possible."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from clicktide.operators.funnel import funnel
from clicktide.operators.kpi import daily_kpi
from clicktide.operators.quality import FIXTURE, RULES, Bounds, quality_report
from clicktide.operators.retention import cohort_retention
from clicktide.operators.sessions import session_summary
from clicktide.operators.users import user_base
from clicktide.schemas import ITEMS

from conftest import event, events_of

DAY = date(2020, 11, 2)
BOUNDS = Bounds(DAY, DAY)


def sale(**changes):
    return event(event_name="purchase", transaction_id="t1", purchase_revenue=5.0, **changes)


def items_of(spark, rows):
    names = ITEMS.fieldNames()
    base = {**dict.fromkeys(names), "event_name": "purchase", "quantity": 1, "item_revenue": 1.0}
    return spark.createDataFrame([tuple({**base, **r}[n] for n in names) for r in rows], ITEMS)


def tables(spark, rows, items=({},)):
    events = events_of(spark, list(rows))
    return {
        "events": events,
        "items": items_of(spark, items),
        "session_summary": session_summary(events),
        "daily_kpi": daily_kpi(events),
        "funnel": funnel(events),
        "cohort_retention": cohort_retention(events),
        "user_value": user_base(events),
    }


def failing(report) -> dict[str, int]:
    return {r.rule: r.failures for r in report.collect() if r.status in ("failed", "warning")}


def test_clean_tables_pass(spark):
    report = quality_report(tables(spark, [event(), sale()]), BOUNDS).orderBy("position").collect()
    assert [(r.rule, r.severity) for r in report] == list(RULES)
    assert {r.status for r in report} == {"passed"} and len(report) == 19


BREAKS = {
    "事件非空": ([], 1),
    "时间范围": ([event(), event(event_date=date(2020, 11, 1)), event(event_date=date(2020, 11, 3))], 2),
    "数据覆盖结束日": ([event(event_date=date(2020, 11, 1))], 1),
    "用户标识非空": ([event(), event(user_pseudo_id=None)], 1),
    "事件名非空": ([event(), event(event_name=None)], 1),
    "事件去重": ([event(), event(), event(), event(user_pseudo_id="v", session_id="v-1")], 2),
    "收入非负": ([sale(), event(purchase_revenue=-1.0)], 1),
    "购买收入口径": ([event(purchase_revenue=1.0)], 1),
    "会话主题行数对账": ([event(), event(user_pseudo_id="v")], 1),
    "订单ID非空": ([event(event_name="purchase")], 1),
}


@pytest.mark.parametrize("rule", BREAKS)
def test_event_rules(spark, rule):
    rows, failures = BREAKS[rule]
    assert failing(quality_report(tables(spark, rows), BOUNDS))[rule] == failures


def test_item_rules(spark):
    broken = [{"quantity": None}, {"quantity": 0}, {"quantity": 0, "event_name": "view_item"}, {"item_revenue": -1.0}]
    assert failing(quality_report(tables(spark, [event()], broken), BOUNDS)) == {"购买商品数量为正": 2, "商品收入非负": 1}
    assert failing(quality_report(tables(spark, [event()], []), BOUNDS)) == {"商品展开非空": 1}


def test_mart_rules(spark):
    good = tables(spark, [event(), sale(event_timestamp=datetime(2020, 11, 2, 9))])

    def broken(name, df):
        return failing(quality_report({**good, name: df}, BOUNDS))

    kpi = good["daily_kpi"]
    assert broken("daily_kpi", kpi.withColumn("events", F.col("events") + 3)) == {"日事件对账": 3}
    assert broken("daily_kpi", kpi.withColumn("revenue", F.col("revenue") + 0.02)) == {"日收入对账": 1}
    nothing = kpi.withColumns({"events": F.lit(0), "revenue": F.lit(0.0)})
    assert broken("daily_kpi", kpi.unionByName(nothing)) == {"日汇总行数": 1}
    users = good["user_value"]
    assert broken("user_value", users.unionByName(users)) == {"用户分层行数对账": 1}
    rising = good["funnel"].withColumn("users", F.col("step_order").cast("bigint"))
    assert broken("funnel", rising) == {"漏斗单调": 4}
    short = good["cohort_retention"].withColumn("retention_rate_pct", F.lit(99.0))
    assert broken("cohort_retention", short) == {"队列0周完整": 1}


def test_severity_and_fixture_mode(spark):
    rows = [event(event_name="purchase", event_date=date(2020, 11, 1))]
    status = {r.rule: r.status for r in quality_report(tables(spark, rows), BOUNDS).collect()}
    assert status["订单ID非空"] == "warning" and status["数据覆盖结束日"] == "failed"
    fixture = {r.rule: (r.status, r.failures) for r in quality_report(tables(spark, rows), BOUNDS, FIXTURE).collect()}
    assert fixture["数据覆盖结束日"] == ("not_applicable", 0)
