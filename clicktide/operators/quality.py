"""Rule-based data quality report over the facts and marts.

Each table is aggregated once into one row of named figures; the rows are folded
into one and every rule is an expression on it. No rule scans a table by itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.operators.cleanse import event_key
from clicktide.operators.profile import profile
from clicktide.operators.visits import is_event
from clicktide.schemas import DATE, NAME, ORDER, PURCHASE, REVENUE, SESSION, USER

FIXTURE = "fixture"

# Rule names and severities, in report order.
RULES = (
    ("事件非空", "critical"),
    ("时间范围", "critical"),
    ("数据覆盖结束日", "critical"),
    ("用户标识非空", "critical"),
    ("事件名非空", "critical"),
    ("事件去重", "critical"),
    ("收入非负", "critical"),
    ("购买收入口径", "critical"),
    ("日汇总行数", "critical"),
    ("日事件对账", "critical"),
    ("日收入对账", "critical"),
    ("会话主题行数对账", "critical"),
    ("用户分层行数对账", "critical"),
    ("漏斗单调", "critical"),
    ("队列0周完整", "critical"),
    ("商品展开非空", "critical"),
    ("订单ID非空", "warning"),
    ("购买商品数量为正", "warning"),
    ("商品收入非负", "critical"),
)
COVERAGE_RULE = "数据覆盖结束日"


@dataclass(frozen=True)
class Bounds:
    """Expected first and last day of the data."""

    first: date
    last: date


def event_figures(events: DataFrame, bounds: Bounds) -> DataFrame:
    """Row checks; no distinct counts, so one plain aggregation."""
    day, revenue = F.col(DATE), F.col(REVENUE)
    inside = day.between(F.lit(bounds.first), F.lit(bounds.last))
    return events.agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(revenue).alias("revenue"),
        F.max(day).alias("last_day"),
        F.count_if(~inside).alias("outside"),
        F.count_if(F.col(USER).isNull()).alias("no_user"),
        F.count_if(F.col(NAME).isNull()).alias("no_name"),
        F.count_if(revenue < 0).alias("negative"),
        F.count_if((revenue > 0) & ~is_event(PURCHASE)).alias("misplaced"),
        F.count_if(is_event(PURCHASE) & F.col(ORDER).isNull()).alias("no_order"),
    )


def identity_figures(condensed: DataFrame) -> DataFrame:
    return profile(condensed, [], {"users": F.col(USER), "sessions": F.col(SESSION), "days": F.col(DATE)})


def copy_figures(events: DataFrame) -> DataFrame:
    """Surplus rows per event identity, counted on a hash of it; rows with equal hashes are counted by identity."""
    keys = [k.alias(f"k{i}") for i, k in enumerate(event_key())]
    # NULLs do not change the hash by themselves, so their places are hashed as well.
    hashed = F.xxhash64(*event_key(), *[k.isNull() for k in event_key()]).alias("h")
    doubtful = events.groupBy(hashed).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    same = events.select(hashed, *keys).join(doubtful, "h", "left_semi")
    per_key = same.groupBy("h", *[f"k{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("copies"))


def item_figures(items: DataFrame) -> DataFrame:
    quantity = F.col("quantity")
    return items.agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(is_event(PURCHASE) & (quantity.isNull() | (quantity <= 0))).alias("bad_quantity"),
        F.count_if(F.col("item_revenue") < 0).alias("negative_items"),
    )


def step_rises(steps: DataFrame) -> DataFrame:
    """Funnel steps with the users of the step before and whether the count rises."""
    before = F.lag("users").over(Window.orderBy("step_order"))  # one row per step
    return steps.withColumn("previous", before).withColumn(
        "rises", F.coalesce(F.col("users") > F.col("previous"), F.lit(False))
    )


def mart_figures(marts: Mapping[str, DataFrame]) -> list[DataFrame]:
    kpi = marts["daily_kpi"]
    return [
        kpi.agg(
            F.count(F.lit(1)).alias("kpi_days"),
            F.sum("events").alias("kpi_events"),
            F.sum("revenue").alias("kpi_revenue"),
        ),
        marts["session_summary"].agg(F.count(F.lit(1)).alias("session_rows")),
        marts["user_value"].agg(F.count(F.lit(1)).alias("user_rows")),
        step_rises(marts["funnel"]).agg(F.count_if("rises").alias("rises")),
        marts["cohort_retention"].agg(
            F.count_if((F.col("week_number") == 0) & (F.col("retention_rate_pct") != 100)).alias("short_cohorts")
        ),
    ]


def _failures(bounds: Bounds) -> list[Column]:
    """Failure count per rule, in the order of ``RULES``.

    The two emptiness rules fail on an empty table. (As commonly written, with
    a HAVING on the count, they could never fail.)
    """
    c = F.col

    def gap(a: str, b: str) -> Column:
        return F.abs(c(a) - c(b))

    return [
        F.coalesce(c("events"), F.lit(0)) == 0,
        c("outside"),
        c("last_day") != F.lit(bounds.last),
        c("no_user"),
        c("no_name"),
        c("copies"),
        c("negative"),
        c("misplaced"),
        gap("kpi_days", "days"),
        gap("kpi_events", "events"),
        gap("kpi_revenue", "revenue") > 0.01,
        gap("session_rows", "sessions"),
        gap("user_rows", "users"),
        c("rises"),
        c("short_cohorts"),
        c("items") == 0,
        c("no_order"),
        c("bad_quantity"),
        c("negative_items"),
    ]


def quality_report(tables: Mapping[str, DataFrame], bounds: Bounds, mode: str = "") -> DataFrame:
    """One row per rule: position, name, severity, failures, status.

    ``tables`` holds events, items, session_summary, daily_kpi, funnel,
    cohort_retention and user_value; ``visits``, where present, saves condensing
    the events again. In fixture mode the last-day rule does not
    apply but keeps its row.
    """
    events = tables["events"]
    condensed = tables.get("visits", events)
    parts = [
        event_figures(events, bounds),
        identity_figures(condensed),
        copy_figures(events),
        item_figures(tables["items"]),
        *mart_figures(tables),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    figures = stacked.agg(*[F.max(name).alias(name) for name in stacked.columns])
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("rule"),
            F.lit(severity).alias("severity"),
            F.coalesce(failed.cast("bigint"), F.lit(0)).alias("failures"),
        )
        for i, ((name, severity), failed) in enumerate(zip(RULES, _failures(bounds), strict=True))
    ]
    report = figures.select(F.inline(F.array(*rows)))
    skipped = (F.col("rule") == COVERAGE_RULE) & F.lit(mode == FIXTURE)
    status = (
        F.when(skipped, "not_applicable")
        .when(F.col("failures") == 0, "passed")
        .when(F.col("severity") == "warning", "warning")
        .otherwise("failed")
    )
    return report.withColumns({"failures": F.when(skipped, 0).otherwise(F.col("failures")), "status": status})


def quality_totals(report: DataFrame, mode: str) -> DataFrame:
    def having(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    return report.agg(
        F.lit(mode).alias("mode"),
        F.count(F.lit(1)).alias("rules"),
        having("passed").alias("passed"),
        having("warning").alias("warnings"),
        having("failed").alias("failed"),
        having("not_applicable").alias("not_applicable"),
    )
