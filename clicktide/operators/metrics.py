"""Registry of governed metrics, evaluated as SQL aggregate expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import astuple, dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MetricDef:
    id: str
    name_zh: str
    expression: str
    source: str
    owner: str
    version: str


_OPERATIONS, _GROWTH = "电商经营分析", "增长分析"

# Ids, names, definitions, sources, owners and versions.
REGISTRY = {
    m.id: m
    for m in (
        MetricDef("users", "用户数", "count(DISTINCT user_pseudo_id)", "dwd.events", _OPERATIONS, "1.0.0"),
        MetricDef("sessions", "会话数", "count(DISTINCT session_id)", "dwd.events", _OPERATIONS, "1.0.0"),
        MetricDef(
            "purchasers",
            "购买用户数",
            "count(DISTINCT user_pseudo_id) FILTER (WHERE event_name = 'purchase')",
            "dwd.events",
            _OPERATIONS,
            "1.0.0",
        ),
        MetricDef(
            "orders",
            "订单数",
            "count(DISTINCT transaction_id) FILTER (WHERE event_name = 'purchase')",
            "dwd.events",
            _OPERATIONS,
            "1.0.0",
        ),
        MetricDef("revenue", "收入", "sum(purchase_revenue)", "dwd.events", _OPERATIONS, "1.0.0"),
        MetricDef(
            "purchase_conversion",
            "会话购买转化率",
            # Written on the columns the session table has.
            "sum(purchased) / nullif(count(*), 0)",
            "dws.session_summary",
            _GROWTH,
            "1.0.0",
        ),
    )
}


def metric(name: str, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One metric of ``df`` (the metric's source table) per ``by`` group."""
    return metrics([name], df, by)


def metrics(names: Iterable[str], df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Several metrics that share a source table, in one aggregation."""
    return df.groupBy(*by).agg(*[F.expr(REGISTRY[n].expression).alias(n) for n in names])


def registry_table(spark: SparkSession) -> DataFrame:
    names = [f.name for f in fields(MetricDef)]
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([astuple(m) for m in REGISTRY.values()], schema)
