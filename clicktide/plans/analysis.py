"""The analysis summary: one small DataFrame per section, from a build's written tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from clicktide.operators import views
from clicktide.operators.kpi import summary
from clicktide.operators.retention import weighted_retention


def analysis_summary(tables: Mapping[str, DataFrame], top: int = 10) -> dict[str, DataFrame]:
    products = views.products(tables["product_summary"], top)
    return {
        "summary": summary(tables["visits"]),
        "funnel": views.funnel_steps(tables["funnel"]),
        "retention_weeks_0_to_4": weighted_retention(tables["cohort_retention"]).orderBy("week_number"),
        "top_channels": views.channels(tables["channel_summary"], top),
        "top_products": products.drop("item_event_rows"),
        "anomaly_dates": views.anomalies(tables["daily_anomaly"]).select("event_date", "users", "user_zscore"),
    }
