"""Rolling z-score on daily users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from clicktide.functions.numeric import r2
from clicktide.schemas import DATE


def preceding_rows(order: str, n: int) -> WindowSpec:
    return Window.orderBy(F.col(order).asc_nulls_last()).rowsBetween(-n, -1)


def rolling(df: DataFrame, column: str, order: str, n: int, avg: str, sd: str) -> DataFrame:
    """Mean and sample deviation of the ``n`` rows before each row.

    Meant for a table with one row per day: it is ordered as a whole.
    """
    frame = preceding_rows(order, n)
    return df.withColumns({avg: F.avg(column).over(frame), sd: F.stddev_samp(column).over(frame)})


def daily_anomaly(kpi: DataFrame, window: int = 7, z: float = 3.0) -> DataFrame:
    stats = rolling(kpi, "users", DATE, window, "avg_7d", "sd_7d")
    # NULL without a spread: fewer than two days before, or all of them equal.
    spread: Column = F.when(F.col("sd_7d") > 0, F.col("sd_7d"))
    score = (F.col("users") - F.col("avg_7d")) / spread
    return stats.withColumns(
        {
            "user_zscore": r2(score),
            "is_anomaly": F.coalesce(F.abs(score) >= z, F.lit(False)),
        }
    )
