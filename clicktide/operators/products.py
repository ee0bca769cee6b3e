"""Product performance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.functions.numeric import r2

# Fixed values shown for missing product fields.
MISSING_ITEM = {"item_id": "(missing)", "item_name": "(not set)", "item_category": "(not set)"}


def product_summary(items: DataFrame) -> DataFrame:
    """Rows, quantity and revenue per product.

    Groups on the raw fields and fills the display text afterwards, so a missing
    id and a literal ``(missing)`` stay two rows.
    """
    totals = items.groupBy(*MISSING_ITEM).agg(
        F.count(F.lit(1)).alias("item_event_rows"),
        F.sum(F.coalesce(F.col("quantity"), F.lit(0))).alias("quantity"),
        r2(F.sum("item_revenue")).alias("item_revenue"),
    )
    return totals.withColumns({name: F.coalesce(F.col(name), F.lit(text)) for name, text in MISSING_ITEM.items()})
