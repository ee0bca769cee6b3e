"""Column names and explicit schemas; nothing in the library infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

DATE = "event_date"
TIME = "event_timestamp"
NAME = "event_name"
USER = "user_pseudo_id"
SESSION = "session_id"
ORDER = "transaction_id"
REVENUE = "purchase_revenue"

PURCHASE = "purchase"
FIRST_VISIT = "first_visit"


_TEXT, _DAY, _MOMENT, _AMOUNT, _COUNT = (
    T.StringType(),
    T.DateType(),
    T.TimestampType(),
    T.DoubleType(),
    T.LongType(),
)


def _record(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Flat events and items as they arrive in CSV. Amounts stay text so that one bad
# number becomes a repaired row instead of a failed job.
EVENTS_CSV = _record(
    event_date=_DAY,
    event_timestamp=_MOMENT,
    event_name=_TEXT,
    user_pseudo_id=_TEXT,
    session_id=_TEXT,
    source=_TEXT,
    medium=_TEXT,
    campaign=_TEXT,
    page_location=_TEXT,
    transaction_id=_TEXT,
    purchase_revenue=_TEXT,
    total_item_quantity=_TEXT,
    device_category=_TEXT,
    country=_TEXT,
    is_entrance=T.BooleanType(),
)
# Columns that an older extract may lack.
OPTIONAL = {"is_entrance"}
ITEMS_CSV = _record(
    event_date=_DAY,
    event_timestamp=_MOMENT,
    event_name=_TEXT,
    user_pseudo_id=_TEXT,
    transaction_id=_TEXT,
    item_id=_TEXT,
    item_name=_TEXT,
    item_brand=_TEXT,
    item_category=_TEXT,
    price=_TEXT,
    quantity=_TEXT,
    item_revenue=_TEXT,
)

# The same events as landed in Parquet, amounts typed.
EXTRACTED_EVENTS = T.StructType(
    [
        T.StructField(f.name, {"purchase_revenue": _AMOUNT, "total_item_quantity": _COUNT}.get(f.name, f.dataType))
        for f in EVENTS_CSV
    ]
)

EVENTS = _record(
    event_date=_DAY,
    event_timestamp=_MOMENT,
    event_name=_TEXT,
    user_pseudo_id=_TEXT,
    session_id=_TEXT,
    source=_TEXT,
    medium=_TEXT,
    campaign=_TEXT,
    transaction_id=_TEXT,
    purchase_revenue=_AMOUNT,
    device_category=_TEXT,
    country=_TEXT,
)
_ITEM = dict(
    item_id=_TEXT,
    item_name=_TEXT,
    item_brand=_TEXT,
    item_category=_TEXT,
    price=_AMOUNT,
    quantity=_COUNT,
    item_revenue=_AMOUNT,
)
ITEMS = _record(
    event_date=_DAY,
    event_timestamp=_MOMENT,
    event_name=_TEXT,
    user_pseudo_id=_TEXT,
    transaction_id=_TEXT,
    **_ITEM,
)

# One nested record per event, as the daily export shards hold it.
NESTED_EVENTS = _record(
    event_date=_TEXT,
    event_timestamp=_COUNT,
    event_name=_TEXT,
    user_pseudo_id=_TEXT,
    event_params=T.ArrayType(_record(key=_TEXT, value=_record(int_value=_COUNT, string_value=_TEXT))),
    traffic_source=_record(source=_TEXT, medium=_TEXT, name=_TEXT),
    ecommerce=_record(transaction_id=_TEXT, purchase_revenue=_AMOUNT, total_item_quantity=_COUNT),
    device=_record(category=_TEXT),
    geo=_record(country=_TEXT),
    items=T.ArrayType(_record(**_ITEM)),
)
