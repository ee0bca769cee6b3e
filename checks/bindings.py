"""The supplied tables in the shapes the operators expect.

``events`` becomes flat and nested clickstream events, ``lineitem`` with ``part``
becomes basket items. Every binding is a projection (plus one dimension join).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.operators.cleanse import bind_events, cleanse_events, cleanse_items
from clicktide.operators.quality import Bounds
from clicktide.session import pin_utc

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
    " l_shipdate timestamp_ntz"
)
PART = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"

FIRST_VISIT = "signup"
STEPS = (("signup", "join"), ("view", "look"), ("click", "act"), ("purchase", "buy"))
BOUNDS = Bounds(date(2024, 1, 2), date(2024, 1, 30))


def table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return pin_utc(spark).read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def _coded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in ``props``, read from the JSON text once per row."""
    code = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events", EVENTS).withColumn("k", code)


def flat_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat events before cleansing. Some amounts are negative, some purchases lack an order id."""
    k, buys = F.col("k"), F.col("event_type") == "purchase"
    user = F.col("user_id").cast("string")
    return bind_events(
        _coded_events(spark, sf_dir),
        {
            "event_date": F.col("ts").cast("date"),
            "event_timestamp": F.col("ts").cast("timestamp"),
            "event_name": "event_type",
            "user_pseudo_id": user,
            "session_id": F.concat(user, F.lit("-"), F.date_format("ts", "yyyyMMdd")),
            "source": F.when(k < 40, "search").when(k < 60, "video").when(k < 80, "letter"),
            "medium": F.when(k < 50, "organic").when(k < 75, "paid"),
            "campaign": F.when(k < 30, "winter"),
            "transaction_id": F.when(buys & (k < 90), F.concat(F.lit("t"), F.col("event_id"))),
            "purchase_revenue": F.when(buys, F.when(k < 5, -F.col("value")).otherwise(F.col("value"))),
            "device_category": F.when(k < 70, "desktop").otherwise("mobile"),
            "country": F.lit(None).cast("string"),
        },
    )


def defective_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as text, some unreadable; some rows without user or name."""
    rows = flat_source(spark, sf_dir).withColumn("k", F.pmod(F.dayofmonth("event_date"), F.lit(7)))
    amount = F.when(F.col("k") == 3, "n/a").otherwise(F.col("purchase_revenue").cast("string"))
    return rows.withColumns(
        {
            "purchase_revenue": amount,
            "user_pseudo_id": F.when(F.col("k") != 4, F.col("user_pseudo_id")),
            "event_name": F.when(F.col("k") != 5, F.col("event_name")),
        }
    ).drop("k")


def doubled_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event twice, the copies differing in country: dedupe has to choose."""
    source = flat_source(spark, sf_dir)
    places = F.explode(F.array(F.lit("north"), F.lit("south")))
    return source.withColumn("country", places)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse_events(flat_source(spark, sf_dir))


def _posting_day() -> Column:
    """Lines are posted monthly: date and time are separate fields of a source."""
    return F.trunc("l_shipdate", "month")


def items_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket lines. Returned lines have no quantity, a few revenues are negative."""
    lines = table(spark, sf_dir, "lineitem", LINEITEM)
    net = F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) * 100 + 0.5) / 100.0
    # Reduced to what a basket line holds before the join, as that may have to shuffle all lines.
    sold = lines.select(
        _posting_day().alias("event_date"),
        F.col("l_shipdate").alias("shipped"),
        "l_linestatus",
        "l_suppkey",
        "l_orderkey",
        "l_partkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity") / 2).alias("quantity"),
        F.when(F.col("l_tax") == 0.08, -net).otherwise(net).alias("item_revenue"),
    )
    # Prices are text in a source; they are made text once per part, not once per line.
    price = F.col("p_retailprice").cast("string").alias("price")
    parts = table(spark, sf_dir, "part", PART).select("p_partkey", "p_name", "p_brand", "p_type", price)
    # A left join: part is a dimension, small enough to broadcast by its file size or shuffled otherwise.
    joined = sold.join(parts, sold.l_partkey == parts.p_partkey, "left")
    return joined.select(
        "event_date",
        F.col("shipped").cast("timestamp").alias("event_timestamp"),
        F.when(F.col("l_linestatus") == "F", "purchase").otherwise("view").alias("event_name"),
        F.col("l_suppkey").cast("string").alias("user_pseudo_id"),
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.when(F.col("l_partkey") >= 5, F.col("l_partkey").cast("string")).alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_brand").alias("item_brand"),
        F.when(F.col("p_type") != "SMALL", F.col("p_type")).alias("item_category"),
        "price",
        "quantity",
        "item_revenue",
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed basket lines, as an extract lands them."""
    return cleanse_items(items_source(spark, sf_dir))


def dated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket lines posted in the month of the events, by order number."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("transaction_id").cast("bigint"), F.lit(30)).cast("int"))
    return items(spark, sf_dir).withColumn("event_date", day)


def _param(key: str, number: Column | None = None, text: Column | None = None) -> Column:
    value = F.struct(
        (F.lit(None) if number is None else number).cast("bigint").alias("int_value"),
        (F.lit(None) if text is None else text).cast("string").alias("string_value"),
    )
    return F.struct(F.lit(key).alias("key"), value.alias("value"))


def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in nested form: some without parameters, session number or user."""
    k = F.col("k")
    params = F.array(
        _param("page_location", text=F.col("props")),
        _param("ga_session_id", number=F.when(k >= 10, F.dayofmonth("ts"))),
        _param("entrances", number=F.when(k < 50, 1).otherwise(0)),
    )
    # Some rows name the page and the session once more; the first entry counts.
    again = F.array(_param("page_location", text=F.lit("/again")), _param("ga_session_id", number=F.lit(99)))
    params = F.when(k < 20, F.concat(params, again)).otherwise(params)
    return _coded_events(spark, sf_dir).select(
        F.date_format("ts", "yyyyMMdd").alias("event_date"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        F.col("event_type").alias("event_name"),
        F.when(k < 95, F.col("user_id").cast("string")).alias("user_pseudo_id"),
        F.when(k < 90, params).alias("event_params"),
        F.struct(
            F.when(k < 40, "search").alias("source"),
            F.when(k < 50, "organic").alias("medium"),
            F.when(k < 30, "winter").alias("name"),
        ).alias("traffic_source"),
        F.struct(
            F.when(F.col("event_type") == "purchase", F.concat(F.lit("t"), F.col("event_id"))).alias("transaction_id"),
            F.col("value").alias("purchase_revenue"),
            F.lit(1).cast("bigint").alias("total_item_quantity"),
        ).alias("ecommerce"),
        F.struct(F.lit("desktop").alias("category")).alias("device"),
        F.struct(F.lit(None).cast("string").alias("country")).alias("geo"),
    )


def nested_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket lines as nested events with two, one, no or missing items."""

    def item(key: str, amount: Column) -> Column:
        return F.struct(
            F.col(key).cast("string").alias("item_id"),
            F.lit("thing").alias("item_name"),
            F.lit(None).cast("string").alias("item_brand"),
            F.col("l_linestatus").alias("item_category"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_linenumber").cast("bigint").alias("quantity"),
            amount.alias("item_revenue"),
        )

    one = item("l_partkey", F.col("l_extendedprice"))
    two = item("l_suppkey", F.lit(0.0))
    flag = F.col("l_returnflag")
    none = F.slice(F.array(one), 1, 0)
    return table(spark, sf_dir, "lineitem", LINEITEM).select(
        F.date_format(_posting_day(), "yyyyMMdd").alias("event_date"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("event_timestamp"),
        F.lit("purchase").alias("event_name"),
        F.when(F.col("l_suppkey") >= 3, F.col("l_suppkey").cast("string")).alias("user_pseudo_id"),
        F.struct(F.col("l_orderkey").cast("string").alias("transaction_id")).alias("ecommerce"),
        F.when(flag == "A", F.array(one, two))
        .when((flag == "N") & (F.col("l_linestatus") == "F"), none)
        .when(flag == "N", F.array(one))
        .alias("items"),
    )
