"""Distinct counts that days can be added to and taken from.

``profile`` counts distinct users, sessions and orders by reading all visits. Here
each (mart, group, kind, entity) keeps the number of days it is present on, and
the number of days it carries a flag on. A day adds one or takes one; an entity
counts while its number is above zero. So the change of a mart follows from the
visits of the changed days, and the counts of the entities these days hold.

Two tables, both sums of signed rows:

* entities: (mart, g1, g2, kind, entity) -> days, days with flag a, days with flag b;
* totals: (mart, g1, g2, kind) -> distinct entities, flagged ones, latest day; under
  the kind ``sums`` the visits, events and revenue of the group.

NULL groups are groups; NULL entities are not counted. Revenue is summed in
millionths of the currency as DECIMAL, so that what a day added can be taken away exactly;
amounts of 1e22 and above, which no order has, are summed as doubles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.functions.numeric import pct, r2
from clicktide.operators.visits import ORDER_ID
from clicktide.schemas import DATE, SESSION, USER

GROUP = ["mart", "g1", "g2"]
KEYS = [*GROUP, "kind", "entity"]
COUNTS = ["days", "flag_a", "flag_b"]
SIDE = "side"
MOST_BROADCAST = 100_000  # keys
MASKED_DAYS = 255  # days kept as bits of an entity; with more of them days are counted by a second aggregation

CHANNEL, PER_USER, OVERALL = "channel", "user", "all"
_BY = {CHANNEL: ("source", "medium"), PER_USER: (USER,), OVERALL: ()}
# (mart, kind, entity, condition of flag a, condition of flag b)
_COUNTED = [
    (CHANNEL, "sessions", SESSION, "bought", None),
    (CHANNEL, "users", USER, None, None),
    (CHANNEL, "orders", ORDER_ID, None, None),
    (PER_USER, "sessions", SESSION, None, None),
    (PER_USER, "orders", ORDER_ID, None, None),
    (PER_USER, "days", DATE, None, None),
    (OVERALL, "users", USER, "is_new", "bought"),
    (OVERALL, "sessions", SESSION, "bought", None),
    (OVERALL, "orders", ORDER_ID, None, None),
    (OVERALL, "days", DATE, None, None),
]
ENTITY_SCHEMA = "mart string, g1 string, g2 string, kind string, entity string, days bigint, flag_a bigint, flag_b bigint"
_FIGURES = [
    ("n", "bigint"),
    ("flag_a", "bigint"),
    ("flag_b", "bigint"),
    ("last_day", "bigint"),
    ("visits", "bigint"),
    ("events", "bigint"),
    ("revenue", "decimal(38,6)"),
    ("large", "double"),
]
TOTAL_SCHEMA = ", ".join(["mart string, g1 string, g2 string, kind string", *[f"{n} {t}" for n, t in _FIGURES]])


def _group(mart: str) -> list[Column]:
    named = [F.col(c).cast("string") for c in _BY[mart]]
    return [F.lit(mart).alias("mart"), *[c.alias(f"g{i + 1}") for i, c in enumerate([*named, *[F.lit(None).cast("string")] * (2 - len(named))])]]


def _flag(name: str | None) -> Column:
    return F.coalesce(F.col(name), F.lit(False)) if name else F.lit(False)


def signed(visits: DataFrame, side: int) -> DataFrame:
    """Visits that come (1) or go (-1)."""
    return visits.withColumn(SIDE, F.lit(side).cast("bigint"))


# Mart and kind are one number until the counting is done: two strings fewer in every shuffled row.
_SHORT = ["counted", "g1", "g2", "entity"]


def _entity_rows(visits: DataFrame, *kept: str) -> DataFrame:
    """A row per visit and counted entity: ``kept`` columns, short key, flags."""
    each = [
        F.struct(F.lit(i).alias("counted"), *_group(mart)[1:], F.col(entity).cast("string").alias("entity"), _flag(a).alias("a"), _flag(b).alias("b"))
        for i, (mart, _, entity, a, b) in enumerate(_COUNTED)
    ]
    return visits.select(*kept, F.explode(F.array(*each)).alias("e")).select(*kept, "e.*").where("entity IS NOT NULL")


def _named(counted: DataFrame) -> DataFrame:
    mart, kind = (F.array(*[F.lit(row[n]) for row in _COUNTED])[F.col("counted")] for n in (0, 1))
    return counted.select(mart.alias("mart"), "g1", "g2", kind.alias("kind"), "entity", *COUNTS)


def first_entities(visits: DataFrame, days: list) -> DataFrame:
    """``entity_changes`` of visits that all come, where there are ``MASKED_DAYS`` days at most.

    A day is a bit of some numbers, so that one aggregation takes an entity's days together: one
    shuffle instead of two, and none by day. ``days`` are all days of the visits.
    """
    known = sorted(d for d in days if d is not None)
    # Rows without a day have place 0.
    place = F.coalesce(F.array_position(F.array(*[F.lit(d) for d in known]), F.col(DATE)), F.lit(0)).cast("int") if known else F.lit(0)
    masks = [f"mask_{n}" for n in range(len(known) // 64 + 1)]
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.col("place"), F.lit(64)))
    no_bit = F.lit(0).cast("bigint")
    placed = visits.withColumn("place", place).withColumns(
        {m: F.when(F.floor(F.col("place") / 64) == n, bit).otherwise(no_bit) for n, m in enumerate(masks)}
    )
    flags = {"days": F.lit(True), "flag_a": F.col("a"), "flag_b": F.col("b")}
    held = {(c, m): F.bit_or(F.when(flag, F.col(m)).otherwise(no_bit)) for c, flag in flags.items() for m in masks}
    merged = _entity_rows(placed, *masks).groupBy(*_SHORT).agg(*[found.alias(f"{c}_{m}") for (c, m), found in held.items()])
    return _named(
        merged.withColumns({c: reduce(Column.__add__, [F.bit_count(f"{c}_{m}").cast("bigint") for m in masks]) for c in COUNTS})
    )


def entity_changes(moved: DataFrame) -> DataFrame:
    """What signed visits, whole days each, change in the table of entities: one row per key, none that change nothing."""
    rows = _entity_rows(moved, DATE, SIDE)
    per_day = rows.groupBy(DATE, SIDE, *_SHORT).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    side = F.col(SIDE)
    summed = per_day.groupBy(*_SHORT).agg(
        F.sum(side).alias("days"),
        F.sum(F.when(F.col("a"), side).otherwise(F.lit(0))).alias("flag_a"),
        F.sum(F.when(F.col("b"), side).otherwise(F.lit(0))).alias("flag_b"),
    )
    return _named(summed.where(reduce(Column.__or__, [F.col(c) != 0 for c in COUNTS])))


def _sum_changes(moved: DataFrame) -> DataFrame:
    exact = F.col("revenue").try_cast("decimal(28,6)")
    # Folded to one row per user and channel first, so that a row is not copied for each mart.
    folded = moved.groupBy(USER, "source", "medium").agg(
        F.sum(SIDE).alias("visits"),
        F.sum(F.col(SIDE) * F.col("events")).alias("events"),
        F.sum(F.when(F.col(SIDE) > 0, exact).otherwise(-exact)).alias("revenue"),
        F.sum(F.when(exact.isNull(), F.col(SIDE) * F.col("revenue"))).alias("large"),
    )
    marts = F.explode(F.array(*[F.struct(*_group(mart)) for mart in _BY])).alias("g")
    values = ["visits", "events", "revenue", "large"]
    out = folded.select(marts, *values).select("g.*", *values).groupBy(*GROUP).agg(*[F.sum(v).alias(v) for v in values])
    return out.select(*GROUP, F.lit("sums").alias("kind"), *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values])


def _beside(changes: DataFrame, stored: DataFrame | None, keys: list[str], few: bool) -> DataFrame:
    """Per key the stored counts (``before_``) and their changes, for the keys that ``changes`` has.

    Few changes are broadcast to the store. Many are added up with it in one aggregation, which
    may also return keys without changes; these change no total.
    """
    zero = F.lit(0).cast("bigint")
    new = changes.select(*KEYS, *[zero.alias(f"before_{c}") for c in COUNTS], *COUNTS)
    if stored is None:
        return new
    if few:
        same = reduce(Column.__and__, [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
        stored = stored.alias("s").join(F.broadcast(changes.select(*keys).distinct().alias("c")), same, "left_semi")
    old = stored.select(*KEYS, *[F.col(c).alias(f"before_{c}") for c in COUNTS], *[zero.alias(c) for c in COUNTS])
    return old.unionByName(new).groupBy(*KEYS).agg(*[F.sum(n).alias(n) for c in COUNTS for n in (f"before_{c}", c)])


def _then(c: str) -> Column:
    return F.col(f"before_{c}") + F.col(c) > 0


def _before(c: str) -> Column:
    return F.col(f"before_{c}") > 0


def total_changes(moved: DataFrame, changes: DataFrame, stored: DataFrame | None, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Rows to add to the totals when ``changes`` (of the visits ``moved``) are added to the ``stored`` entities.

    ``changes`` has one row per key; it is counted and read several times. Nothing stored: None.
    """
    few = stored is not None and changes.count() <= most_broadcast
    state = _beside(changes, stored, KEYS, few)
    steps = {n: _then(c).cast("bigint") - _before(c).cast("bigint") for c, n in zip(COUNTS, ["n", "flag_a", "flag_b"])}
    moves = state.select(*GROUP, "kind", *[step.alias(n) for n, step in steps.items()])
    moves = moves.where(reduce(Column.__or__, [F.col(n) != 0 for n in steps]))
    counts = moves.groupBy(*GROUP, "kind").agg(*[F.sum(n).alias(n) for n in steps])
    # The latest day of a user needs all days of the users whose days change.
    is_day = (F.col("mart") == PER_USER) & (F.col("kind") == "days")
    days = _beside(changes.where(is_day), None if stored is None else stored.where(is_day), ["g1"], few)

    def latest(present: Column) -> Column:
        return F.coalesce(F.unix_date(F.max(F.when(present, F.col("entity"))).cast("date")), F.lit(0)).cast("bigint")

    last = days.groupBy(*GROUP, "kind").agg((latest(_then("days")) - latest(_before("days"))).alias("last_day")).where("last_day != 0")
    parts = [counts, last, _sum_changes(moved)]
    wide = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return wide.select(*GROUP, "kind", *[F.coalesce(F.col(n), F.lit(0)).cast(t).alias(n) for n, t in _FIGURES])


def merged_entities(entities: DataFrame) -> DataFrame:
    """Signed rows added up, without those that came to nothing."""
    summed = entities.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in COUNTS])
    return summed.where(reduce(Column.__or__, [F.col(c) != 0 for c in COUNTS]))


def merged_totals(totals: DataFrame) -> DataFrame:
    """Signed rows added up."""
    return totals.groupBy(*GROUP, "kind").agg(*[F.sum(n).cast(t).alias(n) for n, t in _FIGURES])


def _sum(kind: str, column: str = "n") -> Column:
    return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(column))), F.lit(0))


def _revenue() -> Column:
    whole = F.sum("revenue").cast("double") + F.sum("large")
    return r2(F.when(_sum("sums", "visits") > 0, whole))


def channels_of(totals: DataFrame) -> DataFrame:
    """``channel_summary`` from the totals."""
    p = (
        totals.where(F.col("mart") == CHANNEL)
        .groupBy(F.col("g1").alias("source"), F.col("g2").alias("medium"))
        .agg(
            _sum("sums", "visits").alias("visits"),
            _sum("sessions").alias("sessions"),
            _sum("users").alias("users"),
            _sum("orders").alias("orders"),
            _revenue().alias("revenue"),
            _sum("sessions", "flag_a").alias("buying"),
        )
        .where("visits > 0")
    )
    rate = pct(F.col("buying"), F.col("sessions")).alias("session_conversion_pct")
    return p.select("source", "medium", "sessions", "users", "orders", "revenue", rate)


def users_of(totals: DataFrame) -> DataFrame:
    """``user_base`` from the totals."""
    p = (
        totals.where(F.col("mart") == PER_USER)
        .groupBy(F.col("g1").alias(USER))
        .agg(
            _sum("sums", "visits").alias("visits"),
            F.when(_sum("days") > 0, F.date_from_unix_date(_sum("days", "last_day").cast("int"))).alias("last_active"),
            _sum("sessions").alias("sessions"),
            _sum("orders").alias("orders"),
            _revenue().alias("revenue"),
        )
        .where("visits > 0")
    )
    return p.drop("visits")


def _overall(totals: DataFrame) -> DataFrame:
    return totals.where(F.col("mart") == OVERALL)


def summary_of(totals: DataFrame, entities: DataFrame, mode: str) -> DataFrame:
    """``summary`` from the totals, one row; first and last day come from the entities, a row per day and part."""
    is_day = (F.col("mart") == OVERALL) & (F.col("kind") == "days")
    present = merged_entities(entities.where(is_day)).where("days > 0")
    edges = present.agg(F.min("entity").cast("date").alias("start_date"), F.max("entity").cast("date").alias("end_date"))
    p = _overall(totals).agg(
        _sum("sums", "events").alias("events"),
        _sum("users").alias("users"),
        _sum("sessions").alias("sessions"),
        _sum("users", "flag_a").alias("new_users"),
        _sum("users", "flag_b").alias("purchasers"),
        _sum("orders").alias("orders"),
        _revenue().alias("revenue"),
        pct(_sum("sessions", "flag_a"), _sum("sessions")).alias("session_conversion_pct"),
    )
    both = p.unionByName(edges, allowMissingColumns=True)  # two one-row results, folded into one row
    names = [*p.columns, *edges.columns]
    return both.agg(*[F.max(n).alias(n) for n in names]).withColumn("data_mode", F.lit(mode))


def build_summary_of(totals: DataFrame, items: DataFrame, mode: str) -> DataFrame:
    """``build_summary`` from the totals and the item facts, one row."""
    p = _overall(totals).agg(
        _sum("sums", "events").alias("events"),
        _sum("users").alias("users"),
        _sum("days").alias("days"),
        _sum("orders").alias("orders"),
        _revenue().alias("revenue"),
    )
    both = p.unionByName(items.agg(F.count(F.lit(1)).alias("item_rows")), allowMissingColumns=True)
    names = ["events", "item_rows", "users", "days", "orders", "revenue"]
    return both.agg(F.lit(mode).alias("mode"), *[F.max(n).alias(n) for n in names])


def day_digests(visits: DataFrame) -> DataFrame:
    """Rows and an order-free digest per day: a sum of row hashes that also hold which columns are NULL."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in visits.columns])
    row = F.xxhash64(*visits.columns, nulls).cast("decimal(38,0)")
    return visits.groupBy(DATE).agg(F.count(F.lit(1)).alias("rows"), F.sum(row).cast("string").alias("digest"))
