"""Ordered funnel over each user's first time per step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.schemas import DATE, NAME, TIME, USER

# Event name and displayed label of each step.
CHECKOUT_STEPS = (
    ("page_view", "浏览"),
    ("view_item", "查看商品"),
    ("add_to_cart", "加购"),
    ("begin_checkout", "开始结账"),
    ("purchase", "购买"),
)


def step_times(events: DataFrame, steps: Sequence[tuple[str, str]] = CHECKOUT_STEPS) -> DataFrame:
    """First time of each step per user and day: ``user, event_date, t0, t1, ..``.

    A day can be taken back or replaced without the events of other days.
    """
    return _first_times(events, steps, USER, DATE)


def _first_times(events: DataFrame, steps: Sequence[tuple[str, str]], *keys: str) -> DataFrame:
    names = [name for name, _ in steps]
    firsts = [F.min(F.when(F.col(NAME) == n, F.col(TIME))).alias(f"t{i}") for i, n in enumerate(names)]
    return events.where(F.col(NAME).isin(names)).groupBy(*keys).agg(*firsts)


def funnel(events: DataFrame, steps: Sequence[tuple[str, str]] = CHECKOUT_STEPS) -> DataFrame:
    """Users per step. A user is in step n when t1 <= t2 <= .. <= tn (ties allowed)."""
    return _depths(_first_times(events, steps, USER), steps)


def funnel_of(times: DataFrame, steps: Sequence[tuple[str, str]] = CHECKOUT_STEPS) -> DataFrame:
    """The same from ``step_times``."""
    return _depths(times.groupBy(USER).agg(*[F.min(f"t{i}").alias(f"t{i}") for i in range(len(steps))]), steps)


def _depths(first_times: DataFrame, steps: Sequence[tuple[str, str]]) -> DataFrame:
    in_step = [F.col("t0").isNotNull()]
    for i in range(1, len(steps)):
        in_step.append(in_step[-1] & (F.col(f"t{i}") >= F.col(f"t{i - 1}")))
    counts = first_times.agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(in_step)])
    rows = [
        F.struct(
            F.lit(i + 1).alias("step_order"),
            F.lit(label).alias("step"),
            F.col(f"n{i}").alias("users"),
        )
        for i, (_, label) in enumerate(steps)
    ]
    return counts.select(F.inline(F.array(*rows)))
