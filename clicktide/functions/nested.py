"""Look-ups inside keyed arrays. All stay in one row: no explode, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first_value(params: Column, key: str) -> Column:
    matches = F.filter(params, lambda p: p["key"] == key)
    return F.get(matches, F.lit(0))["value"]


def param_int(params: Column, key: str) -> Column:
    return _first_value(params, key)["int_value"]


def param_str(params: Column, key: str) -> Column:
    return _first_value(params, key)["string_value"]


def has_param(params: Column, key: str, value: int) -> Column:
    """True when an entry has this key and integer value; never NULL."""

    def hit(p: Column) -> Column:
        return F.coalesce((p["key"] == key) & (p["value"]["int_value"] == value), F.lit(False))

    return F.coalesce(F.exists(params, hit), F.lit(False))


def repeated_keys(params: Column, key: str) -> Column:
    """How many entries beyond the first carry ``key`` (0 in a well-formed row)."""
    extra = F.size(F.filter(params, lambda p: p["key"] == key)) - 1
    return F.greatest(F.coalesce(extra, F.lit(0)), F.lit(0))


def session_key(user: Column, number: Column) -> Column:
    """``user-number``; NULL when either part is NULL."""
    return F.concat(user, F.lit("-"), number.cast("string"))
