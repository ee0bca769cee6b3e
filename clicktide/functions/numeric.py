"""Rounding and lenient number parsing with fixed, engine-independent results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_places(x: Column, places: int) -> Column:
    """Round half away from zero on the scaled binary value.

    Spark's ``round(double, n)`` rounds the shortest decimal text of the
    number, which differs from rounding the scaled double in a few per cent of
    half-way cases.
    """
    scale = F.lit(float(10**places))
    return F.round(x * scale, 0) / scale


def r2(x: Column) -> Column:
    return to_places(x, 2)


def pct(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in per cent, two places; NULL when ``whole`` is 0."""
    return r2(F.lit(100.0) * part / F.nullif(whole, F.lit(0)))


def money(x: Column) -> Column:
    """Amount as double; unreadable, missing and negative amounts become 0."""
    zero = F.lit(0.0)
    return F.greatest(F.coalesce(x.try_cast("double"), zero), zero)


def lenient_long(df: DataFrame, name: str) -> Column:
    """Whole number or NULL: text rounds half away from zero, doubles half to even."""
    x, kind = F.col(name), df.schema[name].dataType
    if isinstance(kind, T.StringType):
        # Plain whole numbers, the usual case, skip the slower decimal arithmetic.
        return F.coalesce(x.try_cast("bigint"), F.round(x.try_cast("decimal(38,10)"), 0).try_cast("bigint"))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.rint(x).try_cast("bigint")
    if isinstance(kind, T.DecimalType):
        return F.round(x, 0).try_cast("bigint")
    return x.try_cast("bigint")
