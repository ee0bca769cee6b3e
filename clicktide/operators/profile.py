"""Several exact distinct counts per group in one pass.

A mart such as the daily KPI counts distinct users, sessions and orders, plus
users and sessions that carry a flag (bought, first visit). Asking Spark for each
``count(DISTINCT ..)`` copies every row once per count. Here each kind of entity
is one grouping set, flags ride along as ``max``, and the second aggregation
counts rows:

* first shuffle: keyed by (group, entity), after map-side combining, so neither a
  hot group nor a hot entity reaches one task row by row;
* second shuffle: one combined row per task and group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_FOLD = {"sum": F.sum, "min": F.min, "max": F.max}


def profile(
    df: DataFrame,
    by: Sequence[str],
    entities: Mapping[str, Column],
    flags: Mapping[str, tuple[str, Column]] | None = None,
    folds: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Distinct counts and plain folds per ``by`` group (one row in total if empty).

    ``entities``  output name -> identifier; NULL identifiers are not counted.
    ``flags``     output name -> (entity name, condition): entities with any matching row.
    ``folds``     output name -> ("sum" | "min" | "max", value).
    """
    flags, folds, by = dict(flags or {}), dict(folds or {}), list(by)
    ids = {name: f"_id_{name}" for name in entities}
    wide = df.select(
        *by,
        *[e.alias(ids[n]) for n, e in entities.items()],
        *[cond.alias(n) for n, (_, cond) in flags.items()],
        *[value.alias(n) for n, (_, value) in folds.items()],
    )
    keys = [F.col(name) for name in by]
    sets = [keys + [F.col(i)] for i in ids.values()]
    per_entity = wide.groupingSets(sets, *by, *ids.values()).agg(
        F.grouping_id().alias("_set"),
        *[F.max(n).alias(n) for n in flags],
        *[_FOLD[how](n).alias(n) for n, (how, _) in folds.items()],
    )
    # grouping_id has one bit per identifier, 0 where the set contains it.
    full = (1 << len(ids)) - 1
    number = {n: full - (1 << (len(ids) - 1 - k)) for k, n in enumerate(ids)}

    def of(name: str) -> Column:
        return (F.col("_set") == number[name]) & F.col(ids[name]).isNotNull()

    # Each set holds every input row once; any one of them serves for the folds.
    once = F.col("_set") == number[next(iter(ids))]
    return per_entity.groupBy(*by).agg(
        *[F.count_if(of(n)).alias(n) for n in ids],
        *[F.count_if(of(e) & F.col(n)).alias(n) for n, (e, _) in flags.items()],
        *[_FOLD[how](F.when(once, F.col(n))).alias(n) for n, (how, _) in folds.items()],
    )
