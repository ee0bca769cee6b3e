"""Global ``ntile`` without a sort of the table: only the borders between buckets are looked for."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows between two splitters in which a border is picked exactly, and splitters looked for in one pass.
NARROW = 2048
SPLITTERS = 64

# Types whose values come back from their text unchanged.
PLAIN = (T.StringType, T.BooleanType, T.NumericType, T.DateType)


@dataclass
class Border:
    """The first row of a bucket, known to lie among the ``size`` rows above ``low`` and up to ``high``."""

    score: str
    place: int  # among these rows, from 0
    size: int
    low: tuple | None = None
    high: tuple | None = None

    @property
    def span(self) -> tuple:
        return self.score, self.low, self.high


def bucket_starts(rows: int, n: int) -> list[int]:
    """Places (from 0) of the first row of the second and later ``ntile`` buckets that have rows."""
    small, larger = divmod(rows, n)
    starts = (b * small + min(b, larger) for b in range(1, n))
    return [s for s in starts if s < rows]


class _Keys:
    """Ordering keys (NULLs last, then value, then tie) as columns and as literals."""

    def __init__(self, df: DataFrame, orders: Mapping[str, Column], tie: str) -> None:
        # ``no`` is nullable as the fields of literals are: then rows and literals compare without casts.
        no = {s: F.when(v.isNull(), True).when(v.isNotNull(), False) for s, v in orders.items()}
        self.column = {s: F.struct(no[s].alias("no"), v.alias("value"), F.col(tie).alias("tie")) for s, v in orders.items()}
        fields = df.select(*[c.alias(s) for s, c in self.column.items()]).schema
        self.types: dict[str, T.StructType] = {f.name: f.dataType for f in fields}

    def literal(self, score: str, key: tuple) -> Column:
        return F.struct(*[F.lit(x).cast(f.dataType).alias(f.name) for x, f in zip(key, self.types[score], strict=True)])

    def literals(self, score: str, keys: list[tuple]) -> Column:
        """Many keys as one constant: an expression per key and field would cost the driver more than the pass itself."""
        if not all(isinstance(f.dataType, PLAIN) for f in self.types[score]):
            return F.array(*[self.literal(score, key) for key in keys])
        text = json.dumps([{f.name: None if x is None else str(x) for x, f in zip(key, self.types[score], strict=True)} for key in keys])
        names = self.types[score].names
        plain = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        typed = T.ArrayType(T.StructType([T.StructField(f.name, f.dataType) for f in self.types[score]]))
        return F.from_json(F.lit(text), plain).cast(typed)

    def below(self, score: str, cuts: list[tuple]) -> Column:
        """How many of ``cuts`` lie below a row."""
        key = self.column[score]
        return F.size(F.filter(self.literals(score, cuts), lambda c: c < key))

    def within(self, span: tuple) -> Column:
        score, low, high = span
        found = F.lit(True)
        if low is not None:
            found &= self.column[score] > self.literal(score, low)
        if high is not None:
            found &= self.column[score] <= self.literal(score, high)
        return found


def _splitters(df: DataFrame, keys: _Keys, spans: dict[tuple, int], tie: str, turn: int) -> dict[tuple, list[tuple]]:
    """About ``SPLITTERS`` keys of each span, chosen by hash, in order; one row reaches the driver."""
    picked = []
    for k, (span, size) in enumerate(spans.items()):
        here = F.pmod(F.xxhash64(tie, F.lit(turn)), F.lit(max(1, size // SPLITTERS))) == 0
        picked.append(F.sort_array(F.collect_list(F.when(keys.within(span) & here, keys.column[span[0]]))).alias(f"s{k}"))
    found = df.agg(*picked).first()
    return {span: [tuple(x) for x in keys_of] for span, keys_of in zip(spans, found, strict=True)}


def _narrowed(df: DataFrame, keys: _Keys, borders: list[Border], cuts: dict[tuple, list[tuple]]) -> list[Border]:
    """Each border within the splitters around it: one count per span and splitter, with map-side combining."""
    spans = [s for s, c in cuts.items() if c]
    if not spans:
        return borders
    bins = []
    for k, span in enumerate(spans):
        bins.append(F.when(keys.within(span), F.struct(F.lit(k).alias("span"), keys.below(span[0], cuts[span]).alias("bin"))))
    counted = df.select(F.inline(F.array_compact(F.array(*bins)))).groupBy("span", "bin").agg(F.count(F.lit(1)).alias("rows"))
    rows = {(r["span"], r["bin"]): r["rows"] for r in counted.collect()}  # spans times splitters at most
    out = []
    for b in borders:
        if b.span in spans:
            k, place, edges = spans.index(b.span), b.place, [b.low, *cuts[b.span], b.high]
            for bin_, (low, high) in enumerate(zip(edges, edges[1:], strict=False)):
                size = rows.get((k, bin_), 0)
                if place < size:
                    b = Border(b.score, place, size, low, high)
                    break
                place -= size
        out.append(b)
    return out


def ntile_columns(df: DataFrame, orders: Mapping[str, Column], tie: str, n: int, rows: int) -> dict[str, Column]:
    """For each of ``orders`` (ascending, NULLs last, equals by ``tie``) the ``ntile(n)`` of a row over all rows.

    ``rows`` is the row count of ``df``; ``tie`` must be unique and ``df`` cheap to
    read again: each pass divides the rows among which a border lies by some 64,
    for all borders of all orders at once. The last pass picks each border exactly
    among the few rows left. A bucket is then a comparison with the borders in the
    row itself: nothing is sorted, shuffled row by row or joined, and any number of
    equal values is divided by ``tie``.
    """
    keys = _Keys(df, orders, tie)
    borders = [Border(score, start, rows) for score in orders for start in bucket_starts(rows, n)]
    turn = 0
    while wide := {b.span: b.size for b in borders if b.size > NARROW}:
        borders = _narrowed(df, keys, borders, _splitters(df, keys, wide, tie, turn))
        turn += 1
    first: dict[str, list[Column]] = {score: [] for score in orders}
    if borders:
        held = [F.sort_array(F.collect_list(F.when(keys.within(b.span), keys.column[b.score]))) for b in borders]
        exact = df.agg(*[F.get(h, F.lit(b.place)).alias(f"b{k}") for k, (h, b) in enumerate(zip(held, borders, strict=True))]).first()
        for b, key in zip(borders, exact, strict=True):
            first[b.score].append(keys.literal(b.score, tuple(key)))
    return {
        score: sum(((keys.column[score] >= f).cast("bigint") for f in found), F.lit(1).cast("bigint")) for score, found in first.items()
    }


def top_k(df: DataFrame, by: str, ties: Sequence[str], k: int) -> DataFrame:
    """The ``k`` rows with the largest ``by``; equal values ordered by ``ties``."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(t) for t in ties]).limit(k)
