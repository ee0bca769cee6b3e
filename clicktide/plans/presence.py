"""The stored distinct counts: numbered parts of signed rows, each written once.

Below ``presence`` lie generations ``g<n>`` with parts ``p<n>``. The first part of a
generation counts all visits, each later one what a refresh changed. A part has
entities, totals and the digests of the days it counted; it holds from the moment
its digests are written, which is last. A generation of many parts is merged into
a new one, so reading stays bounded.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.operators.presence import (
    ENTITY_SCHEMA,
    MASKED_DAYS,
    TOTAL_SCHEMA,
    day_digests,
    entity_changes,
    first_entities,
    merged_entities,
    merged_totals,
    signed,
    total_changes,
)
from clicktide.schemas import DATE
from clicktide.session import delete_folder
from clicktide.sources.tables import open_folders, path_exists, subfolders

MARK_SCHEMA = f"{DATE} date, rows bigint, digest string"
MOST_PARTS = 16


@dataclass(frozen=True)
class Store:
    """A generation of the store: its number, and how many parts of it hold."""

    root: str
    generation: int
    parts: int

    def part(self, number: int) -> str:
        return f"{self.root}/g{self.generation}/p{number}"

    def read(self, spark: SparkSession, kind: str, schema: str, since: int = 0) -> DataFrame:
        # Folder columns are given back their place: Spark puts them last.
        parts = [spark.read.schema(schema).parquet(f"{self.part(n)}/{kind}") for n in range(since, self.parts)]
        return reduce(DataFrame.unionByName, parts)

    def entities(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "entities", ENTITY_SCHEMA)

    def totals(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "totals", TOTAL_SCHEMA)

    def marks(self, spark: SparkSession) -> dict[object, tuple[int, str]]:
        """Rows and digest of every day as last counted: a row per day and part."""
        found: dict[object, tuple[int, str]] = {}
        for n in range(self.parts):
            part = spark.read.schema(MARK_SCHEMA).parquet(f"{self.part(n)}/marks")
            found |= {r[DATE]: (r["rows"], r["digest"]) for r in part.collect()}
        return found


def _holds(spark: SparkSession, part: str) -> bool:
    return path_exists(spark, f"{part}/marks/_SUCCESS")


def _numbers(spark: SparkSession, path: str, letter: str) -> list[int]:
    return sorted(int(name[1:]) for name in subfolders(spark, path) if name[:1] == letter and name[1:].isdigit())


def current(spark: SparkSession, root: str) -> Store | None:
    """The newest generation whose first part holds, if any."""
    for generation in reversed(_numbers(spark, root, "g")):
        store = Store(root, generation, 0)
        while _holds(spark, store.part(store.parts)):
            store = Store(root, generation, store.parts + 1)
        if store.parts:
            return store
    return None


def _write_entities(store: Store, entities: DataFrame) -> None:
    """Entities of the next part, as dealt by the aggregation they come from: no task has more than its share of any folder."""
    out = entities.write.option("compression", "zstd").mode("overwrite").option("partitionOverwriteMode", "static")
    with open_folders(entities.sparkSession):
        out.partitionBy("mart", "kind").parquet(f"{store.part(store.parts)}/entities")


def _finish_part(store: Store, totals: DataFrame, marks: DataFrame) -> Store:
    """Write the rest of the next part. What a job that died left of it is replaced."""
    path = store.part(store.parts)
    for kind, df, folders in (("totals", totals, ["mart"]), ("marks", marks, [])):
        by = [F.col(c) for c in folders]
        out = df.hint("rebalance", *by).write.option("compression", "zstd").mode("overwrite").option("partitionOverwriteMode", "static")
        (out.partitionBy(*folders) if folders else out).parquet(f"{path}/{kind}")
    return Store(store.root, store.generation, store.parts + 1)


def _start_generation(spark: SparkSession, root: str) -> Store:
    numbers = _numbers(spark, root, "g")
    return Store(root, numbers[-1] + 1 if numbers else 0, 0)


def _drop_older(spark: SparkSession, store: Store) -> None:
    for generation in _numbers(spark, store.root, "g"):
        if generation < store.generation:
            delete_folder(spark, f"{store.root}/g{generation}")


def _append(spark: SparkSession, store: Store, moved: DataFrame, entities: DataFrame, stored: DataFrame | None, marks: DataFrame) -> Store:
    """Write what signed visits change, the entities as counted from them, as the next part; the totals are counted on its written entities."""
    _write_entities(store, entities)
    changes = Store(store.root, store.generation, store.parts + 1).read(spark, "entities", ENTITY_SCHEMA, since=store.parts)
    return _finish_part(store, total_changes(moved, changes, stored), marks)


def count_all(spark: SparkSession, root: str, visits: DataFrame) -> Store:
    """Count all visits into a new generation; older ones go once it holds."""
    known = [(r[DATE], r["rows"], r["digest"]) for r in day_digests(visits).collect()]  # a row per day
    days, moved = [day for day, _, _ in known], signed(visits, 1)
    entities = first_entities(visits, days) if len(days) <= MASKED_DAYS else entity_changes(moved)
    store = _append(spark, _start_generation(spark, root), moved, entities, None, spark.createDataFrame(known, MARK_SCHEMA))
    _drop_older(spark, store)
    return store


def _merge(spark: SparkSession, store: Store) -> Store:
    known = [(day, rows, digest) for day, (rows, digest) in store.marks(spark).items()]  # a row per day
    entities, totals = merged_entities(store.entities(spark)), merged_totals(store.totals(spark))
    fresh = _start_generation(spark, store.root)
    _write_entities(fresh, entities)
    merged = _finish_part(fresh, totals, spark.createDataFrame(known, MARK_SCHEMA))
    _drop_older(spark, merged)
    return merged


def count_days(spark: SparkSession, root: str, old: DataFrame, new: DataFrame, days: set) -> bool:
    """Take the ``old`` visits of ``days`` from the store and add the ``new`` ones. False: it has to be counted anew.

    Both hold rows of ``days`` only. A day is known by the digest of its visits as
    counted: one that already has the new digest, from a run that died later, is left
    alone; one that has neither the old nor the new was never counted rightly.
    """
    store = current(spark, root)
    if store is None:
        return False
    nothing = (0, None)
    marks = store.marks(spark)
    before, after = (
        {r[DATE]: (r["rows"], r["digest"]) for r in day_digests(v).collect()}  # a row per refreshed day
        for v in (old, new)
    )
    moved = set()
    for day in days:
        counted, gone, come = (m.get(day, nothing) for m in (marks, before, after))
        if counted == come:
            continue
        if counted != gone:
            return False
        moved.add(day)
    if not moved:
        return True
    store = _merge(spark, store) if store.parts >= MOST_PARTS else store
    here = reduce(lambda x, y: x | y, [F.col(DATE).eqNullSafe(F.lit(d).cast("date")) for d in moved])
    both = signed(old.where(here), -1).unionByName(signed(new.where(here), 1))
    known = spark.createDataFrame([(d, *after.get(d, nothing)) for d in moved], MARK_SCHEMA)
    _append(spark, store, both, entity_changes(both), store.entities(spark), known)
    return True
