"""Embedding near-duplicates by an exact metric range join.

Vectors go to the cell of their nearest pivot. A vector is copied into another
cell only if the triangle inequality lets one of that cell's vectors lie within
range: with angles as the metric, ``angle(y, p) - angle(y, home) <= 2 r``. The
distance from ``y`` to the plane between both pivots bounds it once more. Of
two cells the pair is left to the one with the smaller number, so that every
pair meets exactly once, and cells join independently. Large cells are cut into
blocks which meet pairwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import ready
from clicktide.llm.components import components
from clicktide.session import settle

BLOCK_ROWS = 2048
# Rounding may move a bound this far; it only copies a few vectors more.
SLACK = 1e-6
ASSIGNED = "node long, copies long, embedding array<float>, label string, dim int, cell int, home boolean"
FOUND = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def usable(column: str = "embedding"):
    """Vectors that are not NULL or zero and hold finite numbers only."""
    vector = F.col(column)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & some, F.lit(False))


def unit_rows(vectors: pa.Array) -> np.ndarray:
    """Lists of one length as rows of length 1, in double precision."""
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def pivot_count(vectors: int) -> int:
    """Grows with the root of the table: 1 at 1,000 vectors, 7 at 50,000, 989 at a billion."""
    return max(1, math.ceil(math.sqrt(vectors) / 32))


def _cells(classes: DataFrame, angle: float) -> DataFrame:
    """Home cell of every vector, and copies for the cells it may reach."""
    total = classes.count()
    # Not more than pivot_count rows reach the driver, in an order that never varies.
    chosen = classes.orderBy(F.xxhash64("node"), "node").limit(pivot_count(total)).select("dim", "embedding").collect()
    pivots: dict[int, np.ndarray] = {}
    for dim in {r["dim"] for r in chosen}:
        pivots[dim] = unit_rows(pa.array([r["embedding"] for r in chosen if r["dim"] == dim], pa.list_(pa.float32())))
    chord = 2 * math.sin(angle / 2)

    def assign(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            dims = part.column("dim").to_numpy()
            for dim in np.unique(dims):
                mine = part.filter(pa.array(dims == dim))
                centres = pivots.get(int(dim))
                rows = np.arange(mine.num_rows)
                if centres is None:
                    who, where, at_home = rows, np.zeros(len(rows), np.int32), np.ones(len(rows), bool)
                else:
                    near = np.clip(unit_rows(mine.column("embedding")) @ centres.T, -1, 1)
                    home = near.argmax(axis=1)
                    best = near[rows, home]
                    gap = np.linalg.norm(centres[:, None] - centres[None], axis=2)[home]
                    triangle = np.arccos(near) - np.arccos(best)[:, None] <= 2 * angle + SLACK
                    plane = best[:, None] - near <= chord * gap + SLACK
                    lower = np.arange(len(centres))[None] < home[:, None]
                    far_row, far_cell = np.nonzero(triangle & plane & lower)
                    who, where = np.r_[rows, far_row], np.r_[home, far_cell]
                    at_home = np.r_[np.ones(len(rows), bool), np.zeros(len(far_row), bool)]
                out = mine.take(pa.array(who))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(where, pa.int32()), pa.array(at_home)], names=[*mine.schema.names, "cell", "home"]
                )

    return classes.mapInArrow(assign, ASSIGNED)


def _blocks(assigned: DataFrame) -> DataFrame:
    """Rows of a cell gathered into blocks of about ``BLOCK_ROWS``."""
    place = ["label", "dim", "cell", "home"]
    sizes = assigned.groupBy(*place).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    numbered = assigned.join(sizes, place).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    row = F.struct("node", "copies", "embedding")
    return numbered.groupBy(*place, "block").agg(F.collect_list(row).alias("rows"))


def _roots(left: np.ndarray, right: np.ndarray, nodes: int) -> np.ndarray:
    """Smallest reachable position per position, by repeated minima over the pairs."""
    root = np.arange(nodes)
    while True:
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
        if np.array_equal(before, root):
            return root


def _joined(least: float):
    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for k in range(part.num_rows):
                one, two = (part.column(c)[k].values for c in ("rows", "others"))
                same = part.column("same")[k].as_py()
                a, b = unit_rows(one.field("embedding")), unit_rows(two.field("embedding"))
                near = a @ b.T >= least
                i, j = np.nonzero(np.triu(near, 1) if same else near)
                if not len(i):
                    continue
                ids = [x.field("node").to_numpy() for x in (one, two)]
                copies = [x.field("copies").to_numpy() for x in (one, two)]
                nodes = ids[0] if same else np.r_[ids[0], ids[1]]
                shift = 0 if same else len(ids[0])
                links = np.zeros(len(nodes), np.int64)
                np.add.at(links, i, copies[1][j])
                np.add.at(links, j + shift, copies[0][i])
                order = np.argsort(nodes, kind="stable")
                rank = np.argsort(order, kind="stable")
                root = _roots(rank[i], rank[j + shift], len(nodes))
                touched = np.nonzero(links)[0]
                named = nodes[order][root[rank[touched]]]
                yield pa.RecordBatch.from_arrays([pa.array(nodes[touched]), pa.array(links[touched]), pa.array(named)], schema=FOUND)

    return compare


def range_links(classes: DataFrame, least: float) -> DataFrame:
    """Linked vectors of each pair of blocks: ``node, links, root``.

    ``classes`` has ``node, copies, embedding, label, dim``. ``links`` adds the
    copies of linked vectors, ``root`` is a node connected to it by links. A
    vector may appear once for each pair of blocks that it is in.
    """
    angle = math.acos(least)
    blocks = settle(_blocks(settle(_cells(classes, angle), "cells")), "blocks")
    key = ["label", "dim", "cell"]
    homes = blocks.where("home")
    others = blocks.select(*key, F.col("home").alias("other_home"), F.col("block").alias("other"), F.col("rows").alias("others"))
    pairs = homes.join(others, key).where("NOT other_home OR other >= block")
    pairs = pairs.select("rows", "others", (F.col("other_home") & (F.col("other") == F.col("block"))).alias("same"))
    return pairs.mapInArrow(_joined(least), "node long, links long, root long")


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """Links and groups of vectors with equal labels and cosine of at least ``least``: ``vec_id, n_links, component_id, kept``.

    One row per input row. ``n_links`` counts the other rows linked directly;
    ``component_id`` is the smallest ``vec_id`` reachable; ``kept`` says that it
    is the row's own. Vectors that are NULL, empty, zero or hold NULL or
    non-finite components, and rows with a NULL label, link with nothing, nor do
    vectors of different lengths. Rows with a NULL ``vec_id`` have no links, no
    component and are not kept. Equal vectors are compared once and counted as
    often as they occur; rows with one ``vec_id`` but several vectors share a
    component. Other columns are not looked at.
    """
    ready(vectors.sparkSession)
    vector = F.col("embedding").cast("array<float>")
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), vector.alias("embedding"))
    able = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & usable()
    rows = rows.withColumn("embedding", F.when(able, F.col("embedding")))
    linked = rows.where("embedding IS NOT NULL")
    classes = linked.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"))
    classes = settle(classes.select("node", "copies", "embedding", "label", F.size("embedding").alias("dim")), "vectors")
    found = settle(range_links(classes, least), "found")
    # Copies of one vector are linked with each other; a node stands for them.
    copies = linked.join(classes.select("label", "embedding", "node", "copies"), ["label", "embedding"]).select("vec_id", "node", "copies")
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    edges = edges.unionByName(copies.where("vec_id != node").select(F.col("vec_id").alias("a"), F.col("node").alias("b")))
    groups = components(edges, "a", "b").select(F.col("node").alias("vec_id"), "component")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    linked_counts = copies.join(counted, "node", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    idle = rows.where("embedding IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"))
    every = linked_counts.unionByName(idle).join(groups, "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return every.select(
        "vec_id", "n_links", component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept")
    )
