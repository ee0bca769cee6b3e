"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.session import settle


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free hash of an edge table."""
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def _round(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges ``u > v``.

    Neighbours are reduced to their minimum with map-side combining and joined
    back, so that the rows of a hub are never gathered in one group.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u != v").distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    hung = large.join(lowest, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """Smallest node reachable from every linked node: ``node, component``.

    ``links`` may hold a pair in either order and more than once; links of a node
    to itself and links with a NULL end are ignored. Nodes without links do not
    appear. Each round is written to the shared scratch folder; the driver only
    sees a count and a hash, and stops when a round changes nothing.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & F.col("u").isNotNull() & (F.col("u") != F.col("v")))
    edges = settle(edges.distinct(), "links")
    mark = _mark(edges)
    while mark[0]:
        edges = settle(_round(edges), "stars")
        last, mark = mark, _mark(edges)
        if mark == last:
            break
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)
