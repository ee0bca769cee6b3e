"""Merkle manifest of a table: one tree per group of rows, and a tree over the groups.

Each level is a join of the level with itself: the first node of every run
computes the indices of its siblings (index XOR 1 in binary trees, slot offsets
otherwise), an equijoin fetches them, and that first row emits the parent. No
group is ever gathered: a key of such a join names one node, and a run has at
most ``fanout`` of them. On the way down every node joins its parent, which
brings the siblings and the path above.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.session import settle

ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of texts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def counted(value: Column) -> Column:
    """A value as text after its number of UTF-8 bytes and a colon; ``-`` for NULL."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    """Digest of a row over the given values."""
    return digest(*map(counted, values))


def group_key(value: Column) -> Column:
    """A text that is never NULL and sorts like the value's UTF-8 bytes, NULL first."""
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), value.cast("string")))


def numbered(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``rows`` with ``idx`` (from 0) and ``size`` within their ``grp``, in the given order.

    One range sort over (group, order); a large group lies in several sort
    partitions, whose counts are added up. Sorted rows are written out, so that
    places cannot change between counting and use.
    """
    placed = settle(rows.orderBy("grp", *order).withColumn("at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("part", F.shiftright("at", ROW_BITS))
    runs = placed.groupBy("grp", "part").agg(F.min("at").alias("lead"), F.count(F.lit(1)).alias("n"))
    # One row per group and sort partition.
    within = Window.partitionBy("grp")
    before = within.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("lead")
    runs = runs.select("grp", "part", start.alias("shift"), F.sum("n").over(within).alias("size"))
    return placed.join(runs, ["grp", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def siblings(idx: Column, fanout: int) -> Column:
    """Indices of the nodes that share a run with the first node of the run, itself included."""
    if fanout == 2:
        return F.array(idx, idx.bitwiseXOR(F.lit(1).cast("long")))
    return F.transform(F.sequence(F.lit(0), F.lit(fanout - 1)), lambda slot: idx + slot)


def parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level of the groups that have more than one node: ``grp, idx, size, node, children``."""
    level = nodes.where("size > 1").select("grp", "idx", "size", "node")
    first = level.where(F.col("idx") % fanout == 0)
    asked = first.select("grp", F.col("idx").alias("lead"), F.explode(siblings(F.col("idx"), fanout)).alias("idx"))
    runs = asked.join(level, ["grp", "idx"]).groupBy("grp", "lead", "size")
    found = runs.agg(F.sort_array(F.collect_list(F.struct("idx", "node"))).alias("run"))
    children = F.transform("run", lambda x: x["node"])
    up = found.select("grp", F.expr(f"lead div {fanout}").alias("idx"), F.ceil(F.col("size") / fanout).alias("size"), children.alias("children"))
    return up.withColumn("node", F.sha2(F.array_join("children", ""), 256))


@dataclass
class Trees:
    """Levels of the trees of all groups, leaves first: ``grp, idx, size, node`` and, above the leaves, ``children``."""

    levels: list[DataFrame]
    fanout: int

    def roots(self) -> DataFrame:
        """``grp, node``: the last node of every group."""
        tops = [level.where("size = 1").select("grp", "node") for level in self.levels]
        for more in tops[1:]:
            tops[0] = tops[0].unionByName(more)
        return tops[0]

    def paths(self, above: DataFrame | None = None, more: Sequence[str] = ()) -> DataFrame:
        """``grp, idx``, the leaf columns ``more`` and ``path`` for every leaf: the digests left and right of it, level by level to the root.

        ``above`` (``grp, path`` and any other columns, which every leaf of the group
        gets) goes on from the root of each group. A path moves once, to the run below it.
        """
        nothing = F.expr("cast(array() as array<struct<lead: string, tail: string>>)")
        given = [] if above is None else [c for c in above.columns if c not in ("grp", "path")]
        path = None
        for k in reversed(range(len(self.levels))):
            own = ["grp", "idx", *(more if k == 0 else ())]
            tops = self.levels[k].where("size = 1").select(*own)
            here = tops.withColumn("path", nothing) if above is None else tops.join(above, "grp")
            here = here.select(*own, *given, "path")
            if path is not None:
                kids = self.levels[k].where("size > 1").select(*own, F.expr(f"idx div {self.fanout}").alias("up"))
                over = path.join(self.levels[k + 1].select("grp", "idx", "children"), ["grp", "idx"]).withColumnRenamed("idx", "up")
                slot = (F.col("idx") % self.fanout).cast("int")
                lead = F.array_join(F.slice("children", F.lit(1), slot), "")
                tail = F.array_join(F.slice("children", slot + 2, F.lit(self.fanout)), "")
                step = F.array(F.struct(lead.alias("lead"), tail.alias("tail")))
                under = kids.join(over, ["grp", "up"]).select(*own, *given, F.concat(step, "path").alias("path"))
                here = here.unionByName(under)
            path = here
        return path


def climb(leaves: DataFrame, fanout: int) -> Trees:
    """Trees over ``grp, idx, size, node``; each level is written to the scratch folder. The driver sees the largest size."""
    levels = [leaves]
    most = leaves.agg(F.max("size")).first()[0] or 0
    while most > 1:
        levels.append(settle(parents(levels[-1], fanout), "merkle-level"))
        most = -(-most // fanout)
    return Trees(levels, fanout)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["lead"], node, step["tail"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path, from the leaf upwards, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["lead"], step["tail"])), ""), 256)


def manifest(docs: DataFrame, group: str, order: str, leaf: Column, *more: Column, fanout: int = 16) -> DataFrame:
    """A row per row of ``docs``: ``order``'s column, ``leaf, subroot, root, path`` and the columns ``more``.

    The rows of a group are leaves in ascending ``order``; repeated order values go by
    their leaves, NULLs stand first. While several nodes remain, each run of
    ``fanout`` (the last may be shorter, even one node) becomes the digest of its
    nodes; the roots of the groups, NULL first, then by UTF-8 bytes, give the root
    in the same way. A single leaf is its own root. An empty table gives no rows.
    """
    if fanout < 2:
        raise ValueError(f"fanout: 2 or more, not {fanout}")
    extra = [f"more{k}" for k in range(len(more))]
    rows = docs.select(
        group_key(F.col(group)).alias("grp"), F.col(order).alias("place"), leaf.alias("node"), *(c.alias(n) for c, n in zip(more, extra, strict=True))
    )
    leaves = settle(numbered(rows, [F.col("place"), F.col("node")], "merkle-sorted"), "merkle-leaves")
    trees = climb(leaves, fanout)
    roots = trees.roots().select(F.lit("").alias("grp"), F.col("grp").alias("of"), "node")
    roots = settle(numbered(roots, [F.col("of")], "merkle-roots"), "merkle-subroots")
    top = climb(roots, fanout)
    root = top.roots().select("grp", F.col("node").alias("root"))
    above = roots.select("grp", "idx", "of", F.col("node").alias("subroot")).join(top.paths(), ["grp", "idx"]).join(root, "grp")
    above = settle(above.select(F.col("of").alias("grp"), "subroot", "root", "path"), "merkle-groups")
    found = trees.paths(above, ["place", "node", *extra])
    return found.select(F.col("place").alias(order), F.col("node").alias("leaf"), "subroot", "root", "path", *extra)


def audit(docs: DataFrame, tampered: Column, fanout: int = 16) -> DataFrame:
    """Manifest of documents by source, and what verification finds where texts were altered.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` per
    row. Leaves cover doc_id, source, lang, n_chars and text. Where ``tampered`` is
    true the text's A-Z are in lower case when its leaf is folded with the original
    siblings; elsewhere (and where it is NULL) the original leaf is folded. NULLs
    in any column have a digest of their own; NULL ids stand first in their source,
    repeated rows are leaves of their own. Other columns are not looked at.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = leaf_digest(*fields, F.translate("text", upper, upper.lower()))
    altered = F.when(tampered, lowered)
    found = manifest(docs, "source", "doc_id", leaf_digest(*fields, F.col("text")), altered, fanout=fanout)
    found = found.withColumn("folded_root", fold(F.coalesce("more0", "leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
