"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into segments. If two differ in at most ``max_bits`` bits,
they differ in few bits within some segment (pigeonhole), so each fingerprint
enumerates a small Hamming ball around each of its segments and fetches the
fingerprints filed under those keys; complete distances are verified in the
join itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import ready, text_of
from clicktide.llm.components import components
from clicktide.session import settle

BITS = 64
SEED = 42
UPPER_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
# Shingles whose bits are counted at a time; bounds memory for very long texts.
BLOCK = 65536


def fingerprint(text: str, words: int = 3) -> int:
    """64-bit fingerprint of one text; 0 when it has no words."""
    tokens = text.encode("utf-8", "surrogatepass").translate(UPPER_TO_LOWER).split()
    if not tokens:
        return 0
    if len(tokens) <= words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        part = hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(words: int):
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            found = np.array([fingerprint(t, words) for t in part], dtype=np.uint64)
            yield pd.Series(found.view(np.int64))

    return of


def segment_balls(max_bits: int, segments: int) -> list[tuple[int, int, list[int]]]:
    """Per segment: its first bit, its width and the masks of its Hamming ball.

    With ``max_bits = segments * r + a``, ``a + 1`` segments get radius r and the
    others r - 1: if all failed, the distance would exceed ``max_bits``.
    """
    radius, extra = divmod(max_bits, segments)
    plan, low = [], 0
    for k in range(segments):
        width = BITS // segments + (k < BITS % segments)
        reach = radius if k <= extra else radius - 1
        masks = [sum(1 << i for i in chosen) for r in range(reach + 1) for chosen in combinations(range(width), r)]
        if masks:
            plan.append((low, width, masks))
        low += width
    return plan


def _keyed(segment: int):
    """A segment's value filed under its number."""
    return lambda value: F.struct(F.lit(segment).alias("seg"), value.alias("key"))


def hamming_links(prints: DataFrame, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints (column ``fp``) at ``max_bits`` or fewer differing bits.

    Each pair appears once: it is kept only in the first segment that finds it.
    """
    plan = segment_balls(max_bits, segments)

    filed, probes = [], []
    for k, (low, width, masks) in enumerate(plan):
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        filed.append(_keyed(k)(part))
        ball = F.array(*[part.bitwiseXOR(F.lit(m).cast("long")) for m in masks])
        probes.append(F.transform(ball, _keyed(k)))
    table = prints.select(F.col("fp").alias("b"), F.inline(F.array(*filed)))
    asked = prints.select(F.col("fp").alias("a"), F.inline(F.concat(*probes)))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    # A pair found in several segments is kept in the first.
    first, earlier = F.lit(False), F.lit(False)
    for k, (low, width, masks) in enumerate(plan):
        first = first | ((F.col("asked.seg") == k) & ~earlier)
        bits = F.bit_count(F.shiftrightunsigned(apart, low).bitwiseAND(F.lit((1 << width) - 1)))
        earlier = earlier | (bits <= max(m.bit_count() for m in masks))
    asked, table = asked.alias("asked"), table.alias("filed")
    same = (F.col("asked.seg") == F.col("filed.seg")) & (F.col("asked.key") == F.col("filed.key"))
    close = (F.col("a") < F.col("b")) & (F.bit_count(apart) <= max_bits)
    return asked.join(table, same & close & first).select("a", "b")


def fingerprints(docs: DataFrame, words: int = 3, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp`` for every row; NULL and wordless texts have fingerprint 0."""
    ready(docs.sparkSession)
    return docs.select(F.col(id_column).alias("doc_id"), _fingerprints(words)(text_of(text)).alias("fp"))


def _grouped(rows: DataFrame, max_bits: int, segments: int) -> DataFrame:
    """Group of each fingerprint of ``doc_id, fp``: ``fp, component, component_id`` (a fingerprint and the smallest id of the group)."""
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = components(hamming_links(prints.select("fp"), max_bits, segments), "a", "b")
    named = prints.join(groups.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.withColumn("component", F.coalesce("component", "fp"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return named.join(smallest, "component").select("fp", "component", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """Fingerprint and group of every document: ``doc_id, fp, component_id``.

    Every input row gives one row, repeated rows too. ``component_id`` is the
    smallest ``doc_id`` reachable over links, NULL ids not counting (NULL if the
    group has no other id). Texts with the same fingerprint are in one group
    without being compared. An empty table gives an empty table; columns other
    than ``doc_id`` and ``text`` are not looked at.
    """
    rows = settle(fingerprints(docs, words), "fingerprints")
    named = _grouped(rows, max_bits, segments)
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 3, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """One row of each group of near-duplicates, with all columns of ``docs``.

    The row with the smallest ``doc_id`` stays; of several such rows (repeated ids,
    or none but NULL ids) the one with the smallest text, then any of the rows equal in both.
    Groups are told apart by fingerprint, so that one id in several groups stays in each.
    """
    groups = _grouped(settle(fingerprints(docs, words), "fingerprints"), max_bits, segments)
    packed = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("keep_id"), F.col("text").alias("keep_text"))
    # By fingerprint and id at once: texts move once here, and copies of a text are dealt out by their ids.
    known = groups.select("fp", "component", F.col("component_id").alias("least_id"))
    # Named nondeterministic, as Spark repeats others in a filter of its own: twice the work, and a second Python worker per task.
    prints = _fingerprints(words).asNondeterministic()
    printed = packed.withColumn("keep_fp", prints(text_of("keep_text")))
    chosen = (F.col("keep_fp") == F.col("fp")) & F.col("keep_id").eqNullSafe(F.col("least_id"))
    least = printed.join(known, chosen).select("row", "keep_text", "component")
    order = F.struct(F.col("keep_text").isNull(), "keep_text")
    return least.groupBy("component").agg(F.min_by("row", order).alias("row")).select("row.*")
