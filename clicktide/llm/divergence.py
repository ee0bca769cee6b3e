"""Divergence between the sources of a language, by smoothed term shares.

Terms are counted per (language, source) with map-side totals. Each group is
then a set of sorted (term id, count) arrays, one per slice of the vocabulary,
and a task co-groups two blocks of sources: for every unordered pair a galloping
search intersects the arrays and prices shared terms, terms of one side only and
terms that both lack. Slices of a pair are added up afterwards.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicktide.llm.common import batches, ready
from clicktide.session import settle

UNIT = 1_000_000_000
# Occurrences added to every term.
ADDED = 5
# Terms of a slice and sources of a block: a task holds at most two blocks of arrays of one slice.
SLICE = 1 << 13
BLOCK = 32
# Distinct terms that a counting task holds before it passes them on.
HELD = 300_000

# Letters and bytes of non-ASCII characters stay, A-Z in lower case; all else separates terms.
_TERM_BYTES = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters (in lower case) and non-ASCII characters."""
    return text.translate(_TERM_BYTES).split(b" ")


def _counts(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Occurrences and documents of each term by group, added up within a task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out() -> Iterator[dict]:
        for (lang, source), (times, docs) in held.items():
            terms = list(times)
            yield {"lang": [lang] * len(terms), "source": [source] * len(terms), "term": terms, "n": list(times.values()), "docs": [docs[t] for t in terms]}

    for part in parts:
        for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            times, docs = held.setdefault((lang, source), (Counter(), Counter()))
            size -= len(times)
            terms = terms_of(text)
            times.update(terms)
            docs.update(set(terms))
            del times[b""], docs[b""]
            size += len(times)
            if size > HELD:
                yield from out()
                held.clear()
                size = 0
    yield from out()


COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and rows that hold the term; columns without NULL, text binary."""
    rows = docs.mapInArrow(lambda p: batches(_counts(p), COUNTS), "lang string, source string, term binary, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + ADDED) / (total + ADDED * terms)), in whole numbers, digit by digit.

    The divisor may be as large as 9e15.
    """
    over = total + terms * ADDED
    rest, found = count + ADDED, F.lit(0).cast("long")
    for _ in range(3):
        rest = rest * 1000
        found = found * 1000 + F.call_function("div", rest, over)
        rest = rest % over
    return found + 1


def prices(counts: np.ndarray, over: int) -> np.ndarray:
    """The same for an array, with the divisor given."""
    rest, found = counts.astype(np.int64) + ADDED, np.zeros(len(counts), np.int64)
    for _ in range(3):
        rest = rest * 1000
        found = found * 1000 + rest // over
        rest = rest % over
    return found + 1


def gallop(few: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ids that two sorted arrays share, the shorter searched in the longer."""
    at = np.searchsorted(many, few)
    at[at == len(many)] = 0
    hit = np.flatnonzero(many[at] == few) if len(many) else np.zeros(0, np.int64)
    return hit, at[hit]


def apart(a: tuple, b: tuple, terms: int) -> int:
    """Sum of price differences over ``terms`` terms of two groups, each given as sorted ids, their prices and the price of an absent term."""
    (ids_a, p_a, none_a), (ids_b, p_b, none_b) = (a, b) if len(a[0]) <= len(b[0]) else (b, a)
    in_a, in_b = gallop(ids_a, ids_b)
    both_a, both_b = p_a[in_a], p_b[in_b]
    shared = np.abs(both_a - both_b).sum()
    only_a = np.abs(p_a - none_b).sum() - np.abs(both_a - none_b).sum()
    only_b = np.abs(p_b - none_a).sum() - np.abs(both_b - none_a).sum()
    lacking = terms - len(ids_a) - len(ids_b) + len(in_a)
    return int(shared + only_a + only_b) + abs(none_a - none_b) * lacking


def _pairs(cell: pd.DataFrame) -> pd.DataFrame:
    """Parts of the pair sums of one slice between two blocks of sources, of which the first may be the second."""
    held = []
    for row in cell.itertuples(index=False):
        over = row.total + ADDED * row.terms
        ids = np.asarray(row.ids, np.int32) if row.ids is not None else np.zeros(0, np.int32)
        counts = np.asarray(row.counts, np.int64) if row.ids is not None else np.zeros(0, np.int64)
        none = int(prices(np.zeros(1, np.int64), over)[0]) if over else 0
        held.append((row.place, row.block, (ids, prices(counts, over), none), int(row.width)))
    first, last = cell["lo"].iloc[0], cell["hi"].iloc[0]
    found = []
    for place, block, own, width in held:
        for other, its_block, its, _ in held:
            if place < other and block == first and its_block == last:
                found.append((cell["lang"].iloc[0], place, other, apart(own, its, width)))
    return pd.DataFrame(found, columns=["lang", "a", "b", "value"])


def pair_values(groups: DataFrame, kept: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, a, b, value``: divergence of each two sources (by their ``place`` in the language, a < b).

    ``groups``: lang, source, place, total, terms; ``kept``: lang, slice, id, term;
    ``counts``: lang, source, slice, id, n.
    """
    arrays = counts.groupBy("lang", "source", "slice").agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("held"))
    arrays = arrays.select("lang", "source", "slice", F.transform("held", lambda x: x["id"]).alias("ids"), F.transform("held", lambda x: x["n"]).alias("counts"))
    widths = kept.groupBy("lang", "slice").agg(F.count(F.lit(1)).alias("width"))
    grid = groups.withColumn("block", F.floor((F.col("place") - 1) / BLOCK).cast("int"))
    grid = grid.withColumn("slice", F.explode(F.sequence(F.lit(0), slices_of(F.col("terms")) - 1)))
    grid = grid.join(arrays, ["lang", "source", "slice"], "left").join(widths, ["lang", "slice"], "left")
    grid = grid.withColumn("other", F.explode(F.sequence(F.lit(0), F.floor((F.col("sources") - 1) / BLOCK).cast("int"))))
    cells = grid.select(
        "lang", "slice", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "place", "block", "total", "terms", "ids", "counts", F.coalesce("width", F.lit(0)).alias("width"),
    )
    parts = cells.groupBy("lang", "slice", "lo", "hi").applyInPandas(_pairs, "lang string, a int, b int, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def slices_of(terms: Column) -> Column:
    """Slices of a vocabulary: one for every ``SLICE`` terms, at least one."""
    return F.greatest(F.ceil(terms / SLICE), F.lit(1)).cast("int")


def divergence(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """How far each source of a language is from the others, and which terms set it apart: ``lang, source, part, item, value, rank``.

    A language keeps the terms found in at least ``least_docs`` of its rows. Part
    ``pair`` has a row for every other source of the language, part ``term`` the
    ``top`` terms that the source holds more of than the language, both by
    falling value, then by UTF-8 bytes. All arithmetic is in whole numbers.

    NULL text, lang and source count as empty. Every row is a document, repeated
    rows too; ids are not looked at, nor are other columns. A source without terms
    still has pairs; without any kept term their value is 0.
    """
    ready(docs.sparkSession)
    texts = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    counts = settle(term_counts(texts), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("everywhere")).where(F.col("docs") >= least_docs)
    kept = settle(kept.select("lang", "term", "everywhere"), "kept-terms")
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("everywhere").alias("lang_total"))
    slice_ = F.pmod(F.xxhash64("term"), slices_of(F.col("terms"))).cast("int")
    by_term = Window.partitionBy("lang", "slice").orderBy("term")
    kept = kept.join(languages, "lang").withColumn("slice", slice_).withColumn("id", F.row_number().over(by_term) - 1)
    kept = settle(kept, "numbered-terms")
    held = settle(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")

    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(languages, "lang", "left")
    lang = Window.partitionBy("lang")
    groups = groups.select(
        "lang", "source", F.row_number().over(lang.orderBy("source")).alias("place"), F.count(F.lit(1)).over(lang).alias("sources"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "terms")),
    )
    groups = settle(groups, "audited-sources")

    found = pair_values(groups, kept, held.select("lang", "source", "slice", "id", "n"))
    names = groups.select("lang", "place", "source")
    both = found.select("lang", "value", F.inline(F.array(F.struct(F.col("a").alias("place"), F.col("b").alias("other")), F.struct(F.col("b").alias("place"), F.col("a").alias("other")))))
    pairs = both.join(names, ["lang", "place"]).join(names.select("lang", F.col("place").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")

    priced = held.join(totals, ["lang", "source"])
    own, usual = price(F.col("n"), F.col("total"), F.col("terms")), price(F.col("everywhere"), F.col("lang_total"), F.col("terms"))
    terms = priced.select("lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), (own - usual).alias("value")).where("value > 0")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
