"""Repeated lines, found with two Bloom filters.

Every task adds the hashes of its lines to a filter of lines seen once, and those
already in it to a filter of lines seen twice. Filters of different tasks merge
bit by bit: what is in two once-filters has been seen twice. A line in the merged
twice-filter is only suspected; suspects alone are shuffled, as SHA-256 digests
with pre-added counts, to be confirmed exactly. Texts are shuffled only where a
filter of the confirmed digests says that they may lose a line.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktide.llm.common import batches, ready, text_of
from clicktide.session import settle

# Filter bits per line, and the most a filter may have (128 MB). Past that more lines
# are suspected than repeat, up to all of them, and results stay the same.
BITS_PER_LINE = 16
MOST_BITS = 1 << 30
# Bits of one segment, the unit in which filters are merged.
SEGMENT = 1 << 18
# Texts whose suspects a task holds before it passes them on.
HELD = 20_000


def keys_of(text: bytes) -> list[bytes]:
    """The key of each line: stripped of ASCII white space, A-Z in lower case."""
    return [line.strip().lower() for line in text.split(b"\n")]


def long_enough(key: bytes, least: int) -> bool:
    """Whether a key has at least ``least`` code points."""
    return len(key) >= least and (len(key) >= 4 * least or sum(b & 0xC0 != 0x80 for b in key) >= least)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Two bit numbers per hash; ``bits`` is a power of two."""
    return np.stack([hashes & np.uint64(bits - 1), (hashes >> np.uint64(32)) * np.uint64(0x9E3779B1) & np.uint64(bits - 1)])


def hashes_of(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


class Bloom:
    """A filter of 64-bit hashes over packed bits."""

    def __init__(self, bits: int, packed: np.ndarray | None = None) -> None:
        self.bits = bits
        self.packed = np.zeros(bits // 8, np.uint8) if packed is None else packed

    def add(self, hashes: np.ndarray) -> None:
        at = _places(hashes, self.bits).ravel()
        np.bitwise_or.at(self.packed, at >> np.uint64(3), np.left_shift(1, (at & np.uint64(7)).astype(np.uint8), dtype=np.uint8))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = _places(hashes, self.bits)
        return ((self.packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def filter_bits(lines: int, most: int = MOST_BITS) -> int:
    """Size of a filter for so many lines: a power of two between one segment and ``most``."""
    return min(max(SEGMENT, 1 << (max(1, lines) * BITS_PER_LINE - 1).bit_length()), most)


SEGMENTS = pa.schema([("segment", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
SEGMENTS_DDL = "segment int, once binary, twice binary"


def _cut(once: np.ndarray, twice: np.ndarray) -> Iterator[dict]:
    """The segments of a pair of filters that hold a bit."""
    width = SEGMENT // 8
    for k in range(len(once) // width):
        span = slice(k * width, (k + 1) * width)
        if once[span].any():
            pair = [[zlib.compress(x[span].tobytes(), 1)] for x in (once, twice)]
            yield {"segment": [k], "once": pair[0], "twice": pair[1]}


def _seen(parts: Iterator[pa.RecordBatch], bits: int, least: int) -> Iterator[dict]:
    """Both filters over the lines of one task; a line counts once a text."""
    once, twice = Bloom(bits), Bloom(bits)
    for part in parts:
        found = [hashes_of([k for k in set(keys_of(t)) if long_enough(k, least)]) for t in part.column("text").to_pylist()]
        hashes, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
        twice.add(hashes[(times > 1) | once.has(hashes)])
        once.add(hashes)
    yield from _cut(once.packed, twice.packed)


def _merged(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Filters of several tasks as one; holds the segments of one partition."""
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for part in parts:
        for k, *pair in zip(*(part.column(c).to_pylist() for c in SEGMENTS.names), strict=True):
            once, twice = (np.frombuffer(zlib.decompress(x), np.uint8) for x in pair)
            if k in held:
                once, twice = held[k][0] | once, held[k][1] | twice | (held[k][0] & once)
            held[k] = once, twice
    for k, (once, twice) in held.items():
        if twice.any():
            yield {"segment": [k], "once": [b""], "twice": [zlib.compress(twice.tobytes(), 1)]}


def _assembled(rows: DataFrame, bits: int) -> Bloom:
    """A whole filter on the driver, of at most ``MOST_BITS``."""
    found = Bloom(bits)
    for row in rows.select("segment", "twice").toLocalIterator():
        part = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
        found.packed[row["segment"] * (SEGMENT // 8) :][: len(part)] = part
    return found


def _per_task(parts: int, bits: int) -> int:
    return max(1, min(parts, bits // SEGMENT // 32 or 1))


def twice_seen(texts: DataFrame, bits: int, least: int) -> Bloom:
    """A filter that has every line found in two or more rows of ``text`` (binary), and few others."""
    own = texts.select("text").mapInArrow(lambda p: batches(_seen(p, bits, least), SEGMENTS), SEGMENTS_DDL)
    dealt = own.repartition(_per_task(4096, bits), "segment")
    return _assembled(dealt.mapInArrow(lambda p: batches(_merged(p), SEGMENTS), SEGMENTS_DDL), bits)


def _filter_of(digests: DataFrame, bits: int) -> Bloom:
    """A filter over the first eight bytes of ``digest``."""

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        found = Bloom(bits)
        for part in parts:
            found.add(np.array([int.from_bytes(d[:8], "little") for d in part.column("digest").to_pylist()], np.uint64))
        yield from _cut(found.packed, found.packed)

    own = digests.select("digest").mapInArrow(lambda p: batches(add(p), SEGMENTS), SEGMENTS_DDL)
    dealt = own.repartition(_per_task(4096, bits), "segment")
    return _assembled(dealt.mapInArrow(lambda p: batches(_merged(p), SEGMENTS), SEGMENTS_DDL), bits)


SUSPECTS = pa.schema([("page", pa.binary()), ("copies", pa.int64()), ("least_id", pa.int64()), ("digests", pa.list_(pa.binary())), ("lines", pa.list_(pa.int32()))])
SUSPECTS_DDL = "page binary, copies long, least_id long, digests array<binary>, lines array<int>"


def _suspects(texts: DataFrame, twice: Callable[[], Bloom], least: int) -> DataFrame:
    """Per distinct text of a task, its digest, number and smallest id, and the digests and first places of its suspected lines."""

    def out(held: dict[bytes, list]) -> dict:
        pages = [(d, *x) for d, x in held.items()]
        return dict(zip(SUSPECTS.names, map(list, zip(*pages, strict=True)), strict=True))

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known, held = twice(), {}
        for part in parts:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                page = hashlib.sha256(text).digest()
                if page in held:
                    held[page][0] += 1
                    if doc_id is not None and (held[page][1] is None or doc_id < held[page][1]):
                        held[page][1] = doc_id
                    continue
                first: dict[bytes, int] = {}
                for at, key in enumerate(keys_of(text)):
                    if long_enough(key, least):
                        first.setdefault(key, at)
                keys = list(first)
                hits = [k for k, hit in zip(keys, known.has(hashes_of(keys)), strict=True) if hit]
                if hits:
                    held[page] = [1, doc_id, [hashlib.sha256(k).digest() for k in hits], [first[k] for k in hits]]
                if len(held) >= HELD:
                    yield out(held)
                    held = {}
        if held:
            yield out(held)

    return texts.mapInArrow(lambda p: batches(found(p), SUSPECTS), SUSPECTS_DDL)


def drop_repeated_lines(docs: DataFrame, least_docs: int = 10, least_chars: int = 1, keep: str = "none", most_bits: int = MOST_BITS) -> DataFrame:
    """Texts without the lines that many documents share: ``doc_id, text, n_lines, n_dropped``.

    Lines end at ``\\n``. Lines are the same when they agree without ASCII white
    space at their ends and with A-Z in lower case; those of fewer than
    ``least_chars`` code points (0 counts as 1: empty lines always stay) are left
    alone. A line found in at least ``least_docs`` rows goes from every row, or,
    with ``keep="first"``, stays where it stands first, by smallest ``doc_id``
    (rows without id last), then by place; rows that share that id keep it too.

    Every row is a document of its own, repeated rows too, and gives one row. NULL
    texts count as empty; an empty text is one empty line. Columns other than
    ``doc_id`` and ``text`` are not looked at. ``n_lines`` counts before dropping.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep: none or first, not {keep}")
    if least_docs < 2:
        raise ValueError(f"least_docs: 2 or more, not {least_docs}")
    context = ready(docs.sparkSession).sparkContext
    least = max(1, least_chars)
    texts = docs.select("doc_id", text_of().cast("binary").alias("text"))
    line_count = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    lines = docs.select(text_of().alias("text")).agg(F.sum(line_count)).first()[0] or 0
    bits = filter_bits(lines, most_bits)
    twice = context.broadcast(twice_seen(texts, bits, least))
    suspects = settle(_suspects(texts, lambda: twice.value, least), "suspected-lines")
    twice.destroy()

    each = suspects.select("page", "copies", "least_id", F.inline(F.arrays_zip(F.col("digests").alias("digest"), F.col("lines").alias("line"))))
    place = F.struct(F.col("least_id").isNull().alias("no_id"), F.col("least_id").alias("id"), F.col("line").alias("line"))
    confirmed = each.groupBy("digest").agg(F.sum("copies").alias("n"), F.min(place).alias("first")).where(F.col("n") >= least_docs)
    confirmed = settle(confirmed.select("digest", "first"), "repeated-lines")
    held = context.broadcast(_filter_of(confirmed, filter_bits(confirmed.count(), most_bits)))

    pages = each.select("page", "digest").distinct().join(confirmed, "digest")
    # Written out, so that the join below may split the rows of a text with very many copies.
    lost = settle(pages.groupBy("page").agg(F.collect_list(F.struct("digest", "first.id", "first.line")).alias("lost")), "lost-lines")

    @F.pandas_udf("boolean")
    def may_lose(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            found = []
            for text in part:
                digests = [hashlib.sha256(k).digest() for k in set(keys_of(text)) if long_enough(k, least)]
                found.append(bool(held.value.has(np.array([int.from_bytes(d[:8], "little") for d in digests], np.uint64)).any()))
            yield pd.Series(found)

    @F.pandas_udf("text binary, n_dropped long")
    def kept(ids: pd.Series, texts: pd.Series, lost: pd.Series) -> pd.DataFrame:
        rows = []
        for doc_id, text, gone in zip(ids, texts, lost, strict=True):
            if gone is None:
                rows.append((text, 0))
                continue
            places = {bytes(g["digest"]): (g["id"], g["line"]) for g in gone}
            own = int(doc_id) if doc_id is not None and doc_id == doc_id else None
            lines = text.split(b"\n")
            stay = [line for at, line in enumerate(lines) if _stays(line, at, own, places, least, keep)]
            rows.append((b"\n".join(stay), len(lines) - len(stay)))
        return pd.DataFrame(rows, columns=["text", "n_dropped"])

    told = texts.withColumn("may_lose", may_lose("text"))
    whole = told.where(~F.col("may_lose")).select("doc_id", F.col("text").cast("string").alias("text"), F.lit(0).cast("long").alias("n_dropped"), "text")
    some = told.where("may_lose").withColumn("page", F.unhex(F.sha2("text", 256))).join(lost, "page", "left")
    ids = F.col("doc_id").cast("string")  # a column of numbers with NULLs would arrive as floats
    cut = some.select("doc_id", "text", kept(ids, "text", "lost").alias("kept"))
    cut = cut.select("doc_id", F.col("kept.text").cast("string").alias("kept_text"), "kept.n_dropped", "text")
    both = whole.toDF("doc_id", "kept_text", "n_dropped", "text").unionByName(cut)
    text = F.col("text").cast("string")
    n_lines = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return both.select("doc_id", F.col("kept_text").alias("text"), n_lines.cast("long").alias("n_lines"), "n_dropped")


def _stays(line: bytes, at: int, doc_id: int | None, places: dict, least: int, keep: str) -> bool:
    key = line.strip().lower()
    if not long_enough(key, least):
        return True
    place = places.get(hashlib.sha256(key).digest(), False)
    return place is False or keep == "first" and place == (doc_id, at)
