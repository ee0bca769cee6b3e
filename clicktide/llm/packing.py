"""Best-fit packing of documents into sequences, by hierarchical residual packing.

Each input partition packs its pieces by best fit. Sequences that are nearly full
are done; the others become items of the next round, in which a task packs the
underfull sequences of many earlier tasks. Rounds go on until one task could hold
all that is left, or a round gains nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import batches, ready, text_of
from clicktide.llm.token_ids import REMEMBERED, token_ids
from clicktide.session import settle

# A sequence with so few free tokens is done.
NEARLY_FULL = 4
# Underfull sequences that one task packs in a later round.
ITEMS_PER_TASK = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, filled long"
MOVES = "bin long, parent long, shift long, filled long"


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit in decreasing order: bin and offset of each item, and the tokens in each bin.

    Open bins are kept by their free room, with one bit per room that has any,
    so that the tightest bin is found at once.
    """
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    filled: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0
    for item in np.argsort(-lengths, kind="stable"):
        need = int(lengths[item])
        fitting = rooms >> need
        if fitting:
            room = need + (fitting & -fitting).bit_length() - 1
            found = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, found = size, len(filled)
            filled.append(0)
        bins[item], offsets[item] = found, filled[found]
        filled[found] += need
        if room > need:
            by_room[room - need].append(found)
            rooms |= 1 << (room - need)
    return bins, offsets, np.array(filled, np.int64)


def pieces_of(ids: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """Number, start, length and CRC-32 of the pieces of one document; the first may be shorter."""
    total = len(ids) // 4
    first = (total - 1) % size + 1
    cuts = [0, *range(first, total + 1, size)]
    return [(k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def _first(level: int, part: int, count: int) -> np.ndarray:
    """Numbers of new bins, different in every round and task."""
    return (np.int64(level) << 56) + (np.int64(part) << 32) + np.arange(count, dtype=np.int64)


def _local(path: str, size: int, remembered: int):
    schema = pa.schema([(n, pa.int32() if n == "piece" else pa.int64()) for n in ("doc_id", "piece", "start", "length", "ids_crc32", "bin", "offset", "filled")])
    end = np.array([0], "<u4").tobytes()

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        encode = token_ids(path, remembered)
        found: list[tuple] = []
        for part in parts:
            ids, texts = (part.column(c).to_pylist() for c in ("doc_id", "text"))
            for at in range(0, len(texts), 512):
                for doc, tokens in zip(ids[at : at + 512], encode(texts[at : at + 512]), strict=True):
                    found += [(doc, *p) for p in pieces_of(tokens + end, size)]
        if not found:
            return
        lengths = np.array([f[3] for f in found], np.int64)
        bins, offsets, filled = best_fit(lengths, size)
        named = _first(0, TaskContext.get().partitionId(), len(filled))
        for at in range(0, len(found), 65536):
            some = slice(at, at + 65536)
            columns = dict(zip(schema.names[:5], zip(*found[some], strict=True), strict=True))
            yield columns | {"bin": named[bins[some]], "offset": offsets[some], "filled": filled[bins[some]]}

    return lambda parts: batches(pack(parts), schema)


def _merge(level: int, size: int):
    schema = pa.schema([(n, pa.int64()) for n in ("bin", "parent", "shift", "filled")])

    def pack(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = [(p.column("bin").to_numpy(), p.column("filled").to_numpy()) for p in parts]
        if not sum(len(b) for b, _ in held):
            return
        children, lengths = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(children, kind="stable")  # the same result in a repeated task
        children, lengths = children[order], lengths[order]
        bins, offsets, filled = best_fit(lengths, size)
        named = _first(level, TaskContext.get().partitionId(), len(filled))
        yield {"bin": children, "parent": named[bins], "shift": offsets, "filled": filled[bins]}

    return lambda parts: batches(pack(parts), schema)


def pack(docs: DataFrame, path: str, size: int = 2048, remembered: int = REMEMBERED) -> DataFrame:
    """Pieces of all documents and their places: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its token ids (NULL text: none) followed by id 0, so that every
    row has a piece. Documents longer than ``size`` are cut into pieces of
    ``size``, the first of which may be shorter. Repeated rows and NULL ids are
    packed like others; an empty table gives an empty table. Columns other than
    ``doc_id`` and ``text`` are not looked at. What a task holds is bounded: the
    pieces' numbers of one input partition, then ``ITEMS_PER_TASK`` sequences.
    ``remembered`` pieces of text stay in a worker's memory (about 200 bytes each):
    more memory saves encoding the same words again.
    """
    ready(docs.sparkSession)
    rows = docs.select("doc_id", text_of().alias("text"))
    placed = settle(rows.mapInArrow(_local(path, size, remembered), PIECES), "pieces")
    under = placed.where(F.col("filled") < size - NEARLY_FULL).select("bin", "filled").distinct()
    under = settle(under, "underfull")
    left, level = under.count(), 0
    while left > 1:
        level += 1
        tasks = -(-left // ITEMS_PER_TASK)
        dealt = under.repartition(tasks, F.xxhash64("bin", F.lit(level))) if tasks > 1 else under.coalesce(1)
        moves = settle(dealt.mapInArrow(_merge(level, size), MOVES), "moves")
        placed = placed.join(moves.select("bin", "parent", "shift"), "bin", "left").select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            F.coalesce("parent", "bin").alias("bin"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
        parents = moves.where(F.col("filled") < size - NEARLY_FULL).select(F.col("parent").alias("bin"), "filled").distinct()
        under = settle(parents, "underfull")
        last, left = left, under.count()
        if tasks == 1 or left > 0.99 * last:
            break
        placed = settle(placed, "pieces")
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
