"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector's direction, padded with zeros, is rotated at random; the signs of the
result are its code, stored packed beside one correction scalar (the inner
product of code and direction) and the length. The code estimates an inner
product with a query, and the scalar bounds the error of the estimate. Only
candidates whose upper bound reaches the query's twentieth score are compared
with their original vectors.

Candidates and queries are dealt into blocks, every query block meets every
candidate block once, and each meeting keeps the best of each query only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktide.llm.common import ready
from clicktide.llm.embed_dedup import usable
from clicktide.session import settle

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024
# Code bits per dimension and width of the error bound in standard deviations.
BITS_PER_DIM = 4
DEVIATIONS = 3.0
SEED = 20
CODED = "vec_id long, embedding array<float>, dim int, code binary, fit double, length double"
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def code_bits(dim: int) -> int:
    """Bits of a code: whole 64-bit words."""
    return -(-dim * BITS_PER_DIM // 64) * 64


@cache
def rotation(dim: int) -> np.ndarray:
    """The first ``dim`` rows of a random orthogonal matrix, the same in every task."""
    bits = code_bits(dim)
    turned, upper = np.linalg.qr(np.random.default_rng(SEED).standard_normal((bits, bits)))
    return np.ascontiguousarray((turned * np.sign(np.diag(upper)))[:dim])


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def encode(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes, inner products of code and direction, lengths."""
    scale = np.abs(rows).max(axis=1, keepdims=True)
    length = np.linalg.norm(rows / scale, axis=1) * scale[:, 0]
    turned = ((rows / scale) @ rotation(rows.shape[1])) / (length / scale[:, 0])[:, None]
    fit = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    return np.packbits(turned > 0, axis=1), fit, length


def _encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        dims = part.column("dim").to_numpy()
        for dim in np.unique(dims):
            mine = part.filter(pa.array(dims == dim))
            codes, fit, length = encode(_matrix(mine.column("embedding")))
            columns = [*mine.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(fit), pa.array(length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*mine.schema.names, "code", "fit", "length"])


def build_index(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding, dim, code, fit, length`` of every usable vector.

    NULL ids and vectors that are NULL, empty, zero or hold NULL or non-finite
    components are left out. Of rows with the same id the smallest vector stays.
    """
    ready(vectors.sparkSession)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable()).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return rows.withColumn("dim", F.size("embedding")).mapInArrow(_encode, CODED)


def _best(ids: np.ndarray, rows: np.ndarray, codes: np.ndarray, fit: np.ndarray, length: np.ndarray, qids: np.ndarray, queries: np.ndarray, k: int):
    """Best ``k`` candidates of one block for each query: positions of queries, ids, scores."""
    bits = codes.shape[1] * 8
    signs = (np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(bits))
    turned = (queries @ rotation(queries.shape[1])).astype(np.float32)
    size = np.linalg.norm(queries, axis=1)
    spread = np.sqrt(np.maximum(1 - fit**2, 0)) / fit * DEVIATIONS / np.sqrt(bits - 1)
    own = ids[None, :] == qids[:, None]
    guess = (turned @ signs.T) * (length / fit).astype(np.float32)
    guess[own] = -np.inf
    margin = np.outer(size, length * spread).astype(np.float32)
    top = min(k, len(ids))
    first = np.argpartition(-guess, top - 1, axis=1)[:, :top]
    sure = np.einsum("qkd,qd->qk", rows[first], queries)
    sure[np.take_along_axis(own, first, axis=1)] = -np.inf
    # The k-th of these exact scores; a candidate whose bound lies below cannot be among the best.
    floor = sure.min(axis=1) - 1e-4 * size * length.max()
    q, c = np.nonzero((guess + margin >= floor[:, None].astype(np.float32)) & ~own)
    score = np.einsum("nd,nd->n", rows[c], queries[q])
    order = np.lexsort((ids[c], -score, q))
    q, c, score = q[order], c[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < k
    return q[keep], ids[c[keep]], score[keep]


def _search(k: int):
    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for n in range(part.num_rows):
                held, asked = part.column("rows")[n].values, part.column("queries")[n].values
                codes = np.frombuffer(b"".join(held.field("code").to_pylist()), np.uint8).reshape(len(held), -1)
                rows, queries = _matrix(held.field("embedding")), _matrix(asked.field("embedding"))
                ids, qids = held.field("vec_id").to_numpy(), asked.field("vec_id").to_numpy()
                fit, length = (held.field(c).to_numpy() for c in ("fit", "length"))
                for at in range(0, len(qids), 256):  # bounds the matrices in memory
                    some = slice(at, at + 256)
                    q, found, score = _best(ids, rows, codes, fit, length, qids[some], queries[some], k)
                    yield pa.RecordBatch.from_arrays([pa.array(qids[some][q]), pa.array(found), pa.array(score)], schema=FOUND)

    return search


def search(index: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` nearest of each query by inner product: ``query_id, rank, vec_id, score``.

    ``queries`` are rows of the index (``vec_id, embedding, dim``). A query's own
    row is no candidate, and vectors of another length are none. Equal scores are
    ranked by smaller ``vec_id``. A query without candidates has no rows; an empty
    index gives an empty table.
    """
    row = F.struct("vec_id", "embedding", "code", "fit", "length")
    sizes = index.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / CANDIDATE_BLOCK).cast("int").alias("blocks"))
    held = index.join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))
    held = held.groupBy("dim", "block").agg(F.collect_list(row).alias("rows"))
    parts = queries.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("parts"))
    asked = queries.join(parts, "dim").withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("parts")))
    asked = asked.groupBy("dim", "part").agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries"))
    # Each block of queries is sent to each block of candidates.
    asked = asked.join(sizes, "dim").select("dim", "queries", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    # Blocks are few and heavy: a fixed width keeps small partitions from being merged into one task.
    width = max(8, 2 * index.sparkSession.sparkContext.defaultParallelism)
    met = held.repartition(width, "dim", "block").join(asked.repartition(width, "dim", "block"), ["dim", "block"])
    found = met.select("rows", "queries").mapInArrow(_search(k), "query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """Search with the rows whose ``vec_id`` is divisible by ``every`` against all rows."""
    index = settle(build_index(vectors), "codes")
    return search(index, index.where(F.col("vec_id") % every == 0).select("vec_id", "embedding", "dim"), k)
