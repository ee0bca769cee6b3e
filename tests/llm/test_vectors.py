"""Vector operators against brute force, over odd vectors."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clicktide.llm import ann, embed_dedup, queries
from clicktide.llm.components import components
from llm.edge_tables import key_order, with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed: int = 0, n: int = 400, dim: int = 24) -> list[tuple]:
    """Random vectors, tight groups around some of them, exact copies and scaled ones."""
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, dim))
    for k in range(n // 3):  # a third of all rows lies around one vector
        rows[n - 1 - k] = rows[0] + rng.standard_normal(dim) * 0.08 * (k % 5)
    return [(i, [float(np.float32(x)) for x in v * (1 + i % 3)], i % 3 if i < 50 else 1) for i, v in enumerate(rows)]


ODD = [
    (1001, None, 1),
    (1002, [], 1),
    (1003, [0.0] * 24, 1),
    (1004, [float("nan")] * 24, 1),
    (1005, [float("inf")] + [1.0] * 23, 1),
    (1006, [None] + [1.0] * 23, 1),
    (1007, [1.0, 2.0], 1),
    (1008, [1.0, 2.0], 1),
    (1009, [1.0, 2.0], None),
    (1020, [1.0] * 24, None),
]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute_links(rows, least=0.98):
    ok = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            u = np.array(v, np.float32).astype(float)
            ok[i] = (label, len(v), u / np.linalg.norm(u))
    links = {i: {j for j in ok if j != i and ok[i][:2] == ok[j][:2] and ok[i][2] @ ok[j][2] >= least} for i in ok}
    out = []
    for i, _, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            new = links.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        out.append((i, len(links.get(i, ())), min(seen), min(seen) == i))
    return out


@pytest.mark.parametrize("block", [2048, 32])
def test_embedding_links(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK_ROWS", block)
    monkeypatch.setattr(embed_dedup, "pivot_count", lambda n: 9)
    rows = vectors() + ODD
    got = embed_dedup.near_duplicates(with_clashes(table(spark, rows)).repartition(5))
    assert key_order(map(tuple, got.collect())) == key_order(brute_links(rows))


def test_embedding_links_without_vectors(spark):
    assert embed_dedup.near_duplicates(table(spark, [])).count() == 0
    rows = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1)]
    got = key_order(map(tuple, embed_dedup.near_duplicates(table(spark, rows)).collect()))
    assert got == key_order([(None, 0, None, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)])


def test_embedding_query_equals_sql(spark, tmp_path):
    table(spark, vectors(3, 200)).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.execute(queries.OP10_SQL).fetchall()
    got = queries.op10_embedding_duplicates(spark, str(tmp_path))
    assert key_order(map(tuple, got.collect())) == key_order(want)


def brute_nearest(rows, every, k):
    ok = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in (i for i in ok if i % every == 0):
        scored = sorted((-float(ok[q] @ v), i) for i, v in ok.items() if i != q and len(v) == len(ok[q]))
        out[q] = [(i, -s) for s, i in scored[:k]]
    return out


@pytest.mark.parametrize("block", [4096, 64])
def test_nearest(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "CANDIDATE_BLOCK", block)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 8)
    rows = vectors(5) + ODD
    got: dict[int, list] = {}
    for r in ann.nearest(with_clashes(table(spark, rows)), every=20, k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute_nearest(rows, 20, 20)
    assert set(got) == {q for q, found in want.items() if found}
    hits = total = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, len(want[q]) + 1))
        assert [(-s, i) for _, i, s in found] == sorted((-s, i) for _, i, s in found)
        hits += len({i for _, i, _ in found} & {i for i, _ in want[q]})
        total += len(want[q])
    assert hits / total >= 0.99
    assert ann.nearest(table(spark, [])).count() == 0


def test_estimates_keep_their_bounds():
    rows = np.random.default_rng(1).standard_normal((500, 64))
    codes, fit, length = ann.encode(rows)
    signs = (np.unpackbits(codes, axis=1) * 2.0 - 1) / np.sqrt(ann.code_bits(64))
    queries_ = rows[:50]
    guess = (queries_ @ ann.rotation(64)) @ signs.T * (length / fit)
    margin = np.outer(np.linalg.norm(queries_, axis=1), length * np.sqrt(1 - fit**2) / fit * ann.DEVIATIONS / np.sqrt(ann.code_bits(64) - 1))
    assert (np.abs(guess - queries_ @ rows.T) <= margin).mean() > 0.99


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "x long, y long"), "x", "y").collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert got == want
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def test_plans_have_no_cross_join(spark):
    index = ann.build_index(table(spark, vectors(1, 60)))
    plan = ann.search(index, index.where(F.col("vec_id") % 20 == 0).select("vec_id", "embedding", "dim"))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
