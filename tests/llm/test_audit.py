"""Line dedup, source divergence and Merkle manifests against brute force, over odd documents."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import difference
from clicktide.llm import audit_sql, divergence, line_dedup, merkle
from llm.edge_tables import DOCUMENTS, ROWS, documents, key_order, with_clashes


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


# Lines


def line_rows(seed: int, docs: int) -> list[tuple]:
    rng = random.Random(seed)
    pool = ["Share this", " share THIS\t", "é ½", "É ½", "", "x", "All rights reserved.", "\x0bnext page\r", "\xa0next page", "日本"]
    rows = []
    for i in range(docs):
        lines = [rng.choice(pool) if rng.random() < 0.4 else f"line {rng.randrange(10 * docs)}" for _ in range(rng.randrange(6))]
        rows.append((None if i % 17 == 0 else i // 2 if i % 5 == 0 else i, "\n".join(lines), "en", "s", 0))
    return rows


def key_of(line: str) -> str:
    return lower(line.strip(" \t\n\x0b\x0c\r"))


def without_repeats(rows, least_docs, least_chars, keep):
    texts = [(i, (t or "").split("\n")) for i, t, *_ in rows]
    docs = Counter(k for _, lines in texts for k in {key_of(x) for x in lines} if len(k) >= max(1, least_chars))
    often = {k for k, n in docs.items() if n >= least_docs}
    first = {}
    for i, lines in texts:
        for at, x in enumerate(lines):
            place = (i is None, i if i is not None else 0, at)
            if (k := key_of(x)) in often and (k not in first or place < first[k]):
                first[k] = place
    out = []
    for i, lines in texts:
        mine = [x for at, x in enumerate(lines) if key_of(x) not in often or keep == "first" and first[key_of(x)] == (i is None, i if i is not None else 0, at)]
        out.append((i, "\n".join(mine), len(lines), len(lines) - len(mine)))
    return key_order(out)


@pytest.mark.parametrize("least_docs, least_chars, keep", [(10, 1, "none"), (2, 3, "none"), (4, 0, "first"), (2, 2, "first")])
def test_repeated_lines_go(spark, least_docs, least_chars, keep):
    rows = line_rows(least_docs, 240) + ROWS
    docs = with_clashes(documents(spark, rows)).repartition(7)
    got = line_dedup.drop_repeated_lines(docs, least_docs, least_chars, keep)
    assert key_order(map(tuple, got.collect())) == without_repeats(rows, least_docs, least_chars, keep)


def test_a_saturated_filter_changes_nothing(spark):
    rows = line_rows(5, 3000) + ROWS
    got = line_dedup.drop_repeated_lines(documents(spark, rows).repartition(5), 3, 1, "none", most_bits=line_dedup.SEGMENT)
    assert key_order(map(tuple, got.collect())) == without_repeats(rows, 3, 1, "none")


def test_no_documents_no_lines(spark):
    assert line_dedup.drop_repeated_lines(documents(spark, [])).collect() == []
    with pytest.raises(ValueError):
        line_dedup.drop_repeated_lines(documents(spark, []), keep="last")
    with pytest.raises(ValueError):
        line_dedup.drop_repeated_lines(documents(spark, []), least_docs=1)


def test_line_sql(spark):
    rows = line_rows(3, 200) + ROWS
    con = duckdb.connect()
    documents = spark.createDataFrame(rows, DOCUMENTS).toPandas()  # noqa: F841 - read by name
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    got = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, DOCUMENTS)).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
    assert difference(got.toPandas(), con.sql(audit_sql.LINES).df()) is None


def test_filters_find_what_is_there_twice():
    rng = np.random.default_rng(1)
    lines = rng.integers(0, 1 << 63, 40_000, dtype=np.uint64)
    bits = line_dedup.filter_bits(len(lines))
    assert bits == 1 << 20 and line_dedup.filter_bits(0) == line_dedup.SEGMENT and line_dedup.filter_bits(10**12) == line_dedup.MOST_BITS
    pairs = []
    for part in (lines[:20_000], np.concatenate([lines[20_000:], lines[:500]])):
        once, twice = line_dedup.Bloom(bits), line_dedup.Bloom(bits)
        twice.add(part[once.has(part)])
        once.add(part)
        pairs.append((once.packed, twice.packed))
    both = line_dedup.Bloom(bits, pairs[0][1] | pairs[1][1] | (pairs[0][0] & pairs[1][0]))
    assert both.has(lines[:500]).all()
    assert both.has(lines[500:]).mean() < 0.03
    assert not both.has(np.zeros(0, np.uint64)).any()


def test_only_suspects_are_passed_on(spark):
    """Lines that stand alone leave their task only by a coincidence in the filter."""
    rows = [(i, f"own line {i}\nshared {i % 50}", "en", "s", 0) for i in range(4000)]
    texts = documents(spark, rows).repartition(6).select("doc_id", F.col("text").cast("binary").alias("text"))
    twice = line_dedup.twice_seen(texts, line_dedup.filter_bits(8000), 1)
    passed = line_dedup._suspects(texts, lambda: twice, 1).select(F.explode("digests").alias("d")).collect()
    shared = {hashlib.sha256(f"shared {k}".encode()).digest() for k in range(50)}
    found = {bytes(r["d"]) for r in passed}
    assert shared <= found and len(found) < 50 + 4000 * 0.05


# Divergence


def brute_divergence(rows, least_docs, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t or ""))) for _, t, lang, source, _ in rows]
    out = []
    for lang in sorted({d[0] for d in docs}):
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, terms in mine for t in set(terms))
        kept = sorted(t for t, n in seen.items() if n >= least_docs)
        groups = defaultdict(Counter)
        for _, source, terms in mine:
            groups[source].update(t for t in terms if seen[t] >= least_docs)
        every = sum(groups.values(), Counter())

        def share(counts):
            over = sum(counts.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // over for t in kept}

        p, q = {s: share(c) for s, c in groups.items()}, share(every)
        for source, own in p.items():
            pairs = [(other, sum(abs(own[t] - its[t]) for t in kept)) for other, its in p.items() if other != source]
            terms = [(t, own[t] - q[t]) for t in kept if groups[source][t] and own[t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ordered) if part == "pair" or k < top]
    return sorted(out)


def corpus(seed: int, docs: int, sources: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [a + b for a in ("ka", "É", "日", "zo", "Qu") for b in ("", "ra", "ß", "li", "mO", "x")]
    rows = []
    for i in range(docs):
        source = rng.randrange(sources) if i % 3 else 0
        words = rng.choices(vocabulary, [1 + (k * (source + 1)) % 7 for k in range(len(vocabulary))], k=rng.randrange(30))
        rows.append((i, rng.choice([" ", "-", "1", "\x7f"]).join(words), rng.choice(["en", "de", None]), None if source == 3 else f"s{source}", 0))
    return rows


@pytest.mark.parametrize("least_docs, sources, width, block", [(30, 4, 1 << 15, 32), (5, 9, 7, 2), (1, 3, 4, 2), (10**6, 3, 8, 2)])
def test_divergence_is_that_of_brute_force(spark, monkeypatch, least_docs, sources, width, block):
    """Also with many slices and blocks, and without any kept term."""
    monkeypatch.setattr(divergence, "SLICE", width)
    monkeypatch.setattr(divergence, "BLOCK", block)
    rows = corpus(sources, 400, sources) + ROWS + [(1, "", "en", "silent", 0), (2, "Alone", "xx", "only", 0)]
    got = divergence.divergence(with_clashes(documents(spark, rows)).repartition(5), least_docs, 12)
    assert sorted(map(tuple, got.collect())) == brute_divergence(rows, least_docs, 12)


def test_divergence_of_nothing(spark):
    assert divergence.divergence(documents(spark, [])).collect() == []


def test_prices_are_exact():
    rng = random.Random(2)
    for _ in range(300):
        total, terms = rng.randrange(10 ** rng.randrange(1, 15)), rng.randrange(1, 10**6)
        counts = np.array([0, total, rng.randrange(total + 1)], np.int64)
        over = total + 5 * terms
        assert divergence.prices(counts, over).tolist() == [1 + 10**9 * (int(c) + 5) // over for c in counts]


def test_gallop_intersects():
    rng = np.random.default_rng(4)
    for few, many in ((0, 0), (0, 5), (3, 0), (5, 900), (400, 420)):
        a, b = (np.unique(rng.integers(0, 1000, n)).astype(np.int32) for n in (few, many))
        in_a, in_b = divergence.gallop(a, b)
        assert a[in_a].tolist() == b[in_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


# Manifest


def part(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root of a list, and for every leaf what stands left and right of it, level by level."""
    paths, under = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        above, over = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for slot in range(len(run)):
                for leaf in under[at + slot]:
                    paths[leaf].append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            above.append(sha("".join(run)))
            over.append([x for k in range(len(run)) for x in under[at + k]])
        nodes, under = above, over
    return nodes[0], paths


def brute_manifest(rows, fanout):
    def leaf(row, text):
        i, _, lang, source, n = row
        return sha("".join(map(part, (i, source, lang, n, text))))

    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = climb([x[2] for x in groups[name]], fanout)
    root, over = climb([trees[n][0] for n in names], fanout) if names else ("", [])
    out = []
    for name, above in zip(names, over):
        for (*_, own, row), path in zip(groups[name], trees[name][1]):
            path = path + above
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded = leaf(row, lower(row[1]) if row[1] is not None else None) if hit else own
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((row[0], own, trees[name][0], root, sha("".join(a + b for a, b in path)), folded, folded == root))
    return key_order(out)


def tree_rows(seed: int, docs: int) -> list[tuple]:
    rng = random.Random(seed)
    sources = [None, "", "a", "B", "é", "日", "~"] + [f"s{k}" for k in range(20)]
    return [
        (rng.choice([None, rng.randrange(docs)]), rng.choice([None, "", "Ab", f"Text {k}"]), "en", "a" if k % 3 else rng.choice(sources), rng.choice([None, k]))
        for k in range(docs)
    ]


@pytest.mark.parametrize("fanout, docs", [(16, 900), (2, 70), (3, 200), (16, 1)])
def test_manifest_is_that_of_brute_force(spark, fanout, docs):
    rows = tree_rows(fanout, docs) + (ROWS if docs > 1 else [])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.audit(with_clashes(documents(spark, rows)).repartition(6), tampered, fanout)
    assert key_order(map(tuple, got.collect())) == brute_manifest(rows, fanout)


def test_manifest_of_nothing_and_of_one_child(spark):
    never = F.lit(False)
    assert merkle.audit(documents(spark, []), never).collect() == []
    rows = [(k, f"t{k}", "en", "a", k) for k in range(17)]  # the last run is a single node
    found = merkle.audit(documents(spark, rows), never).collect()
    assert key_order(map(tuple, found)) == key_order((*r[:5], r[3], True) for r in brute_manifest(rows, 16))
    with pytest.raises(ValueError):
        merkle.audit(documents(spark, rows), never, fanout=1)


def test_any_change_is_found(spark):
    rows = [(k, f"text {k}", "en", f"s{k % 3}", k) for k in range(60)]
    before = merkle.audit(documents(spark, rows), F.lit(False)).select("root").distinct().collect()
    for change in ((7, "text 8", "en", "s1", 7), (7, "text 7", None, "s1", 7)):
        after = merkle.audit(documents(spark, rows[:7] + [change] + rows[8:]), F.lit(False)).select("root").distinct().collect()
        assert len(after) == 1 and after != before


def test_manifest_sql(spark):
    rows = tree_rows(5, 300)
    con = duckdb.connect()
    documents = spark.createDataFrame(rows, DOCUMENTS).toPandas()  # noqa: F841 - read by name
    documents[["doc_id", "n_chars"]] = documents[["doc_id", "n_chars"]].astype("Int64")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    got = merkle.audit(spark.createDataFrame(rows, DOCUMENTS), tampered)
    assert difference(got.toPandas(), con.sql(audit_sql.manifest()).df()) is None
