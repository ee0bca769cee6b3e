"""Tokens, packing and SimHash against brute force, over odd documents."""

from __future__ import annotations

import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clicktide.llm import packing, queries, sentence_pieces, simhash, token_counts
from clicktide.llm.token_ids import TokenIds
from clicktide.session import scratch_path
from llm.edge_tables import DOCUMENTS, ROWS, documents, key_order, with_clashes

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    near, far = list("  \n\t''_ab1s.,!\"treé"), [chr(c) for c in (*range(1, 0x250), *range(0x300, 0x320), *range(0x2000, 0x2070), 0x3000, 0x1F600)]
    texts = ["".join(rng.choice(near if rng.random() < 0.7 else far) for _ in range(rng.randrange(40))) for _ in range(n)]
    return texts + ["a <|endoftext|> b", "x  <|startoftext|>y", "<|endoftext|>", "it's 'tis don''t _a_b 3's"]


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_are_those_of_the_library(path):
    library, mine, texts = Tokenizer.from_file(path), TokenIds(path), odd_texts(1, 1500)
    assert mine.cut is not None
    for text, ids in zip(texts, mine(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_common_words_are_encoded_once_however_many_others_pass(path):
    class Noting:
        def __init__(self, model):
            self.model, self.given = model, []

        def encode_batch(self, texts, **kinds):
            self.given += [w for t in texts for w in ([t] if isinstance(t, str) else t)]
            return self.model.encode_batch(texts, **kinds)

        def encode_batch_fast(self, texts, **kinds):
            self.given += texts
            return self.model.encode_batch_fast(texts, **kinds)

    mine = TokenIds(path, remembered=100)
    library, mine.model = mine.model, Noting(mine.model)
    texts = [" ".join(["often", *(f"w{n}é{k}" for k in range(30)), "often"]) for n in range(200)]
    assert mine(texts, at_once=1) == [np.array(library.encode(t).ids, "<u4").tobytes() for t in texts]
    assert sum(w.strip() == "often" for w in mine.model.given) <= 2
    assert len(mine.seen) + len(mine.before) <= 100 + 2 * 33


def test_sentence_pieces_are_those_of_the_library():
    library, mine = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.Pieces(PIECES)
    texts = [t.replace("\x00", "") for t in odd_texts(2, 800)] + ["a" * 300, "    " * 9 + "x", "floccinaucinihilipilification 1234567890 ====----"]
    for text, ids in zip(texts, mine.encode(texts), strict=True):
        want = library.encode(text)
        assert np.frombuffer(ids, "<i4").tolist() == want, text
        assert mine.decode(want) == library.decode(want)


def long_words(size: int) -> list[str]:
    """Words that no white space cuts: random letters, code, and repetitions of several lengths."""
    rng = random.Random(3)
    base = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(size))
    stems = ["in", "ter", "nation", "al", "isation", "the", "e", "s", "日本", "é"]
    made = "".join(rng.choice(stems) for _ in range(size // 4))
    return [base, made, *("".join(w * (size // len(w) + 1)) for w in ("a", "=", "abc", "internal", "thethes", "xyzzy" * 7 + "q"))]


def test_pieces_of_long_words_are_those_of_the_library():
    library, mine = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.Pieces(PIECES)
    texts = [w for size in (700, 1200, 5000) for w in long_words(size)]
    for text, ids in zip(texts, mine.encode(texts), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(text), text[:40]


def test_a_very_long_word_takes_seconds():
    library, mine = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.Pieces(PIECES)
    text = long_words(200_000)[0]
    began = time.monotonic()
    ids = mine.encode([text])[0]
    assert time.monotonic() - began < 30
    assert np.frombuffer(ids, "<i4").tolist() == library.encode(text)


def test_spans_that_do_not_agree_go_on_letter_by_letter(monkeypatch):
    """Spans that overlap by one longest piece hardly ever agree for so long; the result is still the library's."""
    library, mine = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.Pieces(PIECES)
    monkeypatch.setattr(sentence_pieces, "OVERLAP", 1)
    went_on, go_on = [], mine._go_on
    monkeypatch.setattr(mine, "_go_on", lambda *a: went_on.append(1) or go_on(*a))
    texts = long_words(1500)
    for text, ids in zip(texts, mine.encode(texts), strict=True):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(text), text[:40]
    assert went_on


def test_token_counts(spark):
    cache = scratch_path(spark, "cache")
    library = Tokenizer.from_file(WORDS)
    want = [
        (i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048) for i, t, *_ in ROWS
    ]
    docs = with_clashes(documents(spark))
    for _ in range(2):
        got = token_counts.token_counts(docs, WORDS, cache, normalise=token_counts.without_extra_space)
        assert key_order(map(tuple, got.collect())) == key_order(want)
    stored = spark.read.parquet(f"{cache}/version={token_counts.tokenizer_version(WORDS)}")
    assert stored.count() == stored.select("digest").distinct().count() == 8  # each distinct text once, none in the second run
    more = documents(spark, [(11, "One two three four five six.", "", "", 1), (12, "new words", "", "", 1)])
    assert token_counts.token_counts(more, WORDS, cache, normalise=token_counts.without_extra_space).count() == 2
    assert spark.read.parquet(f"{cache}/version={token_counts.tokenizer_version(WORDS)}").count() == 9
    assert token_counts.token_counts(documents(spark, []), WORDS, scratch_path(spark, "cache")).count() == 0


def test_sentence_piece_round_trip(spark):
    docs = with_clashes(documents(spark))
    encoded = sentence_pieces.encode(docs, PIECES)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert key_order((r.doc_id, list(r.ids)) for r in encoded.collect()) == key_order((i, library.encode(t or "")) for i, t, *_ in ROWS)
    texts = sentence_pieces.decode(encoded, PIECES)
    assert key_order(map(tuple, texts.collect())) == key_order((i, t or "") for i, t, *_ in ROWS)
    digests = sentence_pieces.digest(encoded, PIECES).collect()
    assert key_order((r.doc_id, r.text_crc32) for r in digests) == key_order((i, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)
    assert sentence_pieces.encode(documents(spark, []), PIECES).count() == 0


def check_packing(rows, texts, size=2048):
    library = Tokenizer.from_file(BYTES)
    want = []
    for doc, text in texts:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = (len(ids) - 1) % size + 1
        cuts = [0, *range(first, len(ids) + 1, size)]
        want += [(doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    assert key_order((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == key_order(want)
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by), sum(r.length for r in rows)


def test_packing(spark):
    docs = with_clashes(documents(spark))
    check_packing(packing.pack(docs, BYTES).collect(), [r[:2] for r in ROWS])
    assert packing.pack(documents(spark, []), BYTES).count() == 0


def test_packing_merges_what_tasks_left(spark, monkeypatch):
    """Many tasks with few pieces each, several rounds: no more sequences than needed."""
    rng = random.Random(4)
    texts = [(i, "word " * rng.randrange(1, 60)) for i in range(300)]
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in texts], DOCUMENTS).repartition(24)
    monkeypatch.setattr(packing, "ITEMS_PER_TASK", 8)
    used, tokens = check_packing(packing.pack(docs, BYTES, 64).collect(), texts, 64)
    assert used <= 1.1 * -(-tokens // 64)


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, filled = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert filled.tolist() == [10, 10] and bins.tolist() == [0, 1, 0, 1, 1] and offsets.tolist() == [0, 0, 6, 5, 8]


def brute_print(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints: list[int], ids: list, bits: int) -> list:
    group = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [min((d for d, g in zip(ids, group, strict=True) if g == mine and d is not None), default=None) for mine in group]


def test_simhash(spark):
    got = simhash.near_duplicates(with_clashes(documents(spark))).collect()
    prints, ids = [brute_print(r[1]) for r in ROWS], [r[0] for r in ROWS]
    want = zip(ids, prints, brute_groups(prints, ids, 3), strict=True)
    assert key_order((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == key_order(want)
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize(("bits", "segments"), [(3, 2), (3, 3), (3, 4), (2, 2), (5, 3)])
def test_hamming_links_lose_none(spark, bits, segments):
    rng = random.Random(bits * 10 + segments)
    prints = {rng.getrandbits(64) for _ in range(20)}
    for p in list(prints):
        for _ in range(12):
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 4)))
            prints.add(p)
    signed = [(p - 2**64 if p >> 63 else p,) for p in prints]
    got = simhash.hamming_links(spark.createDataFrame(signed, "fp long"), bits, segments).collect()
    want = {(a, b) for (a,) in signed for (b,) in signed if a < b and ((a ^ b) % 2**64).bit_count() <= bits}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_one_of_each_group_stays(spark):
    docs = with_clashes(documents(spark))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = key_order(r.doc_id for r in kept.collect())
    assert ids == key_order([1, 3, 6, 8, 10, None])  # 7 has the words of 1; 4, 5 and one bare row are empty like 3
    assert simhash.keep_one(documents(spark, [])).count() == 0


def test_fingerprints_are_made_once_where_texts_move(spark):
    docs = documents(spark, [(i, f"word{i} of a text", "en", "s", 1) for i in range(20)])
    plan = simhash.keep_one(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # a second one is a second Python worker in every task


def test_one_id_in_two_groups_stays_in_both(spark):
    one, other = "a b c d e f g h i", "entirely different words stand in this text here"
    rows = [(5, one), (5, other), (9, other.upper()), (7, one.upper())]
    kept = simhash.keep_one(documents(spark, [(i, t, "en", "s", 1) for i, t in rows]))
    assert key_order((r.doc_id, r.text) for r in kept.collect()) == key_order([(5, one), (5, other)])


def test_queries_over_a_folder(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("op2_token_counts", "op3_sentence_pieces", "op7_licenses", "op9_simhash"):
        assert queries.queries()[name](spark, str(tmp_path)).count() == len(ROWS), name
    prints = queries.op9_simhash(spark, str(tmp_path)).where(F.col("doc_id") == 3).first()
    assert prints.fingerprint == "0" * 16
