"""SentencePiece encoding and decoding by a batched Viterbi in numpy.

Texts are cut into words that no piece spans. New words are grouped by length and
advance together: at each position the substrings that end there are hashed from
prefix sums and looked up in the sorted hashes of the pieces, and a vectorised
maximum over the candidates stores a backpointer for every word.

For a unigram model the maximum is over sums of scores. The pieces of a BPE model
follow from merges, which no sum of scores reproduces. There, every prefix of a
word has exactly one last piece: the one which, after the last piece of the prefix
before it, is left as it is when the two are merged from letters. So candidates
are admitted by that test (remembered per pair), and the longest admitted one is
the backpointer. That piece depends on the last pieces of a few prefixes before it
only, so a very long word is cut into overlapping spans of equal length that
advance together; a span holds from where it has agreed with the one before it for
as many positions as the longest piece has letters.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import batches, ready, text_of

BLANK = "▁"
REMEMBERED = 300_000
LETTERS_AT_ONCE = 4_000_000
# Spans of a long word begin this many longest pieces or so apart, and overlap by so many.
APART, OVERLAP = 15, 4
# Two odd bases; both hashes must agree.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
NONE = np.int64(-1)
# Ids from here on stand for letters without a piece: UNKNOWN + code point.
UNKNOWN = 1 << 24


def cutter(texts: list[str]) -> re.Pattern:
    """Words that no piece spans: a blank begins one, and letters or digits end one before any other character.

    Letters and digits that some piece joins to such a character do not count as ones.
    """
    joined = {a for t in texts for a, b in zip(t, t[1:], strict=False) if a.isalnum() and not b.isalnum() and b != BLANK}
    odd = re.escape("".join(sorted(joined | {"_"})))
    other = f"(?:[^\\w{BLANK}]|[{odd}])"
    return re.compile(f"{BLANK}*{other}*[^\\W{odd}]+|{BLANK}*{other}+|{BLANK}+")


class Pieces:
    """A model's pieces, and encoding and decoding with them."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        with open(path, "rb") as file:
            spec.ParseFromString(file.read())
        norm = spec.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models without text normalisation are supported")
        if spec.trainer_spec.treat_whitespace_as_suffix or spec.trainer_spec.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models with blanks before words are supported")
        self.unigram = spec.trainer_spec.model_type == 1
        self.dummy = norm.add_dummy_prefix
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(model.get_piece_size())]
        self.text = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        normal = [i for i, s in enumerate(special) if not s]
        if any(re.search(f"[^{BLANK}]{BLANK}", self.text[i]) for i in normal):
            raise ValueError("a piece spans two words")
        self.cut = cutter([self.text[i] for i in normal])
        self.unknown = model.unk_id()
        self.score = np.array([model.get_score(i) for i in range(len(special))])
        self.rank = {self.text[i]: float(self.score[i]) for i in normal}
        self.id_of = {self.text[i]: i for i in normal}
        self.byte = [model.piece_to_id(f"<0x{b:02X}>") if spec.trainer_spec.byte_fallback else self.unknown for b in range(256)]
        self.longest = max((len(t) for t in self.rank), default=1)
        self.unknown_score = float(self.score[normal].min()) - 10.0 if normal else -10.0
        self._sort(normal)
        self.fits: dict[int, bool] = {}
        self.seen: dict[str, bytes] = {}
        # Bytes of each piece; control pieces stand for nothing.
        self.raw = [b"" if model.is_control(i) else t.replace(BLANK, " ").encode() for i, t in enumerate(self.text)]
        for b, i in enumerate(self.byte):
            if i != self.unknown:
                self.raw[i] = bytes([b])
        self.raw[self.unknown] = " ⁇ ".encode()

    def _sort(self, normal: list[int]) -> None:
        """Both hashes of every piece, sorted by the first."""
        hashes = []
        for base in BASES:
            with np.errstate(over="ignore"):
                found = []
                for i in normal:
                    h = np.uint64(0)
                    for c in self.text[i]:
                        h = h * base + np.uint64(ord(c) + 1)
                    found.append(h)
            hashes.append(np.array(found, np.uint64))
        order = np.argsort(hashes[0])
        self.keys, self.second = hashes[0][order], hashes[1][order]
        self.key_id = np.array(normal, np.int64)[order]
        with np.errstate(over="ignore"):
            self.powers = [np.cumprod(np.r_[np.uint64(1), np.full(self.longest, base)], dtype=np.uint64) for base in BASES]

    # --- words of one length ------------------------------------------------------

    def _lookup(self, sums: list[np.ndarray], start: int, end: int) -> np.ndarray:
        """Piece of the substring of each word, or NONE."""
        with np.errstate(over="ignore"):
            first, second = (s[:, end] - s[:, start] * p[end - start] for s, p in zip(sums, self.powers, strict=True))
        at = np.minimum(np.searchsorted(self.keys, first), len(self.keys) - 1)
        hit = (self.keys[at] == first) & (self.second[at] == second)
        return np.where(hit, self.key_id[at], NONE)

    def _advance(self, words: list[str], size: int, known: np.ndarray | None = None) -> np.ndarray:
        """Start of the last piece at each end position of each word; ``known`` holds the last pieces of the first positions."""
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), size)
        sums = []
        with np.errstate(over="ignore"):
            for base in BASES:
                sums.append(np.zeros((len(words), size + 1), np.uint64))
                for j in range(size):
                    sums[-1][:, j + 1] = sums[-1][:, j] * base + letters[:, j] + np.uint64(1)
        last = np.full((len(words), size + 1), NONE)
        back = np.zeros((len(words), size + 1), np.int64)
        best = np.full((len(words), size + 1), -np.inf)
        best[:, 0] = 0.0
        rows = np.arange(len(words))
        first = 1
        if known is not None:
            first = known.shape[1]
            last[:, :first] = known
        for end in range(first, size + 1):
            starts = list(range(max(0, end - self.longest), end))  # longest first
            ids = np.stack([self._lookup(sums, s, end) for s in starts])
            alone = ids[-1] == NONE
            ids[-1] = np.where(alone, UNKNOWN + letters[:, end - 1].astype(np.int64), ids[-1])
            if self.unigram:
                worth = np.where(ids >= UNKNOWN, self.unknown_score, self.score[np.where(ids < 0, 0, np.minimum(ids, len(self.score) - 1))])
                sums_to = np.where(ids == NONE, -np.inf, worth + best[:, starts].T)
            else:
                fits = self._admitted(ids, last[:, starts].T)
                sums_to = np.where(fits, np.arange(len(starts), 0, -1)[:, None], -np.inf)
            chosen = sums_to.argmax(axis=0)
            best[:, end] = sums_to[chosen, rows]
            back[:, end] = np.array(starts)[chosen]
            last[:, end] = ids[chosen, rows]
        self._last = last
        return back

    def _admitted(self, ids: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Which candidates (rows, longest first) may end each word's prefix; the first admitted one is the only one."""
        out = np.zeros(ids.shape, bool)
        open_ = np.ones(ids.shape[1], bool)
        for k in range(len(ids)):
            rows = np.nonzero(open_ & (ids[k] != NONE))[0]
            if not len(rows):
                continue
            if k == len(ids) - 1:  # some piece must end here: it is the last one left
                out[k, rows] = True
                break
            pairs = (before[k, rows] + 1) << 25 | ids[k, rows]
            unique, which = np.unique(pairs, return_inverse=True)
            fits = np.array([self._fits(int(p)) for p in unique])[which]
            out[k, rows] = fits
            open_[rows[fits]] = False
        return out

    def _fits(self, pair: int) -> bool:
        """Whether merging the letters of two pieces gives these two pieces (of one: this piece)."""
        if pair not in self.fits:
            if len(self.fits) > 4 * REMEMBERED:
                self.fits.clear()
            before, after = (pair >> 25) - 1, pair & ((1 << 25) - 1)
            want = [self._spelled(i) for i in (before, after) if i >= 0]
            self.fits[pair] = self.merge("".join(want)) == want
        return self.fits[pair]

    def _spelled(self, i: int) -> str:
        return chr(i - UNKNOWN) if i >= UNKNOWN else self.text[i]

    def merge(self, word: str) -> list[str]:
        """Pieces of a short word by merges: the best-scored neighbours first, the leftmost of equals."""
        parts = list(word)
        while len(parts) > 1:
            scores = [self.rank.get(a + b, -np.inf) for a, b in zip(parts, parts[1:], strict=False)]
            top = max(scores)
            if top == -np.inf:
                break
            at = scores.index(top)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _learn(self, words: list[str]) -> None:
        """Encode new words, those of one length together."""
        by_size: dict[int, list[str]] = {}
        for w in words:
            by_size.setdefault(len(w), []).append(w)
        for size, group in by_size.items():
            if not self.unigram and size > 2 * (APART + OVERLAP) * self.longest:
                for word in group:
                    self.seen[word] = np.array(self._walk(self._in_spans(word)), "<i4").tobytes()
                continue
            # About a million letters at a time bound the matrices in memory.
            step = max(1, 1_000_000 // (size * min(size, self.longest)))
            for at in range(0, len(group), step):
                some = group[at : at + step]
                back = self._advance(some, size)
                for r, word in enumerate(some):
                    ids: list[int] = []
                    end = size
                    while end:
                        i = int(self._last[r, end])
                        ids += [i] if i < UNKNOWN else [self.byte[b] for b in reversed(chr(i - UNKNOWN).encode("utf-8", "replace"))]
                        end = int(back[r, end])
                    self.seen[word] = np.array(ids[::-1], "<i4").tobytes()

    def _in_spans(self, word: str) -> np.ndarray:
        """Last piece of every prefix of one long word, from spans that advance together."""
        shared, n = OVERLAP * self.longest, len(word)
        # A multiple of many small numbers, so that repeated letters meet pieces in step.
        apart = -(-APART * self.longest // 240) * 240
        size = apart + shared
        starts = [*range(0, n - size, apart), n - size]
        last = np.full(n + 1, NONE)
        done = 0
        step = max(1, 1_000_000 // (size * self.longest))
        for at in range(0, len(starts), step):
            some = starts[at : at + step]
            self._advance([word[s : s + size] for s in some], size)
            for s, span in zip(some, self._last, strict=True):
                if not s:
                    last[: size + 1] = span
                else:
                    differ = np.nonzero(last[s + 1 : done + 1] != span[1 : done - s + 1])[0]
                    # Ends of the runs of agreement before each difference, and of the one before the end.
                    stops = np.r_[differ, done - s]
                    runs = np.diff(np.r_[-1, stops]) - 1
                    enough = np.nonzero(runs >= self.longest)[0]
                    if len(enough):
                        here = int(stops[enough[-1]])
                        last[s + here + 1 : s + size + 1] = span[here + 1 :]
                    else:
                        last[done + 1 : s + size + 1] = self._go_on(word[: s + size], last, done)
                done = s + size
        return last

    def _go_on(self, word: str, last: np.ndarray, done: int) -> np.ndarray:
        """Last pieces after position ``done``, one letter after the other."""
        start = done - 2 * self.longest
        kept = self._last
        self._advance([word[start:]], len(word) - start, last[None, start : done + 1])
        found, self._last = self._last[0, done - start + 1 :], kept
        return found

    def _walk(self, last: np.ndarray) -> list[int]:
        """Ids of one word from the last piece of each of its prefixes."""
        ids: list[int] = []
        end = len(last) - 1
        while end:
            i = int(last[end])
            ids += [i] if i < UNKNOWN else [self.byte[b] for b in reversed(chr(i - UNKNOWN).encode("utf-8", "replace"))]
            end -= 1 if i >= UNKNOWN else len(self.text[i])
        return ids[::-1]

    # --- texts --------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out: list[bytes] = []
        start = size = 0
        for end, text in enumerate(texts, 1):
            size += len(text)
            # Many texts at a time make large groups of new words.
            if size >= LETTERS_AT_ONCE or end == len(texts):
                out += self._some(texts[start:end])
                start, size = end, 0
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        cut = [self.cut.findall((BLANK if self.dummy and t else "") + t.replace(" ", BLANK)) for t in texts]
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        self._learn(list(set().union(*cut) - self.seen.keys()))
        return [b"".join(map(self.seen.__getitem__, words)) for words in cut]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes that are not UTF-8 become U+FFFD, the blank put before the text goes."""
        raw = b"".join([self.raw[i] for i in ids])
        return (raw[1:] if self.dummy and raw[:1] == b" " else raw).decode("utf-8", "replace")


@cache
def pieces(path: str) -> Pieces:
    """One model per worker process and file."""
    return Pieces(path)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Ids of every whole text: ``doc_id, ids``.

    Ids are those of the sentencepiece library. Every input row gives one row,
    repeated rows and NULL ids too; NULL and empty texts have no ids. Columns other
    than ``doc_id`` and ``text`` are not looked at.
    """
    ready(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        model = pieces(path)
        for part in parts:
            texts = part.column("text").to_pylist()
            for at in range(0, len(texts), 2048):
                found = [np.frombuffer(i, "<i4") for i in model.encode(texts[at : at + 2048])]
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                yield {"doc_id": part.column("doc_id").slice(at, 2048), "ids": ids}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(lambda parts: batches(work(parts), schema), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Texts of ids: ``doc_id, text``; NULL ids give the empty text."""
    ready(encoded.sparkSession)

    @F.pandas_udf("string")
    def work(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = pieces(path)
        for part in rows:
            yield pd.Series(["" if r is None else model.decode(list(r)) for r in part], dtype="object")

    return encoded.select("doc_id", work("ids").alias("text"))


def digest(encoded: DataFrame, path: str) -> DataFrame:
    """Number and CRC-32 of each row's ids, and that of its decoded text: ``doc_id, n_ids, ids_crc32, text_crc32``."""
    ready(encoded.sparkSession)

    @F.pandas_udf("n_ids long, ids_crc32 long, text_crc32 long")
    def work(rows: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = pieces(path)
        for part in rows:
            found = [(len(r), zlib.crc32(np.asarray(r, "<i4").tobytes()), zlib.crc32(model.decode(list(r)).encode())) for r in part]
            yield pd.DataFrame(found, columns=["n_ids", "ids_crc32", "text_crc32"], dtype="int64")

    return encoded.select("doc_id", work("ids").alias("d")).select("doc_id", "d.*")
