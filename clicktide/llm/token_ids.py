"""Token ids of whole texts by a ``tokenizers`` file, with memory of repeated words.

Byte-level BPE tokenizers split a text before merging and never merge across a
split. Text is therefore cut at places that are always splits, each distinct
piece is encoded once per task by the library, and the results are joined. A text
that holds one of the special strings is encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache
from struct import pack

import numpy as np

# White space as Unicode defines it; Python's \s also has \x1c to \x1f.
SPACE = "\t-\r \x85\xa0  -     　"
# Letters and digits with the blank before them and what apostrophes join to them, the same after an
# apostrophe, other marks with the blank before them, white space but for the blank before a word, other white space.
JOINED = r"[^\W_]+(?:'[^\W_]+)*"
KEPT_SPACE = re.compile(f" ?{JOINED}|'{JOINED}| ?(?:[^\\w{SPACE}]|_)+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# The same for ASCII texts, which need no look at Unicode's classes.
ASCII_JOINED = "[A-Za-z0-9]+(?:'[A-Za-z0-9]+)*"
ASCII_KEPT_SPACE = re.compile(f" ?{ASCII_JOINED}|'{ASCII_JOINED}| ?[^A-Za-z0-9\t-\r ]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
# White space that the tokenizer drops anyhow.
DROPPED_SPACE = re.compile("[^ \t\n\r]+")
# Pieces that a worker keeps in memory, of about 200 bytes each.
REMEMBERED = 300_000


def cutter(spec: dict) -> re.Pattern | None:
    """How texts may be cut for a tokenizer's JSON, or None if no safe way is known."""
    if spec["model"].get("type") != "BPE" or spec["model"].get("dropout") or spec.get("truncation") or spec.get("padding"):
        return None
    if any(t["lstrip"] or t["rstrip"] or t["normalized"] or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
        return None
    before, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and norm is None:
        return KEPT_SPACE
    steps = before.get("pretokenizers") or [{}]
    split = steps[0].get("type") == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
    no_space = split and steps[0]["pattern"].get("Regex", "").endswith(r"|[^\s\p{L}\p{N}]+")
    plain = all(n["type"] in ("NFC", "Lowercase", "Replace") for n in (norm or {}).get("normalizers", []))
    if no_space and plain and not any(s.get("add_prefix_space") for s in steps[1:]):
        return DROPPED_SPACE
    return None


class TokenIds:
    """Encodes texts into little-endian unsigned 32-bit ids without added special tokens."""

    def __init__(self, path: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.cut = cutter(spec)
        self.cut_ascii = ASCII_KEPT_SPACE if self.cut is KEPT_SPACE else self.cut
        names = [re.escape(t["content"]) for t in spec["added_tokens"]]
        self.special = re.compile("|".join(names)) if names else None
        # The words of late, and those of before, which are kept if they are met again.
        self.seen: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [pack(f"<{len(e.ids)}I", *e.ids) for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _apart(self, words: list[str]) -> list[bytes]:
        """Ids of words that never merge with each other, given to the library as one text that is split already."""
        found = self.model.encode_batch([words], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.array(found.ids, "<u4").tobytes()
        ends = (4 * np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(words) + 1))).tolist()
        return [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]

    def __call__(self, texts: list[str], at_once: int = 512) -> list[bytes]:
        out: list[bytes] = []
        for start in range(0, len(texts), at_once):
            out += self._some(texts[start : start + at_once])
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        if self.cut is None:
            return self._library(texts)
        if len(self.seen) > self.remembered // 2:
            self.seen, self.before = {}, self.seen
        whole = [bool(self.special and self.special.search(t)) for t in texts]
        cut = [() if w else (self.cut_ascii if t.isascii() else self.cut).findall(t) for t, w in zip(texts, whole, strict=True)]
        new = set().union(*cut) - self.seen.keys()
        again = new & self.before.keys()
        self.seen.update((word, self.before[word]) for word in again)
        if words := list(new - again):
            self.seen.update(zip(words, self._apart(words), strict=True))
        get = self.seen.__getitem__
        out = [b"".join(map(get, pieces)) for pieces in cut]
        for k in (k for k, w in enumerate(whole) if w):
            out[k] = self._library([texts[k]])[0]
        return out


@cache
def token_ids(path: str, remembered: int = REMEMBERED) -> TokenIds:
    """One encoder per worker process and file."""
    return TokenIds(path, remembered)
