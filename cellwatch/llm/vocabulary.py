"""Byte-level BPE vocabularies: files, symbol tables and the splitting of texts before merges."""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import regex

# The white space of the split pattern (Unicode White_Space) and the pattern itself.
_WS = "\t-\r \x85\xa0  -     　"
_PATTERN = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+"
            rf"|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_SPLIT = regex.compile(_PATTERN)
_RAGGED = re.compile(r"\s | \s")  # a space beside other white space: such a text is split as a whole
_STAND_IN = ""


@lru_cache(1)
def _newer_letters() -> dict[str, str]:
    """Letters and digits that the regex module knows but this Python's Unicode tables don't.

    The tokenizer library's tables are as old as Python's, so there they are other signs.
    """
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF)
    return {c: _STAND_IN for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"}


def split_pretokens(text: str) -> list[str]:
    """Pre-tokens of a text without special strings, in order; joined they give the text."""
    if not text.isascii():
        newer = _newer_letters()
        if not newer.keys().isdisjoint(text):
            plain = "".join(newer.get(c, c) for c in text)
            return [text[m.start():m.end()] for m in _SPLIT.finditer(plain)]
    return _SPLIT.findall(text)


def chunks(text: str) -> list[str] | None:
    """The text cut before every space, or None where such cuts could change the split.

    A single space between two other signs always starts a new pre-token, so each chunk splits by
    itself. Chunks repeat, so their results are worth keeping.
    """
    if _RAGGED.search(text) or not text:
        return None
    first, *rest = text.split(" ")
    if rest and (not first or not rest[-1]):
        return None
    return [first, *[" " + x for x in rest]]


def _byte_signs() -> list[str]:
    """The printable sign that stands for each byte in byte-level vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in signs:
            signs[b] = chr(256 + extra)
            extra += 1
    return [signs[b] for b in range(256)]


@dataclass
class Vocabulary:
    """A byte-level BPE: byte ids, merges by rank, vocabulary bytes by id and special strings."""

    byte_ids: np.ndarray
    ranks: dict[tuple[int, int], int]      # (left id, right id) -> rank
    merged: np.ndarray                     # rank -> id
    strings: list[bytes]                   # id -> bytes
    special: dict[str, int]
    keys: np.ndarray = field(default=None)      # sorted left * size + right
    key_ranks: np.ndarray = field(default=None)

    def __post_init__(self):
        size = self.size = len(self.strings)
        self.byte_list, self.merged_list = self.byte_ids.tolist(), self.merged.tolist()
        keys = np.fromiter((a * size + b for a, b in self.ranks), np.int64, len(self.ranks))
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_ranks = np.fromiter(self.ranks.values(), np.int64, len(self.ranks))[order]
        self.special_split = re.compile("(" + "|".join(
            re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None

    def parts(self, text: str) -> list[tuple[str, int | None]]:
        """(ordinary text, None) and (special string, its id) in order."""
        if self.special_split is None or not any(s in text for s in self.special):
            return [(text, None)]
        return [(p, self.special.get(p)) for p in self.special_split.split(text) if p]


@lru_cache(4)
def parse(content: bytes) -> Vocabulary:
    """Vocabulary of a tokenizer file's content (kept per worker process)."""
    spec = json.loads(content)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    signs = _byte_signs()
    back = {s: b for b, s in enumerate(signs)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    strings = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for s, i in vocab.items():
        strings[i] = bytes(back[c] for c in s) if all(c in back for c in s) else s.encode()
    for s, i in special.items():
        strings[i] = s.encode()
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
    ranks = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
    return Vocabulary(np.array([vocab[s] for s in signs]), ranks,
                      np.array([vocab[a + b] for a, b in pairs]), strings, special)
