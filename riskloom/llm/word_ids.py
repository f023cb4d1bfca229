"""Token ids of whole texts with a public ``tokenizers`` vocabulary of word pieces, each distinct word once.

The tokenizer splits a normalised text into words and encodes each word on its own, so a text's ids are those of
its words in order. Texts of plain letters (ASCII and Latin up to U+017F, where normalising only lowers the case) are split into words
as arrays of bytes; a word that the worker has not met is encoded by the library's model, then remembered under its
64-bit hash. All other texts, and texts that hold the string of an added token, go through the library whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

from riskloom.llm.common import mix
from riskloom.llm.textbytes import _CODES, powers

#: Split pattern that the array code below follows; a file with another one is encoded by the library throughout (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words that a worker remembers; beyond, it starts anew.
REMEMBERED = 2_000_000
#: Characters of text encoded at once.
AT_ONCE = 1 << 20

_PLAIN = "\t\n\r\x20-\x7eÀ-ÖØ-öø-įı-ſ"
_SPACE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0, 9, 10, 13, 32]] = _SPACE
_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_CLASS[48:58] = _DIGIT
#: Bytes that a lowered plain text does not hold.
_BAD = np.ones(256, bool)
_BAD[[0, 9, 10, 13, *range(32, 127), *range(0x80, 0xC0), 0xC3, 0xC4, 0xC5]] = False
_SHORT = np.zeros(256, bool)
_SHORT[[ord(c) for c in "stmd"]] = True
_LONG = {ord("r"): ord("e"), ord("v"): ord("e"), ord("l"): ord("l")}


def word_starts(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word of lowered plain text, and the byte behind it."""
    kind = _CLASS[buf]
    first = np.empty(len(buf), bool)
    first[0] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    first |= kind == _DIGIT
    for p in np.flatnonzero(buf == 39):
        # An apostrophe that begins a word may be a contraction, which ends there even if letters follow.
        if not first[p] or p + 1 >= len(buf):
            continue
        c = int(buf[p + 1])
        n = 2 if _SHORT[c] else 3 if c in _LONG and p + 2 < len(buf) and buf[p + 2] == _LONG[c] else 0
        if n:
            first[p + 1] = False
            if p + n < len(buf):
                first[p + n] = True
    at = np.flatnonzero(first)
    end = np.append(at[1:], len(buf))
    solid = kind[at] != _SPACE
    return at[solid], end[solid]


class Words:
    """Ids of words by hash: an open-addressed table of arrays."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self._size(1 << 17)
        self.begin = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _size(self, slots: int) -> None:
        self.mask = np.uint64(slots - 1)
        self.key = np.zeros(slots, np.uint64)
        self.row = np.full(slots, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if unknown."""
        slot = (keys & self.mask).astype(np.int64)
        row = self.row[slot]
        bad = np.flatnonzero((self.key[slot] != keys) & (row >= 0))
        while len(bad):
            slot[bad] = (slot[bad] + 1) & int(self.mask)
            row[bad] = self.row[slot[bad]]
            bad = bad[(self.key[slot[bad]] != keys[bad]) & (row[bad] >= 0)]
        return row

    def _place(self, keys: np.ndarray, rows: np.ndarray) -> None:
        slot = (keys & self.mask).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.row[slot[left]] < 0]
            self.row[slot[free]] = rows[free]  # of several for one slot the last stays
            mine = free[self.row[slot[free]] == rows[free]]
            self.key[slot[mine]] = keys[mine]
            placed = np.zeros(len(keys), bool)
            placed[mine] = True
            left = left[~placed[left]]
            slot[left] = (slot[left] + 1) & int(self.mask)

    def add(self, keys: np.ndarray, encoded: list[list[int]]) -> None:
        """New distinct keys with their ids."""
        length = np.fromiter(map(len, encoded), np.int64, len(encoded))
        flat = np.fromiter((i for ids in encoded for i in ids), np.uint32, int(length.sum()))
        rows = np.arange(len(self.begin), len(self.begin) + len(keys), dtype=np.int32)
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.ids = np.concatenate([self.ids, flat])
        if 2 * len(self.begin) > len(self.key):
            known = self.row >= 0
            old = self.key[known], self.row[known]
            self._size(4 * len(self.key))
            self._place(*old)
        self._place(keys, rows)


def ragged(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The stretches ``flat[begin:begin + length]`` one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    step = np.ones(total, np.int64)
    some = np.flatnonzero(length)
    if not len(some):
        return flat[:0]
    b, e = begin[some], ends[some]
    step[0] = b[0]
    step[e[:-1]] = b[1:] - (b[:-1] + length[some][:-1] - 1)
    return flat[np.cumsum(step)]


class Encoder:
    """Texts to arrays of ids."""

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.odd = re.compile("|".join([f"[^{_PLAIN}]", *map(re.escape, self.added)]))
        pre = spec.get("pre_tokenizer") or {}
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        patterns = [s.get("pattern", {}).get("Regex") for s in pre.get("pretokenizers", [])]
        self.by_words = kinds == ["NFC", "Replace", "Lowercase"] and patterns == [PATTERN, None]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in printable}
        letters |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in letters)}
        self.letters = letters
        self.words = Words()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _word(self, raw: bytes) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(raw.decode("latin-1").translate(self.letters))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the library's ``encode(text, add_special_tokens=False)`` gives them."""
        out: list[np.ndarray | None] = [None] * len(texts)
        some: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            some.append(i)
            size += len(text)
            if size > AT_ONCE:
                self._several(texts, some, out)
                some, size = [], 0
        if some:
            self._several(texts, some, out)
        return out

    def _several(self, texts: list[str], some: list[int], out: list) -> None:
        joined = "\0".join([texts[i] for i in some])
        raw = joined.lower().encode() + b"\0"
        buf = np.frombuffer(raw, np.uint8)
        if not self.by_words or _BAD[buf].any() or raw.count(0) != len(some) or any(x in joined for x in ("\xd7", "\xf7", *self.added)):
            for i in some:
                if not self.by_words or self.odd.search(texts[i]):
                    out[i] = self._whole(texts[i])
            some = [i for i in some if out[i] is None]
            if not some:
                return
            raw = "\0".join([texts[i] for i in some]).lower().encode() + b"\0"
            buf = np.frombuffer(raw, np.uint8)
        at, end = word_starts(buf)
        cut = np.searchsorted(at, np.flatnonzero(buf == 0))
        if not len(at):
            for i in some:
                out[i] = np.zeros(0, np.uint32)
            return
        length = end - at
        value = ragged(_CODES[buf], at, length)
        value *= ragged(powers(int(length.max())), np.zeros(len(at), np.int64), length)
        keys = mix(np.add.reduceat(value, np.cumsum(length) - length))
        row = self.words.find(keys)
        missing = np.flatnonzero(row < 0)
        if len(missing):
            if len(self.words.begin) > REMEMBERED:
                self.words.clear()
                missing = np.arange(len(keys))
            new, where = np.unique(keys[missing], return_index=True)
            where = missing[where]
            self.words.add(new, [self._word(raw[a:b]) for a, b in zip(at[where].tolist(), end[where].tolist())])
            row = self.words.find(keys)
        n = self.words.length[row]
        ids = ragged(self.words.ids, self.words.begin[row], n)
        ends = np.concatenate([[0], np.cumsum(n)])[cut]
        for i, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist()):
            out[i] = ids[a:b]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder: the words it has met serve later tasks too."""
    return Encoder(path)
