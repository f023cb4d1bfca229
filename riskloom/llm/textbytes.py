"""Vectorised view of texts as UTF-8 bytes: blocks of documents, word boundaries, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from riskloom.llm.common import mix

#: Bytes handled at once; a longer text is handled in pieces.
BLOCK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CODES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def powers(n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    p = np.full(max(n, 1), _BASE, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def blocks(raws: list[bytes], limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts whose bytes fit into one block (a longer text stands alone)."""
    i = 0
    while i < len(raws):
        j, size = i, 0
        while j < len(raws) and (j == i or size + len(raws[j]) <= limit):
            size += len(raws[j])
            j += 1
        yield i, j
        i = j


def _pieces(raw: bytes) -> Iterator[bytes]:
    """A text in pieces that end at white space."""
    at = 0
    while at < len(raw):
        end = at + BLOCK
        while end < len(raw) and not _SPACE[raw[end]]:
            end += 1
        yield raw[at:end]
        at = end


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of each word (maximal run without ASCII white space) of ``raw``, in order."""
    if len(raw) > BLOCK:
        return np.concatenate([_word_hashes(p) for p in _pieces(raw)] or [np.zeros(0, np.uint64)])
    return _word_hashes(raw)


def _word_hashes(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.uint64)
    buf = np.frombuffer(raw, np.uint8)
    solid = ~_SPACE[buf]
    before = np.empty_like(solid)
    before[0] = False
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & ~before)
    if not len(start):
        return np.zeros(0, np.uint64)
    word = np.cumsum(solid & ~before) - 1
    at = np.flatnonzero(solid)
    offset = at - start[word[at]]
    value = _CODES[buf[at]] * powers(int(offset.max()) + 1)[offset]
    first = np.searchsorted(at, start)
    return mix(np.add.reduceat(value, first))


def many_word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts in one array, and the number of words of each text."""
    parts, counts = [], np.zeros(len(raws), np.int64)
    for i, j in blocks(raws):
        if j - i == 1:
            h = word_hashes(raws[i])
            counts[i] = len(h)
            parts.append(h)
            continue
        joined = b" ".join(raws[i:j])
        parts.append(_word_hashes(joined))
        buf = np.frombuffer(joined, np.uint8)
        solid = ~_SPACE[buf]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        total = np.concatenate([[0], np.cumsum(begins)])
        ends = np.cumsum([len(r) + 1 for r in raws[i:j]]) - 1
        counts[i:j] = np.diff(np.concatenate([[0], total[ends]]))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), counts
