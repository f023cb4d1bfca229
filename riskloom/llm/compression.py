"""Quality rules by compression bands.

The zstandard ratio (bytes over compressed bytes) of repetitive text is far above that of prose, the ratio of
random text about 1. What is normal depends on length, as a short text has little to refer back to; so
each band of lengths has its own limits. A text is rejected when its whole ratio is outside the band, or when more than
``CHUNK_SHARE`` of its bytes lie in chunks of ``CHUNK`` bytes outside the chunk band (a long text that hides a repetitive stretch).
The last chunk is the last ``CHUNK`` bytes and counts for the bytes that no other chunk holds.

Only a projection: one pass, nothing shuffled.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from riskloom.llm.common import id_and_text, map_batches, texts_of

LEVEL = 3
#: Upper length in bytes (exclusive), least and greatest ratio of a whole text. Under 200 bytes frame
#: overhead and chance outweigh content, so only extremes go. The least ratios lie between measured base64 (1.14 at 400 bytes, 1.33 at
#: 40,000) and, from 16,000, hex digits (1.97 at 40,000) and the least of measured prose and licenses (1.24 at 400,
#: 1.45 at 1,000, 1.68 at 2,000, 1.83 at 4,096, 2.04 at 12,000).
BANDS = (
    (200, 0.0, 2.6), (400, 1.1, 3.0), (700, 1.22, 3.0), (1_000, 1.3, 3.0), (2_000, 1.42, 3.4), (4_000, 1.6, 3.4), (16_000, 1.75, 3.8), (float("inf"), 2.0, 4.5),
)
#: Bytes from which a text must shrink further than the frequencies of its bytes alone allow: hex digits and random letters do not.
ENTROPY_FROM = 4_096
#: Bytes of a chunk, its least and greatest ratio, share of a text's bytes that may be in chunks outside.
CHUNK, CHUNK_BAND, CHUNK_SHARE = 4_096, (1.75, 3.6), 0.25
#: Base rules: fewest words, percent of words in repeated 3-word windows.
LEAST_WORDS, MOST_REPEATED = 50, 50

_WORD = re.compile(r"[^ \t-\r]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")


def repeated_words(words: list[str]) -> int:
    """Words that lie in a 3-word window which stands twice or more in the text."""
    if len(words) < 4:
        return 0
    number: dict[str, int] = {}
    at = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    pairs = np.unique(at[:-1] * len(number) + at[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(number) + at[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : k + len(again)] |= again
    return int(inside.sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return len(lines) - len(set(lines))


def ratio(raw: bytes, compressor: zstandard.ZstdCompressor) -> float:
    return len(raw) / len(compressor.compress(raw))


def beats_entropy(raw: bytes, reached: float) -> bool:
    """Whether the ratio is above 8 bits over the order-0 entropy of the bytes."""
    share = np.bincount(np.frombuffer(raw, np.uint8)) / len(raw)
    share = share[share > 0]
    return reached * -float(share @ np.log2(share)) > 8


def in_band(raw: bytes, low: float, high: float, compressor: zstandard.ZstdCompressor) -> tuple[float, bool]:
    """Ratio of a text or chunk, and whether it is in the band."""
    reached = ratio(raw, compressor)
    return reached, low <= reached <= high and (len(raw) < ENTROPY_FROM or beats_entropy(raw, reached))


def in_bands(raw: bytes, compressor: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of its bytes in chunks outside their band, and the verdict."""
    if not raw:
        return 0.0, 0.0, True
    low, high = next((low, high) for upper, low, high in BANDS if len(raw) < upper)
    whole, good = in_band(raw, low, high, compressor)
    bad = 0
    for at in range(0, len(raw), CHUNK) if len(raw) >= CHUNK else ():
        first = min(at, len(raw) - CHUNK)
        if not in_band(raw[first : first + CHUNK], *CHUNK_BAND, compressor)[1]:
            bad += first + CHUNK - at
    share = bad / len(raw)
    return whole, share, good and share <= CHUNK_SHARE


def _judge(batch: pa.RecordBatch) -> dict:
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept ratio bad_chunks".split()
    rows = []
    for text in texts_of(batch):
        words = _WORD.findall(text)
        again = repeated_words(words)
        failed = len(words) < LEAST_WORDS or 100 * again > MOST_REPEATED * len(words)
        whole, share, good = in_bands(text.encode(), compressor)
        rows.append((len(words), sum(map(len, words)), len(_SYMBOL.findall(text)), repeated_lines(text), again, failed, good and not failed, whole, share))
    return {"doc_id": batch.column("doc_id")} | {name: [r[k] for r in rows] for k, name in enumerate(names)}


def quality(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, ratio, bad_chunks)``, one row per input row.

    Null and empty texts: no words, ratio 0, base failed. Ids are passed on, null or repeated; equal rows get equal results. Empty
    table: empty result. Other columns are ignored.
    """
    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, ratio double, bad_chunks double"
    )
    return map_batches(id_and_text(docs), _judge, schema)
