"""Benchmark decontamination by latent semantic retrieval.

1. *Passages.* Benchmark texts are cut into even pieces of at most ``PIECE_WORDS`` words, and the pieces are dealt
   into blocks of about ``BLOCK_PIECES``. Words are runs of letters, digits and non-ASCII characters, ASCII letters lowered.
2. *Latent space.* For each block, a randomised SVD of the TF-IDF matrix of its pieces: tasks turn their
   rows a into partial sums of a (a' Q), added up under the word, for a random start and ``POWER`` rounds;
   the driver only orthogonalises the words x rank matrix of the block, whose size the block's bounds fix.
3. *Candidates.* Every document is read once, as windows of ``WINDOW_WORDS`` words, each ``STRIDE`` words on. A window whose
   known words carry too little of its weight to reach ``COSINE`` with anything is passed over
   (exact bound); the others are folded into the latent space and compared with all pieces of the
   block. All that reach ``COSINE`` go on; there is no limit on their number.
4. *Checks.* The longest common subsequence of a piece and the words around the window must cover ``LCS_SHARE`` of the
   piece, or ``LCS_WITH_ANSWER`` if the answer, its last ``ANSWER_WORDS`` words, stands there word by word.

Items of SHORTEST to LEAST_WORDS - 1 words have too few words for a cosine: a document holds one if its words stand there one after another.

Nothing but the blocks' sums is shuffled. Blocks are broadcast ``BLOCKS_AT_ONCE`` at a time, so a larger
benchmark means more passes, not more memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_schema, cut, filter_rows, give_back, id_and_text, map_batches, mix, order_id, original_id, record_batch
from riskloom.llm.textbytes import many_word_hashes

PIECE_WORDS, LEAST_WORDS = 48, 8
#: Items with fewer words than LEAST_WORDS are found word by word; those with fewer than SHORTEST are words, not passages, and are left out.
SHORTEST, SHORT_AT_ONCE = 3, 50_000
BLOCK_PIECES, BLOCKS_AT_ONCE = 200, 8
RANK, OVERSAMPLE, POWER = 192, 16, 2
WINDOW_WORDS, STRIDE = 24, 12
COSINE = 0.36
LCS_SHARE, LCS_WITH_ANSWER, ANSWER_WORDS = 0.6, 0.45, 6
#: Windows folded into the latent space at once.
FOLD = 512

_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def plain(text: str | None) -> bytes:
    return (text or "").encode().lower().translate(_PLAIN)


def pieces_of(words: np.ndarray) -> list[np.ndarray]:
    """A benchmark text in even pieces; one of fewer than SHORTEST words tells nothing and has none."""
    return np.array_split(words, -(-len(words) // PIECE_WORDS)) if len(words) >= SHORTEST else []


def _cut_items(batch: pa.RecordBatch) -> dict:
    out = {"item": [], "words": []}
    for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
        words, _ = many_word_hashes([plain(text)])
        for piece in pieces_of(words):
            out["item"].append(item)
            out["words"].append(piece.view(np.int64))
    return out


@dataclass
class Block:
    """A latent space and the pieces in it."""

    items: np.ndarray
    pieces: list[np.ndarray]  # word hashes
    places: list[dict[int, int]]
    vocabulary: np.ndarray  # sorted word hashes
    idf: np.ndarray  # of the vocabulary, and last of an unknown word
    basis: np.ndarray  # words x rank, and last a row of zeros
    folded: np.ndarray  # pieces x rank, divided by their norms


@dataclass
class ShortItems:
    """Items that are found word by word: for each number of words, sorted hashes of the word sequences and their items."""

    by_size: dict[int, tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple[int, np.ndarray]]) -> ShortItems:
        by_size = {}
        for size in sorted({len(w) for _, w in rows}):
            mine = [(i, w) for i, w in rows if len(w) == size]
            keys = np.array([_sequences(w, size)[0] for _, w in mine])
            order = np.argsort(keys, kind="stable")
            by_size[size] = keys[order], np.array([i for i, _ in mine])[order]
        return cls(by_size)

    def matches(self, words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """``(row, item, 1.0)`` for each place of an item in the texts."""
        row = np.repeat(np.arange(len(counts)), counts)
        for size, (keys, items) in self.by_size.items():
            if len(words) < size:
                continue
            h = _sequences(words, size)
            first, last = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
            for at in np.flatnonzero((last > first) & (row[: len(h)] == row[size - 1 :])):
                for k in range(first[at], last[at]):
                    yield int(row[at]), int(items[k]), 1.0


def _sequences(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words."""
    h = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[k : len(words) - size + 1 + k])
    return h


def _projected(rows: DataFrame, vocabulary: np.ndarray, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A'(A q) for the TF-IDF matrix A of ``rows(words)``: summed per task, then per word."""
    schema = "word long, sums binary"
    target = arrow_schema(schema)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for words in batch.column("words").to_pylist():
                at, weight = _weights(np.array(words, np.int64).view(np.uint64), vocabulary, idf)
                y = weight @ q[at]
                for w, x in zip(at.tolist(), weight.tolist(), strict=True):
                    total[w] = total.get(w, 0) + x * y
        yield record_batch({"word": list(total), "sums": [v.tobytes() for v in total.values()]}, target)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for w, v in zip(batch.column("word").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                total[w] = total.get(w, 0) + np.frombuffer(v)
        yield record_batch({"word": list(total), "sums": [v.tobytes() for v in total.values()]}, target)

    sums = rows.select("words").mapInArrow(partial, schema).repartition(4, "word").mapInArrow(added, schema)
    out = np.zeros_like(q)
    for row in sums.collect():  # at most BLOCK_PIECES x PIECE_WORDS rows, give or take the dealing
        out[row["word"]] = np.frombuffer(row["sums"])
    return out


def _weights(words: np.ndarray, vocabulary: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, count = np.unique(np.searchsorted(vocabulary, words), return_counts=True)
    return at, count * idf[at]


def latent_space(rows: DataFrame) -> Block | None:
    """Randomised SVD of one block's pieces ``(item, words)``."""
    found = sorted((r["item"], tuple(r["words"])) for r in rows.collect())  # one block: bounded
    if not found:
        return None
    pieces = [np.array(w, np.int64).view(np.uint64) for _, w in found]
    vocabulary, df = np.unique(np.concatenate([np.unique(p) for p in pieces]), return_counts=True)
    idf = np.log((len(pieces) + 1) / (np.append(df, 0) + 0.5))
    rank = min(RANK, len(pieces), len(vocabulary))
    q = np.random.default_rng(5).standard_normal((len(vocabulary), min(rank + OVERSAMPLE, len(vocabulary))))
    for _ in range(POWER):
        q, _ = np.linalg.qr(_projected(rows, vocabulary, idf, q))
    # Rayleigh-Ritz in the range found: singular vectors of A from the small matrix q'A'Aq.
    small = q.T @ _projected(rows, vocabulary, idf, q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    basis = (q @ vectors[:, np.argsort(values)[::-1][:rank]]).astype(np.float32)
    folded = np.zeros((len(pieces), basis.shape[1]), np.float32)
    for k, p in enumerate(pieces):
        at, weight = _weights(p, vocabulary, idf)
        folded[k] = weight @ basis[at] / np.linalg.norm(weight)
    return Block(np.array([i for i, _ in found]), pieces, [places(p) for p in pieces], vocabulary, idf.astype(np.float32), np.vstack([basis, np.zeros((1, basis.shape[1]), np.float32)]), folded)


def places(piece: np.ndarray) -> dict[int, int]:
    """For each word of a piece, its places as bits of one integer."""
    out: dict[int, int] = {}
    for k, w in enumerate(piece.tolist()):
        out[w] = out.get(w, 0) | 1 << k
    return out


def lcs(piece: dict[int, int], size: int, words: np.ndarray, least: float = 0) -> int:
    """Length of the longest common subsequence of a piece, given by its ``places``, and ``words``.

    The rows of the table are bits of one integer. 0 if the places that have their word anywhere in ``words`` are
    fewer than ``least``, as the subsequence then is, too.
    """
    hits = [piece[w] for w in words.tolist() if w in piece]
    if reduce(or_, hits, 0).bit_count() < least:
        return 0
    full = (1 << size) - 1
    row = full
    for m in hits:
        u = row & m
        row = ((row + u) | (row - u)) & full
    return size - row.bit_count()


def _answered(piece: np.ndarray, around: np.ndarray) -> bool:
    answer = piece[-ANSWER_WORDS:]
    if len(around) < len(answer):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(around, len(answer)) == answer).all(axis=1).any())


def _matches(words: np.ndarray, counts: np.ndarray, block: Block) -> Iterator[tuple[int, int, float]]:
    """``(row, item, share of the piece)`` for what passes the checks, of several texts in one array of words."""
    if not len(words):
        return
    size = len(block.vocabulary)
    at = np.minimum(np.searchsorted(block.vocabulary, words), size - 1)
    at = np.where(block.vocabulary[at] == words, at, size)
    weight = block.idf[at].astype(np.float64) ** 2
    every = np.concatenate([[0], np.cumsum(weight)])
    known = np.concatenate([[0], np.cumsum(np.where(at < size, weight, 0))])
    ends = np.cumsum(counts)
    n = -(-np.maximum(counts - (WINDOW_WORDS - STRIDE), (counts > 0).astype(np.int64)) // STRIDE)
    row = np.repeat(np.arange(len(counts)), n)
    start = (ends - counts)[row] + STRIDE * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    end = np.minimum(start + WINDOW_WORDS, ends[row])
    norm2 = every[end] - every[start]
    some = np.flatnonzero(known[end] - known[start] >= COSINE**2 * norm2)
    padded = np.append(at, np.full(WINDOW_WORDS, size))
    for k in range(0, len(some), FOLD):
        part = some[k : k + FOLD]
        span = start[part, None] + np.arange(WINDOW_WORDS)
        words_at = np.where(span < end[part, None], padded[span], size)
        folded = np.einsum("ijk,ij->ik", block.basis[words_at], block.idf[words_at] * (words_at < size))
        cosine = folded @ block.folded.T / np.sqrt(norm2[part, None])
        for i, j in zip(*np.nonzero(cosine >= COSINE), strict=True):
            w, piece, r = part[i], block.pieces[j], row[part[i]]
            around = words[max(start[w] - len(piece), ends[r] - counts[r]) : min(end[w] + len(piece), ends[r])]
            share = lcs(block.places[j], len(piece), around, LCS_WITH_ANSWER * len(piece)) / len(piece)
            if share >= LCS_SHARE or share >= LCS_WITH_ANSWER and _answered(piece, around):
                yield int(r), int(block.items[j]), share


def _blocks(benchmark: DataFrame) -> Iterator[list[Block | ShortItems]]:
    items = benchmark.select(order_id("item_id").alias("item"), F.col("text").cast("string").alias("text"))
    pieces = cut(map_batches(items, _cut_items, "item long, words array<long>"), "benchmark-pieces")
    short = pieces.filter(F.size("words") < LEAST_WORDS)
    batches = -(-short.count() // SHORT_AT_ONCE)
    for k in range(batches):
        mine = short.filter(F.pmod(F.xxhash64("item", "words"), F.lit(batches)) == k).distinct()
        yield [ShortItems.of([(r["item"], np.array(r["words"], np.int64).view(np.uint64)) for r in mine.collect()])]  # about SHORT_AT_ONCE rows
    pieces = pieces.filter(F.size("words") >= LEAST_WORDS)
    dealt = -(-pieces.count() // BLOCK_PIECES)
    pieces = pieces.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(max(dealt, 1))))
    for first in range(0, dealt, BLOCKS_AT_ONCE):
        spaces = [latent_space(pieces.filter(F.col("block") == b).select("item", "words")) for b in range(first, min(first + BLOCKS_AT_ONCE, dealt))]
        give_back()
        yield [b for b in spaces if b is not None]


def _found(batch: pa.RecordBatch, blocks: list[Block | ShortItems]) -> tuple[list[set[int]], list[float]]:
    """Items and best share of each text of a batch."""
    items: list[set[int]] = [set() for _ in range(batch.num_rows)]
    best = [0.0] * batch.num_rows
    words, counts = many_word_hashes([plain(t) for t in batch.column("text").to_pylist()])
    for block in blocks:
        for r, item, share in block.matches(words, counts) if isinstance(block, ShortItems) else _matches(words, counts, block):
            items[r].add(item)
            best[r] = max(best[r], share)
    return items, best


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are."""
    for blocks in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(blocks)
        docs = filter_rows(docs, lambda batch, shared=shared: [not x for x in _found(batch, shared.value)[0]])
    return docs


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, contaminated, n_items, item_ids, best_share)``, one row per input row.

    ``item_ids``: ids of the items found, ascending, comma-joined; ``best_share``: largest share of a piece that stands
    in the text in order (0 if none was found). Null and empty texts hold nothing; null and empty benchmark texts and those of
    fewer than ``SHORTEST`` words are not searched for, short ones word by word. Ids are passed on, null or repeated: each row is judged by
    its own text, whatever the size of the benchmark. An empty benchmark leaves all
    documents clean; an empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    found = id_and_text(docs).select("doc_id", "text", F.array().cast("array<long>").alias("items"), F.lit(0.0).alias("best_share"))
    for blocks in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(blocks)  # at most BLOCKS_AT_ONCE x BLOCK_PIECES x PIECE_WORDS x RANK numbers

        def run(batch: pa.RecordBatch, shared=shared) -> dict:
            items, best = _found(batch, shared.value)
            before = zip(batch.column("items").to_pylist(), batch.column("best_share").to_pylist(), strict=True)
            merged = [(sorted(x.union(old)), max(b, o)) for x, b, (old, o) in zip(items, best, before, strict=True)]
            return {"doc_id": batch.column("doc_id"), "text": batch.column("text"), "items": [x for x, _ in merged], "best_share": [b for _, b in merged]}

        found = map_batches(found, run, "doc_id long, text string, items array<long>, best_share double")
    return found.select(
        "doc_id",
        (F.size("items") > 0).alias("contaminated"),
        F.size("items").cast("long").alias("n_items"),
        F.concat_ws(",", F.transform("items", lambda i: original_id(i).cast("string"))).alias("item_ids"),
        "best_share",
    )
