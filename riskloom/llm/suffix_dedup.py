"""Removal of long repeated substrings by a logarithmic family of suffix arrays.

A byte goes when a string of ``WINDOW`` bytes that covers it also starts earlier: in a
document with a smaller id, or earlier in the same one. The work in four Spark steps:

1. *Anchors.* Each string of ``WINDOW`` bytes picks the position inside it whose ``SEED``-byte
   hash is least. Equal strings pick alike, so they meet under the seed's hash. Neighbouring
   strings mostly pick the same position; such a run is one row ``(seed, hash of the run's
   bytes, doc, start, length)``, about one row for 32 bytes of text. Copies of a run inside
   one input batch keep their first row only; the rest becomes one interval per stretch.
2. *Copies.* Sorted by seed, every later copy of a whole run is a known repeat; it is streamed, so
   no seed, however common, is held in memory. What is left of a seed that has two or more
   different runs goes on to step 4 (about 5 % of the rows), with its bytes.
3. *Bytes.* The runs that are left are cut out of their documents by one join on the id.
4. *Suffix arrays.* Per partition of seeds, runs arrive in document order and are taken in batches.
   Each batch gets a suffix array (its suffixes sorted by their first ``WINDOW`` bytes), is
   merge-scanned against the levels there are, and becomes a new level; levels of like size
   are merged, so n suffixes stand in O(log n) levels and each is merged O(log n) times. A
   seed with more than ``HOT_RUNS`` different runs is dealt out string by string (by the hash of the
   string) instead of whole.

Hashes (128 bits together) decide that two whole runs are equal; all else compares bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_schema, cut, id_and_text, map_batches, mix, order_id, original_id, record_batch
from riskloom.llm.textbytes import _BASE, _CODES, BLOCK, blocks

#: Bytes of a string that counts as repeated, and of the seed inside it.
WINDOW = 100
SEED = 32
#: Bytes of text within which copies of a run are collapsed before the shuffle.
COLLAPSE = 32 << 20
#: Strings in a batch of step 4; strings meant for one task; different runs of a seed that stay together.
BATCH = 1 << 16
TASK_STRINGS = 1 << 20
HOT_RUNS = 20_000

_LOW = np.uint64(BLOCK * 2 - 1)
_RUN = "seed long, whole long, doc long, start long, n long"
_FOUND = "doc long, start long, n long, seed long"


def _seed_hash(buf: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes that start at each position; spans are doubled log2(SEED) times."""
    h, span = _CODES[buf], 1
    while span < SEED:
        h = h[:-span] * np.uint64(pow(_BASE, span, 2**64)) + h[span:]
        span *= 2
    return mix(h)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def runs_of(raw: bytes, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of strings that share an anchor, in a block of joined texts.

    Returns the first string of each run, the end (exclusive) and the seed hash. Strings that
    would reach over the end of a text belong to no run.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < WINDOW:
        return none, none, none.astype(np.uint64)
    h = _seed_hash(np.frombuffer(raw, np.uint8))
    key = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    pick = _sliding_min(key, WINDOW - SEED + 1)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    long = np.asarray(lengths) >= WINDOW
    edge = np.zeros(len(pick) + 1, np.int32)
    np.add.at(edge, starts[long], 1)
    np.add.at(edge, ends[long] - WINDOW + 1, -1)
    inside = np.cumsum(edge[:-1]) > 0
    change = np.ones(len(pick), bool)
    change[1:] = pick[1:] != pick[:-1]
    change[starts[long]] = True
    first = np.flatnonzero(inside & change)
    breaks = np.append(np.flatnonzero(change | ~inside), len(pick))
    end = breaks[np.searchsorted(breaks, first, side="right")]
    return first, end, h[(pick[first] & _LOW).astype(np.int64)]


def _pieces(raw: bytes) -> list[tuple[int, bytes]]:
    """A text cut into pieces of at most BLOCK bytes, so that each string lies in exactly one."""
    step = BLOCK - WINDOW + 1
    return [(at, raw[at : at + BLOCK]) for at in range(0, max(len(raw) - WINDOW + 1, 1), step)]


def _anchors(batch: pa.RecordBatch) -> dict | None:
    docs, offsets, raws = [], [], []
    for d, t in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
        if t:
            for at, piece in _pieces(t.encode()):
                docs.append(d)
                offsets.append(at)
                raws.append(piece)
    seeds, wholes, doc, start, n = [], [], [], [], []
    for i, j in blocks(raws):
        raw = b"".join(raws[i:j])
        lengths = [len(r) for r in raws[i:j]]
        first, end, seed = runs_of(raw, lengths)
        ends = np.cumsum(lengths)
        of = np.searchsorted(ends, first, side="right")
        seeds.append(seed.view(np.int64))
        wholes.append(np.fromiter((xxhash.xxh3_64_intdigest(raw[a : b + WINDOW - 1]) for a, b in zip(first.tolist(), end.tolist(), strict=True)), np.uint64, len(first)).view(np.int64))
        doc.append(np.asarray(docs[i:j], np.int64)[of])
        start.append(first - (ends - lengths)[of] + np.asarray(offsets[i:j], np.int64)[of])
        n.append(end - first)
    if not seeds:
        return None
    cols = [np.concatenate(x) for x in (seeds, wholes, doc, start, n)]
    return _first_copies(*cols)


def _first_copies(seed, whole, doc, start, n) -> dict:
    """Keep the first row of the copies of a run; the others become stretches with n < 0."""
    order = np.lexsort((start, doc, whole, seed))
    same = np.zeros(len(order), bool)
    s, w = seed[order], whole[order]
    same[1:] = (s[1:] == s[:-1]) & (w[1:] == w[:-1])
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    d, p = doc[order], start[order]
    later = same & ((d != d[head]) | (p != p[head]))
    keep = np.ones(len(order), bool)
    keep[order[later]] = False
    doc2, start2, n2 = _stretches(doc[~keep], start[~keep], n[~keep])
    spread = mix(doc2.view(np.uint64) ^ np.uint64(0x5DEECE66D)).view(np.int64)
    return {
        "seed": np.concatenate([seed[keep], spread]),
        "whole": np.concatenate([whole[keep], np.zeros(len(doc2), np.int64)]),
        "doc": np.concatenate([doc[keep], doc2]),
        "start": np.concatenate([start[keep], start2]),
        "n": np.concatenate([n[keep], -n2]),
    }


def _stretches(doc, start, n):
    """Runs that follow each other in a document, as one."""
    if not len(doc):
        return doc, start, n
    order = np.lexsort((start, doc))
    doc, start, n = doc[order], start[order], n[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + n[:-1])
    at = np.flatnonzero(new)
    return doc[at], start[at], np.add.reduceat(n, at)


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2 over rows sorted by (seed, whole, doc, start); state: the last first copy seen."""
    target = arrow_schema(_FOUND)
    held, several = None, False  # held: first copy of the last run; several: its seed's first copies go out
    for batch in batches:
        seed, whole, doc, start, n = (batch.column(c).to_numpy() for c in ("seed", "whole", "doc", "start", "n"))
        known = n < 0
        out = [(doc[known], start[known], -n[known], None)]
        seed, whole, doc, start, n = (x[~known] for x in (seed, whole, doc, start, n))
        old = 0
        if held is not None:
            seed, whole, doc, start, n = (np.concatenate([[h], x]) for h, x in zip(held[:5], (seed, whole, doc, start, n), strict=True))
            old = 1
        if len(seed):
            size = len(seed)
            newseed = np.ones(size, bool)
            newseed[1:] = seed[1:] != seed[:-1]
            newrun = newseed.copy()
            newrun[1:] |= whole[1:] != whole[:-1]
            head = np.maximum.accumulate(np.where(newrun, np.arange(size), 0))
            later = ~newrun & ((doc != doc[head]) | (start != start[head]))
            out.append((*_stretches(doc[later], start[later], n[later]), None))
            group = np.cumsum(newseed) - 1
            runs = np.bincount(group, weights=newrun)
            many = runs[group] > 1
            if old and several:
                many |= group == 0
            go = newrun & many
            if old and several:
                go[0] = False  # went out before
            out.append((doc[go], start[go], n[go], seed[go]))
            last = head[-1]
            several = bool(many[last])
            held = (seed[last], whole[last], doc[last], start[last], n[last])
        for d, p, k, s in out:
            if len(d):
                yield record_batch({"doc": d, "start": p, "n": k, "seed": [None] * len(d) if s is None else s}, target)


def _contexts(batch: pa.RecordBatch) -> dict:
    """Step 3: the bytes of each wanted run, or of each string of it when its seed is hot."""
    out = {"key": [], "doc": [], "start": [], "bytes": []}
    for d, t, runs in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
        raw = (t or "").encode()
        for run in runs:
            start, n = run["start"], run["n"]
            if start + n + WINDOW - 1 > len(raw):
                continue  # of another row with this id
            if not run["hot"]:
                out["key"].append(run["seed"])
                out["doc"].append(d)
                out["start"].append(start)
                out["bytes"].append(raw[start : start + n + WINDOW - 1])
                continue
            for p in range(start, start + n):
                out["key"].append(xxhash.xxh3_64_intdigest(raw[p : p + WINDOW]) - 2**63)
                out["doc"].append(d)
                out["start"].append(p)
                out["bytes"].append(raw[p : p + WINDOW])
    return out


class SuffixLevels:
    """Suffix arrays in geometrically growing levels; each level holds different sorted strings."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def add(self, suffixes: np.ndarray) -> np.ndarray:
        """Take a batch in document order; True for each suffix that stands in an earlier place."""
        order = np.argsort(suffixes, kind="stable")
        batch = suffixes[order]
        seen = np.zeros(len(batch), bool)
        seen[1:] = batch[1:] == batch[:-1]
        head = np.flatnonzero(~seen)
        fresh = batch[head]
        known = np.zeros(len(fresh), bool)
        for level in self.levels:
            at = np.searchsorted(level, fresh)
            inside = at < len(level)
            known[inside] |= level[at[inside]] == fresh[inside]
        seen[head] = known
        found = np.empty(len(batch), bool)
        found[order] = seen
        fresh = fresh[~known]
        if len(fresh):
            self.levels.append(fresh)
            while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
                last = self.levels.pop()
                merged = np.concatenate([self.levels.pop(), last])
                merged.sort(kind="stable")
                self.levels.append(merged)
        return found


def _family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 4 over rows sorted by (doc, start)."""
    target = arrow_schema(_FOUND)
    levels = SuffixLevels()
    doc, start, raws, strings = [], [], [], 0

    def flush():
        lengths = np.array([len(r) for r in raws])
        n = lengths - WINDOW + 1
        buf = np.frombuffer(b"".join(raws), np.uint8)
        windows = np.lib.stride_tricks.sliding_window_view(buf, WINDOW)
        row = np.repeat(np.arange(len(raws)), n)
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = (np.cumsum(lengths) - lengths)[row] + within
        suffixes = np.ascontiguousarray(windows[at]).view(f"S{WINDOW}").ravel()
        d, p = np.asarray(doc, np.int64)[row], np.asarray(start, np.int64)[row] + within
        found = levels.add(suffixes)
        d, p, k = _stretches(d[found], p[found], np.ones(found.sum(), np.int64))
        return record_batch({"doc": d, "start": p, "n": k, "seed": [None] * len(d)}, target)

    for batch in batches:
        for d, p, raw in zip(batch.column("doc").to_pylist(), batch.column("start").to_pylist(), batch.column("bytes").to_pylist(), strict=True):
            doc.append(d)
            start.append(p)
            raws.append(raw)
            strings += len(raw) - WINDOW + 1
            if strings >= BATCH:
                yield flush()
                doc, start, raws, strings = [], [], [], 0
    if raws:
        yield flush()


def _kept(batch: pa.RecordBatch) -> dict:
    out = {"doc": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
    for d, t, spans in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
        raw = (t or "").encode()
        merged: list[list[int]] = []
        for s in sorted((s["start"], s["start"] + s["n"] + WINDOW - 1) for s in spans or ()):
            if s[0] >= len(raw):
                continue
            end = min(s[1], len(raw))
            if merged and s[0] <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([s[0], end])
        left, at = [], 0
        for a, b in merged:
            left.append(raw[at:a])
            at = b
        left.append(raw[at:])
        kept = b"".join(left)
        out["doc"].append(d)
        out["n_bytes"].append(len(raw))
        out["n_removed"].append(len(raw) - len(kept))
        out["n_spans"].append(len(merged))
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        out["kept"].append(kept)
    return out


def repeated_strings(docs: DataFrame) -> DataFrame:
    """``(doc, start, n)``: from ``start`` on, ``n`` strings in a row that also start earlier."""
    spark = docs.sparkSession
    pairs = id_and_text(docs).select(order_id().alias("doc"), "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = map_batches(pairs, _anchors, _RUN, COLLAPSE)
    found = runs.repartition(parts, "seed").sortWithinPartitions("seed", "whole", "doc", "start").mapInArrow(_copies, _FOUND)
    found = cut(found, "suffix-runs")
    wanted = found.filter(F.col("seed").isNotNull())
    strings = wanted.agg(F.sum("n")).first()[0] or 0
    hot = wanted.groupBy("seed").count().filter(F.col("count") > HOT_RUNS).select("seed", F.lit(True).alias("hot"))
    per_doc = (
        wanted.join(hot, "seed", "left")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("seed", "start", "n", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("runs"))
    )
    contexts = map_batches(pairs.join(per_doc, "doc").select("doc", "text", "runs"), _contexts, "key long, doc long, start long, bytes binary")
    tasks = max(parts, -(-strings // TASK_STRINGS))
    resolved = contexts.repartition(tasks, "key").sortWithinPartitions("doc", "start").mapInArrow(_family, _FOUND)
    return found.filter(F.col("seed").isNull()).unionByName(resolved).drop("seed")


def dedup(docs: DataFrame, with_bytes: bool = False) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row per input row; with ``with_bytes`` also ``kept``.

    Null or empty text: no bytes, nothing removed. A null id counts as smaller than every other. Rows that share an
    id are one document: a string is no repeat of the same string at the same place. An empty table gives an
    empty result. Other columns of ``docs`` are left out.
    """
    spans = repeated_strings(docs).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    joined = id_and_text(docs).select(order_id().alias("doc"), "text").join(spans, "doc", "left").select("doc", "text", "spans")
    schema = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    return map_batches(joined, _kept, schema).select(original_id("doc").alias("doc_id"), *[c.split()[0] for c in schema.split(", ")[1:]])
