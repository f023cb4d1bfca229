"""Token ids of a corpus in Parquet files of Re-Pair grammars, with random access.

1. *Order.* Documents are range-partitioned and sorted by id; rows with one id are dealt on by their text and place, so that a
   repeated id does not fill one task.
2. *Shards.* Each task encodes its documents one after another, puts the end id behind each and cuts the ids into shards of about
   ``SHARD`` ids at the ends of documents (a longer document is a shard of its own).
3. *Grammar.* The ids of a shard are compressed by Re-Pair: frequent pairs of neighbours are replaced by a new id, the
   nonterminal, again and again. A round replaces, most frequent first, every pair that does not overlap a more frequent one. Pairs
   are counted in a hashed table that holds one pair for each slot; pairs that meet another one there have their turn in a later round.
4. *Files.* One Parquet row for each shard: document ids and ends, rules (a pair for each nonterminal), the expansion length of each
   rule, the compressed ids. A small index beside it holds the first position of each shard.
5. *Access.* ``read`` expands whole shards; ``fetch`` expands only the symbols under the wanted stretch of a document: running
   sums of expansion lengths tell where it begins.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import arrow_schema, id_and_text, order_id, original_id, record_batch, sliced
from riskloom.llm.word_ids import encoder, ragged

#: Ids of a shard (more only if one document has more).
SHARD = 1 << 20
#: A pair is replaced if that many of its places can be; rounds end when one shortens the shard by less than one in GAIN.
LEAST, GAIN = 8, 32
#: Slots of the pair table, as a power of two.
BITS = 18

_ROW = "part int, shard int, doc_id array<long>, end array<long>, n_tokens long, first int, levels array<int>, rules binary, lengths binary, width int, ids binary"


class Grammar:
    """Ids as rules and a sequence: id ``first + k`` stands for the two ids ``rules[k]``, which are less."""

    def __init__(self, first: int, levels: list[int], rules: np.ndarray, lengths: np.ndarray, sequence: np.ndarray) -> None:
        self.first, self.levels, self.rules, self.lengths, self.sequence = first, levels, rules, lengths, sequence
        self._flat: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
        self._ends: np.ndarray | None = None

    @classmethod
    def of(cls, ids: np.ndarray) -> Grammar:
        """Re-Pair of an array of ids (below 2^31)."""
        first = int(ids.max()) + 1 if len(ids) else 0
        slots = 1 << BITS
        sequence, rules, lengths, levels, total = ids.astype(np.uint32), [], [], [], 0
        known = np.zeros(0, np.int64)
        for turn in range(64):
            n = len(sequence)
            if n < 2 * LEAST:
                break
            h = sequence[:-1] * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            h += sequence[1:]
            h *= np.uint32(0x85EBCA6B + 15838 * turn)
            h = (h >> np.uint32(32 - BITS)).astype(np.int64)
            pair = sequence[:-1].astype(np.uint64)
            pair <<= np.uint64(32)
            pair |= sequence[1:]
            holder = np.zeros(slots, np.uint64)
            holder[h] = pair
            mine = holder[h] == pair
            count = np.bincount(h[mine], minlength=slots)
            often = np.flatnonzero(count >= LEAST)
            rank = np.zeros(slots, np.int32)
            rank[often[np.argsort(count[often], kind="stable")]] = np.arange(1, len(often) + 1, dtype=np.int32)
            order = rank[h]
            order *= mine
            best = order > 0
            best[1:] &= order[1:] >= order[:-1]
            best[:-1] &= order[:-1] >= order[1:]
            at = np.flatnonzero(best)
            # Neighbours that are both best are one pair of equal ids in a row: every other one is replaced.
            joined = np.zeros(len(at), bool)
            joined[1:] = at[1:] == at[:-1] + 1
            if joined.any():
                place = np.arange(len(at))
                at = at[(place - np.maximum.accumulate(np.where(joined, 0, place))) % 2 == 0]
            slot = h[at]
            used = np.flatnonzero(np.bincount(slot, minlength=slots) >= LEAST)
            name = np.zeros(slots, np.uint32)
            name[used] = first + total + np.arange(len(used), dtype=np.uint32)
            new = name[slot]
            at, new = at[new > 0], new[new > 0]
            if not len(at):
                break
            held = holder[used]
            rule = np.stack([(held >> np.uint64(32)).astype(np.uint32), held.astype(np.uint32)], 1)
            length = cls._long(rule, first, known).sum(1)
            rules.append(rule)
            lengths.append(length)
            known = np.concatenate([known, length])
            total += len(used)
            levels.append(total)
            sequence[at] = new
            keep = np.ones(n, bool)
            keep[at + 1] = False
            sequence = sequence[keep]
            if len(at) * GAIN < n:
                break
        return cls(first, levels, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), known.astype(np.uint32), sequence)

    @staticmethod
    def _long(ids: np.ndarray, first: int, lengths: np.ndarray) -> np.ndarray:
        """How many ids each symbol stands for."""
        k = ids.astype(np.int64) - first
        out = np.ones(ids.shape, np.int64)
        out[k >= 0] = lengths[k[k >= 0]]
        return out

    def _expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all symbols one after another, where each begins and how long it is: one level of rules at a time."""
        if self._flat is None:
            length = np.concatenate([np.ones(self.first, np.int64), self.lengths.astype(np.int64)])
            begin = np.cumsum(length) - length
            flat = np.zeros(int(length.sum()), np.uint32)
            flat[: self.first] = np.arange(self.first)
            done = 0
            for upto in self.levels:
                pairs = self.rules[done:upto].ravel()
                made = ragged(flat, begin[pairs], length[pairs])
                at = int(begin[self.first + done])
                flat[at : at + len(made)] = made
                done = upto
            self._flat = flat, begin, length
        return self._flat

    def expand(self) -> np.ndarray:
        """All ids."""
        flat, begin, length = self._expansions()
        return ragged(flat, begin[self.sequence], length[self.sequence])

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` (exclusive): only the symbols that reach into them are expanded, rule by rule."""
        if self._ends is None:
            self._ends = np.cumsum(self._long(self.sequence, self.first, self.lengths))
        total = int(self._ends[-1]) if len(self._ends) else 0
        start, stop = max(0, min(start, total)), max(0, min(stop, total))
        if stop <= start:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self._ends, [start, stop - 1], "right")
        skip = start - (int(self._ends[a - 1]) if a else 0)
        symbols = self.sequence[a : b + 1]
        while (symbols >= self.first).any():
            rule = symbols >= self.first
            wide = np.where(rule, 2, 1)
            at = np.cumsum(wide) - wide
            out = np.empty(int(wide.sum()), np.uint32)
            out[at[~rule]] = symbols[~rule]
            pair = self.rules[symbols[rule].astype(np.int64) - self.first]
            out[at[rule]], out[at[rule] + 1] = pair[:, 0], pair[:, 1]
            symbols = out
        return symbols[skip : skip + stop - start]

    def stored(self) -> dict:
        """The columns of a file's row."""
        width = 2 if self.first + len(self.rules) <= 1 << 16 else 4
        return {"first": self.first, "levels": self.levels, "rules": self.rules.astype("<u4").tobytes(), "lengths": self.lengths.astype("<u4").tobytes(), "width": width, "ids": self.sequence.astype(f"<u{width}").tobytes()}

    @classmethod
    def load(cls, row: dict) -> Grammar:
        rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
        sequence = np.frombuffer(row["ids"], f"<u{row['width']}").astype(np.uint32)
        return cls(row["first"], list(row["levels"]), rules, np.frombuffer(row["lengths"], "<u4"), sequence)


def _shards(batches: Iterator[pa.RecordBatch], path: str, end_id: int, most: int) -> Iterator[pa.RecordBatch]:
    target = arrow_schema(_ROW)
    part, shard = TaskContext.get().partitionId(), 0
    encode = encoder(path).encode
    docs, pieces, held = [], [], 0
    end = np.array([end_id], np.uint32)

    def out() -> pa.RecordBatch:
        ids = np.concatenate([x for p in pieces for x in (p, end)])
        ends = np.cumsum([len(p) + 1 for p in pieces])
        row = {"part": part, "shard": shard, "doc_id": docs, "end": ends, "n_tokens": len(ids)} | Grammar.of(ids).stored()
        return record_batch({k: [v] for k, v in row.items()}, target)

    for batch in batches:
        for some in sliced(batch):
            texts = [t or "" for t in some.column("text").to_pylist()]
            for doc, ids in zip(some.column("doc").to_pylist(), encode(texts), strict=True):
                if held and held + len(ids) > most:
                    yield out()
                    docs, pieces, held, shard = [], [], 0, shard + 1
                docs.append(doc)
                pieces.append(ids)
                held += len(ids) + 1
    if docs:
        yield out()


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1, shard: int = SHARD) -> None:
    """Encode every text and write the store under ``path``, which must not exist, in ascending order of ids.

    ``tokenizer``: a ``tokenizer.json`` that every executor can open; ``shard``: ids of a shard. Null text: as the empty one, only the end id. Null id: before
    every other. Rows with one id keep all their rows, in the order of a hash of their text. Texts of any length are encoded
    whole, so a task needs memory for its longest text. Empty table: an empty store. Other columns are ignored.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = id_and_text(docs).select(order_id().alias("doc"), "text", F.xxhash64("text").alias("_1"), F.monotonically_increasing_id().alias("_2"))
    dealt = rows.repartitionByRange(parts, "doc", "_1", "_2").sortWithinPartitions("doc", "_1", "_2").select("doc", "text")
    dealt.mapInArrow(lambda batches: _shards(batches, tokenizer, end_id, shard), _ROW).write.parquet(f"{path}/data")
    held = spark.read.schema(_ROW).parquet(f"{path}/data").select("part", "shard", "n_tokens")
    # Two steps of running sums: inside a part, and over the parts, of which there are as many as shuffle partitions.
    totals = held.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts_before = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    index = held.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts_before, "part")
    index.select("part", "shard", (F.col("base") + F.col("inside")).alias("start")).write.parquet(f"{path}/index")


def shards(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard as stored."""
    return spark.read.schema(_ROW).parquet(f"{path}/data")


def index(spark: SparkSession, path: str) -> DataFrame:
    """``(part, shard, start)``: ids of all documents before each shard."""
    return spark.read.schema("part int, shard int, start long").parquet(f"{path}/index")


def _documents(batches: Iterator[pa.RecordBatch], columns: dict[str, Callable], target: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            ids = Grammar.load(row).expand()
            ends = row["end"]
            begins = [0, *ends[:-1]]
            out = {"part": [row["part"]] * len(ends), "shard": [row["shard"]] * len(ends), "doc": row["doc_id"], "offset": begins, "n_tokens": [b - a for a, b in zip(begins, ends)]}
            out |= {name: [f(ids[a:b]) for a, b in zip(begins, ends)] for name, f in columns.items()}
            yield record_batch(out, target)


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document in the store, with its end id; with ``with_ids`` also ``ids``.

    ``start``: ids of all documents before it. ``ids_crc32``: unsigned CRC-32 of its ids as little-endian unsigned 32-bit integers.
    """
    columns = {"ids_crc32": lambda x: zlib.crc32(x.astype("<u4").tobytes())} | ({"ids": lambda x: x.astype(np.int32)} if with_ids else {})
    schema = "part int, shard int, doc long, offset long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    target = arrow_schema(schema)
    rows = shards(spark, path).mapInArrow(lambda batches: _documents(batches, columns, target), schema)
    placed = rows.join(index(spark, path), ["part", "shard"])
    return placed.select(original_id("doc").alias("doc_id"), (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] * with_ids))


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, shard, is request): the shard, then the stretches wanted from it."""
    target = arrow_schema("doc long, from long, to long, ids array<int>")
    grammar = None
    for batch in batches:
        out: dict[str, list] = {"doc": [], "from": [], "to": [], "ids": []}
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            if not row["request"]:
                grammar = Grammar.load(row)
                continue
            out["doc"].append(row["doc"])
            out["from"].append(row["from"])
            out["to"].append(row["to"])
            out["ids"].append(grammar.slice(row["begin"] + row["from"], min(row["begin"] + row["to"], row["stop"])).astype(np.int32))
        yield record_batch(out, target)


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``(doc_id, from, to, ids)``: ids ``from`` to ``to`` (exclusive, counted in the document, its end id included) of ``wanted(doc_id, from, to)``.

    A stretch behind the document's end gives what there is; an id that the store does not have gives no row, one that it has
    several times a row for each, a null stretch or one that begins before 0 no row. Only the shards that are asked for are read by more than their ids.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    where = shards(spark, path).select("part", "shard", F.posexplode(F.arrays_zip("doc_id", "end")).alias("at", "x"), "end")
    where = where.select("part", "shard", F.col("x.doc_id").alias("doc"), F.when(F.col("at") > 0, F.col("end")[F.col("at") - 1]).otherwise(F.lit(0)).cast("long").alias("begin"), F.col("x.end").alias("stop"))
    asked = wanted.select(order_id().alias("doc"), F.col("from").cast("long").alias("from"), F.col("to").cast("long").alias("to")).filter((F.col("from") >= 0) & F.col("to").isNotNull())
    requests = asked.join(where, "doc").withColumn("request", F.lit(True))
    stored = shards(spark, path).drop("doc_id", "end", "n_tokens").join(requests.select("part", "shard").distinct(), ["part", "shard"], "left_semi").withColumn("request", F.lit(False))
    both = stored.unionByName(requests, allowMissingColumns=True)
    met = both.repartition(parts, "part", "shard").sortWithinPartitions("part", "shard", "request")
    return met.mapInArrow(_fetched, "doc long, from long, to long, ids array<int>").select(original_id("doc").alias("doc_id"), "from", "to", "ids")

