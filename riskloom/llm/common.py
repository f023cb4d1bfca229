"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import scratch_path

#: Stands for a null doc_id wherever ids are ordered: before every other id.
NULL_ID = -(2**63)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the cluster's shared folder and read it back.

    A lost executor then costs a re-read, never a recomputation of an iteration.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def order_id(column: str = "doc_id") -> Column:
    """The id as a long that is never null (``NULL_ID``), for ordering and joining."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def original_id(column: str | Column) -> Column:
    """Undo ``order_id``."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != NULL_ID, column)


def id_and_text(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``: whatever else the table carries, and whatever it is called, stays out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


#: Bytes of text that an operator works on at once; a longer text stands alone.
SLICE = 4 << 20


def sliced(batch: pa.RecordBatch, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``most`` bytes of text, so that memory does not follow the length of the texts."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def give_back() -> None:
    """Return freed memory to the system: Python workers and the driver live on, and would keep what one stage needed at its peak."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that gives its memory back when its task ends."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return tidied


def map_batches(df: DataFrame, fn, schema: str, most: int = SLICE) -> DataFrame:
    """``mapInArrow`` over slices with ``fn(slice) -> dict of columns`` (or None for no rows).

    Output batches are made from one dict of plain lists / arrays, so an operator only states
    what it computes.
    """
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, most):
                out = fn(part)
                if out is not None:
                    yield record_batch(out, target)

    return df.mapInArrow(tidy(run), schema)


def filter_rows(df: DataFrame, keep) -> DataFrame:
    """The rows of ``df`` for which ``keep(batch)`` gives True, all columns as they are: no join, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch):
                yield part.filter(pa.array(keep(part), pa.bool_()))

    return df.mapInArrow(tidy(run), df.schema)


_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a flat "name type, name type" list; needs no session, so tasks can use it."""
    return pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def record_batch(columns: dict, target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in target], schema=target)


def texts_of(batch: pa.RecordBatch) -> list[str]:
    """Texts of a batch, null as the empty text."""
    return [t if t is not None else "" for t in batch.column("text").to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift, multiply)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))
