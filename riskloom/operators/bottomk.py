"""The k least keys of each group in one pass: an aggregate that merges in a tree.

A window over a group would bring a hot group's rows to one task. Here each task keeps the k least keys of every group it
sees, and the tasks' results meet ``FAN_IN`` at a time until one is left, so no task holds more than ``FAN_IN`` x groups x k
keys, however many rows a group has. The rows that are left out are counted on the way, so the group's size comes with the keys.
For few groups (strata, languages): every task may keep k keys of each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.prefix import cut

FAN_IN = 16
_GROUP, _N, _PART = "_rl_group", "_rl_n", "_rl_part"


def _least(frames: list[pd.DataFrame], order: list[str], k: int) -> pd.DataFrame:
    """The k least rows of each group; the first one carries the counts of those that go."""
    rows = pd.concat(frames, ignore_index=True).sort_values([_GROUP, *order], kind="stable", ignore_index=True)
    place = rows.groupby(_GROUP, sort=False, dropna=False).cumcount()
    total = rows.groupby(_GROUP, sort=False, dropna=False)[_N].transform("sum")
    kept = rows[place < k].copy()
    kept[_N] = total[place < k].where(place[place < k] == 0, 0)
    return kept


def least_keys(df: DataFrame, group_col: str, order_cols: Sequence[str], k: int) -> DataFrame:
    """``(group, order..., rank, size)``: for each non-null group its k least keys with their 0-based rank, and its number of rows.

    Keys are compared column by column, ascending, as text or numbers; rows with a null in the key come last, among themselves
    in no order, and count in the size. Equal keys are all kept. ``df`` is read once.
    """
    order = [f"_rl_o{i}" for i in range(len(order_cols))]
    rows = df.where(F.col(f"`{group_col}`").isNotNull()).select(
        F.col(f"`{group_col}`").alias(_GROUP), *[F.col(f"`{c}`").alias(o) for c, o in zip(order_cols, order)], F.lit(1).cast("long").alias(_N), F.lit(0).alias(_PART)
    )
    schema = rows.schema

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            if len(batch):
                held.append(batch)
                size += len(batch)
            if size > 4 * k * max(1, len(held[0][_GROUP].unique()) if held else 1) + 50_000:
                held = [_least(held, order, k)]
                size = len(held[0])
        if held:
            out = _least(held, order, k)
            out[_PART] = TaskContext.get().partitionId()
            yield out

    tree = cut(rows.mapInPandas(keep, schema))
    parts = tree.agg(F.max(_PART)).first()[0] or 0
    while parts:
        parts //= FAN_IN
        met = tree.withColumn(_PART, F.floor(F.col(_PART) / FAN_IN).cast("int")).repartition(parts + 1, _PART)
        tree = cut(met.groupBy(_PART).applyInPandas(lambda pdf: _least([pdf], order, k), schema))
    held = tree.select(_GROUP, *order, _N)

    def ranked(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pdf.sort_values(order, kind="stable", ignore_index=True)
        out["rank"], out["size"] = range(len(out)), out[_N].sum()
        return out.drop(columns=[_N])

    out = held.groupBy(_GROUP).applyInPandas(ranked, held.drop(_N).withColumns({"rank": F.lit(0).cast("long"), "size": F.lit(0).cast("long")}).schema)
    return out.withColumnsRenamed({_GROUP: group_col, **dict(zip(order, order_cols))})
