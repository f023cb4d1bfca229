"""Source cleaning: label binarisation, sentinel -> NULL, column drops, coercing casts.

All narrow, single-projection transformations (no shuffle).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the missing-value sentinel of the raw sources.
SENTINEL = "?"


def binarise(col: str, positive) -> Column:
    """``col == positive`` as 0/1; NULL compares as not equal (0)."""
    return F.coalesce(F.col(f"`{col}`") == F.lit(positive), F.lit(False)).cast("int")


def sentinel_to_null(df: DataFrame, sentinel: str = SENTINEL) -> DataFrame:
    """Replace the sentinel by NULL in every string column."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(F.nullif(c, F.lit(sentinel)).alias(f.name) if isinstance(f.dataType, T.StringType) else c)
    return df.select(*cols)


def drop_if_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def coerce_numeric(df: DataFrame, names: Sequence[str], to: str = "double") -> DataFrame:
    """``try_cast`` each present column (unparseable -> NULL)."""
    present = set(names)
    return df.select(
        *[
            (F.col(f"`{c}`").try_cast(to).alias(c) if c in present else F.col(f"`{c}`"))
            for c in df.columns
        ]
    )


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """The rows that have a target."""
    return df.na.drop(subset=[target])


def clean_source(
    df: DataFrame,
    *,
    label_source: str,
    positive,
    target: str,
    drop: Sequence[str] = (),
    numeric: Sequence[str] = (),
    sentinel: str = SENTINEL,
) -> DataFrame:
    """Binarise the label, drop its source and listed columns, NULL the sentinel,
    coerce numerics, drop rows with a NULL target."""
    out = df.withColumn(target, binarise(label_source, positive))
    out = drop_if_present(out, [label_source, *drop])
    out = sentinel_to_null(out, sentinel)
    out = coerce_numeric(out, numeric)
    return drop_null_target(out, target)
