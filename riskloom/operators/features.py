"""Projection of a table onto the features a spec declares: one ``select``, the same for training and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.spec import JobSpec


def q(name: str) -> Column:
    """Column by name, safe for spaces, slashes and parentheses."""
    return F.col(f"`{name}`")


def project(spec: JobSpec, df: DataFrame, keep: Sequence[str] = ()) -> tuple[DataFrame, list[str], list[str]]:
    """``(frame, numbers, categories)``: ``keep`` columns, the features that ``df`` can give, the target if it is there.

    Numbers and categories are the names of the features in the frame. A derived feature whose name the table
    already uses for something else is an error, as one of the two would be lost.
    """
    given = [f for f in spec.features if set(f.needs) <= set(df.columns)]
    taken = [f.name for f in given if f.name not in f.needs and f.name in df.columns and f.name not in keep]
    if taken:
        raise ValueError(f"features clash with columns of the table: {taken}")
    names = {f.name for f in given}
    columns = [q(k) for k in keep if k not in names] + [f.column(df).alias(f.name) for f in given]
    if spec.target in df.columns:
        columns.append(q(spec.target).cast("int").alias(spec.target))
    return df.select(*columns), [f.name for f in given if not f.categorical], [f.name for f in given if f.categorical]
