"""Two-level running sums and rank lookups over a global order.

A window with ``orderBy`` but no ``partitionBy`` runs in a single task. Everything
ordered in this package (curves over scores, KS, exact quantiles, ordered splits) goes
through :func:`cumulative` instead:

1. The rows are range-partitioned by ``(group, key)`` and written once to the checkpoint
   folder, with the number of their range as bucket. Spark samples the ranges over the whole
   key, so a hot first key is split by the keys behind it, any number of groups shares
   the ranges, and there are as many buckets as partitions were asked for.
2. Bucket totals (at most buckets + groups rows) get exclusive running offsets from a window
   over that small table. How the offsets are joined back is left to Spark, which knows
   their size.
3. ``Window.partitionBy(group, bucket).orderBy(key)`` gives the local running sum.

The checkpoint fixes the ranges: a task that is run again after the loss of an executor
reads the same bucket numbers. Keys must be unique within a group (pre-aggregate or add a tie
key): rows with equal keys would get an arbitrary order among themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.session import checkpoint_root

GROUP_ALL = "_rl_all"
BUCKET = "_rl_bucket"


def literal(value, dtype: T.DataType) -> Column:
    """A literal of exactly the column's type, whatever the session time zone."""
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(dtype)
    return F.lit(value).cast(dtype)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder: computed once, survives executors, not cached."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def ranged(df: DataFrame, order: Sequence[Column], group_cols: Sequence[str], n_buckets: int | None = None) -> DataFrame:
    """``df`` with ``BUCKET``: contiguous ranges of ``(group, order)``, numbered in that order."""
    n = n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *[F.col(c) for c in group_cols], *order)
    return cut(dealt.withColumn(BUCKET, F.spark_partition_id()))


def cumulative(
    df: DataFrame,
    order_cols: Sequence[str],
    sum_cols: Sequence[str],
    *,
    group_cols: Sequence[str] = (),
    descending: bool = False,
    n_buckets: int | None = None,
    prefix: str = "cum_",
    keep_bucket: bool = False,
) -> DataFrame:
    """Add inclusive running sums ``cum_<c>`` of ``sum_cols`` over ``order_cols``.

    The order is ascending (or descending) lexicographic over ``order_cols``, nulls last, within
    each group of ``group_cols``. ``n_buckets`` defaults to the session's shuffle partitions.
    """
    order_cols, sum_cols, group_cols = list(order_cols), list(sum_cols), list(group_cols)
    base = df
    if not group_cols:
        base = base.withColumn(GROUP_ALL, F.lit(0))
        group_cols = [GROUP_ALL]
    order = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in order_cols]
    keyed = ranged(base, order, group_cols, n_buckets)

    totals = keyed.groupBy(*group_cols, BUCKET).agg(*[F.sum(c).alias(f"_rl_t_{c}") for c in sum_cols])
    before = Window.partitionBy(*group_cols).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_rl_g_{c}") for c in group_cols],
        F.col(BUCKET).alias("_rl_g_bucket"),
        *[F.coalesce(F.sum(f"_rl_t_{c}").over(before), F.lit(0)).alias(f"_rl_o_{c}") for c in sum_cols],
    )
    same = F.col(BUCKET) == F.col("_rl_g_bucket")
    for c in group_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_rl_g_{c}"))
    joined = keyed.join(offsets, same, "inner")

    here = Window.partitionBy(*group_cols, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = joined.select(
        *[F.col(f"`{c}`") for c in keyed.columns],
        *[(F.col(f"_rl_o_{c}") + F.sum(c).over(here)).alias(f"{prefix}{c}") for c in sum_cols],
    )
    drop = [] if keep_bucket else [BUCKET]
    if GROUP_ALL in out.columns and GROUP_ALL not in df.columns and not keep_bucket:
        drop.append(GROUP_ALL)
    return out.drop(*drop)


def row_index(df: DataFrame, order_cols: Sequence[str], *, name: str = "row_idx") -> DataFrame:
    """0-based global position under ``order_cols`` (which must be unique together)."""
    one = "_rl_one"
    out = cumulative(df.withColumn(one, F.lit(1).cast("long")), order_cols, [one])
    return out.withColumn(name, F.col(f"cum_{one}") - F.lit(1)).drop(one, f"cum_{one}")


def values_at_ranks(
    cum: DataFrame,
    value_col: str,
    count_col: str,
    ranks: Column,
    *,
    group_cols: Sequence[str] = (),
    cum_col: str | None = None,
) -> DataFrame:
    """``(group..., value, rank fields...)`` for each wanted rank of the sorted multiset ``(value, count)``.

    ``cum`` is the output of :func:`cumulative` over the distinct values, ``ranks`` an array of structs with
    a 0-based ``rank`` per row (it may depend on columns of the row, such as the group's size). A
    distinct value answers the ranks in its span ``[cum - count, cum)``, so every rank is answered by one
    row; the only rows left are those that answer something.
    """
    upper = F.col(cum_col or f"cum_{count_col}")
    lower = upper - F.col(count_col)
    mine = F.filter(ranks, lambda r: (r["rank"] >= lower) & (r["rank"] < upper))
    return cum.select(*group_cols, value_col, F.explode(mine).alias("_rl_hit")).select(*group_cols, value_col, "_rl_hit.*")
