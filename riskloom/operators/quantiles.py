"""Exact quantiles with linear interpolation, computed without one-task buffers.

``percentile`` keeps every value of a group in one aggregation buffer, which does not
survive a feature with billions of rows. Here the values are first counted per distinct
value, a running count gives every distinct value its rank span, and the two order
statistics around ``h = (n - 1) q`` are the values whose spans hold these ranks. The result equals
``numpy.quantile`` / DuckDB ``quantile_cont`` (``x_lo + (h - lo) * (x_hi - x_lo)``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.prefix import GROUP_ALL, cumulative, values_at_ranks


def _targets(n: Column, probs: Sequence[float]) -> Column:
    """Two ranks for each quantile of ``n`` values: ``array<struct<q_index, q, frac, which, rank>>``."""
    items = []
    for k, q in enumerate(probs):
        h = (n - F.lit(1)).cast("double") * F.lit(float(q))
        low = F.floor(h).cast("long")
        common = [F.lit(k).alias("q_index"), F.lit(float(q)).alias("q"), (h - low).alias("frac")]
        items.append(F.struct(*common, F.lit(0).alias("which"), low.alias("rank")))
        items.append(F.struct(*common, F.lit(1).alias("which"), F.least(low + F.lit(1), n - F.lit(1)).alias("rank")))
    return F.array(*items)


def quantiles_from_cumulative(
    cum: DataFrame,
    value_col: str,
    count_col: str,
    probs: Sequence[float],
    *,
    group_cols: Sequence[str] = (),
    cum_col: str | None = None,
) -> DataFrame:
    """``(group..., q_index, q, quantile)`` from :func:`cumulative` output; groups without a value are left out.

    One row per group with its size is joined on; Spark broadcasts it by its measured size.
    """
    cg = list(group_cols) or [GROUP_ALL]
    cum_col = cum_col or f"cum_{count_col}"
    src = cum if group_cols or GROUP_ALL in cum.columns else cum.withColumn(GROUP_ALL, F.lit(0))
    sizes = src.groupBy(*cg).agg(F.max(cum_col).alias("_rl_n")).where(F.col("_rl_n") > 0)
    sized = src.join(sizes, cg).withColumn("_rl_targets", _targets(F.col("_rl_n"), probs))
    hits = values_at_ranks(sized, value_col, count_col, F.col("_rl_targets"), group_cols=cg, cum_col=cum_col)
    v = F.col(value_col)
    low, high = F.max(F.when(F.col("which") == 0, v)), F.max(F.when(F.col("which") == 1, v))
    out = hits.groupBy(*cg, "q_index", "q", "frac").agg(low.alias("_rl_lo"), high.alias("_rl_hi"))
    value = F.when(F.col("frac") == 0, F.col("_rl_lo")).otherwise(F.col("_rl_lo") + (F.col("_rl_hi") - F.col("_rl_lo")) * F.col("frac"))
    out = out.select(*cg, "q_index", "q", value.cast("double").alias("quantile"))
    return out if group_cols else out.drop(GROUP_ALL)


def exact_quantiles(
    df: DataFrame,
    value_col: str,
    probs: Sequence[float],
    *,
    group_cols: Sequence[str] = (),
) -> DataFrame:
    """``(group..., q_index, q, quantile)`` for the non-null values of ``value_col``."""
    cg = list(group_cols) or [GROUP_ALL]
    src = df if group_cols else df.withColumn(GROUP_ALL, F.lit(0))
    counts = src.where(F.col(value_col).isNotNull()).groupBy(*cg, value_col).agg(F.count(F.lit(1)).alias("_c"))
    cum = cumulative(counts, [value_col], ["_c"], group_cols=cg, keep_bucket=True)
    out = quantiles_from_cumulative(cum, value_col, "_c", probs, group_cols=cg)
    return out if group_cols else out.drop(GROUP_ALL)
