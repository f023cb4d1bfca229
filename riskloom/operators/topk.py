"""Composite score -> top-k label (the synthetic labelling rule, kept as an operator).

``score = sum w_i * z(x_i)`` with ``z(a) = (a - mean) / (std_pop + 1e-9)``; the label is
``score >= k-th largest score`` (ties included) with ``k = max(1, int(n * rate))``. The
k-th largest value comes from a distributed rank lookup, not a top-k in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.metrics import with_totals
from riskloom.operators.prefix import cumulative, cut, values_at_ranks

# Fixed value: denominator guard of the z-score.
Z_EPS = 1e-9


def with_zscores(df: DataFrame, cols: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Add population z-scores; the mean/std row is one aggregate, broadcast back."""
    stats = df.agg(
        *[x for c in cols for x in (F.avg(c).alias(f"_rl_m_{c}"), F.stddev_pop(c).alias(f"_rl_s_{c}"))]
    )
    out = with_totals(df, stats)
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", (F.col(c) - F.col(f"_rl_m_{c}")) / (F.col(f"_rl_s_{c}") + F.lit(Z_EPS)))
    return out.drop(*[f"_rl_{k}_{c}" for c in cols for k in ("m", "s")])


def topk_threshold(df: DataFrame, score_col: str, rate: float) -> DataFrame:
    """One-row frame ``(threshold)``: the k-th largest non-null score, ``k = max(1, int(n * rate))``; no row if there is none."""
    counts = df.where(F.col(score_col).isNotNull()).groupBy(score_col).agg(F.count(F.lit(1)).alias("_c"))
    cum = cut(cumulative(counts, [score_col], ["_c"], descending=True))
    sized = with_totals(cum, cum.agg(F.max("cum__c").alias("_n")))
    k = F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(rate)))
    rank = F.array(F.struct((k - F.lit(1)).alias("rank")))
    return values_at_ranks(sized, score_col, "_c", rank).select(F.col(score_col).alias("threshold"))


def topk_label(df: DataFrame, score_col: str, rate: float, label_col: str = "label") -> DataFrame:
    """Label 1 for a score at or above the k-th largest. ``df`` is read twice: its scores, then its rows."""
    threshold = topk_threshold(df.select(score_col), score_col, rate)
    out = with_totals(df, threshold.agg(F.max("threshold").alias("threshold")))
    return out.withColumn(label_col, F.coalesce(F.col(score_col) >= F.col("threshold"), F.lit(False)).cast("int")).drop("threshold")


def weighted_score(terms: Sequence[tuple[float, Column]]) -> Column:
    total = F.lit(0.0)
    for w, c in terms:
        total = total + F.lit(float(w)) * c
    return total
