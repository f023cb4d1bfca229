"""Column expressions for statistics (all JVM-side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms of the Kolmogorov series and the lambda below which the
# two-sided p-value is taken as 1 (Q(0.2) = 1 - 1e-8).
KS_SERIES_TERMS = 100
KS_LAMBDA_FLOOR = 0.2


def ks_pvalue(stat: Column, n1: Column, n2: Column) -> Column:
    """Two-sided two-sample KS p-value, Kolmogorov series with Stephens' correction.

    ``Q(lam) = 2 * sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lam^2)`` with
    ``lam = (sqrt(m) + 0.12 + 0.11 / sqrt(m)) * D`` and ``m = n1 n2 / (n1 + n2)``.
    """
    m = (n1.cast("double") * n2.cast("double")) / (n1 + n2).cast("double")
    lam = (F.sqrt(m) + F.lit(0.12) + F.lit(0.11) / F.sqrt(m)) * stat
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_SERIES_TERMS)),
        F.lit(0.0).cast("double"),
        lambda acc, k: acc
        + F.pow(F.lit(-1.0), (k - 1).cast("double"))
        * F.exp(F.lit(-2.0) * (k * k).cast("double") * lam * lam),
    )
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    return (
        F.when((n1 <= 0) | (n2 <= 0) | stat.isNull(), F.lit(None).cast("double"))
        .when(lam < F.lit(KS_LAMBDA_FLOOR), F.lit(1.0))
        .otherwise(p)
    )


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def nan_to_null(c: Column) -> Column:
    """NaN -> NULL (Spark orders NaN above every number; pandas treats it as missing)."""
    return F.nanvl(c, F.lit(None).cast("double"))


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """``num / den``, ``default`` when the denominator is 0 (ANSI division throws)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def round6(c: Column) -> Column:
    return F.round(c.cast("double"), 6)


def balanced_sum(terms: list[Column]) -> Column:
    """Sum as a balanced tree (depth log2 n): long left-nested sums overflow the
    analyzer's recursion for a few hundred terms."""
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        terms = [terms[i] + terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]
