"""Exact law of the two-sample Kolmogorov-Smirnov statistic.

Under the hypothesis every interleaving of the two samples is equally likely: a lattice path from (0, 0) to (n1, n2). The p-value is
the share of paths that somewhere reach a gap of at least the observed one between the two running shares. Seen from its
end, a path that has taken i and j steps came from (i - 1, j) with chance i / (i + j), so the share is a recursion over the diagonals
i + j = s; only the points whose gap is smaller are kept, all others have share 1.
"""

from __future__ import annotations

from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rows of the larger sample up to which the exact law is used (fixed value).
EXACT_ROWS = 10_000


def path_share(stat: float, n1: int, n2: int) -> float:
    """P(gap >= stat) for samples of n1 and n2 rows without ties."""
    unit = gcd(n1, n2)
    a, b = n1 // unit, n2 // unit  # a step in the first sample moves the gap by b, one in the second by -a
    reach = round(stat * a * n2)
    if reach <= 0:
        return 1.0
    lo, hi, share = 0, 0, np.zeros(1)
    for s in range(1, n1 + n2 + 1):
        # i b - (s - i) a lies strictly between -reach and reach
        new_lo = max((s * a - reach) // (a + b) + 1, 0, s - n2)
        new_hi = min(-((-s * a - reach) // (a + b)) - 1, n1, s)
        if new_lo > new_hi:
            return 1.0
        before = np.ones(new_hi - new_lo + 2)  # shares of i = new_lo - 1 .. new_hi on the diagonal before
        p, q = max(lo, new_lo - 1), min(hi, new_hi)
        if p <= q:
            before[p - new_lo + 1 : q - new_lo + 2] = share[p - lo : q - lo + 1]
        i = np.arange(new_lo, new_hi + 1)
        share = (before[:-1] * i + before[1:] * (s - i)) / s
        lo, hi = new_lo, new_hi
    return float(min(max(share[n1 - lo], 0.0), 1.0))


def ks_pvalue_exact(stat: Column, n1: Column, n2: Column) -> Column:
    """Two-sided p-value by the exact law; null if a sample is empty. Meant for reports of a row per feature."""

    @F.pandas_udf("double")
    def exact(d: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        rows = zip(d, a, b, strict=True)
        return pd.Series([None if pd.isna(x) or not m or not n else path_share(float(x), int(m), int(n)) for x, m, n in rows], dtype="float64")

    return exact(stat, n1, n2)
