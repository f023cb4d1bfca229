from itertools import combinations
from math import comb

import numpy as np
import pytest

from riskloom.functions.ks_law import path_share
from riskloom.operators.drift import DriftAnalysis


def gap(first, m, n):
    """Largest gap of the running shares when the first sample holds these places."""
    a = b = 0
    out = 0.0
    for k in range(m + n):
        if k in first:
            a += 1
        else:
            b += 1
        out = max(out, abs(a / m - b / n))
    return out


@pytest.mark.parametrize("m, n", [(1, 1), (1, 5), (3, 3), (4, 6), (5, 5), (2, 7), (6, 4)])
def test_equal_to_counting_all_interleavings(m, n):
    gaps = [gap(set(c), m, n) for c in combinations(range(m + n), m)]
    for d in sorted(set(gaps)):
        want = sum(g >= d - 1e-9 for g in gaps) / comb(m + n, m)
        assert path_share(d, m, n) == pytest.approx(want, abs=1e-12)
    assert path_share(0.0, m, n) == 1.0


def test_known_values():
    # Tail of a full separation: 2 of comb(m + n, m) interleavings.
    assert path_share(1.0, 10, 10) == pytest.approx(2 / comb(20, 10), rel=1e-12)
    assert path_share(1.0, 30, 20) == pytest.approx(2 / comb(50, 20), rel=1e-9)
    # Large samples come close to the limit law.
    lam = 1.2
    limit = 2 * sum((-1) ** (k - 1) * np.exp(-2 * k * k * lam * lam) for k in range(1, 50))
    assert path_share(lam / np.sqrt(2_500), 5_000, 5_000) == pytest.approx(limit, rel=0.03)


def test_the_report_takes_the_exact_law_for_small_samples(spark):
    rows = [(k % 2, "small", float(k % 7 + 3 * (k % 2))) for k in range(60)] + [(0, "empty", 1.0)]
    df = spark.createDataFrame(rows, "side int, feature string, x double")
    got = {r.feature: r for r in DriftAnalysis(df).ks().collect()}
    assert got["small"].ks_pvalue == pytest.approx(path_share(got["small"].ks_stat, 30, 30), rel=1e-12) and got["empty"].ks_pvalue is None
    series = {r.feature: r for r in DriftAnalysis(df, ks_law="series").ks().collect()}
    assert series["small"].ks_stat == got["small"].ks_stat and abs(series["small"].ks_pvalue - got["small"].ks_pvalue) > 1e-6
    with pytest.raises(ValueError):
        DriftAnalysis(df, ks_law="other")
