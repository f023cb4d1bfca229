"""Drift: metamorphic cases and brute-force checks of PSI and KS."""

import bisect
import math

import numpy as np
import pytest

from riskloom.operators.drift import DriftAnalysis, long_values, union_sides


def analysis(spark, ref, cur, **kw):
    r = spark.createDataFrame([(float(v),) for v in ref], "x double")
    c = spark.createDataFrame([(float(v),) for v in cur], "x double")
    return DriftAnalysis.from_tables(r, c, ["x"], **kw)


def counted_psi(expected, actual, cuts):
    """PSI of samples over bins [a, b) between the given inner cuts, from counts by sorted search."""
    total = 0.0
    shares = []
    for sample in (sorted(expected), sorted(actual)):
        below = [0, *(bisect.bisect_left(sample, c) for c in cuts), len(sample)]
        shares.append([max((b - a) / len(sample), 1e-6) for a, b in zip(below, below[1:])])
    for e, a in zip(*shares):
        total += (a - e) * math.log(a / e)
    return total


def inner_cuts(sample, bins=10):
    """Inner cut points of a sample without ties: order statistics, linear between neighbours."""
    s, out = sorted(sample), []
    for k in range(1, bins):
        at = (len(s) - 1) * k / bins
        low = math.floor(at)
        out.append(s[low] + (at - low) * (s[min(low + 1, len(s) - 1)] - s[low]))
    return out


def test_identical_samples_do_not_drift(spark):
    x = np.random.default_rng(0).normal(size=5000)
    rep = analysis(spark, x, x).report().first()
    assert rep["psi"] < 1e-6 and rep["drifted"] is False


def test_shifted_sample_drifts(spark):
    rng = np.random.default_rng(1)
    d = analysis(spark, rng.normal(size=3000), rng.normal(2, 1, size=3000))
    rep = d.report().first()
    assert rep["psi"] > 0.2 and rep["drifted"] is True
    roll = d.rollup().first()
    assert roll["any_drift"] and roll["drifted_features"] == "x"


def test_psi_equals_counts_between_quantiles(spark):
    rng = np.random.default_rng(2)
    ref, cur = rng.normal(size=1237), rng.normal(0.3, 1.2, size=911)
    assert analysis(spark, ref, cur).psi().first()["psi"] == pytest.approx(counted_psi(ref, cur, inner_cuts(ref)), abs=1e-9)


def test_constant_and_two_valued_reference(spark):
    assert analysis(spark, [3.0] * 50, [1.0, 2.0, 3.0]).psi().first()["psi"] == 0.0
    two = [0.0] * 60 + [1.0] * 40
    # the 0.6 quantile lies between the two values, at 0.4: one cut
    assert analysis(spark, two, [1.0] * 100).psi().first()["psi"] == pytest.approx(counted_psi(two, [1.0] * 100, [0.4]))
    even = [0.0] * 50 + [1.0] * 50 + [1.0]
    assert analysis(spark, even, [1.0] * 100).psi().first()["psi"] == 0.0


def test_ks_statistic_brute_force_and_symmetry(spark):
    rng = np.random.default_rng(3)
    a, b = np.round(rng.normal(size=400), 1), np.round(rng.normal(0.2, 1, size=300), 1)
    grid = np.unique(np.concatenate([a, b]))
    brute = max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)
    ab = analysis(spark, a, b).ks().first()
    ba = analysis(spark, b, a).ks().first()
    assert ab["ks_stat"] == pytest.approx(brute, abs=1e-12)
    assert ba["ks_stat"] == pytest.approx(ab["ks_stat"]) and ba["ks_pvalue"] == pytest.approx(ab["ks_pvalue"])
    assert 0.0 <= ab["ks_pvalue"] <= 1.0


def test_nan_and_null_dropped_per_feature_and_empty_side_is_null(spark):
    ref = spark.createDataFrame([(1.0, None), (float("nan"), 2.0), (3.0, 4.0)], "a double, b double")
    cur = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    d = DriftAnalysis(long_values(union_sides(ref, cur, ["a", "b"]), ["a", "b"]))
    ks = {r["feature"]: r for r in d.ks().collect()}
    assert (ks["a"]["n_ref"], ks["a"]["n_cur"]) == (2, 2)
    psi = {r["feature"]: r["psi"] for r in d.psi().collect()}
    assert psi["b"] is None
