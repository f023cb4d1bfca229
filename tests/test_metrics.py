"""Score metrics on tiny vectors and seeded data, checked against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.metrics import ScoreCurve, brier, metrics_at_threshold, reliability_curve


def frame(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")


def brute_ap(y, p):
    y, p = np.asarray(y), np.asarray(p)
    P = y.sum()
    ap = 0.0
    for t in np.unique(p)[::-1]:
        sel = p >= t
        tp = (y[sel] == 1).sum()
        here = ((p == t) & (y == 1)).sum()
        ap += here / P * tp / sel.sum()
    return ap


def brute_auc(y, p):
    y, p = np.asarray(y), np.asarray(p)
    pos, neg = p[y == 1], p[y == 0]
    s = sum((pi > neg).sum() + 0.5 * (pi == neg).sum() for pi in pos)
    return s / (len(pos) * len(neg))


def test_perfect_order_of_uneven_classes(spark):
    df = frame(spark, [1, 0, 1, 0, 0, 0, 1], [0.95, 0.35, 0.7, 0.1, 0.05, 0.35, 0.61])
    s = ScoreCurve(df).summary().first()
    assert (s["n"], s["positives"], s["average_precision"], s["roc_auc"]) == (7, 3, 1.0, 1.0)
    assert brier(df).first()["brier"] == pytest.approx((0.05**2 + 0.35**2 * 2 + 0.3**2 + 0.1**2 + 0.05**2 + 0.39**2) / 7)


def test_no_threshold_reaches_the_target(spark):
    df = frame(spark, [0, 1, 0, 1, 0], [0.9, 0.8, 0.8, 0.3, 0.3])
    t = ScoreCurve(df).threshold_for_precision(0.75).first()
    assert (t["threshold"], t["reachable"]) == (1.0, False)


def test_lowest_threshold_that_reaches_the_target(spark):
    y = [1, 1, 0, 1, 1, 0, 0, 1, 0, 0]
    p = [0.99, 0.9, 0.85, 0.8, 0.75, 0.5, 0.45, 0.4, 0.2, 0.1]
    # precision by threshold: 1, 1, 2/3, 3/4, 4/5, 4/6, 4/7, 5/8, ...
    t = ScoreCurve(frame(spark, y, p)).threshold_for_precision(0.7).first()
    assert (t["threshold"], t["reachable"]) == (0.75, True)
    m = metrics_at_threshold(frame(spark, y, p), 0.75).first()
    assert (m["tp"], m["fp"], m["fn"]) == (4, 1, 1)


def test_ap_and_auc_match_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.random(800), 2)
    y = (rng.random(800) < p * 0.6).astype(int)
    s = ScoreCurve(frame(spark, y, p)).summary().first()
    assert s["average_precision"] == pytest.approx(brute_ap(y, p), abs=1e-12)
    assert s["roc_auc"] == pytest.approx(brute_auc(y, p), abs=1e-12)


def test_pr_curve_per_distinct_score(spark):
    rng = np.random.default_rng(4)
    p = np.round(rng.random(300), 1)
    y = (rng.random(300) < 0.3).astype(int)
    rows = ScoreCurve(frame(spark, y, p)).pr_curve().collect()
    assert len(rows) == len(np.unique(p))
    for r in rows:
        sel = p >= r["threshold"]
        assert r["tp"] == y[sel].sum() and r["n_flagged"] == sel.sum()


def test_reliability_curve_bins(spark):
    rng = np.random.default_rng(5)
    p = rng.random(500)
    y = (rng.random(500) < p).astype(int)
    rows = reliability_curve(frame(spark, y, p), n_bins=5).orderBy("bin").collect()
    edges = np.quantile(p, np.linspace(0, 1, 6))
    ids = np.searchsorted(edges[1:-1], p, side="left")
    exp = [p[ids == b].mean() for b in range(5) if (ids == b).any()]
    assert [r["mean_p"] for r in rows] == pytest.approx(exp)


def test_confusion_metrics_zero_when_undefined(spark):
    m = metrics_at_threshold(frame(spark, [0, 0], [0.1, 0.2]), 0.5).first()
    assert (m["precision"], m["recall"], m["f1"], m["n_flagged"]) == (0.0, 0.0, 0.0, 0)
