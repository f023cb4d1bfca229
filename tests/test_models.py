"""Calibration, boosted trees, the Laplace posterior, persistence and splits."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators.calibrate import IdentityMap, by_score, choose_map, fit_map
from riskloom.operators.models import fit_posterior
from riskloom.operators.scoring import ScoringModel
from riskloom.operators.splits import ordered_split, shuffle_split, stratified_sample
from riskloom.plans.train_job import train_model
from riskloom.spec import JobSpec, Trees, categories, numbers


def miscalibrated(spark, n=4000, seed=0):
    rng = np.random.default_rng(seed)
    true_p = rng.random(n)
    y = (rng.random(n) < true_p).astype(int)
    p = true_p**2.2
    return spark.createDataFrame([(i, int(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "k long, y int, p double")


def brier(df, col):
    return df.agg(F.avg(F.pow(F.col(col) - F.col("y"), 2))).first()[0]


def test_isotonic_lowers_brier_and_is_monotone(spark):
    df = miscalibrated(spark)
    out = fit_map("isotonic", by_score(df)).apply(df, "p", "p_cal")
    assert brier(out, "p_cal") < brier(df, "p")
    pts = sorted((r["p"], r["p_cal"]) for r in out.select("p", "p_cal").collect())
    assert all(b[1] >= a[1] - 1e-12 for a, b in zip(pts, pts[1:]))
    # the min-max formula at every score
    by_p = sorted((r["score"], r["n"], r["pos"]) for r in by_score(df.where("k < 300")).collect())
    few = fit_map("isotonic", by_score(df.where("k < 300"))).apply(df.where("k < 300"), "p", "c").select("p", "c").collect()
    n, pos = (np.concatenate([[0], np.cumsum([x[j] for x in by_p])]) for j in (1, 2))
    at = {x[0]: i for i, x in enumerate(by_p)}
    for r in few:
        i = at[r["p"]]
        low = max(min((pos[k + 1] - pos[j]) / (n[k + 1] - n[j]) for k in range(i, len(by_p))) for j in range(i + 1))
        assert r["c"] == pytest.approx(low, abs=1e-9)


def test_sigmoid_matches_newton_on_same_objective(spark):
    df = miscalibrated(spark, 1500, 1)
    cal = fit_map("sigmoid", by_score(df))
    rows = df.collect()
    x = np.array([r["p"] for r in rows])
    y = np.array([r["y"] for r in rows])
    w = np.zeros(2)  # [coef, intercept]; objective 0.5 coef^2 + sum logloss
    X = np.column_stack([x, np.ones_like(x)])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-X @ w))
        g = X.T @ (mu - y) + np.array([w[0], 0.0])
        h = X.T @ (X * (mu * (1 - mu))[:, None]) + np.diag([1.0, 0.0])
        w = w - np.linalg.solve(h, g)
    assert cal.slope == pytest.approx(w[0], abs=1e-4) and cal.offset == pytest.approx(w[1], abs=1e-4)


def test_selection_no_worse_than_raw_and_bad_name(spark):
    df = miscalibrated(spark, 3000, 2)
    a, b = df.where(F.col("k") % 2 == 0), df.where(F.col("k") % 2 == 1)
    best, scores = choose_map(a)
    assert best.kind == min(scores, key=scores.get) and brier(best.apply(b, "p", "c"), "c") <= brier(b, "p")
    with pytest.raises(ValueError):
        fit_map("bogus", by_score(df))
    assert isinstance(fit_map("none", by_score(df)), IdentityMap)


def synthetic(spark, n=4000, seed=11):
    return spark.range(n).select(
        F.col("id").alias("key"),
        (F.col("id") * 60).cast("timestamp").alias("ts"),
        F.randn(seed).alias("a"),
        F.randn(seed + 1).alias("b"),
        F.when(F.rand(seed + 2) < 0.5, "u").otherwise("v").alias("c"),
    ).withColumn("y", (F.col("a") * 2 + F.col("b") + F.randn(seed + 3) * 0.5 > 1.5).cast("int"))


def test_train_trees_learns_signal_and_reload_is_identical(spark, tmp_path):
    spec = JobSpec("synthetic", "y", "key", (*numbers("a", "b"), *categories("c")), time="ts", learner=Trees({"maxIter": 10, "maxDepth": 3}))
    df = synthetic(spark)
    res = train_model(spec, df, artifacts_dir=str(tmp_path), log=False)
    assert res.metrics["pr_auc_raw"] > 0.5
    scored = res.model.score(df, keep=["key"])
    lo, hi = scored.agg(F.min("probability"), F.max("probability")).first()
    assert 0.0 <= lo <= hi <= 1.0
    loaded = ScoringModel.load(res.model_path)
    again = loaded.score(df, keep=["key"]).select("key", F.col("probability").alias("p2"))
    diff = scored.join(again, "key").agg(F.max(F.abs(F.col("probability") - F.col("p2")))).first()[0]
    assert diff <= 1e-9


def test_posterior_matches_grid_integration(spark):
    # intercept + one slope; brute-force grid posterior vs the Laplace approximation
    rng = np.random.default_rng(5)
    x = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-(0.5 + 1.2 * x)))).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int")
    post = fit_posterior(df, ["x"], [], "y", ci_level=0.9)
    mu, sd = post.design.means_stds["x"]
    z = (x - mu) / sd
    A, B = np.meshgrid(np.linspace(-2, 3, 301), np.linspace(-1, 4, 301), indexing="ij")
    eta = A[..., None] + B[..., None] * z
    ll = (y * eta - np.logaddexp(0, eta)).sum(-1) - A**2 / 8 - B**2 / 2
    w = np.exp(ll - ll.max())
    w /= w.sum()
    assert post.mean[0] == pytest.approx((w * A).sum(), abs=0.02)
    assert post.mean[1] == pytest.approx((w * B).sum(), abs=0.02)
    s = post.score(df.limit(20), [])
    for r in s.collect():
        assert r["ci_low"] <= r["probability"] <= r["ci_high"]


def test_ordered_and_shuffle_splits(spark):
    df = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") % 97).alias("t"))
    out = ordered_split(df, ["t", "key"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in out} == {"train": 700, "cal": 150, "test": 150}
    a = shuffle_split(df, "key", (0.8,), ("train", "test")).select("key", "split").collect()
    b = shuffle_split(df.repartition(7), "key", (0.8,), ("train", "test")).select("key", "split").collect()
    assert sorted(a) == sorted(b)


def test_stratified_sample_counts(spark):
    df = spark.range(5000).select(F.col("id").alias("key"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = stratified_sample(df, "y", "key", 1000)
    counts = {r["y"]: r["count"] for r in s.groupBy("y").count().collect()}
    n_pos = min(500, int(1000 * 0.1) + 1)
    assert counts == {1: n_pos, 0: 1000 - n_pos}
    assert math.isclose(sum(counts.values()), 1000)


def test_cut_key_split_equals_positional_split(spark):
    from riskloom.operators.splits import split_by_cut_keys

    # a hot first key (a third of the rows) and NULL keys, which sort last
    df = spark.range(3000).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 50)
        .alias("t"),
    )
    a = ordered_split(df, ["t", "key"]).select("key", "split")
    b = split_by_cut_keys(df, ["t", "key"], (0.7, 0.85), ("train", "cal", "test")).select(
        "key", F.col("split").alias("s2")
    )
    assert a.join(b, "key").where(F.col("split") != F.col("s2")).count() == 0
    assert b.groupBy("s2").count().count() == 3


def test_cut_key_split_independent_of_session_time_zone(spark):
    from riskloom.operators.splits import split_by_cut_keys

    df = spark.range(500).select(
        F.col("id").alias("key"),
        F.expr("timestamp_ntz '2024-03-10 01:00:00' + make_interval(0, 0, 0, 0, 0, cast(id % 120 as int), 0)").alias("t"),
    )
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        b = split_by_cut_keys(df, ["t", "key"], (0.7,), ("a", "b")).groupBy("split").count().collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert {r["split"]: r["count"] for r in b} == {"a": 350, "b": 150}


def test_newton_sums_equal_the_plain_formula(spark):
    from riskloom.operators.models import _partition_sums

    rng = np.random.default_rng(9)
    x = np.column_stack([np.ones(300), rng.normal(size=(300, 2))])
    y = (rng.random(300) < 0.3).astype(float)
    packed = spark.createDataFrame([(r.tolist(), float(b)) for r, b in zip(x, y)], "x array<double>, y double").repartition(30)
    beta = np.array([-0.5, 0.3, -0.2])
    mu = 1 / (1 + np.exp(-x @ beta))
    g, h, ll = _partition_sums(packed, 3, beta)
    assert np.allclose(g, x.T @ (mu - y), atol=1e-9) and np.allclose(h, x.T @ (x * (mu * (1 - mu))[:, None]), atol=1e-9)
    assert ll == pytest.approx(float(np.sum(y * np.log(mu) + (1 - y) * np.log(1 - mu))), abs=1e-8)


def test_wide_posterior(spark):
    rng = np.random.default_rng(2)
    levels = [f"l{i:03d}" for i in range(200)]
    rows = [(levels[i % 200], int(rng.random() < (0.7 if i % 2 else 0.2))) for i in range(4000)]
    post = fit_posterior(spark.createDataFrame(rows, "c string, y int"), [], ["c"], "y")
    assert len(post.mean) == 200
    got = post.score(spark.createDataFrame([(x,) for x in levels], "c string"), ["c"]).collect()
    odd = [r["probability"] for r in got if int(r["c"][1:]) % 2]
    even = [r["probability"] for r in got if not int(r["c"][1:]) % 2]
    assert min(odd) > np.mean(even) and all(r["ci_low"] < r["probability"] < r["ci_high"] for r in got)


def test_trees_take_many_levels_and_missing_numbers(spark):
    from riskloom.operators.models import fit_gbt, gbt_score

    rng = np.random.default_rng(4)
    rows = []
    for i in range(1500):
        missing = rng.random() < 0.3
        rows.append((None if missing else float("nan") if i % 50 == 0 else float(rng.normal()), f"s{i % 50}", int(missing or rng.random() < 0.1)))
    df = spark.createDataFrame(rows, "a double, state string, y int")
    model = fit_gbt(df, ["a"], ["state"], "y", {"maxIter": 5, "maxDepth": 3})
    new = spark.createDataFrame([(None, "s1", 1), (0.1, "s2", 0), (0.1, None, 0), (float("nan"), "unseen", 1)], "a double, state string, y int")
    p = [r["p_raw"] for r in gbt_score(model, new).orderBy("y").collect()]
    assert max(p[:2]) < 0.5 < min(p[2:])


def test_draws_follow_a_skewed_posterior(spark):
    """Few rows and one label only: the normal law at the mode is off, the draws agree with the grid."""
    x = np.array([-1.5, -0.5, 0.2, 0.9, 1.4, 2.0])
    df = spark.createDataFrame([(float(a), 0) for a in x], "x double, y int")
    post = fit_posterior(df, ["x"], [], "y", ci_level=0.9, draws=4_000)
    mu, sd = post.design.means_stds["x"]
    A, B = np.meshgrid(np.linspace(-9, 4, 521), np.linspace(-5, 5, 401), indexing="ij")
    eta = A[..., None] + B[..., None] * ((x - mu) / sd)
    ll = (-np.logaddexp(0, eta)).sum(-1) - A**2 / 8 - B**2 / 2
    w = np.exp(ll - ll.max())
    w /= w.sum()
    drawn, normal = ({round(r.x, 3): r for r in m.score(df, ["x"]).collect()} for m in (post, replace(post, draws=None)))
    off = []
    for a in x:
        p = (1 / (1 + np.exp(-(A + B * (a - mu) / sd)))).ravel()
        order = np.argsort(p)
        run = np.cumsum(w.ravel()[order])
        low, high = (p[order][np.searchsorted(run, e)] for e in (0.05, 0.95))
        d, n = drawn[round(a, 3)], normal[round(a, 3)]
        assert d.ci_low == pytest.approx(low, abs=0.012) and d.ci_high == pytest.approx(high, abs=0.02) and d.probability == pytest.approx((w.ravel() * p).sum(), abs=0.01)
        off.append(abs(n.ci_high - high))
    assert max(off) > 0.03


def test_a_missing_model_has_its_own_error(spark, tmp_path):
    from riskloom.operators.scoring import ModelNotFound

    with pytest.raises(ModelNotFound, match="no model under"):
        ScoringModel.load(str(tmp_path / "nothing"))
