import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.operators import isotonic as I
from riskloom.operators.calibrate import by_score, fit_map


def pooled(scores, n, pos):
    """Plain pool-adjacent-violators: value of each score."""
    blocks = []
    for k in np.argsort(scores):
        blocks.append([float(n[k]), float(pos[k]), [k]])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w, s, members = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + s, blocks[-1][2] + members]
    out = np.empty(len(scores))
    for w, s, members in blocks:
        out[members] = s / w
    return out


def table(spark, scores, n, pos):
    return spark.createDataFrame([(float(s), float(a), float(b)) for s, a, b in zip(scores, n, pos)], "score double, n double, pos double")


def fitted(spark, scores, n, pos, slopes=I.SLOPES):
    counts = table(spark, scores, n, pos)
    knots = sorted((r.score, r.value) for r in I.fit_knots(counts.repartition(5), slopes).collect())
    xs, ys = np.array(knots).T
    assert (np.diff(xs) > 0).all() and (np.diff(ys) >= -1e-12).all()
    return np.interp(scores, xs, ys)


@pytest.mark.parametrize("slopes", [1, 7, 256])
@pytest.mark.parametrize("shape", ["noisy", "rising", "falling", "steps", "one"])
def test_equal_to_pooling_one_by_one(spark, shape, slopes):
    rng = np.random.default_rng(7)
    m = 1 if shape == "one" else 700
    scores = np.sort(rng.random(m))
    n = rng.integers(1, 9, m)
    rate = {"noisy": scores, "rising": scores**3, "falling": 1 - scores, "steps": np.floor(scores * 5) / 5, "one": scores}[shape]
    pos = rate * n if shape in ("rising", "falling", "steps") else rng.binomial(n, rate)
    order = rng.permutation(m)
    scores, n, pos = scores[order], n[order], pos[order]
    assert np.allclose(fitted(spark, scores, n, pos, slopes), pooled(scores, n, pos), atol=1e-9)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 5), st.integers(0, 5)), min_size=1, max_size=60))
def test_hull_has_the_pooled_slopes(rows):
    n, pos = np.array([a for a, _ in rows], float), np.array([min(a, b) for a, b in rows], float)
    x, y = (np.concatenate([[0.0], np.cumsum(v)]) for v in (n, pos))
    at = I.hull(x, y)
    slopes = np.diff(y[at]) / np.diff(x[at])
    assert (np.diff(slopes) > 0).all()
    assert np.allclose(np.repeat(slopes, np.diff(at)), pooled(np.arange(len(n)), n, pos))


def test_a_million_scores(spark):
    """A rising rate keeps nearly every block: no task and no broadcast may need them all."""
    m = 1_000_000
    counts = spark.range(m).select(F.col("id").cast("double").alias("score"), F.lit(1.0).alias("n"), F.pow(F.col("id") / m, F.lit(2.0)).alias("pos"))
    knots = I.fit_knots(counts)
    n_knots = knots.count()
    assert n_knots > I.BROADCAST_KNOTS
    got = I.interpolate(counts, "score", "value", knots, n_knots).agg(F.count("*").alias("n"), F.max(F.abs(F.col("value") - F.col("pos"))).alias("gap")).first()
    assert got.n == m and got.gap < 1e-6


def test_both_ways_of_mapping_agree(spark, monkeypatch):
    rng = np.random.default_rng(3)
    scores = np.unique(np.round(rng.random(400), 3))
    n = np.ones(len(scores))
    counts = table(spark, scores, n, rng.random(len(scores)) < scores)
    fit = fit_map("isotonic", counts)
    asked = [(float(s),) for s in [-1, 2, 0.5, *rng.random(50)]] + [(None,), (float("nan"),), (0.5,)]
    df = spark.createDataFrame(asked, "p double").withColumn("c", F.lit("x"))
    few = sorted((str(r.p), r.cal) for r in fit.apply(df, "p", "cal").collect())
    monkeypatch.setattr(I, "BROADCAST_KNOTS", 0)
    many = sorted((str(r.p), r.cal) for r in fit.apply(df, "p", "cal").collect())
    assert [p for p, _ in few] == [p for p, _ in many]
    for (_, a), (_, b) in zip(few, many, strict=True):
        assert a is b is None or a == pytest.approx(b, abs=1e-12)


def test_no_scores(spark):
    counts = table(spark, [], [], [])
    fit = fit_map("isotonic", counts)
    assert fit.apply(spark.createDataFrame([(0.3,)], "p double"), "p", "c").first().c is None
    assert I.score_values(counts.select("score"), fit.knots).collect() == []
    assert by_score(spark.createDataFrame([(None, 1)], "p double, y int")).count() == 0
