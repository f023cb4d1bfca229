"""Two-level running sums and rank lookups equal the plain single-task computations."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators.prefix import cumulative, row_index, values_at_ranks
from riskloom.operators.quantiles import exact_quantiles


def test_cumulative_matches_plain_window(spark):
    df = spark.range(3000).select(
        (F.col("id") % 3).alias("g"), (F.rand(1) * 100).alias("k"), F.col("id").alias("tie"),
        (F.rand(2) * 10).cast("long").alias("w"),
    )
    got = cumulative(df, ["k", "tie"], ["w"], group_cols=["g"], n_buckets=7)
    w = Window.partitionBy("g").orderBy("k", "tie").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("ref", F.sum("w").over(w))
    bad = got.join(exp, ["g", "tie"]).where(F.col("cum_w") != F.col("ref")).count()
    assert bad == 0


def test_cumulative_descending_with_hot_key(spark):
    # a third of the rows share one first-key value; the tie key splits them
    df = spark.range(1500).select(
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id").cast("double")).alias("k"),
        F.col("id").alias("tie"), F.lit(1).cast("long").alias("one"),
    )
    got = cumulative(df, ["k", "tie"], ["one"], descending=True, n_buckets=16)
    w = Window.orderBy(F.desc("k"), F.desc("tie")).rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("ref", F.sum("one").over(w))
    assert got.join(exp, ["tie"]).where(F.col("cum_one") != F.col("ref")).count() == 0


def test_row_index_is_a_permutation_and_stable_under_repartition(spark):
    df = spark.range(2000).select(F.col("id"), (F.rand(3) * 50).cast("int").alias("t"))
    a = row_index(df, ["t", "id"]).select("id", "row_idx")
    b = row_index(df.repartition(13), ["t", "id"]).select("id", F.col("row_idx").alias("r2"))
    rows = a.join(b, "id").collect()
    assert sorted(r["row_idx"] for r in rows) == list(range(2000))
    assert all(r["row_idx"] == r["r2"] for r in rows)


def test_values_at_ranks(spark):
    vals = np.random.default_rng(0).integers(0, 40, 500)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    counts = df.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    ranks = [0, 17, 250, 499]
    wanted = F.array(*[F.struct(F.lit(r).alias("rank")) for r in ranks])
    got = {r["rank"]: r["x"] for r in values_at_ranks(cumulative(counts, ["x"], ["c"]), "x", "c", wanted).collect()}
    s = np.sort(vals)
    assert got == {r: float(s[r]) for r in ranks}


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=997), [3.0] * 300])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [i / 10 for i in range(11)]
    got = sorted(exact_quantiles(df, "x", probs).collect(), key=lambda r: r["q_index"])
    exp = np.quantile(vals, probs)
    assert np.allclose([r["quantile"] for r in got], exp, rtol=0, atol=1e-12)


def test_many_buckets_and_groups(spark):
    df = spark.range(40_000).select((F.col("id") % 10).alias("g"), F.xxhash64("id").alias("k"), F.lit(1).cast("long").alias("one"))
    got = cumulative(df, ["k"], ["one"], group_cols=["g"], n_buckets=2_000, keep_bucket=True)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" not in plan
    row = got.groupBy("g").agg(F.max("cum_one").alias("m"), F.countDistinct("cum_one").alias("d")).agg(F.min("m"), F.max("m"), F.min("d")).first()
    assert tuple(row) == (4_000, 4_000, 4_000)
    assert got.select("_rl_bucket").distinct().count() > 1_000


def test_nothing_stays_cached(spark):
    from riskloom.plans import catalog
    from tests.conftest import SF_SMALL

    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    for name in ("psi_report", "score_metrics", "topk_label", "stratified_sample"):
        catalog.queries()[name](spark, SF_SMALL).collect()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == before


def test_nulls_come_last(spark):
    df = spark.createDataFrame([(3, 1), (None, 2), (1, 3), (None, 4)], "k int, tie int")
    got = {r["tie"]: r["row_idx"] for r in row_index(df, ["k", "tie"], name="row_idx").collect()}
    assert got == {3: 0, 1: 1, 2: 2, 4: 3}
