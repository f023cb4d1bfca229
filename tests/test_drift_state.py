import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators.drift import DriftAnalysis, long_values
from riskloom.operators.drift_state import DriftState
from riskloom.session import scratch_path


def events(seed, n):
    rng = random.Random(seed)
    value = lambda d: rng.choice([None, float("nan"), round(rng.gauss(d, 3), 1), 5.0])
    return [(f"2024-01-{d:02d}", value(d), float(rng.randint(0, 3))) for d in (rng.randint(1, 9) for _ in range(n))]


def report(analysis):
    return sorted((r.feature, *(None if v is None else round(v, 9) for v in (r.psi, r.ks_stat, r.ks_pvalue)), r.drifted) for r in analysis.report().collect())


def test_kept_counts_give_the_report_on_the_rows(spark):
    rows = spark.createDataFrame(events(1, 900), "day string, a double, b double")
    state = DriftState(spark, scratch_path(spark, "state"))
    for days in ("day <= '2024-01-05'", "day = '2024-01-06'", "day > '2024-01-06'"):
        state.update(rows.where(days), "day", ["a", "b", "absent"])
    old = F.col("batch") <= "2024-01-06"
    sided = rows.withColumn("side", (F.col("day") > "2024-01-06").cast("int"))
    assert report(state.analysis(old, ~old)) == report(DriftAnalysis(long_values(sided, ["a", "b"])))
    one = sided.where("day IN ('2024-01-02', '2024-01-08')")
    assert report(state.analysis(F.col("batch") == "2024-01-02", F.col("batch") == "2024-01-08")) == report(DriftAnalysis(long_values(one, ["a", "b"])))


def test_an_update_again_replaces_its_batches(spark):
    rows = spark.createDataFrame(events(2, 300), "day string, a double, b double")
    state = DriftState(spark, scratch_path(spark, "state"))
    assert state.counts().count() == 0
    state.update(rows, "day", ["a", "b"])
    before = sorted(map(tuple, state.batches().collect()))
    state.update(rows.where("day = '2024-01-03'"), "day", ["a", "b"])
    assert sorted(map(tuple, state.batches().collect())) == before
    state.update(rows.where("day = '2024-01-03'").unionByName(rows.where("day = '2024-01-03'")), "day", ["a", "b"])
    after = {(b, f): n for b, f, n in state.batches().collect()}
    assert all(after[b, f] == n * (2 if b == "2024-01-03" else 1) for b, f, n in before)
    state.update(spark.createDataFrame([(None, 1.0)], "day string, a double"), "day", ["a"])
    assert len(state.batches().collect()) == len(before)
    with pytest.raises(ValueError):
        state.update(rows, "day", ["absent"])
