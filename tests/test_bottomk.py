import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import bottomk as B
from riskloom.operators.splits import stratified_sample


@pytest.mark.parametrize("fan_in", [2, 16])
def test_equal_to_sorting_everything(spark, monkeypatch, fan_in):
    monkeypatch.setattr(B, "FAN_IN", fan_in)
    rng = random.Random(fan_in)
    rows = [(rng.choice(["hot"] * 8 + ["b", "c", None]), rng.randint(0, 40), f"k{rng.randint(0, 300):03d}") for _ in range(1_500)]
    df = spark.createDataFrame(rows, "g string, a long, b string").repartition(11)
    got = {}
    for r in B.least_keys(df, "g", ["a", "b"], 50).collect():
        got.setdefault(r.g, {})[r["rank"]] = (r.a, r.b)
        assert r["size"] == sum(g == r.g for g, _, _ in rows)
    for g in ("hot", "b", "c"):
        assert [got[g][k] for k in sorted(got[g])] == sorted((a, b) for h, a, b in rows if h == g)[:50]
    assert set(got) == {"hot", "b", "c"}


def test_no_rows_and_null_keys(spark):
    df = spark.createDataFrame([("x", None), ("x", 2), ("x", 1)], "g string, a long")
    assert [(r.a, r["rank"], r["size"]) for r in B.least_keys(df, "g", ["a"], 2).orderBy("rank").collect()] == [(1, 0, 3), (2, 1, 3)]
    assert B.least_keys(df.limit(0), "g", ["a"], 2).collect() == []


def test_sample_reads_the_rows_twice(spark):
    df = spark.range(20_000).select(F.col("id").alias("key"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    s = stratified_sample(df.mapInArrow(count, df.schema), "y", "key", 1_000)
    assert s.count() == 1_000 and read.value == 40_000
