import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources.files import materialize, source_state, write_csv

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def rows(df):
    return sorted((r.k, r.v) for r in df.collect())


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_the_table_follows_its_source(spark, tmp_path):
    raw, typed = str(tmp_path / "raw"), str(tmp_path / "typed")
    write_csv(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), raw)
    assert rows(materialize(spark, raw, typed, schema=SCHEMA)) == [(1, "a"), (2, "b")]
    before = files(typed)
    assert rows(materialize(spark, raw, typed, schema=SCHEMA)) == [(1, "a"), (2, "b")] and files(typed) == before
    assert rows(materialize(spark, raw, typed)) == [(1, "a"), (2, "b")] and files(typed) == before
    write_csv(spark.createDataFrame([(1, "a"), (3, "changed")], SCHEMA), raw)
    assert rows(materialize(spark, raw, typed, schema=SCHEMA)) == [(1, "a"), (3, "changed")]
    other = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
    assert materialize(spark, raw, typed, schema=other).schema["k"].dataType == T.StringType()
    before = files(typed)
    materialize(spark, raw, typed, schema=other, reuse=False)
    assert files(typed) != before
    with pytest.raises(FileNotFoundError, match="nothing"):
        materialize(spark, str(tmp_path / "nothing"), typed, schema=SCHEMA)


def test_only_changed_partitions_are_read_again(spark, tmp_path):
    raw, typed = str(tmp_path / "raw"), str(tmp_path / "typed")
    for day, k in (("a", 1), ("b", 2), ("c", 3)):
        write_csv(spark.createDataFrame([(k, f"{day}{k}")], SCHEMA), f"{raw}/day={day}")
    assert set(source_state(spark, raw)) == {"day=a", "day=b", "day=c"}
    full = T.StructType([*SCHEMA.fields, T.StructField("day", T.StringType())])
    get = lambda: sorted((r.k, r.v, r.day) for r in materialize(spark, raw, typed, schema=full, partition_by=["day"]).collect())
    assert get() == [(1, "a1", "a"), (2, "b2", "b"), (3, "c3", "c")]
    before = files(typed)
    write_csv(spark.createDataFrame([(20, "new")], SCHEMA), f"{raw}/day=b")
    write_csv(spark.createDataFrame([(4, "d4")], SCHEMA), f"{raw}/day=d")
    for name in os.listdir(f"{raw}/day=c"):
        os.remove(f"{raw}/day=c/{name}")
    assert get() == [(1, "a1", "a"), (4, "d4", "d"), (20, "new", "b")]
    after = files(typed)
    assert {f for f in after if "day=a" in f} == {f for f in before if "day=a" in f} and all(after[f] == before[f] for f in after if "day=a" in f)
    assert not any("day=c" in f for f in after)


def test_a_table_without_manifest_is_written_again(spark, tmp_path):
    raw, typed = str(tmp_path / "raw"), str(tmp_path / "typed")
    write_csv(spark.createDataFrame([(1, "a")], SCHEMA), raw)
    spark.range(5).withColumn("v", F.lit("left over")).write.parquet(typed)
    assert rows(materialize(spark, raw, typed, schema=SCHEMA)) == [(1, "a")]
