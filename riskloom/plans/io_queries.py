"""Source/sink and cleaning queries on ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.cleaning import clean_source, coerce_numeric, drop_null_target, sentinel_to_null
from riskloom.operators.encode import fill_category, fill_numeric
from riskloom.session import scratch_path
from riskloom.sources.files import materialize, read_csv, write_csv
from riskloom.sources.tables import table

ROUNDTRIP_COLS = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate"]
ROUNDTRIP_SCHEMA = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_shipdate", T.StringType()),
    ]
)


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> CSV (header) -> typed CSV scan -> Parquet (reused if present) -> scan."""
    base = scratch_path(spark, "csv_roundtrip")
    src = table(spark, sf_dir, "lineitem").select(*ROUNDTRIP_COLS).withColumn(
        "l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    )
    raw = write_csv(src, f"{base}/raw")
    typed = materialize(
        spark, raw, f"{base}/typed", schema=ROUNDTRIP_SCHEMA, datetime_col="l_shipdate", reuse=True
    )
    # a second call reuses the written table instead of re-ingesting
    typed = materialize(spark, raw, f"{base}/typed", reuse=True)
    assert read_csv(spark, raw, schema=ROUNDTRIP_SCHEMA).columns == ROUNDTRIP_COLS
    return typed.select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
        F.round("l_quantity", 6).alias("l_quantity"), F.round("l_extendedprice", 6).alias("l_extendedprice"),
        F.round("l_discount", 6).alias("l_discount"), "l_returnflag",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
    )


def q_clean_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus"
    )
    out = clean_source(
        li, label_source="l_returnflag", positive="R", target="returned",
        drop=["l_partkey", "l_comment", "weight"], numeric=["l_quantity", "l_tax", "l_linenumber"],
    )
    return out.select(
        "l_orderkey", F.round("l_linenumber", 6).alias("l_linenumber"), F.round("l_quantity", 6).alias("l_quantity"),
        F.round("l_tax", 6).alias("l_tax"), "l_linestatus", F.col("returned").cast("long").alias("returned"),
    )


def q_clean_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning steps where each has something to do: sentinels, text numbers that are none, missing targets, fills."""
    odd = F.col("l_orderkey") % 5
    dirty = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
        F.when(odd == 0, "?").when(odd == 1, F.lit(None)).otherwise(F.col("l_linestatus")).alias("status"),
        F.when(odd == 2, "n/a").when(odd == 3, F.concat(F.col("l_quantity").cast("string"), F.lit(" "))).otherwise(F.col("l_quantity").cast("string")).alias("quantity"),
        F.when(odd != 4, (F.col("l_returnflag") == "R").cast("long")).alias("target"),
    )
    clean = drop_null_target(coerce_numeric(sentinel_to_null(dirty), ["quantity"]), "target")
    return clean.select(
        "l_orderkey", "l_linenumber", "status", F.round("quantity", 6).alias("quantity"), "target",
        F.round(fill_numeric(F.col("quantity")), 6).alias("quantity_filled"), fill_category(F.col("status")).alias("status_filled"),
    )


ORACLES = {
    "clean_dirty": """WITH d AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
 CASE WHEN l_orderkey % 5 IN (0, 1) THEN NULL ELSE l_linestatus END AS status, CASE WHEN l_orderkey % 5 = 2 THEN NULL ELSE round(CAST(l_quantity AS DOUBLE), 6) END AS quantity,
 CAST(l_returnflag = 'R' AS BIGINT) AS target FROM lineitem WHERE l_orderkey % 5 <> 4 AND l_returnflag IS NOT NULL)
SELECT *, coalesce(quantity, 0.0) AS quantity_filled, coalesce(status, 'Unknown') AS status_filled FROM d""",
    "csv_roundtrip": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(l_quantity, 6) AS l_quantity, "
    "round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount, l_returnflag, "
    "strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem",
    "clean_source": "SELECT l_orderkey, round(CAST(l_linenumber AS DOUBLE), 6) AS l_linenumber, round(l_quantity, 6) AS l_quantity, "
    "round(l_tax, 6) AS l_tax, nullif(l_linestatus, '?') AS l_linestatus, "
    "CAST(coalesce(l_returnflag = 'R', false) AS BIGINT) AS returned FROM lineitem",
}

QUERIES = {"csv_roundtrip": q_csv_roundtrip, "clean_source": q_clean_source, "clean_dirty": q_clean_dirty}
