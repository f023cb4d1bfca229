"""Driver tables and the derived inputs the queries run on.

Every derived input is a projection of a driver table, so Catalyst prunes columns and
pushes filters into the Parquet scan; nothing here materialises data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLE_NAMES:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(TABLE_NAMES)}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Score pairs on the events flow: label = purchase, score = capped value.
def event_label() -> Column:
    return (F.col("event_type") == F.lit("purchase")).cast("int")


def event_score() -> Column:
    return F.least(F.col("value") / F.lit(100.0), F.lit(1.0))


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, ts, y, p)`` from ``events``."""
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "ts", event_label().alias("y"), event_score().alias("p"))


def event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric drift features of ``events``: value, props.k and user_id."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "ts",
        F.col("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("user_id").cast("double").alias("uid"),
    )


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, y, p)``: toxic label with a raw score from document length.

    The score is a monotone squash of ``n_chars`` (a weak, uncalibrated signal), so
    calibrators have something to fix.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    joined = labels.join(docs, "doc_id", "inner")
    return joined.select(
        "doc_id",
        F.col("toxic").cast("int").alias("y"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.log1p(F.col("n_chars").cast("double")) + F.lit(7.0)))).alias("p"),
    )


# Orders x customer: a mixed-type modelling table with a noisy label.
# Fixed values of the label rule: price cut and the md5 first-hex-digit that flips it.
ORDER_PRICE_CUT = 420000.0
ORDER_FLIP_DIGIT = "0"


def order_label() -> Column:
    base = F.col("o_totalprice") > F.lit(ORDER_PRICE_CUT)
    flip = F.substring(F.md5(F.col("o_orderkey").cast("string")), 1, 1) == F.lit(ORDER_FLIP_DIGIT)
    return (base != flip).cast("int")


def order_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` joined to its ``customer`` row, with label ``y``.

    Customer is the dimension side; with AQE Spark broadcasts it only when its
    runtime size is under the broadcast threshold, otherwise both sides are shuffled
    on the customer key.
    """
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner").drop("c_custkey", "o_custkey")
    return j.withColumn("y", order_label())


ORDER_FRAME_SQL = (
    "frame AS (SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority, "
    "c.c_nationkey, c.c_acctbal, c.c_mktsegment, "
    "CAST(((o.o_totalprice > 420000.0) <> (substr(md5(CAST(o.o_orderkey AS VARCHAR)), 1, 1) = '0')) AS INTEGER) AS y "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"
)
