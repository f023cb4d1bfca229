"""Feature, encoding, split and scalar-function queries.

``orders`` x ``customer`` is the mixed-type modelling table; ``events`` carries the time
column and the coordinates (derived from ``event_id``/``user_id`` arithmetic).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.features import day_of_week, epoch_seconds_ntz, haversine_km, hour, month, parse_timestamp
from riskloom.functions.stats import round6
from riskloom.operators.encode import category_codes, category_levels, fit_design, fit_sparse_design, with_codes
from riskloom.operators.features import project
from riskloom.operators.splits import ordered_split, shuffle_split, stratified_sample
from riskloom.operators.topk import topk_label, weighted_score, with_zscores
from riskloom.sources.tables import ORDER_FRAME_SQL, order_frame, table
from riskloom.spec import JobSpec, Trees, categories, date_parts, numbers

# Fixed values of the orders domain.
ORDERS_NUMBERS = ["o_totalprice", "c_acctbal", "c_nationkey"]
ORDERS_SPEC = JobSpec(
    domain="orders",
    target="y",
    key="o_orderkey",
    features=(*numbers(*ORDERS_NUMBERS), *date_parts("o_orderdate"), *categories("o_orderstatus", "o_orderpriority", "c_mktsegment")),
    time="o_orderdate",
    learner=Trees({"maxIter": 20, "maxDepth": 5, "stepSize": 0.1}),
    precision=0.5,
)
STRATIFIED_SAMPLE_SIZE = 2000
TOPK_RATE = 0.05
TOPK_SEGMENTS = ("MACHINERY", "BUILDING")


def _long_ints(df: DataFrame, names) -> DataFrame:
    for c in names:
        df = df.withColumn(c, F.col(c).cast("long"))
    return df


def q_feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _, _ = project(ORDERS_SPEC, order_frame(spark, sf_dir), keep=["o_orderkey"])
    out = _long_ints(frame, ["hour", "dayofweek", "month", "c_nationkey", "y"])
    return out.withColumn("o_totalprice", round6(F.col("o_totalprice"))).withColumn(
        "c_acctbal", round6(F.col("c_acctbal"))
    )


def category_table(df: DataFrame, columns) -> DataFrame:
    """``(column, n_levels, levels)``: the dictionaries of the spec's categories, side by side."""
    return category_levels(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("n_levels"), F.array_join(F.array_sort(F.collect_list("value")), "|").alias("levels")
    )


def q_category_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = category_table(order_frame(spark, sf_dir), ORDERS_SPEC.names(categorical=True))
    return t.withColumn("n_levels", F.col("n_levels").cast("long"))


def q_category_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = order_frame(spark, sf_dir)
    cats = ORDERS_SPEC.names(categorical=True)
    coded = with_codes(frame, category_codes(frame, cats), cats)
    return coded.select("o_orderkey", *[f"code_{c}" for c in cats])


#: Numbers and categories of the sparse design; the customer key has a level for each customer.
SPARSE_NUMBERS, SPARSE_CATEGORIES = ["o_totalprice"], ["o_orderpriority", "o_custkey"]


def q_design_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    e = fit_sparse_design(frame, SPARSE_NUMBERS, SPARSE_CATEGORIES).entries(frame, ["o_orderkey"])
    return e.select("o_orderkey", "slot", round6(F.col("value")).alias("value"))


def q_design_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = order_frame(spark, sf_dir)
    model = fit_design(frame, ORDERS_NUMBERS, ORDERS_SPEC.names(categorical=True))
    out = model.transform(frame, keep=["o_orderkey"])
    return out.select("o_orderkey", *[round6(F.col(f"`{c}`")).alias(c) for c in model.output_columns])


def q_shuffle_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = order_frame(spark, sf_dir).select("o_orderkey")
    return shuffle_split(frame, "o_orderkey", (0.8,), ("train", "test")).select("o_orderkey", "row_idx", "split")


def q_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = order_frame(spark, sf_dir).select("o_orderkey", "y")
    return stratified_sample(frame, "y", "o_orderkey", STRATIFIED_SAMPLE_SIZE).select(
        "o_orderkey", F.col("y").cast("long").alias("y")
    )


def order_risk_score(frame: DataFrame) -> DataFrame:
    base = frame.select(
        "o_orderkey",
        F.log1p("o_totalprice").alias("log_price"),
        F.col("c_acctbal").cast("double").alias("acctbal"),
        F.col("c_mktsegment").isin(*TOPK_SEGMENTS).cast("double").alias("segment_flag"),
    )
    z = with_zscores(base, ["log_price", "acctbal"])
    return z.select(
        "o_orderkey",
        weighted_score([(1.2, F.col("z_log_price")), (1.5, F.col("segment_flag")), (1.0, F.col("z_acctbal"))]).alias(
            "score"
        ),
    )


def q_topk_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = order_risk_score(order_frame(spark, sf_dir))
    lab = topk_label(scored, "score", TOPK_RATE)
    return lab.select("o_orderkey", round6(F.col("score")).alias("score"), F.col("label").cast("long").alias("label"))


# -- events: time parsing, date parts, distance, ordered split ---------------------------
def event_coordinates() -> list[Column]:
    """Card and merchant coordinates derived from ids (lat in [-90, 90), lon in [-180, 180))."""
    lat = (F.col("event_id") * 37 % 1800) / F.lit(10.0) - F.lit(90.0)
    lon = (F.col("event_id") * 53 % 3600) / F.lit(10.0) - F.lit(180.0)
    mlat = lat + (F.col("user_id") % 7 - 3) / F.lit(10.0)
    mlon = lon + (F.col("event_id") % 11 - 5) / F.lit(10.0)
    return [lat.alias("lat"), lon.alias("long"), mlat.alias("merch_lat"), mlon.alias("merch_long")]


def q_parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "props")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    parsed = parse_timestamp(text).cast("timestamp_ntz")
    return ev.select(
        "event_id",
        epoch_seconds_ntz(parsed).alias("ts_epoch"),
        parse_timestamp(F.col("props")).isNull().alias("bad_text_is_null"),
    )


def q_date_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return ev.select(
        "event_id",
        hour(F.col("ts")).cast("long").alias("hour"),
        day_of_week(F.col("ts")).cast("long").alias("dayofweek"),
        month(F.col("ts")).cast("long").alias("month"),
    )


def q_geo_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    c = ev.select("event_id", *event_coordinates())
    d = haversine_km(F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long"))
    return c.select("event_id", round6(d).alias("geo_distance_km"))


def q_ordered_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return ordered_split(ev, ["ts", "event_id"]).select("event_id", "row_idx", "split")


# -- oracles -----------------------------------------------------------------------------
_LEVELS = {
    "o_orderstatus": ["O", "P"],
    "o_orderpriority": ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "c_mktsegment": ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
}


def _design_sql() -> str:
    z = []
    for c in ORDERS_NUMBERS:
        z.append(
            f"round((coalesce(CAST({c} AS DOUBLE), 0.0) - (SELECT avg(coalesce(CAST({c} AS DOUBLE), 0.0)) FROM frame)) / "
            f"(SELECT CASE WHEN coalesce(stddev_samp(coalesce(CAST({c} AS DOUBLE), 0.0)), 0) = 0 THEN 1.0 "
            f"ELSE stddev_samp(coalesce(CAST({c} AS DOUBLE), 0.0)) END FROM frame), 6) AS z_{c}"
        )
    d = []
    for c, levels in _LEVELS.items():
        for lv in levels:
            d.append(f"round(CAST(coalesce(CAST({c} AS VARCHAR), 'Unknown') = '{lv}' AS DOUBLE), 6) AS \"{c}_{lv}\"")
    return f"WITH {ORDER_FRAME_SQL} SELECT o_orderkey, {', '.join(z + d)} FROM frame"


def _code_sql(c: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS BIGINT) AS code_{c}"


ORACLES = {
    "feature_matrix": f"WITH {ORDER_FRAME_SQL} SELECT o_orderkey, round(o_totalprice, 6) AS o_totalprice, "
    "round(c_acctbal, 6) AS c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey, "
    "CAST(hour(o_orderdate) AS BIGINT) AS hour, CAST(isodow(o_orderdate) - 1 AS BIGINT) AS dayofweek, "
    "CAST(month(o_orderdate) AS BIGINT) AS month, o_orderstatus, o_orderpriority, c_mktsegment, CAST(y AS BIGINT) AS y FROM frame",
    "category_dict": f"WITH {ORDER_FRAME_SQL}, l AS ("
    "SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM frame UNION "
    "SELECT 'o_orderpriority', o_orderpriority FROM frame UNION SELECT 'c_mktsegment', c_mktsegment FROM frame) "
    "SELECT column_name AS \"column\", CAST(count(*) AS BIGINT) AS n_levels, "
    "array_to_string(list_sort(list(value)), '|') AS levels FROM l WHERE value IS NOT NULL GROUP BY column_name",
    "category_encode": f"WITH {ORDER_FRAME_SQL} SELECT o_orderkey, "
    + ", ".join(_code_sql(c) for c in ORDERS_SPEC.names(categorical=True))
    + " FROM frame",
    "design_matrix": _design_sql(),
    "design_sparse": """WITH f AS (SELECT o_orderkey, coalesce(CAST(o_totalprice AS DOUBLE), 0) AS x, coalesce(o_orderpriority, 'Unknown') AS p, coalesce(CAST(o_custkey AS VARCHAR), 'Unknown') AS c FROM orders),
m AS (SELECT avg(x) AS mu, CASE WHEN coalesce(stddev_samp(x), 0) = 0 THEN 1 ELSE stddev_samp(x) END AS sd FROM f),
ps AS (SELECT p, row_number() OVER (ORDER BY p) - 1 AS code FROM (SELECT DISTINCT p FROM f)),
cs AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS code FROM (SELECT DISTINCT c FROM f)),
k AS (SELECT count(*) - 1 AS wide FROM ps)
SELECT o_orderkey, CAST(0 AS BIGINT) AS slot, round((x - mu) / sd, 6) AS value FROM f, m WHERE x <> mu
UNION ALL SELECT o_orderkey, CAST(code AS BIGINT), 1.0 FROM f JOIN ps USING (p) WHERE code > 0
UNION ALL SELECT o_orderkey, CAST(wide + code AS BIGINT), 1.0 FROM f JOIN cs USING (c), k WHERE code > 0""",
    "shuffle_split": f"WITH {ORDER_FRAME_SQL}, r AS (SELECT o_orderkey, "
    "row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey) - 1 AS row_idx, "
    "count(*) OVER () AS n FROM frame) SELECT o_orderkey, CAST(row_idx AS BIGINT) AS row_idx, "
    "CASE WHEN row_idx < CAST(floor(CAST(n AS DOUBLE) * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM r",
    "stratified_sample": f"WITH {ORDER_FRAME_SQL}, st AS (SELECT count(*) AS n, sum(y) AS p, sum(1 - y) AS neg FROM frame), "
    f"k AS (SELECT least(p, CAST(floor({STRATIFIED_SAMPLE_SIZE} * (CAST(p AS DOUBLE) / n)) AS BIGINT) + 1) AS n_pos, neg FROM st), "
    f"k2 AS (SELECT n_pos, least({STRATIFIED_SAMPLE_SIZE} - n_pos, neg) AS n_neg FROM k), "
    "r AS (SELECT o_orderkey, y, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey) AS rk FROM frame) "
    "SELECT o_orderkey, CAST(y AS BIGINT) AS y FROM r, k2 WHERE (y = 1 AND rk <= n_pos) OR (y = 0 AND rk <= n_neg)",
    "topk_label": f"WITH {ORDER_FRAME_SQL}, b AS (SELECT o_orderkey, ln(1 + o_totalprice) AS lp, CAST(c_acctbal AS DOUBLE) AS ab, "
    "CAST(c_mktsegment IN ('MACHINERY', 'BUILDING') AS DOUBLE) AS seg FROM frame), "
    "st AS (SELECT avg(lp) AS ma, stddev_pop(lp) AS sa, avg(ab) AS mb, stddev_pop(ab) AS sb FROM b), "
    "s AS (SELECT o_orderkey, 0.0 + 1.2 * ((lp - ma) / (sa + 1e-9)) + 1.5 * seg + 1.0 * ((ab - mb) / (sb + 1e-9)) AS score FROM b, st), "
    f"k AS (SELECT greatest(1, CAST(floor(CAST(count(*) AS DOUBLE) * {TOPK_RATE}) AS BIGINT)) AS k FROM s), "
    "t AS (SELECT score AS thr FROM (SELECT score, row_number() OVER (ORDER BY score DESC) AS rn FROM s), k WHERE rn = k.k) "
    "SELECT o_orderkey, round(score, 6) AS score, CAST(score >= (SELECT thr FROM t) AS BIGINT) AS label FROM s",
    "parse_ts": "SELECT event_id, CAST(epoch(strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S')) AS BIGINT) AS ts_epoch, "
    "try_strptime(props, '%Y-%m-%d %H:%M:%S') IS NULL AS bad_text_is_null FROM events",
    "date_features": "SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour, CAST(isodow(ts) - 1 AS BIGINT) AS dayofweek, "
    "CAST(month(ts) AS BIGINT) AS month FROM events",
    "geo_distance": "WITH c AS (SELECT event_id, (event_id * 37 % 1800) / 10.0 - 90.0 AS lat, (event_id * 53 % 3600) / 10.0 - 180.0 AS lon, "
    "(event_id * 37 % 1800) / 10.0 - 90.0 + (user_id % 7 - 3) / 10.0 AS mlat, "
    "(event_id * 53 % 3600) / 10.0 - 180.0 + (event_id % 11 - 5) / 10.0 AS mlon FROM events), "
    "a AS (SELECT event_id, pow(sin(radians(mlat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(mlat)) * pow(sin(radians(mlon - lon) / 2), 2) AS a FROM c) "
    "SELECT event_id, round(2 * 6371.0 * asin(sqrt(least(a, 1.0))), 6) AS geo_distance_km FROM a",
    "ordered_split": "WITH r AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_idx, count(*) OVER () AS n FROM events) "
    "SELECT event_id, CAST(row_idx AS BIGINT) AS row_idx, CASE WHEN row_idx < CAST(floor(CAST(n AS DOUBLE) * 0.7) AS BIGINT) THEN 'train' "
    "WHEN row_idx < CAST(floor(CAST(n AS DOUBLE) * 0.85) AS BIGINT) THEN 'cal' ELSE 'test' END AS split FROM r",
}

QUERIES = {
    "feature_matrix": q_feature_matrix,
    "category_dict": q_category_dict,
    "category_encode": q_category_encode,
    "design_matrix": q_design_matrix,
    "design_sparse": q_design_sparse,
    "shuffle_split": q_shuffle_split,
    "stratified_sample": q_stratified_sample,
    "topk_label": q_topk_label,
    "parse_ts": q_parse_ts,
    "date_features": q_date_features,
    "geo_distance": q_geo_distance,
    "ordered_split": q_ordered_split,
}
