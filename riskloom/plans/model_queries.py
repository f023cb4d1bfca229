"""Calibration, model-fit, scoring, persistence and run-log queries."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.stats import round6, sigmoid
from riskloom.operators.calibrate import IdentityMap, brier_scores, by_score, choose_map, fit_map
from riskloom.operators.features import project
from riskloom.operators.metrics import prevalence
from riskloom.operators.models import PRIOR_SD_INTERCEPT, PRIOR_SD_SLOPE, fit_gbt, fit_posterior, gbt_score
from riskloom.operators.prefix import cut
from riskloom.operators.scoring import ScoringModel
from riskloom.operators.splits import shuffle_split
from riskloom.operators.trees import fit_trees
from riskloom.plans.feature_queries import ORDERS_SPEC
from riskloom.plans.train_job import interval_coverage, split_frame, train_model
from riskloom.session import scratch_path
from riskloom.sources.runlog import log_run, read_runs
from riskloom.sources.tables import ORDER_FRAME_SQL, document_scores, order_frame
from riskloom.spec import DatePart, JobSpec, Posterior

# The Bayesian variant of the orders domain (no time column: seeded shuffle).
ORDERS_BAYES_SPEC = JobSpec(
    domain="orders_bayes",
    target="y",
    key="o_orderkey",
    features=tuple(f for f in ORDERS_SPEC.features if not isinstance(f, DatePart)),
    learner=Posterior(cut=0.8, interval=0.9),
    precision=0.6,
)


# -- calibration on documents x labels ---------------------------------------------------
def _doc_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle_split(document_scores(spark, sf_dir), "doc_id", (0.5,), ("cal", "eval"))


def q_calibrate_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = document_scores(spark, sf_dir)
    out = IdentityMap().apply(s, "p", "p_cal")
    return out.select("doc_id", F.col("y").cast("long").alias("y"), round6(F.col("p_cal")).alias("p_cal"))


def _calibrated(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    split = cut(_doc_split(spark, sf_dir))
    fitted = fit_map(method, by_score(split.where(F.col("split") == "cal")))
    ev = split.where(F.col("split") == "eval")
    return fitted.apply(ev, "p", "p_cal").select("doc_id", F.col("y").cast("long").alias("y"), round6(F.col("p")).alias("p"), round6(F.col("p_cal")).alias("p_cal"))


def q_calibrate_isotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calibrated(spark, sf_dir, "isotonic")


def q_calibrate_sigmoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calibrated(spark, sf_dir, "sigmoid")


def q_sigmoid_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradient of the penalised loss at the fitted sigmoid: 0 in both directions, up to rounding."""
    counts = cut(by_score(document_scores(spark, sf_dir)))
    m = fit_map("sigmoid", counts)
    off = F.col("n") * F.col("c") - F.col("pos")
    row = m.apply(counts, "score", "c").agg(
        ((F.sum(off * F.col("score")) + F.lit(m.slope)) / F.sum("n")).alias("slope"), (F.sum(off) / F.sum("n")).alias("offset")
    )
    return row.select(*[(F.round(c, 4) + F.lit(0.0)).alias(f"d_{c}") for c in ("slope", "offset")])


def q_calibrate_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = cut(_doc_split(spark, sf_dir))
    best, scores = choose_map(split.where(F.col("split") == "cal"))
    held = by_score(split.where(F.col("split") == "eval"))
    final = brier_scores(held, {"identity": IdentityMap(), "chosen": best})
    rows = [(best.kind, final["identity"], final["chosen"], scores["isotonic"], scores["sigmoid"])]
    return spark.createDataFrame(rows, "method string, brier_raw double, brier_chosen double, brier_isotonic double, brier_sigmoid double")


# -- boosted trees on orders x customer -------------------------------------------------
def q_train_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = split_frame(ORDERS_SPEC, order_frame(spark, sf_dir), (0.70, 0.85), ("train", "cal", "test"))
    feats, continuous, categorical = project(ORDERS_SPEC, split, keep=["o_orderkey", "split"])
    feats = cut(feats)
    model = fit_gbt(feats.where(F.col("split") == "train"), continuous, categorical, "y",
                    dict(ORDERS_SPEC.learner.params))
    test = feats.where(F.col("split") == "test")
    return gbt_score(model, test, out="p_raw").select("o_orderkey", "y", "p_raw")


STUMP_NUMBERS, STUMP_CATEGORIES = ["c_nationkey", "o_month"], ["o_orderpriority", "c_mktsegment", "o_orderstatus"]


def q_gbt_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First split of the boosted trees: feature, rows and values of both leaves."""
    frame = order_frame(spark, sf_dir).withColumn("o_month", F.month("o_orderdate"))
    model = fit_trees(frame, STUMP_NUMBERS, STUMP_CATEGORIES, "y", {"maxIter": 1, "maxDepth": 1, "reg_lambda": 0.001, "learning_rate": 0.1})
    t = model.trees[0]
    row = (model.binning.names[t.feature[0]], *(t.rows[k] for k in (t.left[0], t.right[0])), *(round(t.value[k], 6) for k in (t.left[0], t.right[0])))
    return spark.createDataFrame([row], "feature string, n_left long, n_right long, value_left double, value_right double")


def _metrics_frame(spark: SparkSession, metrics: dict[str, float], extra: dict[str, str]) -> DataFrame:
    rows = [(k, float(v) if v is not None else math.nan) for k, v in metrics.items()]
    df = spark.createDataFrame(rows, "metric string, value double")
    for k, v in extra.items():
        df = df.withColumn(k, F.lit(v))
    return df


def q_train_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    res = train_model(ORDERS_SPEC, order_frame(spark, sf_dir), artifacts_dir=scratch_path(spark, "artifacts"))
    return _metrics_frame(spark, {**res.metrics, "threshold": res.threshold},
                          {"calibration_method": res.calibration_method})


def q_score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = order_frame(spark, sf_dir)
    res = train_model(ORDERS_SPEC, frame, artifacts_dir=scratch_path(spark, "artifacts"), log=False)
    return res.model.score(frame, keep=["o_orderkey"])


def q_model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = order_frame(spark, sf_dir)
    res = train_model(ORDERS_SPEC, frame, artifacts_dir=scratch_path(spark, "artifacts"), log=False)
    loaded = ScoringModel.load(res.model_path)
    a = res.model.score(frame, keep=["o_orderkey"]).select("o_orderkey", F.col("probability").alias("p_fit"))
    b = loaded.score(frame, keep=["o_orderkey"]).select("o_orderkey", F.col("probability").alias("p_loaded"))
    j = a.join(b, "o_orderkey")
    return j.select("o_orderkey", (F.abs(F.col("p_fit") - F.col("p_loaded")) <= F.lit(1e-9)).alias("same"))


# -- Laplace posterior ------------------------------------------------------------------
def _bayes_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(split_frame(ORDERS_BAYES_SPEC, order_frame(spark, sf_dir), (0.8,), ("train", "test")))


def q_posterior_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _bayes_split(spark, sf_dir)
    s = ORDERS_BAYES_SPEC
    post = fit_posterior(split.where(F.col("split") == "train"), s.names(False), s.names(True), "y")
    terms = ["intercept", *post.design.output_columns]
    rows = [(t, float(m), float(math.sqrt(max(post.cov[i][i], 0.0)))) for i, (t, m) in enumerate(zip(terms, post.mean))]
    return spark.createDataFrame(rows, "term string, mean double, sd double")


def _posterior_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = _bayes_split(spark, sf_dir)
    s = ORDERS_BAYES_SPEC
    post = fit_posterior(split.where(F.col("split") == "train"), s.names(False), s.names(True), "y",
                         ci_level=s.learner.interval)
    return post.score(split.where(F.col("split") == "test"), ["o_orderkey", "y"])


def q_posterior_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradient of the log posterior at the fitted mean, per term and row: 0 up to rounding."""
    train = _bayes_split(spark, sf_dir).where(F.col("split") == "train")
    s = ORDERS_BAYES_SPEC
    post = fit_posterior(train, s.names(False), s.names(True), "y")
    scored = post.score(train.withColumn("_rl_design", post.design.packed()), ["_rl_design", "y"])
    off = F.col("y") - sigmoid(F.col("mu"))
    pieces = scored.select(off.alias("off"), F.posexplode("_rl_design").alias("i", "x"))
    sums = pieces.groupBy("i").agg(F.sum(F.col("off") * F.col("x")).alias("g"), F.count(F.lit(1)).alias("n"))
    terms = ["intercept", *post.design.output_columns]
    prior = [m / (PRIOR_SD_INTERCEPT if i == 0 else PRIOR_SD_SLOPE) ** 2 for i, m in enumerate(post.mean)]
    table = spark.createDataFrame(list(zip(range(len(terms)), terms, prior)), "i int, term string, prior double")
    return sums.join(table, "i").select("term", (F.round((F.col("g") - F.col("prior")) / F.col("n"), 6) + F.lit(0.0)).alias("gradient"))


def q_posterior_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _posterior_scores(spark, sf_dir).select("o_orderkey", "probability", "ci_low", "ci_high")


POSTERIOR_DRAWS = 1_000


def q_posterior_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores from posterior draws against those of the normal law, per test row: ordered, and close as the rows are many."""
    split, s = _bayes_split(spark, sf_dir), ORDERS_BAYES_SPEC
    post = fit_posterior(split.where(F.col("split") == "train"), s.names(False), s.names(True), "y", ci_level=s.learner.interval, draws=POSTERIOR_DRAWS)
    test = split.where(F.col("split") == "test")
    drawn = post.score(test, ["o_orderkey"])
    normal = replace(post, draws=None).score(test, ["o_orderkey"]).select("o_orderkey", *(F.col(c).alias(f"n_{c}") for c in ("probability", "ci_low", "ci_high")))
    close = [F.abs(F.col(c) - F.col(f"n_{c}")) < 0.02 for c in ("probability", "ci_low", "ci_high")]
    both = drawn.join(normal, "o_orderkey")
    return both.select("o_orderkey", ((F.col("ci_low") <= F.col("probability")) & (F.col("probability") <= F.col("ci_high"))).alias("ordered"), (close[0] & close[1] & close[2]).alias("close"))


def q_interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _posterior_scores(spark, sf_dir).select(F.col("y"), F.col("probability").alias("p"), "ci_low", "ci_high")
    return interval_coverage(s)


# -- run log ----------------------------------------------------------------------------
def q_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = order_frame(spark, sf_dir)
    r = prevalence(frame, "y").first()
    metrics = {"n_rows": float(r["n"]), "positives": float(r["positives"]), "prevalence": float(r["prevalence"]),
               "ci_coverage": math.nan}
    path = scratch_path(spark, "runlog")
    log_run(spark, ORDERS_SPEC.domain, {"maxIter": 20, "calibration_method": "auto"}, metrics, None, path=path)
    runs = read_runs(spark, path)
    return runs.where(F.col("kind") == "metric").select("domain", "kind", "key", round6(F.col("value")).alias("value"))


_DOC_SCORES_SQL = """docs AS (SELECT d.doc_id, CAST(l.toxic AS BIGINT) AS y, 1.0 / (1.0 + exp(-ln(1 + CAST(d.n_chars AS DOUBLE)) + 7.0)) AS p,
 row_number() OVER (ORDER BY md5(CAST(d.doc_id AS VARCHAR) || ':42'), d.doc_id) - 1 AS pos, count(*) OVER () AS total FROM labels l JOIN documents d USING (doc_id))"""
#: Min-max formula of isotonic regression on the calibration half, linear between scores.
ISOTONIC_SQL = f"""WITH {_DOC_SCORES_SQL},
cal AS (SELECT p, count(*) AS n, sum(y) AS s FROM docs WHERE pos < CAST(floor(total * 0.5) AS BIGINT) GROUP BY p),
run AS (SELECT p, sum(n) OVER w AS cn, sum(s) OVER w AS cs, n, s, row_number() OVER (ORDER BY p) AS i FROM cal WINDOW w AS (ORDER BY p)),
spans AS (SELECT a.i AS i, b.i AS j, (b.cs - a.cs + a.s) / (b.cn - a.cn + a.n) AS m FROM run a JOIN run b ON b.i >= a.i),
lows AS (SELECT i, j, min(m) OVER (PARTITION BY i ORDER BY j DESC) AS m FROM spans),
fit AS (SELECT r.p, max(l.m) AS c FROM run r JOIN lows l ON l.i <= r.i AND l.j = r.i GROUP BY r.p),
ev AS (SELECT doc_id, y, p FROM docs WHERE pos >= CAST(floor(total * 0.5) AS BIGINT)),
near AS (SELECT e.doc_id, e.y, e.p, (SELECT max(f.p) FROM fit f WHERE f.p <= e.p) AS lo, (SELECT min(f.p) FROM fit f WHERE f.p >= e.p) AS hi FROM ev e)
SELECT x.doc_id, x.y, round(x.p, 6) AS p, round(CASE WHEN x.lo IS NULL THEN h.c WHEN x.hi IS NULL OR x.lo = x.hi THEN l.c
 ELSE l.c + (h.c - l.c) * (x.p - x.lo) / (x.hi - x.lo) END, 6) AS p_cal
FROM near x LEFT JOIN fit l ON l.p = x.lo LEFT JOIN fit h ON h.p = x.hi"""

#: Every cut of the numbers and every prefix of the levels by mean gradient; ties as in the operator.
GBT_STUMP_SQL = "WITH " + ORDER_FRAME_SQL + """, base AS (SELECT avg(y) AS p FROM frame),
long AS (
  SELECT 0 AS f, 'c_nationkey' AS feature, CAST(c_nationkey AS DOUBLE) AS num, NULL AS level, y FROM frame
  UNION ALL SELECT 1, 'o_month', CAST(month(o_orderdate) AS DOUBLE), NULL, y FROM frame
  UNION ALL SELECT 2, 'o_orderpriority', NULL, o_orderpriority, y FROM frame
  UNION ALL SELECT 3, 'c_mktsegment', NULL, c_mktsegment, y FROM frame
  UNION ALL SELECT 4, 'o_orderstatus', NULL, o_orderstatus, y FROM frame),
bins AS (SELECT f, feature, num, level, count(*) AS n, count(*) * p - sum(y) AS g, count(*) * p * (1 - p) AS h FROM long, base GROUP BY f, feature, num, level, p),
placed AS (SELECT *, row_number() OVER (PARTITION BY f ORDER BY num, CASE WHEN num IS NULL THEN g / (h + 0.001) END, level) AS k FROM bins),
sums AS (SELECT f, feature, k, sum(n) OVER w AS nl, sum(g) OVER w AS gl, sum(h) OVER w AS hl,
  sum(n) OVER (PARTITION BY f) AS nt, sum(g) OVER (PARTITION BY f) AS gt, sum(h) OVER (PARTITION BY f) AS ht
  FROM placed WINDOW w AS (PARTITION BY f ORDER BY k)),
gains AS (SELECT *, gl * gl / (hl + 0.001) + (gt - gl) * (gt - gl) / (ht - hl + 0.001) - gt * gt / (ht + 0.001) AS gain FROM sums WHERE nl < nt)
SELECT feature, CAST(nl AS BIGINT) AS n_left, CAST(nt - nl AS BIGINT) AS n_right, round(-0.1 * gl / (hl + 0.001), 6) AS value_left,
 round(-0.1 * (gt - gl) / (ht - hl + 0.001), 6) AS value_right FROM gains ORDER BY gain DESC, f, k LIMIT 1"""
#: Test rows of the Bayesian split.
BAYES_TEST_SQL = f"""WITH {ORDER_FRAME_SQL}, r AS (SELECT o_orderkey, y, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || ':42'), o_orderkey) - 1 AS pos,
 count(*) OVER () AS n FROM frame), test AS (SELECT o_orderkey, y FROM r WHERE pos >= CAST(floor(CAST(n AS DOUBLE) * CAST(0.8 AS DOUBLE)) AS BIGINT))"""

ORACLES = {
    "gbt_stump": GBT_STUMP_SQL,
    "posterior_draws": BAYES_TEST_SQL + " SELECT o_orderkey, true AS ordered, true AS close FROM test",
    "calibrate_isotonic": ISOTONIC_SQL,
    "sigmoid_gradient": "SELECT 0.0 AS d_slope, 0.0 AS d_offset FROM (SELECT count(*) FROM documents)",
    "posterior_gradient": "WITH " + ORDER_FRAME_SQL + """, terms AS (SELECT 'intercept' AS term UNION ALL SELECT unnest(['z_o_totalprice', 'z_c_acctbal', 'z_c_nationkey'])
 UNION ALL (SELECT DISTINCT 'o_orderstatus_' || o_orderstatus FROM frame WHERE o_orderstatus > (SELECT min(o_orderstatus) FROM frame))
 UNION ALL (SELECT DISTINCT 'o_orderpriority_' || o_orderpriority FROM frame WHERE o_orderpriority > (SELECT min(o_orderpriority) FROM frame))
 UNION ALL (SELECT DISTINCT 'c_mktsegment_' || c_mktsegment FROM frame WHERE c_mktsegment > (SELECT min(c_mktsegment) FROM frame)))
SELECT term, 0.0 AS gradient FROM terms""",
    "model_roundtrip": "WITH " + ORDER_FRAME_SQL + " SELECT o_orderkey, true AS same FROM frame",
    "calibrate_identity": "SELECT d.doc_id, CAST(l.toxic AS BIGINT) AS y, "
    "round(1.0 / (1.0 + exp(-ln(1 + CAST(d.n_chars AS DOUBLE)) + 7.0)), 6) AS p_cal "
    "FROM labels l JOIN documents d USING (doc_id)",
    "run_log": "WITH f AS (SELECT CAST(((o.o_totalprice > 420000.0) <> (substr(md5(CAST(o.o_orderkey AS VARCHAR)), 1, 1) = '0')) AS INTEGER) AS y "
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) "
    "SELECT 'orders' AS domain, 'metric' AS kind, 'n_rows' AS key, round(CAST(count(*) AS DOUBLE), 6) AS value FROM f "
    "UNION ALL SELECT 'orders', 'metric', 'positives', round(CAST(sum(y) AS DOUBLE), 6) FROM f "
    "UNION ALL SELECT 'orders', 'metric', 'prevalence', round(avg(y), 6) FROM f",
}

QUERIES = {
    "calibrate_identity": q_calibrate_identity,
    "calibrate_isotonic": q_calibrate_isotonic,
    "calibrate_sigmoid": q_calibrate_sigmoid,
    "sigmoid_gradient": q_sigmoid_gradient,
    "calibrate_select": q_calibrate_select,
    "train_gbt": q_train_gbt,
    "gbt_stump": q_gbt_stump,
    "posterior_draws": q_posterior_draws,
    "train_report": q_train_report,
    "score_batch": q_score_batch,
    "model_roundtrip": q_model_roundtrip,
    "posterior_fit": q_posterior_fit,
    "posterior_gradient": q_posterior_gradient,
    "posterior_interval": q_posterior_interval,
    "interval_coverage": q_interval_coverage,
    "run_log": q_run_log,
}
