"""What must hold for fitted models whatever their coefficients: rules per row and recomputed figures, each with an oracle."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.contracts import REQUEST
from riskloom.operators.models import fit_posterior
from riskloom.operators.scoring import ScoringModel
from riskloom.plans.contract_queries import FRAUD_SRC, FRAUD_TYPES, status_sql
from riskloom.plans.feature_queries import ORDERS_SPEC
from riskloom.plans.model_queries import BAYES_TEST_SQL, ORDERS_BAYES_SPEC, _bayes_split
from riskloom.plans.serving_queries import q_score_requests, q_score_stream
from riskloom.plans.train_job import split_frame, train_model
from riskloom.session import scratch_path
from riskloom.sources.tables import ORDER_FRAME_SQL, order_frame


def _judged(scored: DataFrame) -> DataFrame:
    flagged = F.col("decision").cast("int") == 1
    return scored.select(
        "event_id", "domain", F.col("probability").between(0, 1).alias("bounded"), (~flagged | (F.col("probability") >= F.col("threshold"))).alias("by_threshold")
    )


def q_score_requests_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every accepted request is scored once, and flagged only at the threshold."""
    return _judged(q_score_requests(spark, sf_dir))


def q_score_stream_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the stream, which thereby scores the batch's requests."""
    return _judged(q_score_stream(spark, sf_dir))


def q_train_report_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of the test slice, and whether the report's figures are those of the saved model on that slice."""
    frame = order_frame(spark, sf_dir)
    res = train_model(ORDERS_SPEC, frame, artifacts_dir=scratch_path(spark, "artifacts"), log=False)
    test = split_frame(ORDERS_SPEC, frame, ORDERS_SPEC.learner.cuts, ("train", "cal", "test")).where(F.col("split") == "test")
    s = ScoringModel.load(res.model_path).score(test.withColumn("own_y", F.col("y")), keep=["own_y"])
    hit, flagged = F.col("own_y") == 1, F.col("probability") >= F.col("threshold")
    near = lambda got, name: F.abs(got - F.lit(res.metrics[name])) < 1e-6
    row = s.agg(
        F.count("*").alias("n_test"),
        F.sum(hit.cast("long")).alias("positives_test"),
        near(F.avg(F.pow(F.col("probability") - F.col("own_y"), 2)), "brier_cal").alias("same_brier"),
        near(F.coalesce(F.try_divide(F.sum((hit & flagged).cast("double")), F.sum(flagged.cast("double"))), F.lit(0.0)), "precision_at_threshold").alias("same_precision"),
        near(F.try_divide(F.sum((hit & flagged).cast("double")), F.sum(hit.cast("double"))), "recall_at_threshold").alias("same_recall"),
    )
    better = res.metrics["brier_cal"] <= res.metrics["brier_raw"] + 0.01
    return row.withColumn("calibration_no_worse", F.lit(better))


def q_posterior_interval_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals hold their mean, ``mu`` is the design row times the coefficients, and wider levels give wider intervals."""
    split, s = _bayes_split(spark, sf_dir), ORDERS_BAYES_SPEC
    post = fit_posterior(split.where(F.col("split") == "train"), s.names(False), s.names(True), "y", ci_level=s.learner.interval)
    test = split.where(F.col("split") == "test")
    terms = [F.lit(post.mean[0]), *(F.lit(b) * c for b, c in zip(post.mean[1:], post.design.columns(), strict=True))]
    narrow = post.score(test.withColumn("own_mu", reduce(add, terms)), ["o_orderkey", "own_mu"])
    wide = post.score(test, ["o_orderkey"], level=0.99).select("o_orderkey", F.col("ci_low").alias("low"), F.col("ci_high").alias("high"))
    return narrow.join(wide, "o_orderkey").select(
        "o_orderkey",
        ((F.col("ci_low") <= F.col("probability")) & (F.col("probability") <= F.col("ci_high"))).alias("holds_mean"),
        (F.abs(F.col("mu") - F.col("own_mu")) < 1e-9).alias("own_mu"),
        ((F.col("low") < F.col("ci_low")) & (F.col("ci_high") < F.col("high"))).alias("nested"),
    )


_SCORED_SQL = f"""SELECT event_id, 'fraud' AS domain, true AS bounded, true AS by_threshold
FROM ({status_sql(FRAUD_SRC, REQUEST, ["event_id"], FRAUD_TYPES, [])}) WHERE status = 'accepted'"""

ORACLES = {
    "score_requests_rule": _SCORED_SQL,
    "score_stream_rule": _SCORED_SQL,
    "train_report_rule": f"""WITH {ORDER_FRAME_SQL}, r AS (SELECT y, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM frame)
SELECT count(*) AS n_test, CAST(sum(y) AS BIGINT) AS positives_test, true AS same_brier, true AS same_precision, true AS same_recall, true AS calibration_no_worse
FROM r WHERE pos >= CAST(floor(CAST(n AS DOUBLE) * CAST(0.85 AS DOUBLE)) AS BIGINT)""",
    "posterior_interval_rule": BAYES_TEST_SQL + " SELECT o_orderkey, true AS holds_mean, true AS own_mu, true AS nested FROM test",
}

QUERIES = {
    "score_requests_rule": q_score_requests_rule,
    "score_stream_rule": q_score_stream_rule,
    "train_report_rule": q_train_report_rule,
    "posterior_interval_rule": q_posterior_interval_rule,
}
