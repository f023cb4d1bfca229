"""Metric queries over score pairs.

``events``: label ``event_type = 'purchase'``, score ``least(value / 100, 1)`` (heavy ties
at the cap). ``documents`` x ``labels``: label ``toxic``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.stats import round6
from riskloom.operators.cleaning import binarise
from riskloom.operators.metrics import (
    ScoreCurve,
    brier,
    decide,
    metrics_at_threshold,
    prevalence,
    reliability_curve,
    with_totals,
)
from riskloom.sources.tables import event_scores, table

# Fixed values of the event queries: target precision and decision threshold.
TARGET_PRECISION = 0.25
DECISION_THRESHOLD = 0.5


def q_pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = ScoreCurve(event_scores(spark, sf_dir)).pr_curve()
    return c.select(
        round6(F.col("threshold")).alias("threshold"), "tp", "n_flagged",
        round6(F.col("precision")).alias("precision"), round6(F.col("recall")).alias("recall"),
    )


def q_score_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = event_scores(spark, sf_dir)
    summary = ScoreCurve(s).summary()
    out = with_totals(summary, brier(s))
    return out.select(
        "n", "positives", round6(F.col("average_precision")).alias("average_precision"),
        round6(F.col("roc_auc")).alias("roc_auc"), round6(F.col("brier")).alias("brier"),
    )


def q_pick_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ScoreCurve(event_scores(spark, sf_dir)).threshold_for_precision(TARGET_PRECISION)
    return t.select(
        round6(F.col("target_precision")).alias("target_precision"),
        round6(F.col("threshold")).alias("threshold"), "reachable",
    )


def q_threshold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = metrics_at_threshold(event_scores(spark, sf_dir), DECISION_THRESHOLD)
    return m.select(
        round6(F.col("threshold")).alias("threshold"), "tp", "fp", "fn",
        round6(F.col("precision")).alias("precision"), round6(F.col("recall")).alias("recall"),
        round6(F.col("f1")).alias("f1"), "n_flagged",
    )


def q_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = event_scores(spark, sf_dir)
    return s.select("event_id", round6(F.col("p")).alias("p"), decide(F.col("p"), DECISION_THRESHOLD).alias("decision"))


def q_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reliability_curve(event_scores(spark, sf_dir), n_bins=10)
    return r.select(
        F.col("bin").cast("long").alias("bin"), round6(F.col("mean_p")).alias("mean_p"),
        round6(F.col("frac_pos")).alias("frac_pos"), F.col("n").cast("long").alias("n"),
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return labels.join(docs, "doc_id", "inner")


def q_prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = labelled_documents(spark, sf_dir)
    p = prevalence(d, "toxic")
    return p.select(F.col("n").cast("long").alias("n"), "positives", round6(F.col("prevalence")).alias("prevalence"))


def q_binarise_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return docs.select("doc_id", binarise("lang", "en").alias("label"))


SCORES_SQL = (
    "s AS (SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS y, least(value / 100.0, 1.0) AS p FROM events), "
    "g AS (SELECT p, sum(y) AS pos_here, count(*) AS n_here FROM s GROUP BY p), "
    "c AS (SELECT p, pos_here, n_here, "
    "sum(pos_here) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS tp, "
    "sum(n_here) OVER (ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS flagged, "
    "sum(pos_here) OVER () AS n_pos, sum(n_here - pos_here) OVER () AS n_neg FROM g)"
)

ORACLES = {
    "pr_curve": f"WITH {SCORES_SQL} SELECT round(p, 6) AS threshold, CAST(tp AS BIGINT) AS tp, "
    "CAST(flagged AS BIGINT) AS n_flagged, round(tp / flagged, 6) AS precision, round(tp / n_pos, 6) AS recall FROM c",
    "score_metrics": f"WITH {SCORES_SQL} SELECT CAST(max(n_pos) + max(n_neg) AS BIGINT) AS n, CAST(max(n_pos) AS BIGINT) AS positives, "
    "round(sum(pos_here * (tp / flagged)) / max(n_pos), 6) AS average_precision, "
    "round(sum(pos_here * ((n_neg - (flagged - tp)) + 0.5 * (n_here - pos_here))) / (max(n_pos) * max(n_neg)), 6) AS roc_auc, "
    "(SELECT round(avg(pow(p - y, 2)), 6) FROM s) AS brier FROM c",
    "pick_threshold": f"WITH {SCORES_SQL} SELECT round({TARGET_PRECISION}, 6) AS target_precision, "
    f"round(coalesce(min(p) FILTER (WHERE tp / flagged >= {TARGET_PRECISION}), 1.0), 6) AS threshold, "
    f"count(*) FILTER (WHERE tp / flagged >= {TARGET_PRECISION}) > 0 AS reachable FROM c",
    "threshold_metrics": f"WITH {SCORES_SQL}, m AS (SELECT "
    f"sum(CASE WHEN p >= {DECISION_THRESHOLD} AND y = 1 THEN 1 ELSE 0 END) AS tp, "
    f"sum(CASE WHEN p >= {DECISION_THRESHOLD} AND y = 0 THEN 1 ELSE 0 END) AS fp, "
    f"sum(CASE WHEN p < {DECISION_THRESHOLD} AND y = 1 THEN 1 ELSE 0 END) AS fn FROM s), "
    "r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision, "
    "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM m) "
    f"SELECT round({DECISION_THRESHOLD}, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, "
    "CAST(fn AS BIGINT) AS fn, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END, 6) AS f1, "
    "CAST(tp + fp AS BIGINT) AS n_flagged FROM r",
    "decide": f"WITH {SCORES_SQL} SELECT event_id, round(p, 6) AS p, CAST(p >= {DECISION_THRESHOLD} AS INTEGER) AS decision FROM s",
    "reliability": f"WITH {SCORES_SQL}, e AS (SELECT quantile_cont(p, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS q FROM s), "
    "b AS (SELECT s.y, s.p, len(list_filter(e.q[2:10], lambda x: x < s.p)) AS bin FROM s, e) "
    "SELECT CAST(bin AS BIGINT) AS bin, round(avg(p), 6) AS mean_p, round(avg(y), 6) AS frac_pos, CAST(count(*) AS BIGINT) AS n "
    "FROM b GROUP BY bin",
    "prevalence": "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(l.toxic) AS BIGINT) AS positives, "
    "round(avg(l.toxic), 6) AS prevalence FROM labels l JOIN documents d USING (doc_id)",
    "binarise_label": "SELECT doc_id, CAST(coalesce(lang = 'en', false) AS INTEGER) AS label FROM documents",
}

QUERIES = {
    "pr_curve": q_pr_curve,
    "score_metrics": q_score_metrics,
    "pick_threshold": q_pick_threshold,
    "threshold_metrics": q_threshold_metrics,
    "decide": q_decide,
    "reliability": q_reliability,
    "prevalence": q_prevalence,
    "binarise_label": q_binarise_label,
}
