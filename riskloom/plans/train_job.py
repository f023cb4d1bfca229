"""Train job: split -> features -> fit -> calibrate -> threshold -> metrics -> save -> log.

One driver function over DataFrames that stay on the cluster; the split frame is cached
once and each stage reads it. Only metrics (scalars) and model parameters reach the
driver. Two paths, chosen by ``spec.learner``: boosted trees with a fitted calibrator,
or the Laplace posterior (calibrated by construction, with credible intervals).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.calibrate import choose_map
from riskloom.operators.features import project
from riskloom.operators.metrics import ScoreCurve, metrics_at_threshold
from riskloom.operators.models import fit_gbt, fit_posterior, gbt_score
from riskloom.operators.scoring import ScoringModel
from riskloom.operators.splits import shuffle_order, split_by_cut_keys
from riskloom.session import checkpoint_root
from riskloom.sources.runlog import log_run
from riskloom.spec import JobSpec, Posterior

#: Share of a Bayesian job's training rows that choose the threshold instead of fitting.
THRESHOLD_SHARE = 0.1


@dataclass
class TrainResult:
    model: ScoringModel
    metrics: dict[str, float]
    threshold: float
    calibration_method: str
    model_path: str | None = None
    run_id: str | None = None


def split_frame(spec: JobSpec, df: DataFrame, fractions, labels) -> DataFrame:
    key, order = spec.key, spec.time
    if order and order in df.columns:
        return split_by_cut_keys(df, [order, key], fractions, labels, keys_once=True)
    keyed, order = shuffle_order(df, key)
    return split_by_cut_keys(keyed, order, fractions, labels, keys_once=True).drop("_rl_shuffle", "_rl_shuffle_hi")


def score_summary(scores: DataFrame, p: str, y: str) -> dict[str, float]:
    s = scores.select(F.col(y).alias("y"), F.col(p).alias("p"))
    curve = ScoreCurve(s)
    row = curve.summary().first()
    brier = s.agg(F.avg(F.pow(F.col("p") - F.col("y"), 2))).first()[0]
    return {
        "average_precision": _f(row["average_precision"]) if row else math.nan,
        "roc_auc": _f(row["roc_auc"]) if row else math.nan,
        "brier": _f(brier),
        "curve": curve,
    }


def _f(v) -> float:
    return float(v) if v is not None else math.nan


def threshold_and_point(curve: ScoreCurve, scores: DataFrame, target: float, p: str, y: str) -> tuple[float, bool, dict]:
    t = curve.threshold_for_precision(target).first()
    thr, reachable = float(t["threshold"]), bool(t["reachable"])
    m = metrics_at_threshold(scores, thr, y=y, p=p).first()
    return thr, reachable, {"precision_at_threshold": m["precision"], "recall_at_threshold": m["recall"],
                            "f1_at_threshold": m["f1"], "n_flagged": _f(m["n_flagged"])}


def train_model(
    spec: JobSpec,
    df: DataFrame,
    *,
    artifacts_dir: str | None = None,
    log: bool = True,
    select_on: str = "cal",
) -> TrainResult:
    """Fit, calibrate, evaluate, persist and log one model for ``spec``.

    Calibrator and threshold come from the calibration slice, the calibrator judged on a part of it that it was not
    fitted on; ``select_on="test"`` takes the threshold from the test slice, as the original job does.
    """
    if isinstance(spec.learner, Posterior):
        return _train_posterior(spec, df, artifacts_dir=artifacts_dir, log=log, select_on=select_on)
    return _train_trees(spec, df, artifacts_dir=artifacts_dir, log=log, select_on=select_on)


def _save_and_log(spec, model, params, method, threshold, metrics, artifacts_dir, log) -> tuple[str, str | None]:
    spark = df_spark(model)
    root = artifacts_dir or f"{checkpoint_root(spark).rstrip('/')}/artifacts"
    path = model.save(f"{root}/{spec.domain}/model")
    run_id = None
    if log:
        run_id = log_run(
            spark, spec.domain, {**params, "calibration_method": method, "domain": spec.domain, "threshold": threshold},
            metrics, path,
        )
    return path, run_id


def df_spark(model: ScoringModel):
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession()


def _train_trees(spec, df, *, artifacts_dir, log, select_on) -> TrainResult:
    key, target = spec.key, spec.target
    split = split_frame(spec, df, spec.learner.cuts, ("train", "cal", "test"))
    feats, continuous, categorical = project(spec, split, keep=[key, "split"])
    feats = feats.persist()
    train = feats.where(F.col("split") == "train")
    trees = fit_gbt(train, continuous, categorical, target, dict(spec.learner.params))
    scored = gbt_score(trees, feats.where(F.col("split") != "train"), out="p_raw").persist()
    cal = scored.where(F.col("split") == "cal").select(F.col(target).alias("y"), F.col("p_raw").alias("p"))
    test = scored.where(F.col("split") == "test").select(F.col(key), F.col(target).alias("y"), F.col("p_raw").alias("p"))
    calibrator, _ = choose_map(cal, spec.learner.score_map)
    method = calibrator.kind
    test_cal = calibrator.apply(test, "p", "p_cal").persist()
    raw = score_summary(test_cal, "p", "y")
    calib = score_summary(test_cal, "p_cal", "y")
    thr_src = test_cal if select_on == "test" else calibrator.apply(cal, "p", "p_cal")
    thr_curve = calib["curve"] if select_on == "test" else ScoreCurve(thr_src.select("y", F.col("p_cal").alias("p")))
    threshold, reachable, point = threshold_and_point(thr_curve, test_cal, spec.precision, "p_cal", "y")
    counts = test_cal.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")).first()
    metrics = {
        "pr_auc_raw": raw["average_precision"],
        "pr_auc_cal": calib["average_precision"],
        "brier_raw": raw["brier"],
        "brier_cal": calib["brier"],
        "roc_auc": raw["roc_auc"],
        "precision_at_threshold": _f(point["precision_at_threshold"]),
        "recall_at_threshold": _f(point["recall_at_threshold"]),
        "f1_at_threshold": _f(point["f1_at_threshold"]),
        "n_test": float(counts["n"]),
        "positives_test": float(counts["pos"] or 0),
    }
    model = ScoringModel(spec, "gbt", threshold, reachable, calibrator, trees, None, continuous, categorical)
    path, run_id = _save_and_log(spec, model, dict(spec.learner.params), method, threshold, metrics, artifacts_dir, log)
    feats.unpersist()
    scored.unpersist()
    test_cal.unpersist()
    return TrainResult(model, metrics, threshold, method, path, run_id)


def _train_posterior(spec, df, *, artifacts_dir, log, select_on) -> TrainResult:
    key, target = spec.key, spec.target
    cut = spec.learner.cut
    # The last part of the training rows chooses the threshold; the posterior has not seen it.
    slices = ("train", "cal", "test")
    split = split_frame(spec, df, (cut * (1 - THRESHOLD_SHARE), cut), slices).persist()
    train, held, test = (split.where(F.col("split") == name) for name in slices)
    post = fit_posterior(train, spec.names(False), spec.names(True), target, ci_level=spec.learner.interval, draws=spec.learner.draws)
    scored = post.score(test, [key, target]).persist()
    s = scored.select(F.col(target).alias("y"), F.col("probability").alias("p"), "ci_low", "ci_high")
    summ = score_summary(s, "p", "y")
    if select_on == "test":
        curve = summ["curve"]
    else:
        curve = ScoreCurve(post.score(held, [target]).select(F.col(target).alias("y"), F.col("probability").alias("p")))
    threshold, reachable, point = threshold_and_point(curve, s, spec.precision, "p", "y")
    cov = interval_coverage(s).first()
    counts = s.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")).first()
    metrics = {
        "pr_auc": summ["average_precision"],
        "brier": summ["brier"],
        "roc_auc": summ["roc_auc"],
        "ci_coverage": _f(cov["coverage"]),
        "precision_at_threshold": _f(point["precision_at_threshold"]),
        "recall_at_threshold": _f(point["recall_at_threshold"]),
        "f1_at_threshold": _f(point["f1_at_threshold"]),
        "n_test": float(counts["n"]),
        "positives_test": float(counts["pos"] or 0),
    }
    model = ScoringModel(spec, "bayesian", threshold, reachable, None, None, post)
    path, run_id = _save_and_log(spec, model, {"cut": cut}, "bayesian_posterior", threshold, metrics, artifacts_dir, log)
    split.unpersist()
    scored.unpersist()
    return TrainResult(model, metrics, threshold, "bayesian_posterior", path, run_id)


def interval_coverage(scored: DataFrame, p: str = "p", y: str = "y", bins: int = 10) -> DataFrame:
    """``coverage``: share of rows whose own mean lies in its interval (the original,
    label-free definition) and ``coverage_label``: share of probability deciles whose
    observed positive rate lies inside the decile's mean interval."""
    inside = (F.col(p) >= F.col("ci_low")) & (F.col(p) <= F.col("ci_high"))
    base = scored.agg(F.avg(inside.cast("double")).alias("coverage"))
    dec = scored.withColumn("_bin", F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)))
    per = dec.groupBy("_bin").agg(
        F.avg(F.col(y).cast("double")).alias("rate"), F.avg("ci_low").alias("lo"), F.avg("ci_high").alias("hi")
    )
    lab = per.agg(F.avg(((F.col("rate") >= F.col("lo")) & (F.col("rate") <= F.col("hi"))).cast("double")).alias("coverage_label"))
    from riskloom.operators.metrics import with_totals

    return with_totals(base, lab)
