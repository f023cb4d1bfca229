"""Imbalance-aware metrics over ``(y, p)`` score pairs.

All curve metrics start from one pre-aggregation per distinct score (map-side partial
aggregation, so a score shared by a third of the rows is one row per task), followed by
one descending two-level running sum (``prefix.cumulative``). From that table:

* precision-recall curve: per distinct score ``t`` (descending), ``tp(t)``,
  ``flagged(t)``, precision and recall;
* average precision: ``sum (R_n - R_{n-1}) P_n`` (step sum, no interpolation);
* ROC-AUC: ``sum pos_t (neg_below_t + neg_t / 2) / (P N)`` (ties count one half);
* threshold for a target precision: the lowest score whose precision reaches the target
  (recall never rises with the threshold, so that is the max-recall point), 1.0 if none.

Brier and confusion counts at a threshold are single aggregates over the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.stats import safe_ratio
from riskloom.operators.prefix import GROUP_ALL, cumulative, cut
from riskloom.operators.quantiles import exact_quantiles


def _ratio(num: Column, den: Column) -> Column:
    """``num / den`` or NULL when the denominator is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def with_totals(df: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach a one-row totals table (broadcast equi-join on a constant key)."""
    left = df if GROUP_ALL in df.columns else df.withColumn(GROUP_ALL, F.lit(0))
    right = totals.withColumn(GROUP_ALL, F.lit(0))
    return left.join(F.broadcast(right), GROUP_ALL).drop(GROUP_ALL)


@dataclass
class ScoreCurve:
    """Per-distinct-score running counts of a ``(y, p)`` frame, built once, reused."""

    scores: DataFrame
    y: str = "y"
    p: str = "p"

    def __post_init__(self) -> None:
        s = self.scores.select(F.col(self.y).cast("long").alias("y"), F.col(self.p).cast("double").alias("p"))
        self.rows = s.where(F.col("p").isNotNull() & F.col("y").isNotNull())
        groups = self.rows.groupBy("p").agg(F.sum("y").alias("pos_here"), F.count(F.lit(1)).alias("n_here"))
        cum = cumulative(groups, ["p"], ["pos_here", "n_here"], descending=True)
        cum = cut(cum.withColumnsRenamed({"cum_pos_here": "tp", "cum_n_here": "flagged"}))
        # The last running sums are the totals.
        self.totals = cum.agg(F.max("tp").alias("n_pos"), (F.max("flagged") - F.max("tp")).alias("n_neg"))
        self.table = with_totals(cum, self.totals)

    def pr_curve(self) -> DataFrame:
        """``(threshold, tp, n_flagged, precision, recall)`` per distinct score."""
        t = self.table
        return t.select(
            F.col("p").alias("threshold"),
            F.col("tp").cast("long").alias("tp"),
            F.col("flagged").cast("long").alias("n_flagged"),
            safe_ratio(F.col("tp"), F.col("flagged")).alias("precision"),
            _ratio(F.col("tp"), F.col("n_pos")).alias("recall"),
        )

    def summary(self) -> DataFrame:
        """One row: ``n, positives, average_precision, roc_auc``."""
        t = self.table
        prec = safe_ratio(F.col("tp"), F.col("flagged"))
        neg_here = F.col("n_here") - F.col("pos_here")
        neg_below = F.col("n_neg") - (F.col("flagged") - F.col("tp"))
        agg = t.groupBy("n_pos", "n_neg").agg(
            F.sum(F.col("pos_here") * prec).alias("_ap_num"),
            F.sum(F.col("pos_here") * (neg_below + F.lit(0.5) * neg_here)).alias("_auc_num"),
        )
        return agg.select(
            (F.col("n_pos") + F.col("n_neg")).cast("long").alias("n"),
            F.col("n_pos").cast("long").alias("positives"),
            _ratio(F.col("_ap_num"), F.col("n_pos")).alias("average_precision"),
            _ratio(F.col("_auc_num"), F.col("n_pos") * F.col("n_neg")).alias("roc_auc"),
        )

    def threshold_for_precision(self, target: float) -> DataFrame:
        """One row: ``target_precision, threshold, reachable`` (1.0 when unreachable)."""
        t = self.table
        ok = safe_ratio(F.col("tp"), F.col("flagged")) >= F.lit(target)
        agg = t.agg(F.min(F.when(ok, F.col("p"))).alias("_thr"))
        return agg.select(
            F.lit(float(target)).alias("target_precision"),
            F.coalesce(F.col("_thr"), F.lit(1.0)).alias("threshold"),
            F.col("_thr").isNotNull().alias("reachable"),
        )


def brier(scores: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return scores.agg(F.avg(F.pow(F.col(p) - F.col(y), 2)).alias("brier"))


def prevalence(df: DataFrame, y: str = "y") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(y)).cast("long").alias("positives"),
        F.avg(F.col(y).cast("double")).alias("prevalence"),
    )


def decide(p: Column, threshold: float | Column, reachable: Column | None = None) -> Column:
    """``p >= threshold`` as 0/1; an unreachable precision target flags nothing."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    d = (p >= thr).cast("int")
    return d if reachable is None else F.when(reachable, d).otherwise(F.lit(0))


def metrics_at_threshold(scores: DataFrame, threshold: float, y: str = "y", p: str = "p") -> DataFrame:
    """``threshold, tp, fp, fn, precision, recall, f1, n_flagged`` (0 when undefined)."""
    flag = F.col(p) >= F.lit(float(threshold))
    pos = F.col(y) == 1
    agg = scores.agg(
        F.sum((flag & pos).cast("long")).alias("tp"),
        F.sum((flag & ~pos).cast("long")).alias("fp"),
        F.sum((~flag & pos).cast("long")).alias("fn"),
    )
    prec = safe_ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    out = agg.select("*", prec.alias("precision"), rec.alias("recall"))
    f1 = safe_ratio(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return out.select(
        F.lit(float(threshold)).alias("threshold"),
        "tp", "fp", "fn", "precision", "recall", f1.alias("f1"),
        (F.col("tp") + F.col("fp")).alias("n_flagged"),
    )


def reliability_curve(scores: DataFrame, n_bins: int = 10, y: str = "y", p: str = "p") -> DataFrame:
    """Quantile-binned reliability: ``(bin, mean_p, frac_pos, n)`` per non-empty bin.

    Edges are the exact quantiles of ``p`` at ``0, 1/n_bins, ..., 1`` (not de-duplicated);
    the bin of a score is the number of inner edges strictly below it, so bins are
    right-closed ``(a, b]``.
    """
    rows = scores.select(F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("p")).where(
        F.col("p").isNotNull()
    )
    q = exact_quantiles(rows, "p", [i / n_bins for i in range(n_bins + 1)])
    inner = q.where((F.col("q_index") > 0) & (F.col("q_index") < n_bins)).agg(
        F.array_sort(F.collect_list("quantile")).alias("inner")
    )
    binned = with_totals(rows, inner)
    bin_id = sum(
        (F.coalesce((F.try_element_at("inner", F.lit(i)) < F.col("p")).cast("int"), F.lit(0)) for i in range(1, n_bins)),
        F.lit(0),
    )
    return (
        binned.withColumn("bin", bin_id)
        .groupBy("bin")
        .agg(F.avg("p").alias("mean_p"), F.avg("y").alias("frac_pos"), F.count(F.lit(1)).alias("n"))
    )

