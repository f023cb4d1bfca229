"""Distribution drift per feature: PSI over reference-quantile bins and two-sample KS.

Plan shape, for any number of features:

* one scan, unpivot to ``(feature, side, x)`` (``Expand``), per-feature null drop;
* one grouped count per ``(feature, x)`` with both sides as conditional sums (map-side
  partial aggregation, so a hot value costs one row per task);
* one two-level running sum over the distinct values per feature (see ``prefix``),
  which yields both empirical CDFs (KS) and the rank spans for the exact reference
  quantiles (PSI edges);
* aggregates over at most ``features x (bins + 1)`` rows for the rest.

Semantics kept on purpose: quantile edges are made unique and the outer ones replaced by
-inf/+inf, so a constant reference gives one bin and PSI 0 (and a two-valued reference
likewise collapses); bins are ``[a, b)``; proportions are clipped to >= 1e-6 without
renormalising; ``drifted = psi > psi_threshold OR ks_pvalue < ks_pvalue_threshold``;
an empty side gives NULL. The KS p-value follows the exact law up to 10,000 rows a side and the Kolmogorov
series beyond (``ks_law``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.ks_law import EXACT_ROWS, ks_pvalue_exact
from riskloom.functions.stats import ks_pvalue, nan_to_null
from riskloom.operators.prefix import cumulative, cut
from riskloom.operators.quantiles import quantiles_from_cumulative

# Clip floor for bin proportions and default bin count.
PSI_EPS = 1e-6
DEFAULT_BINS = 10
REFERENCE, CURRENT = 0, 1


def quantile_points(bins: int) -> list[float]:
    return [i / bins for i in range(bins + 1)]


def long_values(df: DataFrame, features: Sequence[str], side_col: str = "side") -> DataFrame:
    """``(side, feature, x)`` with NaN and NULL dropped per feature (not per row)."""
    feats = [f for f in features if f in df.columns]
    if not feats:
        raise ValueError("none of the requested features is present")
    wide = df.select(
        F.col(side_col).cast("int").alias("side"),
        *[nan_to_null(F.col(f"`{f}`").cast("double")).alias(f) for f in feats],
    )
    long = wide.unpivot(["side"], feats, "feature", "x")
    return long.where(F.col("x").isNotNull())


def union_sides(reference: DataFrame, current: DataFrame, features: Sequence[str]) -> DataFrame:
    """Stack two tables with a side marker; only features present in both are kept."""
    feats = [f for f in features if f in reference.columns and f in current.columns]
    ref = reference.select(F.lit(REFERENCE).alias("side"), *[F.col(f"`{f}`") for f in feats])
    cur = current.select(F.lit(CURRENT).alias("side"), *[F.col(f"`{f}`") for f in feats])
    return ref.unionByName(cur)


@dataclass
class DriftAnalysis:
    """Drift tables over a ``(side, feature, x)`` long frame, or over its counts (:meth:`from_counts`).

    The distinct-value table with both running counts is built once and checkpointed. One
    bounded result is then read back: per feature the two sizes and the reference quantiles
    (``features x (bins + 1)`` numbers). Everything after that is one aggregate per output over
    the checkpointed table.
    """

    long: DataFrame | None
    bins: int = DEFAULT_BINS
    psi_threshold: float = 0.2
    ks_pvalue_threshold: float = 0.05
    #: "auto": the exact KS law up to EXACT_ROWS rows a side, the series beyond; "series": always the series.
    ks_law: str = "auto"
    counts: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.ks_law not in ("auto", "series"):
            raise ValueError(f"no KS law {self.ks_law!r}")
        if self.counts is None:
            self.counts = self.long.groupBy("feature", "x").agg(
                F.sum((F.col("side") == REFERENCE).cast("long")).alias("c_ref"),
                F.sum((F.col("side") == CURRENT).cast("long")).alias("c_cur"),
            )
        self.cum = cut(cumulative(self.counts, ["x"], ["c_ref", "c_cur"], group_cols=["feature"], keep_bucket=True))
        self._facts: dict[str, tuple[int, int, list[float]]] | None = None

    @classmethod
    def from_tables(cls, reference: DataFrame, current: DataFrame, features: Sequence[str], **kw) -> DriftAnalysis:
        stacked = union_sides(reference, current, features)
        return cls(long_values(stacked, [f for f in features if f in stacked.columns]), **kw)

    @classmethod
    def from_counts(cls, counts: DataFrame, **kw) -> DriftAnalysis:
        """From ``(feature, x, c_ref, c_cur)``, one row per distinct value, x never null or NaN."""
        return cls(None, counts=counts, **kw)

    # -- bounded facts -----------------------------------------------------------------
    def quantile_edges(self) -> DataFrame:
        """Reference-side quantiles at ``0, 1/bins, ..., 1`` (before de-duplication)."""
        return quantiles_from_cumulative(
            self.cum, "x", "c_ref", quantile_points(self.bins), group_cols=["feature"], cum_col="cum_c_ref"
        )

    def facts(self) -> dict[str, tuple[int, int, list[float]]]:
        """Per feature: reference size, current size, reference quantiles (none for an empty reference)."""
        if self._facts is None:
            sizes = self.cum.groupBy("feature").agg(F.max("cum_c_ref").alias("n_ref"), F.max("cum_c_cur").alias("n_cur"))
            edges = self.quantile_edges().groupBy("feature").agg(
                F.array_sort(F.collect_list(F.struct("q_index", "quantile"))).alias("e")
            )
            rows = sizes.join(edges, "feature", "left").collect()
            self._facts = {r["feature"]: (int(r["n_ref"]), int(r["n_cur"]), [x["quantile"] for x in r["e"] or []]) for r in rows}
        return self._facts

    def _features(self) -> DataFrame:
        """One row per feature: sizes and the inner edges of its bins, ascending."""
        rows = []
        for f, (n_ref, n_cur, q) in self.facts().items():
            u = sorted(set(q))
            rows.append((f, n_ref, n_cur, max(len(u) - 1, 0), u[1:-1]))
        schema = "feature string, n_ref long, n_cur long, n_bins int, inner_edges array<double>"
        return self.cum.sparkSession.createDataFrame(rows, schema)

    def _with_features(self) -> DataFrame:
        """The distinct values with their feature's row: one row per feature, broadcast."""
        totals = self._features().withColumnsRenamed({"n_ref": "total_ref", "n_cur": "total_cur"})
        return self.cum.join(F.broadcast(totals), "feature")

    # -- quantile bins -------------------------------------------------------------------
    def _binned_counts(self) -> DataFrame:
        """Bin = number of inner edges <= x; features without a reference have no bins."""
        reached = F.aggregate("inner_edges", F.lit(0), lambda n, e: n + (e <= F.col("x")).cast("int"))
        return (
            self._with_features()
            .where(F.col("total_ref") > 0)
            .groupBy("feature", "total_ref", "total_cur", reached.alias("bin"))
            .agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur"))
        )

    def psi_bins(self) -> DataFrame:
        """Full grid ``(feature, bin, n_ref, n_cur)`` of counts per reference bin."""
        grid = self._features().where(F.col("n_bins") > 0).select(
            "feature", F.explode(F.sequence(F.lit(0), F.col("n_bins") - 1)).alias("bin")
        )
        return grid.join(self._binned_counts().drop("total_ref", "total_cur"), ["feature", "bin"], "left").select(
            "feature",
            "bin",
            F.coalesce("n_ref", F.lit(0)).cast("long").alias("n_ref"),
            F.coalesce("n_cur", F.lit(0)).cast("long").alias("n_cur"),
        )

    def psi(self) -> DataFrame:
        """``(feature, psi)``; 0 for a constant reference, NULL for an empty side.

        Bins empty on both sides contribute exactly 0 (both proportions clip to 1e-6),
        so only the bins present in the data are summed.
        """
        e = F.greatest(F.try_divide(F.col("n_ref").cast("double"), F.col("total_ref")), F.lit(PSI_EPS))
        a = F.greatest(F.try_divide(F.col("n_cur").cast("double"), F.col("total_cur")), F.lit(PSI_EPS))
        per = self._binned_counts().groupBy("feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi_sum"))
        psi = (
            F.when((F.col("n_ref") == 0) | (F.col("n_cur") == 0), F.lit(None).cast("double"))
            .when(F.col("n_bins") < 1, F.lit(0.0))
            .otherwise(F.coalesce("psi_sum", F.lit(0.0)))
        )
        return self._features().join(per, "feature", "left").select("feature", psi.alias("psi"))

    # -- KS ---------------------------------------------------------------------
    def ks(self) -> DataFrame:
        """``(feature, ks_stat, ks_pvalue, n_ref, n_cur)``."""
        share = lambda c, n: F.try_divide(F.col(c).cast("double"), F.col(n))
        gap = F.abs(share("cum_c_ref", "total_ref") - share("cum_c_cur", "total_cur"))
        both = self._with_features().where((F.col("total_ref") > 0) & (F.col("total_cur") > 0))
        stat = both.groupBy("feature").agg(F.max(gap).alias("ks_stat"))
        out = self._features().join(stat, "feature", "left")
        p = ks_pvalue(F.col("ks_stat"), F.col("n_ref"), F.col("n_cur"))
        if self.ks_law == "auto" and any(max(n_ref, n_cur) <= EXACT_ROWS for n_ref, n_cur, _ in self.facts().values()):
            small = F.greatest("n_ref", "n_cur") <= EXACT_ROWS
            # Large features get null sizes, so that the recursion is not run for them.
            exact = ks_pvalue_exact(F.when(small, F.col("ks_stat")), F.col("n_ref"), F.col("n_cur"))
            p = F.when(small, exact).otherwise(p)
        return out.select(
            "feature",
            "ks_stat",
            p.alias("ks_pvalue"),
            "n_ref",
            "n_cur",
        )

    # -- report -----------------------------------------------------------------
    def tests(self) -> DataFrame:
        """``(feature, psi, ks_stat, ks_pvalue, psi_drifted, ks_drifted)``: each test with its own flag."""
        both = self.psi().join(self.ks(), "feature", "full")
        return both.select(
            "feature",
            "psi",
            "ks_stat",
            "ks_pvalue",
            (F.col("psi") > F.lit(self.psi_threshold)).alias("psi_drifted"),
            (F.col("ks_pvalue") < F.lit(self.ks_pvalue_threshold)).alias("ks_drifted"),
        )

    def report(self) -> DataFrame:
        """``(feature, psi, ks_stat, ks_pvalue, drifted)``, one row per feature."""
        return self.tests().select("feature", "psi", "ks_stat", "ks_pvalue", (F.col("psi_drifted") | F.col("ks_drifted")).alias("drifted"))

    def rollup(self) -> DataFrame:
        """One row: any drift, counts, sorted list of drifted features and a summary."""
        return rollup_report(self.report())


def rollup_report(report: DataFrame) -> DataFrame:
    flagged = F.coalesce(F.col("drifted"), F.lit(False))
    agg = report.agg(
        F.coalesce(F.bool_or(flagged), F.lit(False)).alias("any_drift"),
        F.sum(flagged.cast("long")).alias("n_drifted"),
        F.count(F.lit(1)).alias("n_features"),
        F.array_join(F.array_sort(F.collect_list(F.when(flagged, F.col("feature")))), ", ").alias(
            "drifted_features"
        ),
    )
    summary = F.when(
        F.col("any_drift"),
        F.format_string("DRIFT detected in %d/%d features: %s.", "n_drifted", "n_features", "drifted_features"),
    ).otherwise(F.format_string("No relevant drift in %d features.", "n_features"))
    return agg.withColumn("summary", summary)
