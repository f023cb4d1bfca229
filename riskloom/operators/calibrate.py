"""Probability calibration as fitted score maps.

A slice of scored rows is first reduced to one row per distinct score, with the number of rows and of
positives (map-side combined, so a tie held by a third of the rows is one row per task). Everything
here works on that table:

* isotonic: pooled blocks of the positive rate per score, weighted by rows (see ``isotonic``; linear between
  knots, clipped at the ends), kept as a table of knots;
* sigmoid: logistic regression on the score with an L2 penalty equal to ``C = 1`` on the summed
  loss, ``regParam = 1 / n``, unpenalised intercept, no standardisation; applied as a Column;
* identity: the score itself.

``choose_map`` deals the distinct scores' rows into a fitting part and a holdout part, compares all kinds by their
Brier score on the holdout in one aggregate, and fits the winner anew on everything.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.stats import sigmoid
from riskloom.operators.isotonic import fit_knots, interpolate

#: Names of the maps (fixed values); "none" stands for identity, "auto" for a choice.
KINDS = ("isotonic", "sigmoid", "identity")
#: Share of the rows that fit the candidates; the rest judges them.
FIT_SHARE = 0.5


@dataclass(frozen=True)
class IdentityMap:
    kind: str = "identity"

    def apply(self, df: DataFrame, p: str, out: str) -> DataFrame:
        return df.withColumn(out, F.col(p))


@dataclass(frozen=True)
class SigmoidMap:
    slope: float
    offset: float
    kind: str = "sigmoid"

    def apply(self, df: DataFrame, p: str, out: str) -> DataFrame:
        return df.withColumn(out, sigmoid(F.lit(self.slope) * F.col(p) + F.lit(self.offset)))


@dataclass(frozen=True)
class IsotonicMap:
    knots: DataFrame  # (score, value), checkpointed or read from a saved model
    n_knots: int
    kind: str = "isotonic"

    def apply(self, df: DataFrame, p: str, out: str) -> DataFrame:
        return interpolate(df, p, out, self.knots, self.n_knots)


ScoreMap = IdentityMap | SigmoidMap | IsotonicMap


def by_score(df: DataFrame, p: str = "p", y: str = "y") -> DataFrame:
    """``(score, n, pos)`` per distinct score; rows without score or label are left out."""
    rows = df.select(F.col(p).cast("double").alias("score"), F.col(y).cast("double").alias("_y")).where("score IS NOT NULL AND _y IS NOT NULL")
    return rows.groupBy("score").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("_y").alias("pos"))


def fit_map(kind: str, counts: DataFrame) -> ScoreMap:
    """Fit one kind of map on a table of :func:`by_score`."""
    if kind == "isotonic":
        knots = fit_knots(counts)
        return IsotonicMap(knots, knots.count())
    if kind == "sigmoid":
        total = counts.agg(F.sum("n")).first()[0] or 1.0
        sides = F.array(F.struct(F.lit(1.0).alias("label"), F.col("pos").alias("w")), F.struct(F.lit(0.0).alias("label"), (F.col("n") - F.col("pos")).alias("w")))
        rows = counts.select("score", F.explode(sides).alias("s")).select("score", "s.label", "s.w").where("w > 0")
        regression = LogisticRegression(
            featuresCol="_v", labelCol="label", weightCol="w", regParam=1.0 / total, elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-10
        )
        model = regression.fit(VectorAssembler(inputCols=["score"], outputCol="_v").transform(rows))
        return SigmoidMap(float(model.coefficients[0]), float(model.intercept))
    if kind in ("identity", "none"):
        return IdentityMap()
    raise ValueError(f"no score map of kind {kind!r}")


def brier_scores(counts: DataFrame, maps: dict[str, ScoreMap]) -> dict[str, float]:
    """Brier score of each map on a table of :func:`by_score`, all in one aggregate."""
    mapped = counts
    for name, m in maps.items():
        mapped = m.apply(mapped, "score", f"_rl_{name}")
    lost = lambda c: F.col("n") * F.col(c) * F.col(c) - 2 * F.col("pos") * F.col(c) + F.col("pos")
    row = mapped.agg(*[(F.sum(lost(f"_rl_{name}")) / F.sum("n")).alias(name) for name in maps]).first()
    return {name: float("inf") if row[name] is None else float(row[name]) for name in maps}


def choose_map(rows: DataFrame, kind: str = "auto", p: str = "p", y: str = "y") -> tuple[ScoreMap, dict[str, float]]:
    """The map of ``kind``, or with ``auto`` the better of isotonic and sigmoid; and the Brier scores it was judged by.

    Judged on a holdout that the candidates have not seen, dealt by a hash of score and label; the winner is fitted on all rows.
    """
    everything = by_score(rows, p, y)
    if kind != "auto":
        fitted = fit_map(kind, everything)
        return fitted, brier_scores(everything, {fitted.kind: fitted})
    fitting = F.pmod(F.xxhash64(p, y, F.lit("map")), F.lit(1000)) < F.lit(int(1000 * FIT_SHARE))
    part, holdout = by_score(rows.where(fitting), p, y), by_score(rows.where(~fitting), p, y)
    scores = brier_scores(holdout, {k: fit_map(k, part) for k in ("isotonic", "sigmoid")})
    return fit_map(min(scores, key=scores.get), everything), scores
