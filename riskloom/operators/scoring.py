"""Scoring model: features -> raw score -> calibrator -> decision (or posterior mean +
credible interval), persisted as one JSON metadata row, with the knots of an isotonic calibrator beside it.

The model is loaded once on the driver and shipped inside the plan, so a
batch and a streaming micro-batch run the same code. A path without a model is a ``ModelNotFound``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.calibrate import IdentityMap, IsotonicMap, ScoreMap, SigmoidMap
from riskloom.operators.features import project
from riskloom.operators.metrics import decide
from riskloom.operators.models import PosteriorModel, gbt_score
from riskloom.operators.trees import TreeModel
from riskloom.sources.files import path_exists
from riskloom.spec import JobSpec

OUTPUT_COLUMNS = ["probability", "decision", "threshold", "domain", "ci_low", "ci_high"]


def _q(name: str):
    return F.col(f"`{name}`")


class ModelNotFound(FileNotFoundError):
    """There is no trained model at the given place: a service would answer that it is not available."""


@dataclass
class ScoringModel:
    spec: JobSpec
    kind: str  # gbt | bayesian
    threshold: float
    reachable: bool = True
    calibrator: ScoreMap | None = None
    trees: TreeModel | None = None
    posterior: PosteriorModel | None = None
    continuous: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)

    @property
    def is_bayesian(self) -> bool:
        return self.kind == "bayesian"

    def score(self, df: DataFrame, keep: list[str] | None = None, level: float | None = None) -> DataFrame:
        """``keep`` columns + probability, decision, threshold, domain, ci_low, ci_high."""
        keep = list(keep or [])
        if self.is_bayesian:
            s = self.posterior.score(df, keep, level).drop("mu", "sd")
        else:
            feats, _, _ = project(self.spec, df, keep=keep)
            raw = gbt_score(self.trees, feats, out="_p_raw").select(*[_q(k) for k in keep], "_p_raw")
            cal = (self.calibrator or IdentityMap()).apply(raw, "_p_raw", "probability")
            s = cal.select(
                *[_q(k) for k in keep], "probability",
                F.lit(None).cast("double").alias("ci_low"), F.lit(None).cast("double").alias("ci_high"),
            )
        return s.select(
            *[_q(k) for k in keep],
            "probability",
            decide(F.col("probability"), self.threshold, F.lit(self.reachable)).alias("decision"),
            F.lit(float(self.threshold)).alias("threshold"),
            F.lit(self.spec.domain).alias("domain"),
            "ci_low",
            "ci_high",
        )

    # -- persistence ------------------------------------------------------------------
    def save(self, path: str) -> str:
        spark = SparkSession.getActiveSession()
        meta = {
            "spec": self.spec.to_dict(),
            "kind": self.kind,
            "threshold": self.threshold,
            "reachable": self.reachable,
            "calibrator": _map_dict(self.calibrator),
            "posterior": self.posterior.to_dict() if self.posterior else None,
            "trees": self.trees.to_dict() if self.trees else None,
            "continuous": self.continuous,
            "categorical": self.categorical,
        }
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(
            f"{path}/metadata"
        )
        if isinstance(self.calibrator, IsotonicMap):
            self.calibrator.knots.write.mode("overwrite").parquet(f"{path}/isotonic")
        return path

    @classmethod
    def load(cls, path: str) -> ScoringModel:
        spark = SparkSession.getActiveSession()
        if not path_exists(spark, f"{path}/metadata"):
            raise ModelNotFound(f"no model under {path}; train one first")
        meta = json.loads(spark.read.json(f"{path}/metadata").first()["meta"])
        spec = JobSpec.from_dict(meta["spec"])
        cal = None
        if meta["calibrator"]:
            c = meta["calibrator"]
            if c["kind"] == "isotonic":
                knots = spark.read.schema("score double, value double").parquet(f"{path}/isotonic")
                cal = IsotonicMap(knots, knots.count())
            else:
                cal = SigmoidMap(c["slope"], c["offset"]) if c["kind"] == "sigmoid" else IdentityMap()
        trees = TreeModel.from_dict(meta["trees"]) if meta["trees"] else None
        post = PosteriorModel.from_dict(meta["posterior"]) if meta["posterior"] else None
        return cls(spec, meta["kind"], meta["threshold"], meta["reachable"], cal, trees, post,
                   meta["continuous"], meta["categorical"])


def _map_dict(m: ScoreMap | None) -> dict | None:
    """A score map as JSON; the isotonic model is saved beside it."""
    if m is None:
        return None
    return {"kind": m.kind} | ({"slope": m.slope, "offset": m.offset} if isinstance(m, SigmoidMap) else {})
