"""Drift with kept state: mergeable counts per batch, feature and value.

A batch (a day, a delivery) is reduced once to ``(batch, feature, x, c)``, a row per distinct value, and stored under its name. Counts
add up, so the report on any set of batches reads the kept counts and never the rows again; a new day costs its own rows only. Storing a
batch anew replaces it, which makes a repeated or retried update harmless.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.stats import nan_to_null
from riskloom.operators.drift import DriftAnalysis

_SCHEMA = "feature string, x double, c long, batch string"


class DriftState:
    """Counts stored as Parquet under ``path``, one folder for each batch."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def update(self, rows: DataFrame, batch_col: str, features: Sequence[str]) -> None:
        """Reduce ``rows`` and store their batches; a batch that is there already is replaced, others stay.

        Rows without a batch are left out, as are NULL and NaN values, per feature. Batch names are the column as text.
        """
        feats = [f for f in features if f in rows.columns]
        if not feats:
            raise ValueError("none of the requested features is present")
        named = rows.where(F.col(f"`{batch_col}`").isNotNull())
        wide = named.select(F.col(f"`{batch_col}`").cast("string").alias("batch"), *[nan_to_null(F.col(f"`{f}`").cast("double")).alias(f) for f in feats])
        values = wide.unpivot(["batch"], feats, "feature", "x").where("x IS NOT NULL")
        counts = values.groupBy("batch", "feature", "x").agg(F.count(F.lit(1)).alias("c"))
        counts.select("feature", "x", "c", "batch").write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def counts(self) -> DataFrame:
        """``(feature, x, c, batch)`` of all batches; none if nothing was stored."""
        try:
            return self.spark.read.schema(_SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], _SCHEMA)

    def batches(self) -> DataFrame:
        """``(batch, feature, n)``: values kept of each batch."""
        return self.counts().groupBy("batch", "feature").agg(F.sum("c").alias("n"))

    def analysis(self, reference: Column, current: Column, **kw) -> DriftAnalysis:
        """Drift of the batches that ``current`` holds for against those of ``reference`` (conditions on ``batch``; a batch may count on both sides)."""
        side = lambda which: F.sum(F.when(which, F.col("c")).otherwise(F.lit(0))).cast("long")
        both = self.counts().where(reference | current)
        return DriftAnalysis.from_counts(both.groupBy("feature", "x").agg(side(reference).alias("c_ref"), side(current).alias("c_cur")), **kw)
