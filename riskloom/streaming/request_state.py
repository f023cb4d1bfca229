"""State of a request stream: which keys were scored, and how far event time has come.

Both are kept as small Parquet tables by micro-batch. A batch looks at the batches before it only and writes under its own number, so a batch
that is replayed after a failure finds the same state and writes the same rows: each request is scored once however often it
is sent or replayed. Keys older than the watermark are not looked at again (a request that old is late anyway), so the lookup
grows with the delay, not with the stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.drift import DriftAnalysis
from riskloom.operators.drift_state import DriftState
from riskloom.sources.files import path_exists

LATE, REPLAYED = "request:late", "request:replayed"


@dataclass
class RequestState:
    """``time``: event time of a record, a timestamp or null; ``delay``: how far behind the latest event time a request may be.

    Requests without an event time are never late; their keys are kept with the batch's highest event time.
    """

    spark: SparkSession
    path: str
    key: str
    time: Column
    delay: str = "1 hour"

    def _seen(self, batch_id: int) -> DataFrame:
        """``(key, at)`` scored by earlier batches."""
        empty = self.spark.createDataFrame([], "key string, at timestamp")
        if not path_exists(self.spark, f"{self.path}/seen"):
            return empty
        return self.spark.read.schema("key string, at timestamp, batch_id long").parquet(f"{self.path}/seen").where(F.col("batch_id") < batch_id).drop("batch_id")

    def watermark(self, batch_id: int):
        """Highest event time of earlier batches less the delay; None at first."""
        top = self._seen(batch_id).agg((F.max("at") - F.expr(f"INTERVAL {self.delay}")).alias("w")).first()["w"]
        return top

    def judge(self, accepted: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """``(fresh, refused)`` of accepted records: the first record of each new key, and the late ones with ``reasons``.

        Records of one key in one batch: the earliest, then the least by its columns. Later ones and replayed keys are
        neither scored nor refused, as their answer is there. Records without a key are all fresh.
        """
        limit = self.watermark(batch_id)
        at = self.time.cast("timestamp")
        late = F.lit(False) if limit is None else F.coalesce(at < F.lit(limit), F.lit(False))
        rows = accepted.withColumns({"_rl_at": at, "_rl_late": late, "_rl_key": F.col(f"`{self.key}`").cast("string")})
        seen = self._seen(batch_id)
        if limit is not None:
            seen = seen.where(F.col("at").isNull() | (F.col("at") >= F.lit(limit)))
        new = rows.join(seen.select(F.col("key").alias("_rl_key")).distinct(), "_rl_key", "left_anti")
        on_time = new.where("NOT _rl_late")
        whole = F.struct("_rl_at", *[F.col(f"`{c}`") for c in accepted.columns])
        # One row per key by an aggregate, which combines a key that is sent a million times before the shuffle.
        first = on_time.where("_rl_key IS NOT NULL").groupBy("_rl_key").agg(F.min(whole).alias("_rl_row"))
        nameless = on_time.where("_rl_key IS NULL").select(F.lit(None).cast("string").alias("_rl_key"), whole.alias("_rl_row"))
        fresh = first.unionByName(nameless).select("_rl_row.*")
        return fresh, new.where("_rl_late").drop("_rl_at", "_rl_late", "_rl_key").withColumn("reasons", F.lit(LATE))

    def record(self, fresh: DataFrame, batch_id: int) -> None:
        """Keep the keys of a batch; again for the same batch replaces them."""
        top = fresh.agg(F.max("_rl_at")).first()[0] or self.watermark(batch_id)
        kept = fresh.select(F.col(f"`{self.key}`").cast("string").alias("key"), F.coalesce("_rl_at", F.lit(top).cast("timestamp")).alias("at"))
        kept.where("key IS NOT NULL").write.mode("overwrite").parquet(f"{self.path}/seen/batch_id={batch_id}")

    # -- drift of the scores -----------------------------------------------------------------
    def record_scores(self, scored: DataFrame, batch: str, column: str = "probability") -> None:
        """Keep the counts of a batch's scores (see ``DriftState``); ``batch`` names it, such as "train" or a batch number."""
        DriftState(self.spark, f"{self.path}/scores").update(scored.withColumn("_rl_batch", F.lit(batch)), "_rl_batch", [column])

    def score_drift(self, reference: str, **kw) -> DriftAnalysis:
        """Drift of all other batches' scores against those of batch ``reference``."""
        return DriftState(self.spark, f"{self.path}/scores").analysis(F.col("batch") == reference, F.col("batch") != reference, **kw)
