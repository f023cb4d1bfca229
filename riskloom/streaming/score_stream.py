"""Streaming scorer: request records in, scored records and rejections out.

``readStream`` (one JSON document per line) -> the request contract splits each
micro-batch into accepted and rejected rows -> accepted rows are scored by the same
stateless ``ScoringModel.score`` used in batch -> both go to Parquet sinks from
``foreachBatch``. A batch is parsed and checked once and held until both sinks are written. Rejected rows keep
key, reasons and the body as it was sent, so nothing is lost. Restarts replay
from the checkpoint of the file source; batch ids make the sink writes idempotent (each batch writes its own
partition ``batch_id=...``, a replayed batch overwrites it). A ``RequestState`` adds what outlives a batch: keys
already scored, the watermark, and the counts of the scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.operators.contract import Contract, validate
from riskloom.operators.prefix import cut
from riskloom.operators.scoring import ScoringModel
from riskloom.sources.files import write_parquet
from riskloom.sources.records import BODY, EXTRA_FIELDS, JSON_TYPES, MALFORMED, parse_records
from riskloom.streaming.request_state import RequestState


def judged(records: DataFrame, contract: Contract) -> DataFrame:
    """Coerced records with ``status`` and ``reasons``; a malformed body has that one reason.

    Records with ``json_types`` and ``extra_fields`` (see ``records.with_json_types``) are judged strictly: a field of the wrong JSON type
    is a reason of its own, and so is one that the contract does not know.
    """
    rows = validate(records, contract).with_status()
    if JSON_TYPES in records.columns:
        own = F.concat(F.transform(JSON_TYPES, lambda f: F.concat(f, F.lit(":json_type"))), F.transform(EXTRA_FIELDS, lambda f: F.concat(f, F.lit(":extra_field"))))
        before = F.filter(F.split(F.coalesce("reasons", F.lit("")), "; "), lambda r: r != "")
        every = F.array_sort(F.concat(before, own))
        rows = rows.withColumns({"reasons": F.array_join(every, "; "), "status": F.when(F.size(every) > 0, "rejected").otherwise("accepted")}).drop(JSON_TYPES, EXTRA_FIELDS)
    return rows.withColumns(
        {
            "status": F.when(F.col(MALFORMED), "rejected").otherwise(F.col("status")),
            "reasons": F.when(F.col(MALFORMED), "body:malformed").otherwise(F.col("reasons")),
        }
    )


def request_split(records: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` of parsed records; rejected rows carry body and reasons."""
    rows = judged(records, contract)
    return rows.where(F.col("status") == "accepted").drop("status", "reasons", BODY, MALFORMED), rows.where(F.col("status") == "rejected").drop("status")


def start_scoring_stream(
    spark: SparkSession,
    source_dir: str,
    contract: Contract,
    model: ScoringModel,
    key: str,
    *,
    scored_dir: str,
    rejected_dir: str,
    checkpoint_dir: str,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    state: RequestState | None = None,
):
    """Start the streaming query; returns the ``StreamingQuery``. A trigger takes all new files unless told otherwise.

    With ``state`` each key is scored once, late requests go to the rejected sink, and the scores' counts are kept
    by batch for their drift.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.text(source_dir).withColumnRenamed("value", BODY)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = judged(parse_records(batch, contract, key), contract).persist()
        try:
            accepted = rows.where(F.col("status") == "accepted").drop("status", "reasons", MALFORMED)
            rejected = rows.where(F.col("status") == "rejected").select(key, "reasons", BODY)
            if state is not None:
                fresh, late = state.judge(accepted, batch_id)
                fresh = cut(fresh)
                rejected = rejected.unionByName(late.select(key, "reasons", BODY))
                scored = write_parquet(model.score(fresh.drop(BODY, "_rl_at"), keep=[key]), f"{scored_dir}/batch_id={batch_id}")
                state.record_scores(spark.read.parquet(scored), str(batch_id))
                state.record(fresh, batch_id)
            else:
                write_parquet(model.score(accepted.drop(BODY), keep=[key]), f"{scored_dir}/batch_id={batch_id}")
            write_parquet(rejected, f"{rejected_dir}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
