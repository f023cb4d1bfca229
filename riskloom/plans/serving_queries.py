"""Scoring at the edge (batch and streaming) and the end-to-end job, on the fraud-shaped
frame derived from ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.contracts import DROPOUT, FRAUD, MEDICATION_COLS, READMISSION, REQUEST
from riskloom.operators.contract import schema_of, validate
from riskloom.plans.contract_queries import FRAUD_SRC, FRAUD_TYPES, dropout_frame, fraud_frame, readmission_frame, status_sql
from riskloom.plans.domain_job import run_job
from riskloom.plans.train_job import train_model
from riskloom.session import scratch_path
from riskloom.sources.files import materialize, write_csv
from riskloom.spec import MERCHANT_DISTANCE, Category, JobSpec, Number, Posterior, Trees, categories, date_parts, numbers
from riskloom.sources.records import parse_records, to_json_records, with_json_types
from riskloom.streaming.score_stream import judged, request_split, start_scoring_stream

# The fraud domain spec (columns as in the fraud contract).
FRAUD_SPEC = JobSpec(
    domain="fraud",
    target="is_fraud",
    key="event_id",
    features=(
        *numbers("amt", "city_pop", "lat", "long", "merch_lat", "merch_long"),
        *date_parts("trans_date_trans_time"),
        MERCHANT_DISTANCE,
        *categories("category", "gender", "state"),
    ),
    time="trans_date_trans_time",
    learner=Trees({"maxIter": 10, "maxDepth": 4, "stepSize": 0.1, "is_unbalance": True}),
    precision=0.5,
)
REQUEST_COLUMNS = ["event_id", *[r.column for r in REQUEST.rules]]


def fraud_model(spark: SparkSession, sf_dir: str):
    accepted, _ = validate(fraud_frame(spark, sf_dir), FRAUD).quarantine()
    return train_model(FRAUD_SPEC, accepted, artifacts_dir=scratch_path(spark, "artifacts"), log=False).model


def request_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request bodies as a client sends them: one JSON document per event."""
    return to_json_records(fraud_frame(spark, sf_dir), REQUEST_COLUMNS)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(request_bodies(spark, sf_dir), REQUEST, "event_id")


def q_request_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(requests(spark, sf_dir), REQUEST).select("event_id", "status", "reasons")


def q_request_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies damaged by event: cut off, a word for the amount, an array for the state."""
    eid, body = F.col("event_id"), F.col("body")
    sent = fraud_frame(spark, sf_dir).where("amt >= 0 and state is not null and is_fraud in (0, 1) and category <> 'crypto' and gender <> 'X' and city_pop >= 0")
    opts = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    bodies = sent.select("event_id", F.to_json(F.struct(*[F.col(f"`{c}`") for c in REQUEST_COLUMNS]), opts).alias("body"))
    damaged = F.when(eid % 3 == 0, F.concat(F.lit('{"event_id":'), eid.cast("string"), F.lit(',"amt":1.5,"cat'))).when(
        eid % 3 == 1, F.regexp_replace(body, '"amt":[^,]+', '"amt":"abc"')
    )
    return judged(parse_records(bodies.select(F.coalesce(damaged, body).alias("body")), REQUEST, "event_id"), REQUEST).select(
        "event_id", F.when(F.col("reasons").contains("amt:coerce_dtype"), "amt").when(F.col("malformed"), F.col("reasons")).otherwise("other").alias("reason")
    )


def q_request_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies that a lenient reader would take, by event: a number as text, an object for a text, a field too many, and sound ones."""
    eid = F.col("event_id")
    sent = fraud_frame(spark, sf_dir).where("amt >= 0 and state is not null and is_fraud in (0, 1) and category <> 'crypto' and gender <> 'X' and city_pop >= 0")
    opts = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    body = F.to_json(F.struct(*[F.col(f"`{c}`") for c in REQUEST_COLUMNS]), opts)
    changed = (
        F.when(eid % 4 == 0, F.regexp_replace(body, '"amt":([^,}]+)', '"amt":"$1"'))
        .when(eid % 4 == 1, F.regexp_replace(body, '"state":"([^"]*)"', '"state":{"code":"$1"}'))
        .when(eid % 4 == 2, F.regexp_replace(body, "^\\{", '{"note":1,'))
        .otherwise(body)
    )
    records = with_json_types(parse_records(sent.select(changed.alias("body")), REQUEST, "event_id"), REQUEST, "event_id")
    return judged(records, REQUEST).select("event_id", "status", F.regexp_extract("reasons", "[a-z]+:(json_type|extra_field)", 0).alias("strict_reason"))


def q_score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fraud_model(spark, sf_dir)
    accepted, _ = request_split(requests(spark, sf_dir), REQUEST)
    return model.score(accepted, keep=["event_id"])


def q_score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests land as files of JSON lines (several, to make several micro-batches); the stream
    scores them with ``availableNow`` and the scored sink is read back."""
    model = fraud_model(spark, sf_dir)
    base = scratch_path(spark, "score_stream")
    request_bodies(spark, sf_dir).repartition(4, "body").write.text(f"{base}/in")
    q = start_scoring_stream(
        spark, f"{base}/in", REQUEST, model, "event_id",
        scored_dir=f"{base}/scored", rejected_dir=f"{base}/rejected", checkpoint_dir=f"{base}/_checkpoint", max_files_per_trigger=2,
    )
    q.awaitTermination()
    return spark.read.parquet(f"{base}/scored").select(
        "event_id", "probability", "decision", "threshold", "domain", "ci_low", "ci_high"
    )


def q_end_to_end_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingest (CSV -> typed Parquet) -> contract (quarantine) -> train -> drift, one report."""
    base = scratch_path(spark, "end_to_end")
    raw = fraud_frame(spark, sf_dir).withColumn(
        "trans_date_trans_time", F.date_format("trans_date_trans_time", "yyyy-MM-dd HH:mm:ss")
    )
    write_csv(raw, f"{base}/raw")
    schema = T.StructType([T.StructField("event_id", T.LongType())] + [
        T.StructField(f.name, T.StringType() if f.name == "trans_date_trans_time" else f.dataType)
        for f in schema_of(FRAUD).fields
    ])
    typed = materialize(spark, f"{base}/raw", f"{base}/typed", schema=schema, datetime_col="trans_date_trans_time")
    return run_job(FRAUD_SPEC, FRAUD, typed, on_failure="quarantine", artifacts_dir=f"{base}/artifacts")


#: The two domains without a time column: Bayesian readmission, boosted dropout.
READMISSION_SPEC = JobSpec(
    "readmission", "readmitted_30d", "o_orderkey",
    tuple(Number(r.column) for r in READMISSION.rules if r.dtype != "string" and r.column != "readmitted_30d") + tuple(Category(r.column) for r in READMISSION.rules if r.dtype == "string"),
    learner=Posterior(0.8, 0.9), precision=0.6,
)
DROPOUT_SPEC = JobSpec(
    "dropout", "dropout", "o_orderkey", tuple(Number(r.column) for r in DROPOUT.rules if r.column != "dropout"),
    learner=Trees({"maxIter": 10, "maxDepth": 4}), precision=0.65,
)


def readmission_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readmission frame with its made-up medication level mapped to an allowed one, so that rows pass the contract."""
    frame = readmission_frame(spark, sf_dir)
    return frame.withColumns({c: F.when(F.col(c) == "Maybe", "No").otherwise(F.col(c)) for c in MEDICATION_COLS})


def q_end_to_end_readmission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(READMISSION_SPEC, READMISSION, readmission_table(spark, sf_dir), on_failure="quarantine")


def q_end_to_end_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_job(DROPOUT_SPEC, DROPOUT, dropout_frame(spark, sf_dir), on_failure="quarantine")


ORACLES = {
    "request_strict": f"""WITH {FRAUD_SRC}, judged AS ({status_sql(FRAUD_SRC, REQUEST, ["event_id"], FRAUD_TYPES, [])})
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN status ELSE 'rejected' END AS status,
 CASE event_id % 4 WHEN 0 THEN 'amt:json_type' WHEN 1 THEN 'state:json_type' WHEN 2 THEN 'note:extra_field' ELSE '' END AS strict_reason FROM src JOIN judged USING (event_id)
WHERE amt >= 0 AND state IS NOT NULL AND is_fraud IN (0, 1) AND category <> 'crypto' AND gender <> 'X' AND city_pop >= 0""",
    "request_malformed": f"""WITH {FRAUD_SRC}
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'body:malformed' WHEN 1 THEN 'amt' ELSE 'other' END AS reason FROM src
WHERE amt >= 0 AND state IS NOT NULL AND is_fraud IN (0, 1) AND category <> 'crypto' AND gender <> 'X' AND city_pop >= 0""",
    "request_split": status_sql(FRAUD_SRC, REQUEST, ["event_id"], FRAUD_TYPES, []),
}

QUERIES = {
    "request_split": q_request_split,
    "request_malformed": q_request_malformed,
    "request_strict": q_request_strict,
    "score_requests": q_score_requests,
    "score_stream": q_score_stream,
    "end_to_end_report": q_end_to_end_report,
    "end_to_end_readmission": q_end_to_end_readmission,
    "end_to_end_dropout": q_end_to_end_dropout,
}
