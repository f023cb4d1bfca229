"""Run-log sink: one Parquet table of ``(run_id, domain, kind, key, value, text)`` rows.

Params, metrics and artefact paths of each run are appended (``mode("append")``) to a
table under the shared checkpoint folder, grouped by domain; NaN metrics are dropped.
"""

from __future__ import annotations

import math
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskloom.session import checkpoint_root

RUNLOG_SCHEMA = "run_id string, domain string, kind string, key string, value double, text string, logged_at double"


def runlog_path(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/runlog"


def run_rows(domain: str, params: dict, metrics: dict[str, float], artifact: str | None, run_id: str) -> list[tuple]:
    now = time.time()
    rows: list[tuple] = []
    for k, v in params.items():
        num = float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else None
        rows.append((run_id, domain, "param", str(k), num, str(v), now))
    for k, v in metrics.items():
        if v is None or (isinstance(v, float) and math.isnan(v)):
            continue  # NaN metrics are not logged
        rows.append((run_id, domain, "metric", str(k), float(v), None, now))
    if artifact:
        rows.append((run_id, domain, "artifact", "model_path", None, artifact, now))
    return rows


def log_run(
    spark: SparkSession,
    domain: str,
    params: dict,
    metrics: dict[str, float],
    artifact: str | None = None,
    *,
    path: str | None = None,
) -> str:
    """Append one run; returns its ``run_id``."""
    run_id = uuid.uuid4().hex
    rows = run_rows(domain, params, metrics, artifact, run_id)
    spark.createDataFrame(rows, RUNLOG_SCHEMA).coalesce(1).write.mode("append").parquet(path or runlog_path(spark))
    return run_id


def read_runs(spark: SparkSession, path: str | None = None) -> DataFrame:
    return spark.read.schema(RUNLOG_SCHEMA).parquet(path or runlog_path(spark))
