"""The whole job for any domain: contract -> train -> drift, as one report table.

A table that fails its contract stops the job or goes on without the failing rows, as the caller
chooses. Only counts, metrics and one row per drift feature reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskloom.operators.contract import Contract, DataValidationError, validate
from riskloom.operators.drift import DriftAnalysis, long_values
from riskloom.operators.splits import reference_current, shuffle_order
from riskloom.plans.train_job import train_model
from riskloom.session import scratch_path
from riskloom.spec import JobSpec, Number

REPORT = "stage string, key string, value double, text string"


def run_job(spec: JobSpec, contract: Contract, df: DataFrame, *, on_failure: str = "stop", artifacts_dir: str | None = None, log: bool = True) -> DataFrame:
    """``(stage, key, value, text)``: contract counts, training metrics, drift of the later part of the rows against the earlier one.

    ``on_failure="stop"`` raises :class:`DataValidationError` when a row fails, ``"quarantine"`` goes on with the others.
    Without a time column the parts are dealt in seeded random order.
    """
    if on_failure not in ("stop", "quarantine"):
        raise ValueError("on_failure is stop or quarantine")
    spark = df.sparkSession
    checked = validate(df, contract)
    counts = checked.counts()
    if counts["n_failures"] and on_failure == "stop":
        raise DataValidationError(spec.domain, counts, checked.failure_cases([spec.key]))
    accepted = (checked.quarantine()[0] if counts["n_failures"] else checked.coerced).persist()
    try:
        result = train_model(spec, accepted, artifacts_dir=artifacts_dir or scratch_path(spark, "artifacts"), log=log)
        ordered, order = (accepted, [spec.time, spec.key]) if spec.time else shuffle_order(accepted, spec.key)
        watched = [f.name for f in spec.features if type(f) is Number]
        drift = DriftAnalysis(long_values(reference_current(ordered, order), watched), psi_threshold=spec.psi_limit, ks_pvalue_threshold=spec.ks_limit)
        tests = drift.tests().collect()
    finally:
        accepted.unpersist()
    rows = [("contract", k, float(v), None) for k, v in counts.items()]
    rows += [("train", k, float(v), None) for k, v in result.metrics.items()]
    rows.append(("train", "threshold", float(result.threshold), result.calibration_method))
    for r in tests:
        rows.append(("drift", r["feature"], r["psi"], f"ks={r['ks_stat']};p={r['ks_pvalue']};by_psi={r['psi_drifted']};by_ks={r['ks_drifted']}"))
    return spark.createDataFrame(rows, REPORT)
