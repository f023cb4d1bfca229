"""Domain fixtures: readmission (Bayesian path, constant columns) and dropout (names with
spaces, shuffled split, cohort drift)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.contracts import DROPOUT, MEDICATION_COLS, READMISSION
from riskloom.operators.contract import validate
from riskloom.operators.drift import DriftAnalysis
from riskloom.operators.encode import fit_design
from riskloom.plans.train_job import train_model
from riskloom.spec import JobSpec, Posterior, Trees, categories, numbers

READ_NUMERIC = ["time_in_hospital", "num_lab_procedures", "num_procedures", "num_medications",
                "number_outpatient", "number_emergency", "number_inpatient", "number_diagnoses"]
READ_CATEGORICAL = ["race", "gender", "age", "change", "diabetesMed", *MEDICATION_COLS]


def readmission_rows(n=60, copies=1):
    rng = np.random.default_rng(7)
    races = ["Caucasian", "AfricanAmerican", "Asian", None]
    rows = []
    for i in range(n * copies):
        meds = ["No"] * 9 + ["Steady" if i % 2 else "No", "Up" if i % 3 == 0 else "Down"]
        y = int(rng.random() < 0.3)
        rows.append(
            (races[i % 4], "Female" if i % 2 else "Male", f"[{(i % 10) * 10}-{(i % 10) * 10 + 10})",
             1 + i % 14, 20 + i % 40, i % 7, 5 + i % 30, i % 3, i % 2, (i % 4) + 2 * y, 1 + i % 16,
             "Ch" if i % 2 else "No", "Yes" if i % 3 else "No", *meds, i, y)
        )
    return rows


READ_SCHEMA = (
    "race string, gender string, age string, time_in_hospital long, num_lab_procedures long, num_procedures long, "
    "num_medications long, number_outpatient long, number_emergency long, number_inpatient long, "
    "number_diagnoses long, change string, diabetesMed string, "
    + ", ".join(f"{m} string" for m in MEDICATION_COLS)
    + ", pid long, readmitted_30d long"
)


def test_readmission_contract_and_constant_medications(spark):
    df = spark.createDataFrame(readmission_rows(), READ_SCHEMA)
    assert validate(df, READMISSION).failure_cases().count() == 0
    m = fit_design(df, READ_NUMERIC, READ_CATEGORICAL)
    assert all(m.dummies[c] == [] for c in MEDICATION_COLS[:9])
    bad = spark.createDataFrame([readmission_rows(1)[0][:2] + ("[100-110)",) + readmission_rows(1)[0][3:]], READ_SCHEMA)
    assert [r["column"] for r in validate(bad, READMISSION).failure_cases().collect()] == ["age"]


def test_bayesian_train_path(spark, tmp_path):
    spec = JobSpec(
        "readmission", "readmitted_30d", "pid", (*numbers(*READ_NUMERIC), *categories(*READ_CATEGORICAL)), learner=Posterior(0.8, 0.9), precision=0.6
    )
    df = spark.createDataFrame(readmission_rows(60, copies=5), READ_SCHEMA)
    res = train_model(spec, df, artifacts_dir=str(tmp_path), log=False)
    assert res.calibration_method == "bayesian_posterior"
    assert {"pr_auc", "brier", "roc_auc", "ci_coverage"} <= set(res.metrics)
    assert 0.0 <= res.metrics["ci_coverage"] <= 1.0
    s = res.model.score(df, keep=["pid"]).collect()
    assert all(r["ci_low"] <= r["probability"] <= r["ci_high"] for r in s)


DROP_COLS = [r.column for r in DROPOUT.rules]


def dropout_rows(n=80, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.32)
        rows.append((
            1 + i % 6, 1 + i % 17, i % 10, 1 + i % 33, i % 2, 1 + i % 5, 100.0 + i % 60, 110.0 + i % 50,
            18 + i % 30, i % 2, (i + 1) % 2, i % 2, 1 - y, 5 - 3 * y + i % 3, 4 - 2 * y + i % 2,
            12.0 - 4 * y + (i % 5) * 0.3, 11.5 - 4 * y + (i % 4) * 0.2, 10.0 + (i % 7) * 0.5, 1.0 + (i % 5) * 0.3,
            0.5 + (i % 9) * 0.2, y,
        ))
    return rows


def dropout_frame(spark, rows):
    types = {r.column: ("long" if r.dtype == "long" else "double") for r in DROPOUT.rules}
    schema = ", ".join(f"`{c}` {types[c]}" for c in DROP_COLS)
    return spark.createDataFrame(rows, schema).withColumn("sid", F.monotonically_increasing_id())


def test_dropout_contract_shuffled_gbt_and_cohort_drift(spark, tmp_path):
    df = dropout_frame(spark, dropout_rows(80) * 5).drop("sid").withColumn("sid", F.monotonically_increasing_id())
    assert validate(df, DROPOUT).failure_cases().count() == 0
    numeric = ["Previous qualification (grade)", "Admission grade", "Age at enrollment",
               "Curricular units 1st sem (approved)", "Curricular units 2nd sem (approved)",
               "Curricular units 1st sem (grade)", "Curricular units 2nd sem (grade)",
               "Unemployment rate", "Inflation rate", "GDP"]
    spec = JobSpec("dropout", "dropout", "sid", numbers(*numeric), learner=Trees({"maxIter": 5, "maxDepth": 3}), precision=0.65)
    res = train_model(spec, df, artifacts_dir=str(tmp_path), log=False)
    assert res.metrics["roc_auc"] > 0.7
    cohort = df.withColumn("Unemployment rate", F.col("Unemployment rate") * 2 + 10).withColumn("GDP", F.col("GDP") - 5)
    rep = {r["feature"]: r for r in DriftAnalysis.from_tables(df, cohort, numeric).report().collect()}
    assert rep["Unemployment rate"]["drifted"] and rep["GDP"]["drifted"]
    assert rep["Admission grade"]["psi"] == pytest.approx(0.0, abs=1e-9)
