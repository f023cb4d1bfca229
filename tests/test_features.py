"""Features, scalar functions, encodings and the spec."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.contracts import REQUEST
from riskloom.operators.encode import category_codes, fit_design, fit_sparse_design, with_codes
from riskloom.operators.features import project
from riskloom.plans.serving_queries import FRAUD_SPEC
from riskloom.spec import JobSpec, Posterior, SpecError, Trees, from_config, numbers

RECORD = [(dt.datetime(2020, 6, 1, 12, 30), 125.5, "grocery_pos", "F", "CA", 50000, 37.77, -122.41, 37.80, -122.30)]
RSCHEMA = ("trans_date_trans_time timestamp, amt double, category string, gender string, state string, city_pop long, "
           "lat double, long double, merch_lat double, merch_long double")


def test_engineered_features_scoring_record(spark):
    df = spark.createDataFrame(RECORD, RSCHEMA).withColumn("event_id", F.lit(1))
    feats, numeric, levels = project(FRAUD_SPEC, df, keep=["event_id"])
    r = feats.first()
    assert (r["hour"], r["dayofweek"], r["month"]) == (12, 0, 6)
    assert r["geo_distance_km"] == pytest.approx(10.226, abs=1e-3)
    assert "is_fraud" not in feats.columns  # scoring without target
    assert numeric[6:] == ["hour", "dayofweek", "month", "geo_distance_km"] and levels == ["category", "gender", "state"]
    assert project(FRAUD_SPEC, df.drop("merch_lat"))[1][5:] == ["hour", "dayofweek", "month"]


def test_name_clash_is_an_error(spark):
    df = spark.createDataFrame(RECORD, RSCHEMA).withColumn("hour", F.lit(3))
    with pytest.raises(ValueError, match="clash"):
        project(FRAUD_SPEC, df)


def test_unseen_category_encodes_to_null(spark):
    train = spark.createDataFrame([("a",), ("c",), ("b",), (None,)], "k string")
    codes = category_codes(train, ["k"])
    assert sorted(map(tuple, codes.collect())) == [("k", "a", 0), ("k", "b", 1), ("k", "c", 2)]
    rows = spark.createDataFrame([("b",), ("zzz",), (None,)], "k string")
    assert {r["k"]: r["code_k"] for r in with_codes(rows, codes, ["k"]).collect()} == {"b": 1, "zzz": None, None: None}


def test_a_million_levels(spark):
    """No cap, no literal map: half of the rows share one level, the others have one each."""
    n = 1_000_000
    df = spark.range(2 * n).select("id", F.when(F.col("id") < n, F.format_string("v%07d", "id")).otherwise("v0000005").alias("k"))
    design = fit_sparse_design(df, [], ["k"])
    assert design.size == n - 1 and design.n_levels == {"k": n}
    wrong = with_codes(df, design.codes, ["k"]).where(~F.col("code_k").eqNullSafe(F.substring("k", 2, 7).cast("long")))
    assert wrong.count() == 0
    v = design.vectors(df.where("id IN (0, 7, 1500000)"), ["id"]).collect()
    assert {r.id: (r.features.size, r.features.indices.tolist()) for r in v} == {0: (n - 1, []), 7: (n - 1, [6]), 1_500_000: (n - 1, [4])}


def test_sparse_rows_equal_the_dense_ones(spark):
    rows = [(k, float(k % 5) if k % 4 else None, "abc"[k % 3] if k % 7 else None, "one") for k in range(40)]
    df = spark.createDataFrame(rows, "id long, a double, c string, med string")
    dense, sparse = fit_design(df, ["a"], ["c", "med"]), fit_sparse_design(df, ["a"], ["c", "med"])
    assert sparse.size == len(dense.output_columns)
    other = df.unionByName(spark.createDataFrame([(99, 0.0, "new", "two")], df.schema))
    want = {r.id: [r[c] for c in dense.output_columns] for r in dense.transform(other, keep=["id"]).collect()}
    got = {r.id: r.features.toArray().tolist() for r in sparse.vectors(other, ["id"]).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)
    entries = {}
    for r in sparse.entries(other, ["id"]).collect():
        entries.setdefault(r.id, {})[r.slot] = r.value
    assert {k: entries.get(k, {}) for k in want} == {k: pytest.approx({i: x for i, x in enumerate(v) if x}) for k, v in want.items()}


def test_design_matrix_drop_first_and_constant_columns(spark):
    df = spark.createDataFrame(
        [(1.0, "x", "No"), (3.0, "y", "No"), (None, None, "No")], "a double, c string, med string"
    )
    m = fit_design(df, ["a"], ["c", "med"])
    mu, sd = m.means_stds["a"]
    assert mu == pytest.approx(4.0 / 3) and sd == pytest.approx(1.5275252316519468)
    assert m.dummies == {"c": ["x", "y"], "med": []}  # 'Unknown' first, dropped; constant -> none
    unseen = spark.createDataFrame([(0.0, "new", "No")], "a double, c string, med string")
    r = m.transform(unseen).first()
    assert (r["c_x"], r["c_y"]) == (0.0, 0.0)


def test_spec_from_a_configuration():
    raw = {"domain": "d", "target": "t", "columns": {"numeric": ["a", "b"], "categorical": ["b", "c"], "amount": "a", "key": "k"}, "data": {"raw_path": "x"}}
    with pytest.warns(UserWarning, match="columns.amount, data.raw_path"):
        s = from_config(raw)
    assert [f.name for f in s.features] == ["a", "b", "c", "geo_distance_km"] and s.names(True) == ["b", "c"]
    assert JobSpec.from_dict(s.to_dict()) == s
    b = from_config({"domain": "d", "target": "t", "model": {"type": "bayesian", "valid_fraction": 0.3}}, key="k")
    assert isinstance(b.learner, Posterior) and b.learner.cut == pytest.approx(0.7)


@pytest.mark.parametrize("wrong", [{"domain": ""}, {"precision": 0}, {"features": numbers("a", "a")}, {"learner": Trees(cuts=(0.9, 0.5))}, {"learner": Trees(score_map="x")}])
def test_spec_is_checked_when_made(wrong):
    with pytest.raises(SpecError):
        JobSpec(**({"domain": "d", "target": "t", "key": "k", "features": numbers("a")} | wrong))
    with pytest.raises(SpecError):
        from_config({"domain": "d", "target": "t", "model": {"type": "nope"}}, key="k")


def test_request_contract_rejects_bad_records(spark):
    from riskloom.operators.contract import validate

    bad_amt = [(RECORD[0][0], -10.0) + RECORD[0][2:]]
    bad_cat = [RECORD[0][:2] + ("crypto",) + RECORD[0][3:]]
    for rows in (bad_amt, bad_cat):
        good, bad = validate(spark.createDataFrame(rows, RSCHEMA), REQUEST).quarantine()
        assert good.count() == 0 and bad.count() == 1
    good, _ = validate(spark.createDataFrame(RECORD, RSCHEMA), REQUEST).quarantine()
    assert good.count() == 1
