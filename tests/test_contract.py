"""Contracts: one fault per test, several faults in one report, coercion rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskloom.contracts import CONTRACTS, FRAUD, UnknownDomain
from riskloom.operators.contract import Contract, DataValidationError, Rule, validate, validate_or_raise


def fraud_rows(n=50):
    t0 = dt.datetime(2020, 1, 1)
    return [
        (t0 + dt.timedelta(hours=i), 1.0 + i * 10, "grocery_pos", "M" if i % 2 else "F", "CA", i * 1000 + 100,
         30.0 + i * 0.3, -120.0 + i * 0.8, 30.0 + i * 0.3, -120.0 + i * 0.8, i % 2)
        for i in range(n)
    ]


SCHEMA = ("trans_date_trans_time timestamp, amt double, category string, gender string, state string, city_pop long, "
          "lat double, long double, merch_lat double, merch_long double, is_fraud long")


def checks(spark, rows):
    v = validate(spark.createDataFrame(rows, SCHEMA), FRAUD)
    return {(r["column"], r["check"]) for r in v.failure_cases().collect()}


def test_good_rows_pass(spark):
    out = validate_or_raise(spark.createDataFrame(fraud_rows(), SCHEMA), FRAUD)
    assert out.count() == 50


@pytest.mark.parametrize(
    "col,value,check",
    [
        (1, -5.0, "greater_than_or_equal_to(0)"),
        (2, "crypto", None),
        (3, "X", "isin(['M', 'F'])"),
        (6, 95.0, "in_range(-90, 90)"),
        (10, 2, "isin([0, 1])"),
        (4, None, "not_nullable"),
    ],
)
def test_single_fault_rejected(spark, col, value, check):
    rows = fraud_rows(5)
    bad = list(rows[0])
    bad[col] = value
    rows[0] = tuple(bad)
    got = checks(spark, rows)
    assert len(got) == 1
    name = SCHEMA.split(", ")[col].split()[0]
    (c, k), = got
    assert c == name and (check is None or k == check)


def test_several_faults_in_one_report(spark):
    rows = fraud_rows(5)
    rows[0] = (rows[0][0], -1.0, "crypto") + rows[0][3:]
    rows[1] = rows[1][:3] + ("Z",) + rows[1][4:]
    with pytest.raises(DataValidationError) as exc:
        validate_or_raise(spark.createDataFrame(rows, SCHEMA), FRAUD)
    assert exc.value.counts["n_failures"] == 3 and exc.value.counts["n_bad_rows"] == 2
    assert "contract failed" in str(exc.value)


def test_integral_coercion_same_verdict_for_text_and_double(spark):
    c = Contract("t", [Rule("k", "long")])
    text = validate(spark.createDataFrame([("1.5",), ("2",)], "k string"), c)
    dbl = validate(spark.createDataFrame([(1.5,), (2.0,)], "k double"), c)
    for v in (text, dbl):
        cases = v.failure_cases().collect()
        assert [r["check"] for r in cases] == ["coerce_dtype('int64')"]
        assert sorted(r["k"] for r in v.coerced.collect() if r["k"] is not None) == [2]
    trunc = validate(spark.createDataFrame([(1.5,)], "k double"), Contract("t", [Rule("k", "long")], truncate=True))
    assert trunc.coerced.first()["k"] == 1 and trunc.failure_cases().count() == 0


def test_nan_is_missing_and_nullable_rule(spark):
    c = Contract("t", [Rule("a", "double"), Rule("b", "string", nullable=True, isin=("x",))])
    v = validate(spark.createDataFrame([(float("nan"), None), (1.0, "y")], "a double, b string"), c)
    got = sorted((r["column"], r["check"]) for r in v.failure_cases().collect())
    assert got == [("a", "not_nullable"), ("b", "isin(['x'])")]


def test_missing_column_and_open_schema(spark):
    c = Contract("t", [Rule("a", "long"), Rule("zz", "double")])
    v = validate(spark.createDataFrame([(1, "extra")], "a long, other string"), c)
    assert "other" in v.coerced.columns
    assert [(r["column"], r["check"]) for r in v.failure_cases().collect()] == [("zz", "column_in_dataframe")]


def test_summary_and_quarantine(spark):
    rows = fraud_rows(6)
    rows[0] = (rows[0][0], -1.0) + rows[0][2:]
    rows[1] = (rows[1][0], -2.0) + rows[1][2:]
    v = validate(spark.createDataFrame(rows, SCHEMA), FRAUD)
    s = v.summary().first()
    assert (s["column"], s["n_cases"]) == ("amt", 2)
    good, bad = v.quarantine()
    assert good.count() == 4 and bad.count() == 2
    assert bad.select(F.first("reasons")).first()[0] == "amt:greater_than_or_equal_to(0)"


def test_unknown_domain(spark):
    with pytest.raises(UnknownDomain, match="none of"):
        CONTRACTS["nope"]


def test_integers_above_2_53_keep_every_digit(spark):
    big = 9007199254740993
    rows = [(str(big), big, 1.0, "7"), ("9223372036854775807", -big, 2.5, "1.0"), ("9223372036854775808", 0, float("nan"), "1e3"), ("x", None, 3.0, "2.5")]
    df = spark.createDataFrame(rows, "a string, b long, c double, d string")
    v = validate(df, Contract("t", [Rule(x, "long") for x in "abcd"]))
    got = [tuple(r) for r in v.coerced.collect()]
    assert got == [(big, big, 1, 7), (9223372036854775807, -big, None, 1), (None, 0, None, 1000), (None, None, 3, None)]
    cases = sorted((r["column"], r["check"]) for r in v.failure_cases().collect())
    assert cases == [("a", "coerce_dtype('int64')")] * 2 + [("b", "not_nullable"), ("c", "coerce_dtype('int64')"), ("c", "not_nullable"), ("d", "coerce_dtype('int64')")]
    assert v.counts() == {"n_rows": 4, "n_bad_rows": 3, "n_failures": 6}


def test_summary_counts_equal_the_cases(spark):
    rows = fraud_rows(20)
    rows[0] = (rows[0][0], -1.0, "crypto") + rows[0][3:]
    rows[1] = (rows[1][0], -1.0) + rows[1][2:]
    v = validate(spark.createDataFrame(rows, SCHEMA).drop("state"), FRAUD)
    plain = {(r["column"], r["check"]): r["count"] for r in v.failure_cases().groupBy("column", "check").count().collect()}
    assert {(r["column"], r["check"]): r["n_cases"] for r in v.summary().collect()} == plain
    assert plain[("state", "column_in_dataframe")] == 1 and len(v.summary(1).collect()) == 1


def test_first_failure_stops_early(spark):
    bad = spark.createDataFrame([(r[0], -1.0) + r[2:] for r in fraud_rows(5)], SCHEMA)
    with pytest.raises(DataValidationError) as e:
        validate_or_raise(bad, FRAUD, lazy=False)
    assert e.value.counts["n_failures"] == 1 and e.value.cases.count() == 1


def test_huge_and_infinite_values_are_readable_failures(spark):
    values = [-1e40, float("inf"), float("-inf"), 1e308, -2.5, 3.0, 5e31]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id long, x double")
    checked = validate(df, Contract("c", [Rule("x", "double", ge=0, le=10)]))
    cases = {r.id: r.failure_case for r in checked.failure_cases(["id"]).collect()}
    assert cases == {0: "-1.0E40", 1: "Infinity", 2: "-Infinity", 3: "1.0E308", 4: "-2.500000", 6: "50000000000000000000000000000000.000000"}
    good, bad = checked.quarantine()
    assert [r.id for r in good.collect()] == [5] and bad.count() == 6


def test_json_types_are_told_apart(spark):
    from riskloom.sources.records import parse_records, with_json_types
    from riskloom.streaming.score_stream import judged

    contract = Contract("c", [Rule("a", "double", ge=0), Rule("it's b", "string"), Rule("at", "timestamp", nullable=True)])
    bodies = [
        '{"k": 1, "a": 12, "it\'s b": "x", "at": "2024-01-01 00:00:00"}', '{"k": 2, "a": "12", "it\'s b": "x", "at": null}', '{"k": 3, "a": 1.5, "it\'s b": {"c": 1}}',
        '{"k": 4, "a": 1, "it\'s b": "x", "more": [1], "also": 2}', '{"k": 5, "a": [1], "it\'s b": 7}', '{"k": 6, "a": 1', "[1]",
    ]
    rows = with_json_types(parse_records(spark.createDataFrame([(b,) for b in bodies], "body string"), contract, "k"), contract, "k")
    got = {r.k: (r.status, r.reasons) for r in judged(rows, contract).collect()}
    assert got[1] == ("accepted", "") and got[2] == ("rejected", "a:json_type") and got[3] == ("rejected", "it's b:json_type")
    assert got[4] == ("rejected", "also:extra_field; more:extra_field") and got[5][0] == "rejected" and "a:json_type" in got[5][1] and "it's b:json_type" in got[5][1]
    assert got[6] == ("rejected", "body:malformed") and got[None] == ("rejected", "body:malformed")


def test_checks_are_computed_once_for_cases_and_quarantine(spark):
    c = Contract("t", [Rule("k", "long", ge=1), Rule("x", "double", le=5)])
    v = validate(spark.range(4).select((F.col("id") * 2).cast("string").alias("k"), F.col("id").cast("string").alias("x")), c)
    good, bad = v.quarantine()
    for df, labels in ((v.failure_cases(), 1), (good, 0), (bad, 1)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("k:greater_than_or_equal_to(1)") == labels and plan.count("try_cast(x") == 1
    assert [r["failure_case"] for r in v.failure_cases().collect()] == ["0"]


TEXTS = [
    "7", " 7\t", "\x017\x7f", "+7", "-7", "007", "1e3", "1E+3", "1.", ".5", "1.0", "1.5", "1,5", "n/a", "", " ", ".", "+", "NaN", "-inf", " Infinity ", "1d", "1.5F", "0x1p3", "0x1.8p1d", "٣", "e3", "1e", "1 2",
    "9223372036854775807", "9223372036854775808", "-9223372036854775808", "-9223372036854775809", "00000000000000000000000012", "123456789012345678901", "9223372036854775807.0", "1e400", "1e30", None,
]


@pytest.mark.parametrize("truncate", [False, True])
def test_text_has_the_value_that_a_plain_cast_gives(spark, truncate):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    exact = F.col("t").try_cast("decimal(38,18)")
    whole = exact if truncate else F.when(exact == F.floor(exact), exact)
    want = df.select("i", F.coalesce(F.col("t").try_cast("long"), whole.try_cast("long")).alias("k"), F.nanvl(F.col("t").try_cast("double"), F.lit(None)).alias("x"))
    got = validate(df.select("i", F.col("t").alias("k"), F.col("t").alias("x")), Contract("t", [Rule("k", "long"), Rule("x", "double")], truncate=truncate)).coerced
    assert {(r["i"], r["k"], r["x"]) for r in got.select("i", "k", "x").collect()} == {tuple(r) for r in want.collect()}


def test_doubles_at_the_edges_of_64_bits_and_of_the_failure_text(spark):
    values = [2.0**63, -(2.0**63), 2.0**64, -(2.0**64), 1e32, 9.999999999999999e31, -1e32, float("inf"), float("-inf"), float("nan"), 1.5]
    df = spark.createDataFrame([(v,) for v in values], "k double").withColumn("x", F.col("k"))
    v = validate(df, Contract("t", [Rule("k", "long"), Rule("x", "double", ge=0, le=1)], truncate=True))
    plain = df.select("x", F.nanvl("k", F.lit(None)).try_cast("long").alias("k"), F.coalesce(F.col("x").try_cast("decimal(38,6)").cast("string"), F.col("x").cast("string")).alias("t"))
    assert v.coerced.select("k").exceptAll(plain.select("k")).count() == 0
    want = {r["t"] for r in plain.where("NOT isnan(x) AND NOT x BETWEEN 0 AND 1").collect()}
    assert {r["failure_case"] for r in v.failure_cases().where("column = 'x' AND check LIKE 'in_range%'").collect()} == want


def test_accepted_rows_need_no_cases(spark):
    v = validate(spark.createDataFrame([(1, "a"), (0, "b"), (None, "c")], "k long, s string"), Contract("t", [Rule("k", "long", ge=1), Rule("s", "string")]))
    good, bad = v.quarantine()
    assert "not_nullable" not in good._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in good.select("k", "s").collect()] == [(1, "a")]
    assert {(r["s"], r["reasons"]) for r in bad.collect()} == {("b", "k:greater_than_or_equal_to(1)"), ("c", "k:not_nullable")}
