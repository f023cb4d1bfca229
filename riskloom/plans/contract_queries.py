"""Contract queries on ``lineitem`` and on domain-shaped frames derived from driver tables.

The domain frames rename and re-derive columns of ``events`` / ``orders`` x ``customer``
into the fraud, readmission and dropout layouts, with deliberate out-of-contract values
(negative amounts, unknown levels, out-of-range coordinates and counts), so every check
kind fires on real rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.contracts import DROPOUT, FRAUD, FRAUD_CATEGORIES, MEDICATION_COLS, READMISSION
from riskloom.operators.contract import Contract, Rule, validate
from riskloom.plans.feature_queries import event_coordinates
from riskloom.sources.tables import order_label, table

# The lineitem contract used on the driver's lineitem table.
LINEITEM = Contract(
    "lineitem",
    [
        Rule("l_orderkey", "long"),
        Rule("l_linenumber", "long", ge=1, le=7),
        Rule("l_quantity", "long", ge=1, le=45),
        Rule("l_extendedprice", "double", ge=0),
        Rule("l_discount", "double", ge=0, le=0.08),
        Rule("l_tax", "double", ge=0, le=0.06),
        Rule("l_returnflag", "string", isin=("A", "N")),
        Rule("l_linestatus", "string", isin=("O", "F")),
        Rule("l_shipdate", "timestamp"),
    ],
)
LINEITEM_COLS = [r.column for r in LINEITEM.rules] + ["l_partkey", "l_suppkey"]


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*LINEITEM_COLS)


def q_contract_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = validate(lineitem(spark, sf_dir), LINEITEM)
    return v.failure_cases(["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "column", "check", "failure_case"
    )


def q_contract_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = validate(lineitem(spark, sf_dir), LINEITEM).summary(10)
    return s.select("column", "check", F.col("n_cases").cast("long").alias("n_cases"))


def q_contract_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = validate(lineitem(spark, sf_dir), LINEITEM).coerced
    return c.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        F.round("l_extendedprice", 6).alias("l_extendedprice"), F.round("l_discount", 6).alias("l_discount"),
        F.round("l_tax", 6).alias("l_tax"), "l_returnflag", "l_linestatus",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
    )


def q_contract_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = validate(lineitem(spark, sf_dir), LINEITEM).with_status()
    return s.select("l_orderkey", "l_linenumber", "l_quantity", "status", "reasons")


# -- domain-shaped frames ----------------------------------------------------------------
def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + 1)


def fraud_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    coords = event_coordinates()
    return ev.select(
        "event_id",
        F.col("ts").alias("trans_date_trans_time"),
        (F.col("value") - F.lit(5.0)).alias("amt"),
        _pick([*FRAUD_CATEGORIES, "crypto"], F.col("event_id") % 15).alias("category"),
        _pick(["M", "F", "X"], F.col("user_id") % 3).alias("gender"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string")).otherwise(F.lit("CA")).alias("state"),
        (F.col("user_id") * 1000 - 5000).alias("city_pop"),
        *coords,
        F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "click", 2).otherwise(0).alias("is_fraud"),
    )


def _orders_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return o.join(c, o["o_custkey"] == c["c_custkey"], "inner")


def readmission_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _orders_customers(spark, sf_dir)
    ok, ck, nk = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey")
    band = nk % 11 * 10
    meds = [_pick(["No", "Down", "Steady", "Up", "Maybe"], (ok + i) % 5).alias(m) for i, m in enumerate(MEDICATION_COLS)]
    return j.select(
        "o_orderkey",
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Caucasian")
        .when(F.col("c_mktsegment") == "BUILDING", "AfricanAmerican")
        .when(F.col("c_mktsegment") == "FURNITURE", "Asian")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Hispanic")
        .alias("race"),
        F.when(F.col("o_orderstatus") == "F", "Female").when(F.col("o_orderstatus") == "O", "Male")
        .otherwise("Unknown/Invalid").alias("gender"),
        F.concat(F.lit("["), band.cast("string"), F.lit("-"), (band + 10).cast("string"), F.lit(")")).alias("age"),
        (ok % 16).alias("time_in_hospital"),
        (nk * 3).alias("num_lab_procedures"),
        (ok % 8).alias("num_procedures"),
        F.floor(F.col("o_totalprice") / F.lit(10000.0)).cast("long").alias("num_medications"),
        (ck % 3).alias("number_outpatient"),
        (ck % 2).alias("number_emergency"),
        (ok % 5 - 1).alias("number_inpatient"),
        (ck % 17).alias("number_diagnoses"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Ch").otherwise("No").alias("change"),
        F.when(F.col("c_acctbal") > 0, "Yes").otherwise("No").alias("diabetesMed"),
        *meds,
        order_label().alias("readmitted_30d"),
    )


def dropout_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _orders_customers(spark, sf_dir)
    ok, ck, nk = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey")
    price, bal = F.col("o_totalprice"), F.col("c_acctbal")
    return j.select(
        "o_orderkey",
        (ok % 7).alias("Marital Status"),
        (nk % 18).alias("Application mode"),
        (ok % 11).alias("Application order"),
        (F.col("c_custkey") % 40 + 1).alias("Course"),
        (ok % 2).alias("Daytime/evening attendance"),
        (nk + 1).alias("Previous qualification"),
        (price / F.lit(2500.0)).alias("Previous qualification (grade)"),
        (bal / F.lit(50.0) + F.lit(100.0)).alias("Admission grade"),
        (ok % 60 + 14).alias("Age at enrollment"),
        (ck % 2).alias("Gender"),
        F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("Scholarship holder"),
        F.when(bal < 0, 1).otherwise(0).alias("Debtor"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).otherwise(2)
        .alias("Tuition fees up to date"),
        (nk % 9).alias("Curricular units 1st sem (approved)"),
        (ok % 9 - 1).alias("Curricular units 2nd sem (approved)"),
        ((ok % 210) / F.lit(10.0)).alias("Curricular units 1st sem (grade)"),
        ((F.col("c_custkey") % 200) / F.lit(10.0)).alias("Curricular units 2nd sem (grade)"),
        (bal / F.lit(1000.0)).alias("Unemployment rate"),
        (price / F.lit(100000.0) - F.lit(2.0)).alias("Inflation rate"),
        (nk.cast("double") - F.lit(12.0)).alias("GDP"),
        order_label().alias("dropout"),
    )


def _domain_failures(frame: DataFrame, contract: Contract, key: str) -> DataFrame:
    v = validate(frame, contract)
    return v.failure_cases([key]).select(key, "column", "check", "failure_case")


def q_contract_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _domain_failures(fraud_frame(spark, sf_dir), FRAUD, "event_id")


def q_contract_readmission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _domain_failures(readmission_frame(spark, sf_dir), READMISSION, "o_orderkey")


def q_contract_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _domain_failures(dropout_frame(spark, sf_dir), DROPOUT, "o_orderkey")


# -- text and 64-bit columns: coercion failures, missing values, an absent column -------------
# Fixed value: the first integer above 2^53 that a double cannot hold.
BIG = 9007199254740993
TYPED = Contract(
    "typed_lineitem",
    [
        Rule("big_text", "long"),
        Rule("big_number", "long", ge=BIG + 2),
        Rule("amount", "double", ge=0),
        Rule("shipped", "timestamp"),
        Rule("reading", "double", ge=0, le=1_000_000),
        Rule("channel", "string"),
    ],
)


def typed_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as text: some ids unparseable, fractional, missing or above 2^53; some doubles huge or infinite; no column ``channel``."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    big = (key.cast("long") + F.lit(BIG)).cast("string")
    odd = (key + line) % 6
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        line.cast("long").alias("l_linenumber"),
        F.when(odd == 0, F.lit(None).cast("string")).when(odd == 1, "n/a").when(odd == 2, F.concat(key.cast("string"), F.lit(".5"))).otherwise(big).alias("big_text"),
        (key.cast("long") + F.lit(BIG)).alias("big_number"),
        F.when(odd == 3, "1,5").when(odd == 4, "-2.5").otherwise(F.col("l_quantity").cast("string")).alias("amount"),
        F.when(odd == 5, "soon").otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("shipped"),
        F.when(odd == 0, -1e40).when(odd == 1, float("inf")).when(odd == 2, float("-inf")).when(odd == 3, 1e308).otherwise(F.col("l_quantity").cast("double")).alias("reading"),
    )


def q_contract_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = validate(typed_lineitem(spark, sf_dir), TYPED).failure_cases(["l_orderkey", "l_linenumber"])
    return cases.select("l_orderkey", "l_linenumber", "column", "check", "failure_case")


def q_contract_types_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = validate(typed_lineitem(spark, sf_dir), TYPED).quarantine()
    rows = good.withColumn("reasons", F.lit("")).unionByName(bad)
    return rows.select(
        "l_orderkey", "l_linenumber", "big_text", "big_number", "amount", F.date_format("shipped", "yyyy-MM-dd").alias("shipped"), "reasons"
    )


TYPED_SQL = f"""src AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
 CASE (l_orderkey + l_linenumber) % 6 WHEN 0 THEN NULL WHEN 1 THEN 'n/a' WHEN 2 THEN CAST(l_orderkey AS VARCHAR) || '.5'
   ELSE CAST(l_orderkey + {BIG} AS VARCHAR) END AS big_text,
 l_orderkey + {BIG} AS big_number,
 (l_orderkey + l_linenumber) % 6 AS odd, l_quantity, l_shipdate FROM lineitem),
facts AS (SELECT *, CASE WHEN odd IN (0, 1, 2) THEN NULL ELSE CAST(big_text AS BIGINT) END AS big_value,
 CASE odd WHEN 3 THEN NULL WHEN 4 THEN -2.5 ELSE CAST(l_quantity AS DOUBLE) END AS amount_value FROM src)"""

CONTRACT_TYPES_SQL = f"""WITH {TYPED_SQL}
SELECT l_orderkey, l_linenumber, 'big_text' AS "column", 'coerce_dtype(''int64'')' AS "check", big_text AS failure_case FROM facts WHERE odd IN (1, 2)
UNION ALL SELECT l_orderkey, l_linenumber, 'big_text', 'not_nullable', NULL FROM facts WHERE odd = 0
UNION ALL SELECT l_orderkey, l_linenumber, 'big_number', 'greater_than_or_equal_to({BIG + 2})', CAST(big_number AS VARCHAR) FROM facts WHERE big_number < {BIG + 2}
UNION ALL SELECT l_orderkey, l_linenumber, 'amount', 'coerce_dtype(''float64'')', '1,5' FROM facts WHERE odd = 3
UNION ALL SELECT l_orderkey, l_linenumber, 'amount', 'greater_than_or_equal_to(0)', '-2.500000' FROM facts WHERE odd = 4
UNION ALL SELECT l_orderkey, l_linenumber, 'shipped', 'coerce_dtype(''datetime64[ns]'')', 'soon' FROM facts WHERE odd = 5
UNION ALL SELECT l_orderkey, l_linenumber, 'reading', 'in_range(0, 1000000)',
 CASE odd WHEN 0 THEN '-1.0E40' WHEN 1 THEN 'Infinity' WHEN 2 THEN '-Infinity' ELSE '1.0E308' END FROM facts WHERE odd IN (0, 1, 2, 3)
UNION ALL SELECT NULL, NULL, 'channel', 'column_in_dataframe', 'channel'"""

CONTRACT_TYPES_VALUES_SQL = f"""WITH {TYPED_SQL}
SELECT l_orderkey, l_linenumber, big_value AS big_text, big_number, amount_value AS amount,
 CASE WHEN odd <> 5 THEN strftime(l_shipdate, '%Y-%m-%d') END AS shipped,
 array_to_string(list_sort(list_filter([
  CASE WHEN odd IN (1, 2) THEN 'big_text:coerce_dtype(''int64'')' END,
  CASE WHEN odd = 0 THEN 'big_text:not_nullable' END,
  CASE WHEN big_number < {BIG + 2} THEN 'big_number:greater_than_or_equal_to({BIG + 2})' END,
  CASE WHEN odd = 3 THEN 'amount:coerce_dtype(''float64'')' END,
  CASE WHEN odd = 4 THEN 'amount:greater_than_or_equal_to(0)' END,
  CASE WHEN odd IN (0, 1, 2, 3) THEN 'reading:in_range(0, 1000000)' END,
  CASE WHEN odd = 5 THEN 'shipped:coerce_dtype(''datetime64[ns]'')' END], lambda x: x IS NOT NULL)), '; ') AS reasons FROM facts"""


# -- oracle SQL: an independent re-statement of the check semantics in DuckDB -------------
def _sq(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _dq(s: str) -> str:
    return '"' + s.replace('"', '""') + '"'


def _rule_sql(rule: Rule, src_type: str) -> dict[str, str]:
    c = _dq(rule.column)
    if rule.dtype == "string":
        v, bad = f"CAST({c} AS VARCHAR)", "false"
    elif rule.dtype == "timestamp":
        v, bad = (c, "false") if src_type == "timestamp" else (f"try_strptime({c}, '%Y-%m-%d %H:%M:%S')", f"({c} IS NOT NULL AND try_strptime({c}, '%Y-%m-%d %H:%M:%S') IS NULL)")
    else:
        d = f"(CASE WHEN isnan(TRY_CAST({c} AS DOUBLE)) THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END)"
        nan_in = f"isnan({c})" if src_type == "double" else "false"
        if rule.dtype == "double":
            v = d
        else:
            v = f"(CASE WHEN {d} = floor({d}) THEN TRY_CAST({d} AS BIGINT) END)"
        bad = f"({c} IS NOT NULL AND NOT {nan_in} AND {v} IS NULL)"
    missing = f"({c} IS NULL OR isnan({c}))" if src_type == "double" else f"({c} IS NULL)"
    if rule.isin is not None:
        ok = f"{v} IN ({', '.join(_sq(x) if isinstance(x, str) else str(x) for x in rule.isin)})"
    else:
        parts = []
        if rule.ge is not None:
            parts.append(f"{v} >= {rule.ge}")
        if rule.le is not None:
            parts.append(f"{v} <= {rule.le}")
        ok = " AND ".join(parts) if parts else "true"
    if rule.dtype == "double":
        text = f"CAST(CAST({v} AS DECIMAL(38,6)) AS VARCHAR)"
    else:
        text = f"CAST({v} AS VARCHAR)"
    return {"v": v, "bad": bad, "missing": missing, "ok": ok, "text": text, "raw": f"CAST({c} AS VARCHAR)"}


def failure_sql(src_cte: str, contract: Contract, keys: list[str], src_types: dict[str, str]) -> str:
    branches = []
    k = ", ".join(_dq(x) for x in keys)
    for r in contract.rules:
        e = _rule_sql(r, src_types.get(r.column, "string"))
        col = _sq(r.column)
        if e["bad"] != "false":
            branches.append(f"SELECT {k}, {col} AS \"column\", {_sq(r.coerce_check)} AS \"check\", {e['raw']} AS failure_case FROM src WHERE {e['bad']}")
        if not r.nullable:
            branches.append(
                f"SELECT {k}, {col} AS \"column\", 'not_nullable' AS \"check\", CAST(NULL AS VARCHAR) AS failure_case "
                f"FROM src WHERE {e['missing']}"
            )
        if r.value_check is not None:
            branches.append(
                f"SELECT {k}, {col} AS \"column\", {_sq(r.value_check)} AS \"check\", {e['text']} AS failure_case FROM src WHERE {e['v']} IS NOT NULL AND NOT ({e['ok']})"
            )
    return f"WITH {src_cte}, cases AS ({' UNION ALL '.join(branches)})"


def status_sql(src_cte: str, contract: Contract, keys: list[str], src_types: dict[str, str], extra: list[str]) -> str:
    """Per-row status and sorted reasons; ``extra`` are SQL select items carried along."""
    items = []
    for r in contract.rules:
        e = _rule_sql(r, src_types.get(r.column, "string"))
        if e["bad"] != "false":
            items.append(f"CASE WHEN {e['bad']} THEN {_sq(r.column + ':' + r.coerce_check)} END")
        if not r.nullable:
            items.append(f"CASE WHEN {e['missing']} THEN {_sq(r.column + ':not_nullable')} END")
        if r.value_check is not None:
            items.append(f"CASE WHEN {e['v']} IS NOT NULL AND NOT ({e['ok']}) THEN {_sq(r.column + ':' + r.value_check)} END")
    lst = f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"
    cols = ", ".join([_dq(x) for x in keys] + extra)
    out_cols = ", ".join(_dq(x) for x in keys + [e.rsplit(" AS ", 1)[1] for e in extra])
    return (
        f"WITH {src_cte}, st AS (SELECT {cols}, {lst} AS reasons FROM src) "
        f"SELECT {out_cols}, CASE WHEN len(reasons) = 0 THEN 'accepted' ELSE 'rejected' END AS status, "
        "array_to_string(list_sort(reasons), '; ') AS reasons FROM st"
    )


LINEITEM_TYPES = {
    "l_orderkey": "long", "l_linenumber": "long", "l_quantity": "double", "l_extendedprice": "double",
    "l_discount": "double", "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp",
}
LINEITEM_SRC = "src AS (SELECT * FROM lineitem)"

FRAUD_SRC = (
    "src AS (SELECT event_id, ts AS trans_date_trans_time, value - 5.0 AS amt, "
    f"([{', '.join(_sq(x) for x in [*FRAUD_CATEGORIES, 'crypto'])}])[event_id % 15 + 1] AS category, "
    "(['M', 'F', 'X'])[user_id % 3 + 1] AS gender, CASE WHEN event_type = 'error' THEN NULL ELSE 'CA' END AS state, "
    "user_id * 1000 - 5000 AS city_pop, (event_id * 37 % 1800) / 10.0 - 90.0 AS lat, (event_id * 53 % 3600) / 10.0 - 180.0 AS long, "
    "(event_id * 37 % 1800) / 10.0 - 90.0 + (user_id % 7 - 3) / 10.0 AS merch_lat, "
    "(event_id * 53 % 3600) / 10.0 - 180.0 + (event_id % 11 - 5) / 10.0 AS merch_long, "
    "CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'click' THEN 2 ELSE 0 END AS is_fraud FROM events)"
)
FRAUD_TYPES = {
    "trans_date_trans_time": "timestamp", "amt": "double", "category": "string", "gender": "string", "state": "string",
    "city_pop": "long", "lat": "double", "long": "double", "merch_lat": "double", "merch_long": "double", "is_fraud": "long",
}
_OC = "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"
_LABEL = "CAST(((o.o_totalprice > 420000.0) <> (substr(md5(CAST(o.o_orderkey AS VARCHAR)), 1, 1) = '0')) AS INTEGER)"
READMISSION_SRC = (
    "src AS (SELECT o.o_orderkey, CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Caucasian' WHEN 'BUILDING' THEN 'AfricanAmerican' "
    "WHEN 'FURNITURE' THEN 'Asian' WHEN 'HOUSEHOLD' THEN 'Hispanic' END AS race, "
    "CASE o.o_orderstatus WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' ELSE 'Unknown/Invalid' END AS gender, "
    "'[' || CAST(c.c_nationkey % 11 * 10 AS VARCHAR) || '-' || CAST(c.c_nationkey % 11 * 10 + 10 AS VARCHAR) || ')' AS age, "
    "o.o_orderkey % 16 AS time_in_hospital, c.c_nationkey * 3 AS num_lab_procedures, o.o_orderkey % 8 AS num_procedures, "
    "CAST(floor(o.o_totalprice / 10000.0) AS BIGINT) AS num_medications, o.o_custkey % 3 AS number_outpatient, "
    "o.o_custkey % 2 AS number_emergency, o.o_orderkey % 5 - 1 AS number_inpatient, o.o_custkey % 17 AS number_diagnoses, "
    "CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Ch' ELSE 'No' END AS change, "
    "CASE WHEN c.c_acctbal > 0 THEN 'Yes' ELSE 'No' END AS diabetesMed, "
    + ", ".join(f"(['No', 'Down', 'Steady', 'Up', 'Maybe'])[(o.o_orderkey + {i}) % 5 + 1] AS {m}" for i, m in enumerate(MEDICATION_COLS))
    + f", {_LABEL} AS readmitted_30d {_OC})"
)
READMISSION_TYPES = {r.column: ("long" if r.dtype == "long" else "string") for r in READMISSION.rules}
DROPOUT_SRC = (
    "src AS (SELECT o.o_orderkey, o.o_orderkey % 7 AS \"Marital Status\", c.c_nationkey % 18 AS \"Application mode\", "
    "o.o_orderkey % 11 AS \"Application order\", c.c_custkey % 40 + 1 AS \"Course\", o.o_orderkey % 2 AS \"Daytime/evening attendance\", "
    "c.c_nationkey + 1 AS \"Previous qualification\", o.o_totalprice / 2500.0 AS \"Previous qualification (grade)\", "
    "c.c_acctbal / 50.0 + 100.0 AS \"Admission grade\", o.o_orderkey % 60 + 14 AS \"Age at enrollment\", o.o_custkey % 2 AS \"Gender\", "
    "CASE WHEN o.o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS \"Scholarship holder\", "
    "CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS \"Debtor\", "
    "CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE 2 END AS \"Tuition fees up to date\", "
    "c.c_nationkey % 9 AS \"Curricular units 1st sem (approved)\", o.o_orderkey % 9 - 1 AS \"Curricular units 2nd sem (approved)\", "
    "(o.o_orderkey % 210) / 10.0 AS \"Curricular units 1st sem (grade)\", (c.c_custkey % 200) / 10.0 AS \"Curricular units 2nd sem (grade)\", "
    "c.c_acctbal / 1000.0 AS \"Unemployment rate\", o.o_totalprice / 100000.0 - 2.0 AS \"Inflation rate\", "
    f"CAST(c.c_nationkey AS DOUBLE) - 12.0 AS \"GDP\", {_LABEL} AS dropout {_OC})"
)
DROPOUT_TYPES = {r.column: r.dtype for r in DROPOUT.rules}

_FAIL_SELECT = " SELECT {keys}, \"column\", \"check\", failure_case FROM cases"

ORACLES = {
    "contract_types": CONTRACT_TYPES_SQL,
    "contract_types_values": CONTRACT_TYPES_VALUES_SQL,
    "contract_failures": failure_sql(LINEITEM_SRC, LINEITEM, ["l_orderkey", "l_linenumber"], LINEITEM_TYPES)
    + " SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, \"column\", \"check\", failure_case FROM cases",
    "contract_summary": failure_sql(LINEITEM_SRC, LINEITEM, ["l_orderkey", "l_linenumber"], LINEITEM_TYPES)
    + " SELECT \"column\", \"check\", CAST(count(*) AS BIGINT) AS n_cases FROM cases GROUP BY ALL "
    "ORDER BY n_cases DESC, \"column\" ASC NULLS LAST, \"check\" ASC NULLS LAST LIMIT 10",
    "contract_coerce": "SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
    "CASE WHEN l_quantity = floor(l_quantity) THEN CAST(l_quantity AS BIGINT) END AS l_quantity, "
    "round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax, "
    "l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem",
    "contract_quarantine": status_sql(
        LINEITEM_SRC, LINEITEM, ["l_orderkey", "l_linenumber"], LINEITEM_TYPES,
        ["CASE WHEN l_quantity = floor(l_quantity) THEN CAST(l_quantity AS BIGINT) END AS q_l_quantity"],
    ).replace("\"q_l_quantity\"", "q_l_quantity AS l_quantity"),
    "contract_fraud": failure_sql(FRAUD_SRC, FRAUD, ["event_id"], FRAUD_TYPES) + _FAIL_SELECT.format(keys="event_id"),
    "contract_readmission": failure_sql(READMISSION_SRC, READMISSION, ["o_orderkey"], READMISSION_TYPES)
    + _FAIL_SELECT.format(keys="o_orderkey"),
    "contract_dropout": failure_sql(DROPOUT_SRC, DROPOUT, ["o_orderkey"], DROPOUT_TYPES) + _FAIL_SELECT.format(keys="o_orderkey"),
}

QUERIES = {
    "contract_types": q_contract_types,
    "contract_types_values": q_contract_types_values,
    "contract_failures": q_contract_failures,
    "contract_summary": q_contract_summary,
    "contract_coerce": q_contract_coerce,
    "contract_quarantine": q_contract_quarantine,
    "contract_fraud": q_contract_fraud,
    "contract_readmission": q_contract_readmission,
    "contract_dropout": q_contract_dropout,
}
