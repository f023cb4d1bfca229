"""Declarative data contracts checked in one pass.

A contract is a list of :class:`Rule` (column, type, nullable, at most one value check).
Validation is one projection: every rule becomes a few Column expressions, the failing
ones are packed into ``array<struct<column, check, failure_case>>`` per row, and
``explode`` turns that into the long failure-case table. Counts come from a single
aggregate over the same projection. Nothing is collected but the counts. A row's values are
coerced once, and its checks are computed once for all who ask for them. A value that cannot be cast
is told by its form before the cast is tried, as a failing cast costs an exception.

Semantics (chosen to match a coercing, open-schema contract):

* a declared column that is missing is one table-level case ``column_in_dataframe``;
* coercion uses ``try_cast``: a non-null input whose cast is NULL fails
  ``coerce_dtype``; an integer column only accepts integral values (text ``1.5`` and
  double ``1.5`` both fail, 64-bit integers keep every digit); ``truncate=True`` cuts the
  fraction off instead;
* NaN counts as missing; a NULL input fails ``not_nullable`` unless the rule allows it;
* value checks run on non-null coerced values (NULL passes them);
* undeclared columns pass through untouched (``strict=False``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.stats import nan_to_null

CASE_TYPE = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("failure_case", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)
EMPTY_CASES = T.ArrayType(CASE_TYPE)

# Dtype names used in the check labels, per declared type.
DTYPE_LABEL = {"long": "int64", "double": "float64", "string": "str", "timestamp": "datetime64[ns]"}


def _fmt_num(v) -> str:
    if isinstance(v, float) and v.is_integer():
        return str(int(v))
    return str(v)


@dataclass(frozen=True)
class Rule:
    column: str
    dtype: str  # long | double | string | timestamp
    nullable: bool = False
    ge: float | None = None
    le: float | None = None
    isin: tuple | None = None

    def __post_init__(self) -> None:
        if self.dtype not in DTYPE_LABEL:
            raise ValueError(f"unsupported dtype {self.dtype!r}")

    @property
    def value_check(self) -> str | None:
        if self.isin is not None:
            return "isin([" + ", ".join(repr(v) for v in self.isin) + "])"
        if self.ge is not None and self.le is not None:
            return f"in_range({_fmt_num(self.ge)}, {_fmt_num(self.le)})"
        if self.ge is not None:
            return f"greater_than_or_equal_to({_fmt_num(self.ge)})"
        if self.le is not None:
            return f"less_than_or_equal_to({_fmt_num(self.le)})"
        return None

    @property
    def coerce_check(self) -> str:
        return f"coerce_dtype('{DTYPE_LABEL[self.dtype]}')"


@dataclass
class Contract:
    name: str
    rules: list[Rule]
    strict: bool = False
    truncate: bool = False

    @property
    def columns(self) -> list[str]:
        return [r.column for r in self.rules]

    def without(self, *names: str) -> Contract:
        return Contract(self.name, [r for r in self.rules if r.column not in names], self.strict, self.truncate)


def q(name: str) -> Column:
    return F.col(f"`{name}`")


# What a cast takes, or a little more: text that none of these fits has no value, whatever the cast would say.
_SPACE = r"[\x00-\x20\x7F]*"
LONG_FORM = rf"\A{_SPACE}[+-]?0*[0-9]{{1,19}}{_SPACE}\z"
DECIMAL_FORM = rf"\A{_SPACE}[+-]?[\p{{Nd}}.]+([eE][+-]?\p{{Nd}}+)?{_SPACE}\z"
DOUBLE_FORM = rf"(?i)\A{_SPACE}[+-]?(nan|inf|infinity|0x[0-9a-f.]+p[+-]?[0-9]+[fd]?|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?[fd]?){_SPACE}\z"
#: The first whole numbers beyond 64 bits, and the first double that ``decimal(38,6)`` does not hold.
LEAST_LONG, BEYOND_LONG, BEYOND_DECIMAL = -(2**63), 2**63, 1e32


def _formed(c: Column, src: T.DataType, form: str) -> Column:
    """``c``, but NULL for text without the form."""
    return F.when(c.rlike(form), c) if isinstance(src, T.StringType) else c


def _text(c: Column, dtype: T.DataType | None, held: T.DataType | None = None) -> Column:
    """Failure value as text; fractional numbers with 6 decimals, as they are written where those do not hold them (huge, infinite).

    ``held`` is the type of ``c`` itself, if it is not ``dtype``.
    """
    held = held or dtype
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        fits = F.when(F.abs(c) < F.lit(BEYOND_DECIMAL), c) if isinstance(held, (T.DoubleType, T.FloatType)) else _formed(c, held, DECIMAL_FORM)
        return F.coalesce(fits.try_cast("decimal(38,6)").cast("string"), c.cast("string"))
    return c.cast("string")


def _coerce(rule: Rule, c: Column, src: T.DataType, truncate: bool) -> tuple[Column, Callable[[Column], Column]]:
    """``(coerced value, whether coercion failed, given the coerced value)`` for one rule."""
    if rule.dtype == "string":
        return c.cast("string"), lambda v: F.lit(False)
    if rule.dtype == "timestamp":
        if isinstance(src, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            v = c.cast("timestamp")
        else:
            v = F.try_to_timestamp(c.cast("string"))
        return v, lambda v: c.isNotNull() & v.isNull()
    floating = isinstance(src, (T.DoubleType, T.FloatType))
    nan_in = F.isnan(c) if floating else F.lit(False)
    if rule.dtype == "double":
        v = nan_to_null(_formed(c, src, DOUBLE_FORM).try_cast("double"))
    else:
        v = _as_long(c, src, truncate)
    return v, lambda v: c.isNotNull() & ~nan_in & v.isNull()


def _as_long(c: Column, src: T.DataType, truncate: bool) -> Column:
    """A 64-bit integer without a detour over doubles, which hold 53 bits only.

    Integers pass through. Text and decimals go by exact decimals, so ``1.0`` and ``1e3`` count as
    integers. Only floating sources are judged as doubles. NULL if the value is no integer (unless
    truncated) or does not fit.
    """
    if isinstance(src, T.IntegralType):
        return c.cast("long")
    if isinstance(src, (T.DoubleType, T.FloatType)):
        exact = nan_to_null(c.cast("double"))
        plain = F.lit(None).cast("long")
        held = (exact >= F.lit(float(LEAST_LONG))) & (exact <= F.lit(float(BEYOND_LONG)))
    else:
        exact = _formed(c, src, DECIMAL_FORM).try_cast("decimal(38,18)")
        plain = _formed(c, src, LONG_FORM).try_cast("long") if isinstance(src, T.StringType) else F.lit(None).cast("long")
        held = (exact > F.lit(Decimal(LEAST_LONG - 1))) & (exact < F.lit(Decimal(BEYOND_LONG)))
    whole = F.when(held if truncate else held & (exact == F.floor(exact)), exact)
    return F.coalesce(plain, whole.try_cast("long"))


def _value_ok(rule: Rule, v: Column) -> Column:
    ok = F.lit(True)
    if rule.isin is not None:
        ok = v.isin(*rule.isin)
    else:
        if rule.ge is not None:
            ok = ok & (v >= F.lit(rule.ge))
        if rule.le is not None:
            ok = ok & (v <= F.lit(rule.le))
    return ok


@dataclass
class Validation:
    """Lazy result of checking a DataFrame against a contract."""

    contract: Contract
    source: DataFrame
    columns: list[Column]  # coerced columns and those that pass through
    checks: list[tuple[str, str, Column, Column]]  # column, check, "fails" (never null), failing value as text
    missing: list[str] = field(default_factory=list)

    @property
    def checked(self) -> DataFrame:
        """The coerced rows with ``_rl_cases``, the array of their failing checks.

        The array is exploded out of an array of its own: a filter on it, or the one that Spark adds below ``explode``, would
        otherwise move under this projection and compute every check once more for each place that names the array.
        """
        cases = [_case(fails, column, check, text) for column, check, fails, text in self.checks]
        found = F.concat(*cases) if cases else F.array().cast(EMPTY_CASES)
        return self.source.select(*self.columns, F.explode(F.array(found)).alias("_rl_cases"))

    def _fails(self) -> Column:
        return reduce(or_, [fails for _, _, fails, _ in self.checks], F.lit(False))

    INTERNAL = ("_rl_cases",)

    @property
    def coerced(self) -> DataFrame:
        return self.source.select(*self.columns)

    @staticmethod
    def has_failure() -> Column:
        return F.size("_rl_cases") > 0

    @staticmethod
    def n_failed() -> Column:
        return F.size("_rl_cases")

    @staticmethod
    def reasons() -> Column:
        return F.concat_ws("; ", F.sort_array(F.col("_rl_cases")["label"]))

    def failure_cases(self, keys: Sequence[str] = ()) -> DataFrame:
        """Long table ``(keys..., column, check, failure_case)``; one row per failing cell."""
        per_row = (
            self.checked.select(*[q(k) for k in keys], F.explode("_rl_cases").alias("c"))
            .select(*[q(k) for k in keys], "c.column", "c.check", "c.failure_case")
        )
        if not self.missing:
            return per_row
        spark = self.checked.sparkSession
        table_level = spark.createDataFrame(
            [(m, "column_in_dataframe", m) for m in self.missing], "column string, check string, failure_case string"
        )
        for k in keys:
            table_level = table_level.withColumn(k, F.lit(None).cast(self.checked.schema[k].dataType))
        return per_row.unionByName(table_level.select(*keys, "column", "check", "failure_case"))

    def counts(self) -> dict[str, int]:
        """One aggregate: rows, failing rows, failure cases (cases, not rows)."""
        total = reduce(add, [fails.cast("long") for _, _, fails, _ in self.checks], F.lit(0).cast("long"))
        r = self.source.agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(self._fails().cast("long")).alias("n_bad_rows"), F.sum(total).alias("n_cases")
        ).first()
        return {
            "n_rows": int(r["n_rows"]),
            "n_bad_rows": int(r["n_bad_rows"] or 0),
            "n_failures": int(r["n_cases"] or 0) + len(self.missing),
        }

    def summary(self, max_rows: int = 10) -> DataFrame:
        """Cases per ``(column, check)``, most frequent first, top ``max_rows``: one aggregate, a sum for each check."""
        names = [(c, k) for c, k, _, _ in self.checks] + [(m, "column_in_dataframe") for m in self.missing]
        sums = [F.coalesce(F.sum(fails.cast("long")), F.lit(0).cast("long")) for _, _, fails, _ in self.checks] + [F.lit(1).cast("long")] * len(self.missing)
        if not names:
            return self.source.sparkSession.createDataFrame([], "column string, check string, n_cases long")
        one = self.source.agg(*[s.alias(f"_rl_{i}") for i, s in enumerate(sums)])
        rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("check"), F.col(f"_rl_{i}").alias("n_cases")) for i, (c, k) in enumerate(names)])
        found = one.select(F.explode(rows).alias("r")).select("r.*").where(F.col("n_cases") > 0)
        return found.orderBy(F.desc("n_cases"), "column", "check").limit(max_rows)

    def quarantine(self) -> tuple[DataFrame, DataFrame]:
        """``(accepted, rejected)``; rejected rows carry sorted ``reasons``."""
        # The accepted rows need no cases, only whether there is one.
        good = self.source.select(*self.columns, F.explode(F.array(self._fails())).alias("_rl_bad")).where("NOT _rl_bad").drop("_rl_bad")
        bad = self.checked.where(self.has_failure()).withColumn("reasons", self.reasons()).drop(*self.INTERNAL)
        return good, bad

    def with_status(self) -> DataFrame:
        """Every row with ``status`` (accepted/rejected) and ``reasons`` ('' when accepted)."""
        return self.checked.select(
            "*",
            F.when(self.has_failure(), F.lit("rejected")).otherwise(F.lit("accepted")).alias("status"),
            self.reasons().alias("reasons"),
        ).drop(*self.INTERNAL)


def _case(cond: Column, column: str, check: str, text: Column) -> Column:
    """One-element array when ``cond`` (never null) holds, else an empty array."""
    fields = (F.lit(column), F.lit(check), text.cast("string"), F.lit(f"{column}:{check}"))
    item = F.struct(*[c.alias(f.name) for c, f in zip(fields, CASE_TYPE.fields, strict=True)])
    return F.when(cond, F.array(item)).otherwise(F.array().cast(EMPTY_CASES))


def validate(df: DataFrame, contract: Contract) -> Validation:
    """Check ``df`` against ``contract`` lazily; see the module docstring.

    One projection adds ``_rl_cases``: the ``concat`` of one-element-or-empty arrays, so
    it holds exactly the failing checks of the row. Consumers need no higher-order
    function (which would leave whole-stage codegen) and no filter over the exploded
    cases (whose constraint inference grows exponentially with the number of rules):
    ``explode`` gives the case table, ``size`` the counts, ``sort_array`` of the label
    field the reasons.
    """
    present = set(df.columns)
    missing = [r.column for r in contract.rules if r.column not in present]
    declared = {r.column for r in contract.rules}
    extra = [c for c in df.columns if c not in declared] if contract.strict else []
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    out_cols: list[Column] = [q(n) for n in df.columns if n not in declared]
    checks: list[tuple[str, str, Column, Column]] = []
    nothing = F.lit(None).cast("string")
    coerced: dict[str, Column] = {}
    for rule in contract.rules:
        if rule.column not in present:
            continue
        src = dtypes[rule.column]
        raw = q(rule.column)
        name = f"_rl_v{len(coerced)}"
        coerced[name], failed = _coerce(rule, raw, src, contract.truncate)
        v, bad_cast = F.col(name), failed(F.col(name))
        is_missing = raw.isNull() | (F.isnan(raw) if isinstance(src, (T.DoubleType, T.FloatType)) else F.lit(False))
        out_cols.append(v.alias(rule.column))
        if rule.dtype in ("long", "double", "timestamp"):
            checks.append((rule.column, rule.coerce_check, bad_cast, raw.cast("string")))
        if not rule.nullable:
            checks.append((rule.column, "not_nullable", is_missing, nothing))
        check = rule.value_check
        if check is not None:
            target_type = {"long": T.LongType(), "double": T.DoubleType()}.get(rule.dtype, src)
            checks.append((rule.column, check, v.isNotNull() & ~_value_ok(rule, v), _text(v, target_type, spark_type(rule))))
    for name in extra:
        checks.append((name, "column_in_schema", F.lit(True), nothing))
    checks = [(c, k, F.coalesce(fails, F.lit(False)), text) for c, k, fails, text in checks]
    return Validation(contract, df.withColumns(coerced), out_cols, checks, missing)


class DataValidationError(Exception):
    """Raised by :func:`validate_or_raise`; carries the counts and the lazy cases."""

    def __init__(self, domain: str, counts: dict[str, int], cases: DataFrame):
        self.domain = domain
        self.counts = counts
        self.cases = cases
        super().__init__(
            f"[{domain}] contract failed: {counts['n_failures']} cases in {counts['n_rows']} rows "
            f"({counts['n_bad_rows']} rows with at least one)"
        )


def validate_or_raise(df: DataFrame, contract: Contract, *, lazy: bool = True, keys: Sequence[str] = ()) -> DataFrame:
    """Coerced table, or :class:`DataValidationError` after one counting action.

    ``lazy=False`` stops at the first failing row: only ``limit(1)`` of the cases is
    evaluated, so the scan can end early.
    """
    v = validate(df, contract)
    if lazy:
        counts = v.counts()
        if counts["n_failures"]:
            raise DataValidationError(contract.name, counts, v.failure_cases(keys))
        return v.coerced
    first = v.checked.where(v.has_failure()).select(v.n_failed().alias("_n")).limit(1).collect()
    if first or v.missing:
        counts = {"n_rows": -1, "n_bad_rows": 1 if first else 0,
                  "n_failures": (first[0]["_n"] if first else 0) + len(v.missing)}
        raise DataValidationError(contract.name, counts, v.failure_cases(keys).limit(counts["n_failures"]))
    return v.coerced


def spark_type(rule: Rule) -> T.DataType:
    return {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "timestamp": T.TimestampType()}[
        rule.dtype
    ]


def schema_of(contract: Contract) -> T.StructType:
    """Explicit read schema derived from a contract (no inference pass)."""
    return T.StructType([T.StructField(r.column, spark_type(r), True) for r in contract.rules])
