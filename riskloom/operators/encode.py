"""Fitted encodings: category dictionaries, codes, standardisation, drop-first one-hot.

Codes go by a dictionary table (:func:`category_codes`): distinct levels ranked by a distributed running count and joined back by
value, so any number of levels does; Spark broadcasts the table where it is measured to be small. :class:`SparseDesign` is the
design matrix on that table, with sparse rows. :class:`DesignModel` is its dense form, a column for each level: its
levels become output columns and literals, so it is capped at ``max_levels`` for each categorical column.
Means and deviations are one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.stats import nan_to_null
from riskloom.operators.prefix import cumulative, cut

# Fill values before standardising / one-hot encoding.
NUMERIC_FILL = 0.0
CATEGORY_FILL = "Unknown"
MAX_LEVELS = 10_000


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def category_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value)``: distinct non-null values as text, by a shuffle with map-side de-duplication."""
    wide = df.select(*[q(c).cast("string").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull()).distinct()


def fit_categories(df: DataFrame, columns: Sequence[str], *, max_levels: int = MAX_LEVELS) -> dict[str, list]:
    """Sorted distinct non-null values per column.

    From :func:`category_levels`; the driver receives at most ``max_levels`` values per column and a
    higher-cardinality column is an error, not a silent truncation.
    """
    columns = list(columns)
    if not columns:
        return {}
    limit = max_levels * len(columns) + 1
    rows = category_levels(df, columns).limit(limit).collect()
    out: dict[str, list] = {c: [] for c in columns}
    for r in rows:
        out[r["column"]].append(r["value"])
    for c, vals in out.items():
        if len(vals) > max_levels:
            raise ValueError(f"column {c!r} has more than {max_levels} levels; not categorical")
        vals.sort()
    if len(rows) >= limit:
        raise ValueError("too many categorical levels")
    return out


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, code)``: the levels of each column as text, numbered from 0 in their order. Checkpointed."""
    levels = category_levels(df, columns).withColumn("_rl_one", F.lit(1).cast("long"))
    ranked = cumulative(levels, ["value"], ["_rl_one"], group_cols=["column"])
    return cut(ranked.select("column", "value", (F.col("cum__rl_one") - 1).alias("code")))


def with_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str], prefix: str = "code_") -> DataFrame:
    """``df`` with ``<prefix><column>``, the level's code; unseen and NULL -> NULL.

    One join per column on the value. A value that many rows share lies in one row of the table, so Spark can broadcast the table or
    split the rows.
    """
    for c in columns:
        mine = codes.where(F.col("column") == c).select(F.col("value").alias("_rl_value"), F.col("code").alias(f"{prefix}{c}"))
        df = df.join(mine, q(c).cast("string") == F.col("_rl_value"), "left").drop("_rl_value")
    return df


def fill_numeric(c: Column) -> Column:
    return F.coalesce(nan_to_null(c.cast("double")), F.lit(NUMERIC_FILL))


def fill_category(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(CATEGORY_FILL))


def dummy_name(column: str, level: str) -> str:
    return f"{column}_{level}"


@dataclass
class DesignModel:
    """Standardisation stats and kept dummy levels learnt at fit time."""

    numeric: list[str]
    categorical: list[str]
    means_stds: dict[str, tuple[float, float]] = field(default_factory=dict)
    dummies: dict[str, list[str]] = field(default_factory=dict)

    @property
    def output_columns(self) -> list[str]:
        out = [f"z_{c}" for c in self.numeric]
        for c in self.categorical:
            out += [dummy_name(c, lv) for lv in self.dummies.get(c, [])]
        return out

    def columns(self) -> list[Column]:
        cols = []
        for c in self.numeric:
            mu, sigma = self.means_stds[c]
            cols.append(((fill_numeric(q(c)) - F.lit(mu)) / F.lit(sigma)).alias(f"z_{c}"))
        for c in self.categorical:
            filled = fill_category(q(c))
            for lv in self.dummies.get(c, []):
                cols.append((filled == F.lit(lv)).cast("double").alias(dummy_name(c, lv)))
        return cols

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return df.select(*[q(k) for k in keep], *self.columns())

    def packed(self) -> Column:
        """Intercept and design columns as one ``array<double>``."""
        return F.array(F.lit(1.0), *[c.cast("double") for c in self.columns()])

    def to_dict(self) -> dict:
        return {
            "numeric": self.numeric,
            "categorical": self.categorical,
            "means_stds": {k: list(v) for k, v in self.means_stds.items()},
            "dummies": self.dummies,
        }

    @classmethod
    def from_dict(cls, d: dict) -> DesignModel:
        return cls(
            d["numeric"], d["categorical"], {k: tuple(v) for k, v in d["means_stds"].items()}, d["dummies"]
        )


def fit_means(df: DataFrame, numeric: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and sample deviation of each column after filling with 0; 0 or undefined deviations become 1. One aggregate."""
    means_stds: dict[str, tuple[float, float]] = {}
    if numeric:
        aggs = []
        for c in numeric:
            v = fill_numeric(q(c))
            aggs += [F.avg(v).alias(f"m_{c}"), F.stddev_samp(v).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        for c in numeric:
            mu = float(row[f"m_{c}"] or 0.0)
            s = row[f"s_{c}"]
            sigma = float(s) if s is not None and s == s and s != 0.0 else 1.0
            means_stds[c] = (mu, sigma)
    return means_stds


def fit_design(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DesignModel:
    """Means and sample std (ddof 1; 0 or undefined -> 1) after filling with 0; dummy
    levels = sorted levels after filling with ``Unknown``, first one dropped."""
    numeric = [c for c in numeric if c in df.columns]
    categorical = [c for c in categorical if c in df.columns]
    means_stds = fit_means(df, numeric)
    dummies: dict[str, list[str]] = {}
    if categorical:
        filled = df.select(*[fill_category(q(c)).alias(c) for c in categorical])
        levels = fit_categories(filled, categorical)
        dummies = {c: levels[c][1:] for c in categorical}
    return DesignModel(list(numeric), list(categorical), means_stds, dummies)


@dataclass
class SparseDesign:
    """The design matrix with sparse rows: standardised numbers first, then a slot for each level but a column's first."""

    numeric: list[str]
    categorical: list[str]
    means_stds: dict[str, tuple[float, float]]
    codes: DataFrame  # of the filled columns
    n_levels: dict[str, int]

    @property
    def offsets(self) -> dict[str, int]:
        """First slot of each categorical column."""
        out, at = {}, len(self.numeric)
        for c in self.categorical:
            out[c] = at
            at += max(self.n_levels.get(c, 0) - 1, 0)
        return out

    @property
    def size(self) -> int:
        return len(self.numeric) + sum(max(self.n_levels.get(c, 0) - 1, 0) for c in self.categorical)

    def _coded(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        numbers = [((fill_numeric(q(c)) - F.lit(self.means_stds[c][0])) / F.lit(self.means_stds[c][1])).alias(f"_rl_z{i}") for i, c in enumerate(self.numeric)]
        filled = df.select(*[q(k).alias(f"_rl_k{i}") for i, k in enumerate(keep)], *numbers, *[fill_category(q(c)).alias(c) for c in self.categorical])
        return with_codes(filled, self.codes, self.categorical, prefix="_rl_code_")

    def _kept(self, keep: Sequence[str]) -> list[Column]:
        return [F.col(f"_rl_k{i}").alias(k) for i, k in enumerate(keep)]

    def _cells(self) -> Column:
        """Entries of a row that are not 0, in the order of their slots."""
        one = lambda slot, value: F.struct(slot.cast("int").alias("slot"), value.alias("value"))
        cells = [F.when(F.col(f"_rl_z{i}") != 0, one(F.lit(i), F.col(f"_rl_z{i}"))) for i in range(len(self.numeric))]
        cells += [F.when(F.col(f"_rl_code_{c}") > 0, one(F.col(f"_rl_code_{c}") + F.lit(at - 1), F.lit(1.0))) for c, at in self.offsets.items()]
        return F.filter(F.array(*cells), lambda x: x.isNotNull())

    def entries(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep + (slot, value)``, a row for each entry that is not 0."""
        e = self._coded(df, keep).select(*self._kept(keep), F.explode(self._cells()).alias("_rl_e"))
        return e.select(*[q(k) for k in keep], F.col("_rl_e.slot").cast("long").alias("slot"), "_rl_e.value")

    def vectors(self, df: DataFrame, keep: Sequence[str], out: str = "features") -> DataFrame:
        """``keep + out``: one sparse ML vector of ``size`` slots per row; unseen levels are all zeros.

        The vector's fields are made as a struct; Arrow hands the batches on under the vector's type, untouched. (The one-hot
        encoder names every slot in the column's metadata, which a million levels do not survive.)
        """
        cells = self._coded(df, keep).select(*self._kept(keep), self._cells().alias("_rl_e"))
        fields = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(self.size).alias("size"), F.col("_rl_e.slot").alias("indices"), F.col("_rl_e.value").alias("values"))
        rows = cells.select(*[q(k) for k in keep], fields.alias(out))
        return rows.mapInArrow(lambda batches: batches, T.StructType([*rows.schema.fields[:-1], T.StructField(out, VectorUDT())]))


def fit_sparse_design(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> SparseDesign:
    """Like :func:`fit_design` with the levels kept in a table; what reaches the driver is a row per column."""
    numeric, categorical = ([c for c in columns if c in df.columns] for columns in (numeric, categorical))
    codes, n_levels = df.sparkSession.createDataFrame([], "column string, value string, code long"), {}
    if categorical:
        codes = category_codes(df.select(*[fill_category(q(c)).alias(c) for c in categorical]), categorical)
        n_levels = {r["column"]: r["n"] for r in codes.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return SparseDesign(numeric, categorical, fit_means(df, numeric), codes, n_levels)
