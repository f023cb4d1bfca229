"""Ordered splits, seeded shuffles and stratified samples.

A DataFrame has no row order, so every operator here takes an explicit order: a time
column plus a unique tie key. Positions come from the two-level running count in
``prefix`` (no single-task window); cut points are ``int(n * fraction)`` as in a
positional ``iloc`` split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.operators.bottomk import least_keys
from riskloom.operators.prefix import cumulative, cut, literal, row_index, values_at_ranks

# Fractions of the ordered 3-way split (train / calibration / test),
# the reference share of the drift split and the default shuffle seed.
TRAIN_CAL_CUTS = (0.70, 0.85)
SPLIT_LABELS = ("train", "cal", "test")
REFERENCE_FRACTION = 0.70
SHUFFLE_SEED = 42


def with_position(df: DataFrame, order_cols: Sequence[str], name: str = "row_idx") -> DataFrame:
    """0-based position under ``order_cols`` (nulls last); keys must be unique together.

    This moves whole rows, as every row gets its place; where only the cut matters, use
    :func:`split_by_cut_keys`.
    """
    return row_index(df, order_cols, name=name)


def _ranks_to_values(df: DataFrame, order_cols: Sequence[str], ranks: list[int]) -> dict[int, tuple]:
    """For each 0-based rank among the non-null values of the first key (ascending): the value
    there, the offset of the rank inside that value's run of equal rows, the run's size and the least rest of its keys.

    Counts per distinct value (map-side combined, so a hot value is one row per task),
    a two-level running count, and the rows whose rank span holds a requested rank.
    """
    col = order_cols[0]
    rest = F.min(F.struct(F.lit(0).alias("_rl_0"), *order_cols[1:])).alias("_rl_rest")
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_rl_c"), rest)
    cum = cumulative(counts, [col], ["_rl_c"]).withColumn("_rl_b", F.col("cum__rl_c") - F.col("_rl_c"))
    wanted = F.array(*[F.struct(F.lit(r).cast("long").alias("rank")) for r in ranks])
    keep = cum.withColumn("_rl_v", F.struct(F.col(col).alias("value"), F.col("_rl_b").alias("before"), F.col("_rl_c").alias("size"), "_rl_rest"))
    hits = values_at_ranks(keep, "_rl_v", "_rl_c", wanted).collect()
    return {h["rank"]: (h["_rl_v"]["value"], h["rank"] - h["_rl_v"]["before"], h["_rl_v"]["size"], tuple(h["_rl_v"]["_rl_rest"])[1:]) for h in hits}


def keys_at_ranks(df: DataFrame, order_cols: Sequence[str], ranks: Sequence[int]) -> tuple[int, list[tuple | None]]:
    """Number of rows, and for each 0-based rank the ``order_cols`` key of the row there (ascending, NULLs last; None beyond the end).

    Level by level: the first key's value comes from a rank lookup over its distinct
    values; the rank inside a run of several rows is then looked up among the rows of that run. A
    hot first-key value therefore costs one extra lookup over that value's rows only.
    """
    col, rest = order_cols[0], list(order_cols[1:])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(F.col(col)).alias("nn")).first()
    n, filled = int(row["n"]), int(row["nn"])
    wanted = sorted({r for r in ranks if r < filled})
    looked = _ranks_to_values(df, order_cols, wanted) if wanted else {}
    keys: list[tuple | None] = []
    for r in ranks:
        if r >= n:
            keys.append(None)
            continue
        if r >= filled:  # among the NULL keys, which sort last
            value, offset, size, least = None, r - filled, n - filled, ()
            run = df.where(F.col(col).isNull())
        else:
            value, offset, size, least = looked[r]
            run = df.where(F.col(col) == literal(value, df.schema[col].dataType))
        if not rest:
            keys.append((value,))
        elif size == 1 and value is not None:
            keys.append((value, *least))
        else:
            keys.append((value, *keys_at_ranks(run, rest, [offset])[1][0]))
    return n, keys


def key_less(order_cols: Sequence[str], key: tuple | None, dtypes: dict | None = None) -> Column:
    """Lexicographic ``(order_cols) < key`` with NULLs last; ``key=None`` means +inf.

    Literals take the column's exact type (``TIMESTAMP_NTZ`` through its text form), so
    the comparison does not depend on the session time zone.
    """
    if key is None:
        return F.lit(True)
    dtypes = dtypes or {}
    out = F.lit(False)
    eq = F.lit(True)
    for c, v in zip(order_cols, key):
        col = F.col(c)
        if v is None:
            lt = col.isNotNull()
            same = col.isNull()
        else:
            lit = literal(v, dtypes[c]) if c in dtypes else F.lit(v)
            lt = col.isNotNull() & (col < lit)
            same = col.isNotNull() & (col == lit)
        out = out | (eq & lt)
        eq = eq & same
    return out


def keys_at_fractions(df: DataFrame, order_cols: Sequence[str], fractions: Sequence[float]) -> tuple[int, list[tuple | None]]:
    """As :func:`keys_at_ranks`, for the cuts ``int(n * fraction)``."""
    n = df.count()
    return keys_at_ranks(df, order_cols, cut_points(n, fractions))


def split_by_cut_keys(
    df: DataFrame,
    order_cols: Sequence[str],
    fractions: Sequence[float],
    labels: Sequence[str],
    *,
    split_col: str = "split",
    keys_once: bool = False,
) -> DataFrame:
    """Same labels as :func:`ordered_split` without a global position: the keys at the
    cut ranks are found by rank lookup, then each row is labelled by comparing its key
    with them (a narrow projection, no shuffle of the rows themselves). The lookup reads the keys about
    ten times; ``keys_once`` writes them first, for a ``df`` that costs more than a scan."""
    narrow = df.select(*order_cols)
    narrow = cut(narrow) if keys_once else narrow
    dtypes = {f.name: f.dataType for f in narrow.schema.fields}
    _, keys = keys_at_fractions(narrow, order_cols, fractions)
    expr = None
    for key, lab in zip(keys, labels):
        cond = key_less(order_cols, key, dtypes)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    expr = expr.otherwise(F.lit(labels[len(keys)])) if expr is not None else F.lit(labels[0])
    return df.withColumn(split_col, expr)


def cut_points(n: int, fractions: Sequence[float]) -> list[int]:
    return [int(n * f) for f in fractions]


def label_by_position(pos: Column, cuts: Sequence[int], labels: Sequence[str]) -> Column:
    expr = None
    for cut, lab in zip(cuts, labels):
        expr = F.when(pos < F.lit(cut), F.lit(lab)) if expr is None else expr.when(pos < F.lit(cut), F.lit(lab))
    return expr.otherwise(F.lit(labels[len(cuts)])) if expr is not None else F.lit(labels[0])


def ordered_split(
    df: DataFrame,
    order_cols: Sequence[str],
    fractions: Sequence[float] = TRAIN_CAL_CUTS,
    labels: Sequence[str] = SPLIT_LABELS,
    *,
    split_col: str = "split",
    index_col: str = "row_idx",
) -> DataFrame:
    """Label rows ``[0, int(f1 n))``, ``[int(f1 n), int(f2 n))``, ... by global position."""
    if len(labels) != len(fractions) + 1:
        raise ValueError("need one more label than cut fraction")
    cuts = cut_points(df.count(), fractions)
    indexed = with_position(df, order_cols, name=index_col)
    return indexed.withColumn(split_col, label_by_position(F.col(index_col), cuts, labels))


def reference_current(df: DataFrame, order_cols: Sequence[str], fraction: float = REFERENCE_FRACTION) -> DataFrame:
    """``side`` 0 for the first ``int(fraction n)`` rows by order, 1 for the rest.

    Found through the cut key (see :func:`split_by_cut_keys`), so the rows are labelled
    in place and never shuffled for it.
    """
    out = split_by_cut_keys(df, order_cols, [fraction], ["0", "1"], split_col="_rl_side")
    return out.withColumn("side", F.col("_rl_side").cast("int")).drop("_rl_side")


def shuffle_key(key_col: str, seed: int = SHUFFLE_SEED) -> Column:
    """Seeded pseudo-random order key: ``md5(key || ':' || seed)`` (same in DuckDB)."""
    return F.md5(F.concat(F.col(key_col).cast("string"), F.lit(f":{seed}")))


def shuffle_order(df: DataFrame, key_col: str, seed: int = SHUFFLE_SEED) -> tuple[DataFrame, list[str]]:
    """Columns ordering rows like ``md5(key || ':' || seed)``, led by a numeric key.

    The first 15 hex digits of the digest as a BIGINT sort exactly like the digest text
    (fixed width, 0-9 < a-f), so the order is unchanged and starts with a number; the full digest and the key
    break the (rare) ties.
    """
    h = shuffle_key(key_col, seed)
    out = df.withColumn("_rl_shuffle", h).withColumn(
        "_rl_shuffle_hi", F.conv(F.substring(F.col("_rl_shuffle"), 1, 15), 16, 10).cast("long")
    )
    return out, ["_rl_shuffle_hi", "_rl_shuffle", key_col]


def shuffle_split(
    df: DataFrame,
    key_col: str,
    fractions: Sequence[float] = (0.8,),
    labels: Sequence[str] = ("train", "test"),
    *,
    seed: int = SHUFFLE_SEED,
    split_col: str = "split",
    index_col: str = "row_idx",
) -> DataFrame:
    """Split in seeded random order (used when there is no time column)."""
    keyed, order = shuffle_order(df, key_col, seed)
    out = ordered_split(keyed, order, fractions, labels, split_col=split_col, index_col=index_col)
    return out.drop("_rl_shuffle", "_rl_shuffle_hi")


def stratified_sample(
    df: DataFrame,
    label_col: str,
    key_col: str,
    sample_size: int,
    *,
    seed: int = SHUFFLE_SEED,
) -> DataFrame:
    """Exact stratified subsample without replacement when ``n > sample_size``.

    ``n_pos = min(P, int(sample_size * mean(y)) + 1)`` positives and
    ``min(sample_size - n_pos, N)`` negatives, each the first by the seeded shuffle key.
    Rows with another label, or none, are left out whatever the size. One scan finds the sizes and the least keys of each
    class (:func:`bottomk.least_keys`, at most ``sample_size`` + 1 for each), a second one filters the rows by the key at the cut.
    """
    labelled = df.where(F.col(label_col).isin(0, 1))
    keyed, order = shuffle_order(labelled, key_col, seed)
    keys = cut(least_keys(keyed.select(F.col(label_col).cast("int").alias("_rl_y"), *order), "_rl_y", order, sample_size + 1))
    sizes = {r["_rl_y"]: r["size"] for r in keys.groupBy("_rl_y").agg(F.max("size").alias("size")).collect()}
    n, pos = sum(sizes.values()), sizes.get(1, 0)
    if n <= sample_size:
        return labelled
    n_pos = min(pos, int(sample_size * (pos / n)) + 1)
    wanted = {1: n_pos, 0: min(sample_size - n_pos, n - pos)}
    at = F.lit(False)
    for label, size in wanted.items():
        at = at | ((F.col("_rl_y") == label) & (F.col("rank") == size))
    first_out = {r["_rl_y"]: tuple(r[c] for c in order) for r in keys.where(at).collect()}  # none for a class that stays whole
    dtypes = {f.name: f.dataType for f in keyed.schema.fields}
    keep = F.lit(False)
    for label in wanted:
        keep = keep | ((F.col(label_col) == label) & key_less(order, first_out.get(label), dtypes))
    return keyed.where(keep).drop("_rl_shuffle", "_rl_shuffle_hi")
