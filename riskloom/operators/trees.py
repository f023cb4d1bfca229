"""Gradient-boosted trees on histograms.

1. *Bins.* Every feature becomes one byte per row: 0 stands for a missing value, numbers get the place between their approximate
   quantiles (all values, if there are few), categories their level among the commonest. Rows are packed
   into blocks, one Parquet row for several thousand, so that a pass over the data hands over arrays.
2. *Passes.* One pass serves all leaves that are open at a time: each task adds up gradients, hessians and counts per
   (leaf, feature, bin); the tasks' sums meet in a tree, so what reaches the driver has a fixed size whatever the number of rows and tasks.
3. *Growth.* Leaves are split best first until the leaf budget is used up or no split gains anything. A numeric split tries missing
   values on both sides and keeps the better one; a categorical split takes a prefix of the levels ordered by their mean gradient,
   missing among them, or with the larger side if there are none. A leaf's value is the Newton step ``-G / (H + l2)`` times the learning rate.
4. *Margins.* A row's margin is that of its block's last writing plus the trees since; blocks are written anew every ``REWRITE`` trees.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from riskloom.functions.stats import nan_to_null
from riskloom.session import scratch_path

BINS = 256
#: Rows of a block, rows for which a pass takes one task, trees after which margins are written anew, partial sums that are added up at once.
BLOCK_ROWS, TASK_ROWS, REWRITE, FAN_IN = 1 << 14, 1 << 17, 5, 16

#: Parameters and their defaults, with the names other libraries give them.
DEFAULTS = {"rounds": 20, "learning_rate": 0.1, "max_depth": 5, "max_leaves": 31, "least_rows": 1, "l2": 1e-3, "subsample": 1.0, "seed": 42}
NAMES = {
    "n_estimators": "rounds", "maxIter": "rounds", "stepSize": "learning_rate", "maxDepth": "max_depth", "num_leaves": "max_leaves",
    "minInstancesPerNode": "least_rows", "min_child_samples": "least_rows", "reg_lambda": "l2", "subsamplingRate": "subsample",
}


def tree_params(params: dict) -> dict:
    """``DEFAULTS`` with ``params`` under any of their names; a key that means nothing here is reported."""
    out, foreign = dict(DEFAULTS), []
    for k, v in params.items():
        name = NAMES.get(k, k)
        if name in out:
            out[name] = v
        else:
            foreign.append(k)
    if foreign:
        warnings.warn(f"parameters without a counterpart are left out: {', '.join(sorted(foreign))}", stacklevel=2)
    return out


def q(name: str) -> Column:
    return F.col(f"`{name}`")


# -- bins -------------------------------------------------------------------------------
@dataclass
class Binning:
    """Cut points of the numeric features, and levels of the categorical ones by bin."""

    numeric: list[str]
    categorical: list[str]
    cuts: list[list[float]] = field(default_factory=list)
    levels: list[list[str]] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def columns(self) -> list[Column]:
        return [*(nan_to_null(q(c).cast("double")).alias(f"_f{i}") for i, c in enumerate(self.numeric)), *(q(c).cast("string").alias(f"_f{len(self.numeric) + i}") for i, c in enumerate(self.categorical))]

    def bytes(self, columns: list[pa.Array]) -> np.ndarray:
        """Rows x features as bins: 0 for missing values and unknown levels."""
        out = np.zeros((len(columns[0]) if columns else 0, len(columns)), np.uint8)
        for i, c in enumerate(columns):
            if i < len(self.numeric):
                x = c.to_numpy(zero_copy_only=False).astype(float)
                out[:, i] = np.where(np.isnan(x), 0, np.searchsorted(self.cuts[i], x, "left") + 1)
            else:
                at = pc.index_in(c, pa.array(self.levels[i - len(self.numeric)], pa.string()))
                out[:, i] = pc.fill_null(at, -1).to_numpy(zero_copy_only=False) + 1
        return out


def fit_bins(df: DataFrame, numeric: list[str], categorical: list[str]) -> Binning:
    """Two aggregates: quantiles of the numbers; the ``BINS - 2`` commonest levels of each category (ties in text order), in text order."""
    cuts: list[list[float]] = []
    if numeric:
        share = [k / (BINS - 2) for k in range(BINS - 1)]
        row = df.agg(*[F.percentile_approx(nan_to_null(q(c).cast("double")), share, 10 * BINS).alias(f"q{i}") for i, c in enumerate(numeric)]).first()
        # A cut is a value: what is at most as large lies before it. The largest one needs none.
        cuts = [sorted(set(row[f"q{i}"] or []))[:-1] for i in range(len(numeric))]
    levels: list[list[str]] = [[] for _ in categorical]
    if categorical:
        wide = df.select(*[q(c).cast("string").alias(c) for c in categorical])
        counted = wide.unpivot([], categorical, "column", "value").where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        place = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("n"), "value"))
        for r in counted.withColumn("place", place).where(F.col("place") <= BINS - 2).select("column", "value").collect():
            levels[categorical.index(r["column"])].append(r["value"])
    return Binning(list(numeric), list(categorical), cuts, [sorted(x) for x in levels])


# -- trees ------------------------------------------------------------------------------
@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has no feature. A row goes left if its bin is marked."""

    feature: list[int] = field(default_factory=lambda: [-1])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    goes_left: list[bytes] = field(default_factory=lambda: [b""])
    value: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row of bins."""
        at = np.zeros(len(x), np.int64)
        open_ = [(0, np.arange(len(x)))]  # a node looks at its own rows only
        while open_:
            k, here = open_.pop()
            if self.feature[k] < 0:
                at[here] = k
                continue
            left = np.frombuffer(self.goes_left[k], np.uint8).astype(bool)[x[here, self.feature[k]]]
            open_ += [(self.left[k], here[left]), (self.right[k], here[~left])]
        return at

    def split(self, k: int, feature: int, mask: np.ndarray, values: tuple[float, float], rows: tuple[int, int]) -> tuple[int, int]:
        self.feature[k], self.goes_left[k] = feature, mask.astype(np.uint8).tobytes()
        for value, n in zip(values, rows, strict=True):
            self.feature.append(-1)
            self.left.append(-1)
            self.right.append(-1)
            self.goes_left.append(b"")
            self.value.append(value)
            self.rows.append(n)
        self.left[k], self.right[k] = len(self.feature) - 2, len(self.feature) - 1
        return self.left[k], self.right[k]

    def to_dict(self) -> dict:
        return {"feature": self.feature, "left": self.left, "right": self.right, "goes_left": [m.hex() for m in self.goes_left], "value": self.value, "rows": self.rows}

    @classmethod
    def from_dict(cls, d: dict) -> Tree:
        return cls(d["feature"], d["left"], d["right"], [bytes.fromhex(m) for m in d["goes_left"]], d["value"], d["rows"])


@dataclass
class TreeModel:
    binning: Binning
    base: float
    trees: list[Tree] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((np.array(t.value)[t.leaf_of(x)] for t in self.trees), np.zeros(len(x)))

    def score(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with the positive-class probability."""
        model = self

        @F.pandas_udf("double")
        def probability(*columns: pd.Series) -> pd.Series:
            kinds = [pa.float64()] * len(model.binning.numeric) + [pa.string()] * len(model.binning.categorical)
            x = model.binning.bytes([pa.array(c, kind, from_pandas=True) for c, kind in zip(columns, kinds, strict=True)])
            return pd.Series(_sigmoid(model.margin(x)))

        return df.withColumn(out, probability(*self.binning.columns()) if self.binning.names else F.lit(float(_sigmoid(np.array(self.base)))))

    def to_dict(self) -> dict:
        b = self.binning
        return {"numeric": b.numeric, "categorical": b.categorical, "cuts": b.cuts, "levels": b.levels, "base": self.base, "trees": [t.to_dict() for t in self.trees]}

    @classmethod
    def from_dict(cls, d: dict) -> TreeModel:
        return cls(Binning(d["numeric"], d["categorical"], d["cuts"], d["levels"]), d["base"], [Tree.from_dict(t) for t in d["trees"]])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


# -- data passes ------------------------------------------------------------------------
_BLOCK = "id long, n long, x binary, y binary, w binary, margin binary"


def _packed(ids: list, arrays: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(ids, pa.int64()), pa.array([len(a[1]) for a in arrays], pa.int64()), *(pa.array([a[k].tobytes() for a in arrays], pa.binary()) for k in range(4))]
    return pa.RecordBatch.from_arrays(columns, names=["id", "n", "x", "y", "w", "margin"])


def _blocks(batches: Iterator[pa.RecordBatch], binning: Binning, base: float, positive_weight: float) -> Iterator[pa.RecordBatch]:
    d, seen = len(binning.names), TaskContext.get().partitionId() << 32
    for batch in batches:
        for a in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(a, BLOCK_ROWS)
            y = part.column("_y").to_numpy(zero_copy_only=False).astype(np.float32)
            x = binning.bytes([part.column(f"_f{i}") for i in range(d)]) if d else np.zeros((len(y), 0), np.uint8)
            w = np.where(y == 1, positive_weight, 1.0).astype(np.float32)
            yield _packed([seen], [(x, y, w, np.full(len(y), base))])
            seen += 1


def _unpacked(rows: Iterable[Row], d: int) -> Iterator[tuple]:
    """``(id, x, y, w, margin)`` of each block."""
    for r in rows:
        yield r.id, np.frombuffer(r.x, np.uint8).reshape(r.n, d), np.frombuffer(r.y, np.float32), np.frombuffer(r.w, np.float32), np.frombuffer(r.margin)


def summed(parts: DataFrame, size: int, tasks: int) -> np.ndarray:
    """Sum of ``parts(v binary)``, packed arrays of ``size`` doubles, met FAN_IN at a time; the driver gets FAN_IN rows at most."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for v in batch.column(0):
                total += np.frombuffer(v.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        parts = parts.repartition(tasks).mapInArrow(add, "v binary")
    rows = parts.collect()
    return np.sum([np.frombuffer(r["v"]) for r in rows], axis=0) if rows else np.zeros(size)


def _histograms(blocks: RDD, d: int, trees: list[Tree], open_: list[int], number: int, share: float, seed: int) -> np.ndarray:
    """(leaf, feature, bin, [gradient, hessian, rows]) of the open leaves of the last tree.

    On the RDD of the blocks: a hundred passes with one plan, which a DataFrame would make anew for each.
    """
    shape = (len(open_), d, BINS, 3)
    place = np.full(len(trees[-1].feature), -1)
    place[open_] = np.arange(len(open_))

    def add(rows: Iterable[Row]) -> Iterator[np.ndarray]:
        total = np.zeros(shape)
        for ident, x, y, w, margin in _unpacked(rows, d):
            if share < 1:
                drawn = np.random.default_rng([seed, number, ident, len(y)]).random(len(y)) < share
                x, y, w, margin = x[drawn], y[drawn], w[drawn], margin[drawn]
            for t in trees[:-1]:
                margin = margin + np.array(t.value)[t.leaf_of(x)]
            leaf = place[trees[-1].leaf_of(x)]
            here = np.flatnonzero(leaf >= 0)
            leaf, p = leaf[here], _sigmoid(margin[here])
            g, h = w[here] * (p - y[here]), w[here] * p * (1 - p)
            for f in range(d):
                at = leaf * BINS + x[here, f]
                for k, weights in enumerate((g, h, None)):
                    total[:, f, :, k] += np.bincount(at, weights, len(open_) * BINS).reshape(len(open_), BINS)
        yield total

    parts, tasks = blocks.mapPartitions(add), blocks.getNumPartitions()
    if tasks <= FAN_IN:
        return np.sum(parts.collect(), axis=0)
    return parts.treeReduce(np.add, max(2, math.ceil(math.log(tasks, FAN_IN))))


def _advanced(blocks: DataFrame, d: int, trees: list[Tree]) -> DataFrame:
    """The blocks with the trees added to their margins, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ident, x, y, w, margin in _unpacked((Row(**r) for r in batch.to_pylist()), d):
                for t in trees:
                    margin = margin + np.array(t.value)[t.leaf_of(x)]
                yield _packed([ident], [(x, y, w, margin)])

    return _written(blocks.mapInArrow(run, _BLOCK))


def _few(blocks: DataFrame, most: int) -> RDD:
    """The blocks in at most ``most`` tasks, so that a pass over few rows does not cost many."""
    return blocks.rdd.coalesce(most)


def _written(blocks: DataFrame) -> DataFrame:
    spark = blocks.sparkSession
    path = scratch_path(spark, "tree-blocks")
    blocks.write.parquet(path)
    return spark.read.schema(_BLOCK).parquet(path)


# -- splits -----------------------------------------------------------------------------
def best_split(hist: np.ndarray, n_numeric: int, l2: float, least_rows: int) -> tuple[float, int, np.ndarray] | None:
    """``(gain, feature, bins that go left)`` of one leaf's histogram (feature, bin, [g, h, rows]), None if no split gains anything.

    Ties go to the first feature, then to the first cut, then to missing values on the left.
    """
    best = None
    whole = hist[0].sum(0) if len(hist) else np.zeros(3)
    score = lambda g, h: g * g / (h + l2)
    for f in range(len(hist)):
        rows = hist[f]
        used = np.flatnonzero(rows[:, 2] > 0)
        if f < n_numeric:
            order = used[used > 0]
            sides = (True, False) if rows[0, 2] > 0 else (False,)
        else:
            order = used[np.argsort(rows[used, 0] / (rows[used, 1] + l2), kind="stable")]
            sides = (False,)
        for missing_left in sides:
            run = np.cumsum(rows[order], axis=0) + (rows[0] if missing_left else 0)
            rest = whole - run
            fits = (run[:, 2] >= least_rows) & (rest[:, 2] >= least_rows)
            if not fits.any():
                continue
            gain = np.where(fits, score(run[:, 0], run[:, 1]) + score(rest[:, 0], rest[:, 1]) - score(whole[0], whole[1]), -np.inf)
            k = int(gain.argmax())
            if gain[k] > 1e-9 and (best is None or gain[k] > best[0] * (1 + 1e-12)):
                mask = np.zeros(BINS, bool)
                mask[order[: k + 1]] = True
                if f < n_numeric:
                    mask[1 : order[k] + 1] = True  # bins without rows here
                    mask[0] = missing_left
                elif rows[0, 2] == 0:
                    mask[0] = run[k, 2] > rest[k, 2]  # none missing here: with the larger side
                best = float(gain[k]), f, mask
    return best


def _grow(histograms: Callable, d: int, n_numeric: int, p: dict, trees: list[Tree]) -> None:
    """Append a grown tree to ``trees``: all leaves that fit the budget are opened in one pass, best gain first."""
    tree = Tree()
    trees.append(tree)
    depth, open_, leaves = {0: 0}, [0], 1
    step = lambda s: -p["learning_rate"] * s[0] / (s[1] + p["l2"])
    while open_:
        hist = histograms(trees, open_)
        if open_ == [0] and d:
            whole = hist[0, 0].sum(0)
            tree.value[0], tree.rows[0] = float(step(whole)) if whole[2] else 0.0, int(whole[2])
        found = [(s, k, j) for j, k in enumerate(open_) if (s := best_split(hist[j], n_numeric, p["l2"], p["least_rows"])) is not None]
        found.sort(key=lambda x: -x[0][0])
        after = []
        for (_, f, mask), k, j in found[: max(p["max_leaves"] - leaves, 0)]:
            left = hist[j, f][mask].sum(0)
            right = hist[j, f].sum(0) - left
            children = tree.split(k, f, mask, (float(step(left)), float(step(right))), (int(left[2]), int(right[2])))
            leaves += 1
            for c in children:
                depth[c] = depth[k] + 1
                if depth[c] < p["max_depth"]:
                    after.append(c)
        open_ = after if leaves < p["max_leaves"] else []


def fit_trees(df: DataFrame, numeric: list[str], categorical: list[str], label: str, params: dict | None = None, *, balance: bool = False) -> TreeModel:
    """Boosted trees of the log loss on all rows of ``df`` whose label is 0 or 1.

    ``balance`` weighs positives by negatives over positives. NULL and NaN are missing; levels beyond the
    ``BINS - 2`` commonest count as missing, as do levels that the fit has not seen. One class only or no rows: the
    prevalence, no trees. The result depends on rows and parameters, not on their order or partitioning, as long as all
    rows are used (``subsample`` draws inside the blocks).
    """
    p = tree_params(dict(params or {}))
    binning = fit_bins(df, numeric, categorical)
    d = len(binning.names)
    rows = df.select(*binning.columns(), q(label).cast("double").alias("_y")).where("_y IN (0, 1)")
    n, pos = rows.agg(F.count(F.lit(1)), F.sum("_y")).first()
    pos = float(pos or 0)
    weight = (n - pos) / pos if balance and pos else 1.0
    weighed = pos * weight
    share = weighed / (weighed + n - pos) if n else 0.5
    share = min(max(share, 1e-6), 1 - 1e-6)
    model = TreeModel(binning, math.log(share / (1 - share)))
    if not d or pos in (0, n):
        return model
    most = -(-n // TASK_ROWS)
    blocks = rows.mapInArrow(lambda batches: _blocks(batches, binning, model.base, weight), _BLOCK)
    # Dealt evenly: else a pass has as many tasks as the table has files, however many rows these hold.
    blocks = _written(blocks.repartition(most) if most > 1 else blocks)
    passes = _few(blocks, most)
    since: list[Tree] = []
    for number in range(p["rounds"]):
        _grow(lambda trees, open_: _histograms(passes, d, trees, open_, number, p["subsample"], p["seed"]), d, len(binning.numeric), p, since)
        model.trees.append(since[-1])
        if len(since) >= REWRITE and number + 1 < p["rounds"]:
            blocks = _advanced(blocks, d, since)
            passes = _few(blocks, most)
            since = []
    return model
