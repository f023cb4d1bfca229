"""Isotonic regression and its application as distributed jobs, for any number of distinct scores.

The fit is the lower convex hull of the cumulative diagram (rows so far, positives so far) over the ascending scores: the
value of a score is the slope of the hull there. Hulls of neighbouring ranges can be cut and joined, so no task ever holds all blocks:

1. *Ranges.* The distinct scores are range-partitioned; each task pools its own violators, which leaves the vertices of its
   range's hull. Totals of the ranges (a row each) turn their local sums into global ones.
2. *Anchors.* For a fixed number of slopes, quantiles of the slopes found, the vertex that lies lowest under each slope is a vertex of
   the whole hull. One aggregate finds these anchors.
3. *Windows.* Between two neighbouring anchors the whole hull depends on the vertices between them only, and only on those whose
   own range could touch a slope between the anchors'. So the anchors cut the rest into windows, pooled each in one task.

The result is a table of knots, two for each block. ``interpolate`` maps scores through it (linear between
knots, constant outside): by a broadcast array while the knots are few, else by one range shuffle of knots and distinct scores in which each
partition only needs the nearest knot on either side of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.prefix import BUCKET, cut, ranged

#: Slopes whose anchors cut the diagram into windows; what is collected and broadcast is as long.
SLOPES = 256
#: Knots up to which they are broadcast as an array (16 bytes each).
BROADCAST_KNOTS = 100_000

_VERTEX = "part int, n double, pos double, score double, next_score double, slope_left double, slope_right double"
_KNOT = "score double, value double"


def hull(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Indexes of the lower hull of points with ascending x, end points included, points on an edge left out."""
    keep = np.arange(len(x))
    while len(keep) > 2:
        # A point on or above the chord of its neighbours is no vertex, whatever else goes in the same round.
        dx, dy = np.diff(x[keep]), np.diff(y[keep])
        stays = np.ones(len(keep), bool)
        stays[1:-1] = dy[:-1] * dx[1:] < dy[1:] * dx[:-1]
        if stays.all():
            return keep
        done = 64 * (len(keep) - stays.sum()) < len(keep)
        keep = keep[stays]
        if done:  # few go: the rest one by one
            break
    out: list[int] = []
    xs, ys = x[keep].tolist(), y[keep].tolist()
    for k in range(len(keep)):
        while len(out) > 1 and (ys[out[-1]] - ys[out[-2]]) * (xs[k] - xs[out[-1]]) >= (ys[k] - ys[out[-1]]) * (xs[out[-1]] - xs[out[-2]]):
            out.pop()
        out.append(k)
    return keep[out]


def _batch(columns: dict, target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type, from_pandas=True) for f in target], schema=target)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _range_hull(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vertices of one range in its own sums; the first is its beginning, before its first score."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    score, n, pos = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in rows]) for c in ("score", "n", "pos"))
    x, y = (np.concatenate([[0.0], np.cumsum(v)]) for v in (n, pos))
    at = hull(x, y)
    slope = np.diff(y[at]) / np.diff(x[at])
    before, after = np.append(np.nan, score), np.append(score, np.nan)
    columns = {"part": np.full(len(at), TaskContext.get().partitionId()), "n": x[at], "pos": y[at], "score": before[at], "next_score": after[at]}
    columns |= {"slope_left": np.append(-np.inf, slope), "slope_right": np.append(slope, np.inf)}
    yield _batch(columns, _schema(_VERTEX))


def _vertices(counts: DataFrame, parts: int) -> DataFrame:
    """Vertices of all ranges' hulls in global sums."""
    dealt = counts.select("score", F.col("n").cast("double").alias("n"), F.col("pos").cast("double").alias("pos")).repartitionByRange(parts, "score").sortWithinPartitions("score")
    local = cut(dealt.mapInArrow(_range_hull, _VERTEX))
    totals = local.groupBy("part").agg(F.max("n").alias("all_n"), F.max_by("pos", "n").alias("all_pos"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    offsets = totals.select("part", *(F.coalesce(F.sum(f"all_{c}").over(before), F.lit(0.0)).alias(f"from_{c}") for c in ("n", "pos")))
    placed = local.join(offsets, "part")
    return placed.withColumns({c: F.col(c) + F.col(f"from_{c}") for c in ("n", "pos")}).drop("part", "from_n", "from_pos")


def _lowest(batches: Iterator[pa.RecordBatch], slopes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The lowest vertex under each slope, of those that are the lowest of their range there."""
    height, place = np.full(len(slopes), np.inf), np.zeros(len(slopes))
    for batch in batches:
        n, pos, left, right = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "pos", "slope_left", "slope_right"))
        first, last = np.searchsorted(slopes, left, "left"), np.searchsorted(slopes, right, "right")
        row = np.repeat(np.arange(len(n)), last - first)
        slope = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
        low = pos[row] - slopes[slope] * n[row]
        order = np.lexsort((n[row], low, slope))
        slope, low, row = slope[order], low[order], row[order]
        new = np.append(True, slope[1:] != slope[:-1]) if len(slope) else np.zeros(0, bool)
        slope, low, at = slope[new], low[new], n[row[new]]
        better = low < height[slope]
        height[slope[better]], place[slope[better]] = low[better], at[better]
    some = np.isfinite(height)
    yield _batch({"slope": slopes[some], "height": height[some], "n": place[some]}, _schema("slope double, height double, n double"))


def _anchors(vertices: DataFrame, slopes: int) -> list[tuple[float, float, float]]:
    """``(n, least slope, largest slope)`` of vertices of the whole hull, ascending; at most ``slopes`` of them."""
    finite = vertices.filter(F.col("slope_right") < float("inf"))
    grid = finite.agg(F.percentile_approx("slope_right", [k / (slopes + 1) for k in range(1, slopes + 1)], 10 * slopes)).first()[0]
    wanted = np.array(sorted(set(grid or [])))
    # Each task passes on the lowest vertex under each slope.
    touched = vertices.mapInArrow(lambda batches: _lowest(batches, wanted), "slope double, height double, n double")
    lowest = touched.groupBy("slope").agg(F.min(F.struct("height", "n")).alias("low"))
    found = lowest.groupBy(F.col("low.n").alias("n")).agg(F.min("slope").alias("least"), F.max("slope").alias("most"))
    return sorted((r["n"], r["least"], r["most"]) for r in found.collect())


def _windows(batches: Iterator[pa.RecordBatch], anchors: list[tuple[float, float, float]]) -> Iterator[pa.RecordBatch]:
    """Each vertex under the windows that it may be a vertex of; an anchor under both of its sides."""
    at = np.array([a[0] for a in anchors])
    least = np.append([a[1] for a in anchors], np.inf)  # slope at the right end of window k
    most = np.insert([a[2] for a in anchors], 0, -np.inf)  # and at its left end
    target = _schema("window int, n double, pos double, score double, next_score double")
    for batch in batches:
        n, left, right = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("n", "slope_left", "slope_right"))
        first, last = np.searchsorted(at, n, "left"), np.searchsorted(at, n, "right")
        row = np.repeat(np.arange(len(n)), last - first + 1)
        window = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1)
        slack = 1e-12 * (1 + np.abs(least[window]).clip(max=1e300))
        keep = (last > first)[row] | (right[row] >= most[window] - slack) & (left[row] <= least[window] + slack)
        some = batch.select(["n", "pos", "score", "next_score"]).take(pa.array(row[keep]))
        yield pa.RecordBatch.from_arrays([pa.array(window[keep], pa.int32()), *some.columns], schema=target)


def _knots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (window, n): the knots of each window's blocks."""
    target = _schema(_KNOT)

    def out(rows: list[pd.DataFrame]) -> pa.RecordBatch:
        # A range's end and the beginning of the next are one point: each knows the score on its side.
        points = pd.concat(rows).groupby("n", sort=True).agg({"pos": "first", "score": "max", "next_score": "max"})
        x, y = points.index.to_numpy(), points["pos"].to_numpy()
        at = hull(x, y)
        value = np.diff(y[at]) / np.diff(x[at])
        low, high = points["next_score"].to_numpy()[at[:-1]], points["score"].to_numpy()[at[1:]]
        two = high > low
        return _batch({"score": np.concatenate([low, high[two]]), "value": np.concatenate([value, value[two]])}, target)

    held: list[pd.DataFrame] = []
    for batch in batches:
        for window, rows in batch.to_pandas().groupby("window", sort=True):
            if held and held[0]["window"].iloc[0] != window:
                yield out(held)
                held = []
            held.append(rows)
    if held:
        yield out(held)


def fit_knots(counts: DataFrame, slopes: int = SLOPES) -> DataFrame:
    """``(score, value)``: knots of the isotonic fit of ``counts(score, n, pos)``, one row per distinct score, n above 0.

    A block of one value gives its least and largest score. No rows: no knots. The table is checkpointed.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    vertices = cut(_vertices(counts.filter("n > 0"), parts))
    anchors = _anchors(vertices, min(slopes, parts * 8))
    dealt = vertices.mapInArrow(lambda batches: _windows(batches, anchors), "window int, n double, pos double, score double, next_score double")
    met = dealt.repartition(parts, "window").sortWithinPartitions("window", "n")
    return cut(met.mapInArrow(_knots, _KNOT))


def _mapped(batches: Iterator[pa.RecordBatch], outer: dict[int, list[tuple[float, float]]]) -> Iterator[pa.RecordBatch]:
    """Buckets of knots (with a value) and scores (without), sorted: the scores with their values."""
    target = _schema(_KNOT)
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    bucket, score, value = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in rows]) for c in (BUCKET, "score", "value"))
    for k in np.unique(bucket):
        mine = bucket == k
        knot = mine & ~np.isnan(value)
        xs, ys = score[knot], value[knot]
        for x, y in outer.get(int(k), []):
            xs, ys = np.append(xs, x), np.append(ys, y)
        order = np.argsort(xs, kind="stable")
        asked = score[mine & np.isnan(value)]
        if len(asked) and len(xs):
            yield _batch({"score": asked, "value": np.interp(asked, xs[order], ys[order])}, target)


def score_values(scores: DataFrame, knots: DataFrame) -> DataFrame:
    """``(score, value)`` of the distinct non-null ``scores(score)``, at any number of knots."""
    asked = scores.select("score").filter("score IS NOT NULL").distinct().withColumn("value", F.lit(None).cast("double"))
    both = knots.select("score", "value").unionByName(asked)
    placed = ranged(both.withColumn("kind", F.col("value").isNull()), [F.col("score"), F.col("kind")], [])
    here = placed.filter("value IS NOT NULL").groupBy(BUCKET).agg(
        F.min(F.struct("score", "value")).alias("low"), F.max(F.struct("score", "value")).alias("high")
    )
    ends = sorted((r[BUCKET], tuple(r["low"]), tuple(r["high"])) for r in here.collect())  # a row for each bucket at most
    buckets = [r[0] for r in placed.select(BUCKET).distinct().collect()]
    outer = {b: [*[h for k, _, h in ends if k < b][-1:], *[low for k, low, _ in ends if k > b][:1]] for b in buckets}
    return placed.select(BUCKET, "score", "value").mapInArrow(lambda batches: _mapped(batches, outer), _KNOT)


def interpolate(df: DataFrame, p: str, out: str, knots: DataFrame, n_knots: int) -> DataFrame:
    """``df`` with ``out``: column ``p`` mapped through the knots; null and NaN give null, no knots null."""
    name = lambda c: F.col(f"`{c}`")
    if n_knots <= BROADCAST_KNOTS:
        rows = knots.select("score", "value").toPandas().sort_values("score")  # at most BROADCAST_KNOTS rows
        xs, ys = rows["score"].to_numpy(), rows["value"].to_numpy()

        @F.pandas_udf("double")
        def mapped(s: pd.Series) -> pd.Series:
            values = np.interp(s.to_numpy(dtype=float), xs, ys) if len(xs) else np.full(len(s), np.nan)
            return pd.Series(values).where(s.notna().to_numpy()).where(lambda v: v.notna(), None)

        value = mapped(name(p).cast("double"))
        return df.withColumn(out, F.nanvl(value, F.lit(None).cast("double")))
    score = F.nanvl(name(p).cast("double"), F.lit(None).cast("double"))
    found = score_values(df.select(score.alias("score")), knots).select(F.col("score").alias("_rl_score"), F.col("value").alias("_rl_value"))
    joined = df.join(found, score == F.col("_rl_score"), "left")
    return joined.select(*[name(c) for c in df.columns if c != out], F.col("_rl_value").alias(out))
