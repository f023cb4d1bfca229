import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import trees as T


def grown(x, y, w, n_numeric, p):
    """The same boosting on one array, one leaf at a time: margins and, per tree, the sorted leaf sizes."""
    share = (w * y).sum() / w.sum()
    margin = np.full(len(y), np.log(share / (1 - share)))
    sizes = []
    for _ in range(p["rounds"]):
        prob = 1 / (1 + np.exp(-margin))
        g, h = w * (prob - y), w * prob * (1 - prob)
        done, level, n_leaves = [], [np.arange(len(y))], 1
        for depth in range(p["max_depth"] + 1):
            found = []
            for rows in level:
                hist = np.zeros((x.shape[1], T.BINS, 3))
                for f in range(x.shape[1]):
                    for k, v in enumerate((g[rows], h[rows], np.ones(len(rows)))):
                        hist[f, :, k] = np.bincount(x[rows, f], v, T.BINS)
                s = T.best_split(hist, n_numeric, p["l2"], p["least_rows"]) if depth < p["max_depth"] else None
                found.append((s, rows))
            done += [rows for s, rows in found if s is None]
            found = sorted((x_ for x_ in found if x_[0] is not None), key=lambda x_: -x_[0][0])
            room = max(p["max_leaves"] - n_leaves, 0)
            done += [rows for _, rows in found[room:]]
            level = []
            for (_, f, mask), rows in found[:room]:
                left = mask[x[rows, f]]
                level += [rows[left], rows[~left]]
                n_leaves += 1
        done += level
        sizes.append(sorted(len(r) for r in done))
        for rows in done:
            margin[rows] -= p["learning_rate"] * g[rows].sum() / (h[rows].sum() + p["l2"])
    return margin, sizes


def frame(spark, n=5_000, seed=3):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n).round(2), rng.integers(0, 12, n).astype(float)
    c = rng.choice(list("uvwxyz"), n)
    z = 1.5 * a + (b == 7) * 2 + np.isin(c, ["v", "y"]) * 1.5 - 1
    gone = rng.random(n) < 0.15
    z = np.where(gone, 2.0, z)  # a missing number says something
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    rows = [(i, None if gone[i] else float(a[i]), float(b[i]), None if i % 41 == 0 else str(c[i]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c string, y int").repartition(5)


def leaves(tree):
    return sorted(n for f, n in zip(tree.feature, tree.rows) if f < 0)


@pytest.mark.parametrize("params, balance", [({"maxIter": 4, "maxDepth": 4}, False), ({"n_estimators": 3, "num_leaves": 6, "max_depth": 8, "min_child_samples": 40}, True)])
def test_equal_to_boosting_on_one_array(spark, params, balance):
    df = frame(spark)
    model = T.fit_trees(df, ["a", "b"], ["c"], "y", params, balance=balance)
    rows = df.orderBy("id").toPandas()
    import pyarrow as pa

    x = model.binning.bytes([pa.array(rows["a"], pa.float64(), from_pandas=True), pa.array(rows["b"], pa.float64(), from_pandas=True), pa.array(rows["c"], pa.string(), from_pandas=True)])
    y = rows["y"].to_numpy(float)
    w = np.where(y == 1, (len(y) - y.sum()) / y.sum() if balance else 1.0, 1.0).astype(np.float32)
    margin, sizes = grown(x, y, w, 2, T.tree_params(params))
    assert [leaves(t) for t in model.trees] == sizes
    got = {r.id: r.p for r in model.score(df, "p").select("id", "p").collect()}
    assert np.allclose([got[i] for i in range(len(y))], 1 / (1 + np.exp(-margin)), atol=1e-6)
    again = T.TreeModel.from_dict(model.to_dict())
    assert {r.id: r.p for r in again.score(df, "p").select("id", "p").collect()} == got


def test_missing_values_take_the_better_side(spark):
    rows = [(float(k % 10), int(k % 10 >= 7)) for k in range(400)] + [(None, 1)] * 100
    for flip in (False, True):
        df = spark.createDataFrame([(a, 1 - y if flip else y) for a, y in rows], "a double, y int")
        model = T.fit_trees(df, ["a"], [], "y", {"maxIter": 1, "maxDepth": 1})
        tree = model.trees[0]
        mask = np.frombuffer(tree.goes_left[0], np.uint8)
        assert leaves(tree) == [220, 280] and mask[0] == 0  # with the sevens and above, whichever their label


def test_categories_are_split_by_gradient(spark):
    rows = [(c, int(c in "bdf")) for c in "abcdefg" for _ in range(30)] + [(None, 1)] * 30
    model = T.fit_trees(spark.createDataFrame(rows, "c string, y int"), [], ["c"], "y", {"maxIter": 30, "maxDepth": 1, "stepSize": 0.5})
    assert leaves(model.trees[0]) == [120, 120]
    p = {r.c: r.p for r in model.score(spark.createDataFrame([("b",), ("c",), (None,), ("new",)], "c string"), "p").collect()}
    assert p["b"] > 0.9 > 0.1 > p["c"] and p[None] > 0.9 and p["new"] == p[None]


def test_margins_written_on_the_way(spark, monkeypatch):
    df = frame(spark, 600)
    want = T.fit_trees(df, ["a", "b"], ["c"], "y", {"maxIter": 5, "maxDepth": 2}).to_dict()
    monkeypatch.setattr(T, "REWRITE", 2)
    monkeypatch.setattr(T, "FAN_IN", 2)
    got = T.fit_trees(df, ["a", "b"], ["c"], "y", {"maxIter": 5, "maxDepth": 2}).to_dict()
    assert [t["rows"] for t in got["trees"]] == [t["rows"] for t in want["trees"]]
    assert np.allclose(np.concatenate([t["value"] for t in got["trees"]]), np.concatenate([t["value"] for t in want["trees"]]))


def test_one_class_no_rows_many_levels(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, None)], "a double, y int")
    assert T.fit_trees(df, ["a"], [], "y").trees == [] and T.fit_trees(df, ["a"], [], "y").base > 10
    empty = T.fit_trees(df.limit(0), ["a"], [], "y")
    assert empty.score(df, "p").first().p == pytest.approx(0.5)
    many = spark.range(3_000).select(F.concat(F.lit("l"), F.col("id") % 1_000).alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    model = T.fit_trees(many, [], ["c"], "y", {"maxIter": 2})
    assert len(model.binning.levels[0]) == T.BINS - 2 and model.score(many, "p").where("p IS NULL").count() == 0
    with pytest.warns(UserWarning, match="num_threads"):
        T.tree_params({"num_threads": 4})


def test_passes_share_out_rows_and_trees(spark, monkeypatch):
    """A pass adds up few earlier trees; the trees are those of one task."""
    rng = np.random.default_rng(8)
    rows = [(float(a), f"s{k}", int(rng.random() < (0.7 if a > 0 and k < 3 else 0.2))) for a, k in zip(rng.normal(size=2000), rng.integers(0, 6, 2000), strict=True)]
    df = spark.createDataFrame(rows, "a double, s string, y int").coalesce(1)
    params = {"rounds": 12, "max_depth": 3}
    one = T.fit_trees(df, ["a"], ["s"], "y", params)
    seen = []
    real = T._histograms
    monkeypatch.setattr(T, "_histograms", lambda blocks, d, trees, *a: seen.append((blocks.getNumPartitions(), len(trees))) or real(blocks, d, trees, *a))
    monkeypatch.setattr(T, "TASK_ROWS", 500)
    monkeypatch.setattr(T, "BLOCK_ROWS", 100)
    many = T.fit_trees(df, ["a"], ["s"], "y", params)
    assert max(k for _, k in seen) <= 5
    assert [(t.feature, t.goes_left, t.rows) for t in many.trees] == [(t.feature, t.goes_left, t.rows) for t in one.trees]
    assert np.allclose([v for t in many.trees for v in t.value], [v for t in one.trees for v in t.value])
