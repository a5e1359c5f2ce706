"""The forest whose nodes stay in Spark: against a plain recursion, against Spark's own, and the same whatever its tasks."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lakeaudit.operators import forest, model

COMMON = {"labelCol": "y", "featuresCol": "features", "weightCol": "w"}


def frame(spark, x, y, w=None):
    rows = [(i, [float(v) for v in x[i]], int(y[i]), float(1 if w is None else w[i])) for i in range(len(y))]
    df = spark.createDataFrame(rows, "id long, x array<double>, y int, w double")
    return df.withColumn("features", array_to_vector("x")).drop("x")


def scores(fitted, df):
    out = fitted.transform(df).select("id", vector_to_array("probability")[1].alias("p"), "prediction").collect()
    return {r["id"]: (r["p"], r["prediction"]) for r in out}


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(600, 7)), 1)
    x[:, 5], x[:, 6] = rng.integers(0, 2, 600), 3.0  # two values, one value
    y = (x[:, 0] * x[:, 1] + rng.normal(size=600) > 0).astype(int)
    return frame(spark, x, y, np.where(y == 1, 1.3, 0.8)).cache()


def plain(bins, y, w, tree, path, depth, k, seed):
    """One node after the other; a leaf is its (weight of 0, weight of 1)."""
    total = np.array([w[y == 0].sum(), w[y == 1].sum()])
    best = (0.0, None, None)
    if depth and total.min() > 0:
        for f in forest.chosen(np.array([tree]), np.array([path]), bins.shape[1], k, seed)[0]:
            for c in range(forest.BINS - 1):
                side = [np.array([w[m & (y == v)].sum() for v in (0, 1)]) for m in (bins[:, f] <= c, bins[:, f] > c)]
                if min(s.sum() for s in side) > 0:
                    gain = sum((s ** 2).sum() / s.sum() for s in side) - (total ** 2).sum() / total.sum()
                    if gain > max(best[0] + 1e-9, 1e-12 * total.sum()):
                        best = (gain, f, c)
    if best[1] is None:
        return total
    go = bins[:, best[1]] > best[2]
    a, b = (plain(bins[m], y[m], w[m], tree, 2 * path + s, depth - 1, k, seed) for s, m in enumerate((~go, go)))
    if not isinstance(a, tuple) and not isinstance(b, tuple) and (a[1] > a[0]) == (b[1] > b[0]):
        return total
    return (best[1], best[2], a, b)


def test_a_subtree_is_that_of_a_plain_recursion():
    rng = np.random.default_rng(1)
    for case in range(6):
        bins = rng.integers(0, 9, (150, 6)).astype(np.uint8)
        y, w = rng.integers(0, 2, 150), rng.integers(1, 4, 150).astype(float)
        if case == 5:
            y[:] = 1
        tree = plain(bins, y, w, case, 1, 30 if case else 2, 3, 42)
        grown = forest.grow(bins, y == 1, w, case, 1, 30 if case else 2, 3, 42)
        at = forest.walk(bins, np.zeros(150, np.int64), grown["feature"], grown["cut"], grown["left"])
        for row, leaf in zip(bins, grown["totals"][at], strict=True):
            node = tree
            while isinstance(node, tuple):
                node = node[3] if row[node[0]] > node[1] else node[2]
            assert leaf.tolist() == node.tolist()


def test_large_nodes_split_by_all_tasks_give_the_same_trees(noisy):
    for node_rows, depth in ((40, 30), (40, 3)):
        whole = forest.RandomForest(numTrees=6, maxDepth=depth, seed=42, **COMMON).fit(noisy)
        cut = forest.RandomForest(numTrees=6, maxDepth=depth, seed=42, node_rows=node_rows, **COMMON).fit(noisy)
        assert len(whole.top.tree) == 6 < len(cut.top.tree)
        assert scores(whole, noisy) == scores(cut, noisy)
        assert np.allclose(whole.featureImportances.toArray(), cut.featureImportances.toArray(), rtol=1e-12)


def test_the_driver_does_not_hold_the_nodes(noisy):
    """At the library's settings; before, all nodes of 200 trees were on the driver."""
    fitted = model.classifiers("y")["random_forest"]
    fitted.weight = "w"
    fitted = fitted.fit(noisy)
    nodes = fitted.subtrees.agg(F.sum("nodes")).first()[0]
    assert nodes > 10_000 and len(fitted.top.tree) == 200
    found = scores(fitted, noisy)
    hits = noisy.select("id", "y").collect()
    assert np.mean([found[r["id"]][1] == r["y"] for r in hits]) > 0.98  # pure leaves: rows it was trained on
    weights = fitted.featureImportances.toArray()
    assert abs(weights.sum() - 1) < 1e-9 and weights[6] == 0 and set(np.argsort(-weights)[:2]) == {0, 1}


def test_close_to_sparks_own_forest(noisy):
    """As close as two of Spark's forests are to each other."""
    def alike(a, b):
        return np.corrcoef([a[i][0] for i in a], [b[i][0] for i in a])[0, 1]

    own = scores(forest.RandomForest(numTrees=60, maxDepth=6, seed=1, **COMMON).fit(noisy), noisy)
    first, second = (scores(RandomForestClassifier(numTrees=60, maxDepth=6, seed=s, **COMMON).fit(noisy), noisy) for s in (1, 2))
    assert alike(own, first) > 0.85 and alike(own, first) > alike(first, second) - 0.04


def test_few_rows_one_class_and_wrong_labels(spark):
    few = forest.RandomForest(numTrees=40, maxDepth=30, seed=3, **COMMON).fit(frame(spark, [[0.0], [1.0]], [0, 1]))
    found = scores(few, frame(spark, [[0.0], [1.0], [float("nan")]], [0, 1, 1]))
    assert found[0][1] == 0 and found[1][1] == 1 and found[2] == found[1]
    same = forest.RandomForest(numTrees=4, maxDepth=30, seed=3, **COMMON).fit(frame(spark, [[0.0], [1.0]] * 10, [1] * 20))
    assert set(scores(same, frame(spark, [[0.5]], [1])).values()) == {(1.0, 1.0)}
    assert same.featureImportances.toArray().tolist() == [0.0]
    assert scores(same, frame(spark, [[0.5]], [1]).limit(0)) == {}
    with pytest.raises(ValueError, match="rows to train on"):
        forest.RandomForest(numTrees=4, maxDepth=30, seed=3, **COMMON).fit(frame(spark, [[0.0]], [1]).limit(0))
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        forest.RandomForest(numTrees=4, maxDepth=30, seed=3, **COMMON).fit(frame(spark, [[0.0], [1.0]], [1, 2]))


def test_nodes_split_alike_however_they_are_counted():
    """Small nodes from sorted rows, large ones one by one, others by one histogram."""
    rng = np.random.default_rng(2)
    for rows, m in ((400, 60), (3000, 5), (60, 1)):
        bins, y = rng.integers(0, 32, (rows, 9)).astype(np.uint8), rng.integers(0, 2, rows)
        bins[:, 3], bins[:, 4] = 7, y
        w, at = rng.integers(1, 5, rows) * 0.75, np.sort(np.r_[np.arange(m), rng.integers(0, m, rows - m)])
        slots, cells = forest.chosen(np.arange(m), np.ones(m), 9, 4, 1), forest._cells(bins, y == 1)
        totals = np.stack([np.bincount(at, w * (y == c), m) for c in (0, 1)], 1)
        hist = forest._histogram(cells, at, w, slots, counted=True)
        assert (hist[:, :, :2].sum(3) == totals[:, None]).all()
        assert (hist[:, :, 2].sum(2) == np.bincount(at)[:, None]).all()
        assert (hist[:, :, :2] == forest._counted_apart(cells, w, slots, np.cumsum(np.bincount(at)))).all()
        slot, cut, gain = forest.best_split(hist[:, :, :2])
        other = forest._sorted_split(cells, at, w, totals, slots)
        assert (other[2] == gain).all() and (gain > 0).any()
        assert (np.stack(other[:2])[:, gain > 0] == np.stack([slot, cut])[:, gain > 0]).all()


def test_a_row_to_score_moves_once_and_not_once_per_tree(noisy, monkeypatch):
    """Before, each row went to the subtrees of every tree and the votes of all of them were added up by a shuffle."""
    fitted = forest.RandomForest(numTrees=6, maxDepth=30, seed=42, node_rows=100, **COMMON).fit(noisy)
    scored = fitted.transform(noisy)
    assert "Aggregate" not in scored._jdf.queryExecution().executedPlan().toString()
    few = scores(fitted, noisy)
    monkeypatch.setattr(forest, "GROUP_BYTES", 600)
    assert scores(fitted, noisy) == few and len(few) == 600
