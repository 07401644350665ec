"""Trees that grow level by level, against plain recursions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from lathework.operators import growers, trees
from lathework.operators.encode import assemble
from lathework.operators.growers import RandomSplits, node_draws
from lathework.operators.trees import BaggedTrees, poisson_weight


def recursion(x, y, tree, tries, min_split, min_leaf, depth, seed, name=1):
    """An extremely randomised tree as nested tuples."""
    if depth == 0 or len(y) < min_split or y.min() == y.max():
        return y.mean()
    order, u = node_draws(seed, tree, name, x.shape[1])
    best = None
    for f in [f for f in order if x[:, f].min() < x[:, f].max()][:tries]:
        low, high = x[:, f].min(), x[:, f].max()
        cut = low + u[f] * (high - low)
        left = x[:, f] <= cut
        if min(left.sum(), (~left).sum()) < min_leaf:
            continue
        gain = y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum()
        if best is None or gain > best[0]:
            best = gain, f, cut, left
    if best is None:
        return y.mean()
    _, f, cut, left = best
    sides = [recursion(x[s], y[s], tree, tries, min_split, min_leaf, depth - 1, seed, 2 * name + k) for k, s in enumerate((left, ~left))]
    return f, cut, *sides


def predicted(node, row):
    while isinstance(node, tuple):
        f, cut, left, right = node
        node = left if row[f] <= cut else right
    return node


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 4, 400), np.full(400, 2.0), rng.normal(size=400) ** 3])
    y = 3 * x[:, 0] + x[:, 1] ** 2 + (x[:, 3] > 0) * 5 + rng.normal(size=400) * 0.1
    return pd.DataFrame({"id": np.arange(400), "a": x[:, 0], "b": x[:, 1], "flat": x[:, 2], "c": x[:, 3], "label": y})


@pytest.fixture(scope="module")
def data(spark, frame):
    return assemble(spark.createDataFrame(frame).repartition(5), ["a", "b", "flat", "c"], keep=["id", "label"]).cache()


@pytest.mark.parametrize("tries, min_split, min_leaf, groups", [(1.0, 2, 1, 0), (0.5, 20, 1, 2), (0.75, 2, 15, 3)])
def test_trees_are_those_of_a_recursion(data, frame, tries, min_split, min_leaf, groups):
    stage = trees.ExtraTrees(n_estimators=3, max_features=tries, min_samples_split=min_split, min_samples_leaf=min_leaf, max_depth=3,
                             seed=4, groups=groups)
    got = {r["id"]: r["prediction"] for r in stage.fit(data).transform(data).collect()}
    x, y = frame[["a", "b", "flat", "c"]].to_numpy(), frame["label"].to_numpy()
    grown = [recursion(x, y, t, int(tries * 4), min_split, min_leaf, 3, 4) for t in range(3)]
    for i, row in enumerate(x):
        assert got[i] == pytest.approx(np.mean([predicted(tree, row) for tree in grown]), rel=1e-9)


def rows_of(data):
    from pyspark.ml.functions import vector_to_array
    from pyspark.sql import functions as F

    return data.select(vector_to_array("features").alias("x"), F.col("label").alias("y"), F.xxhash64("id").alias("key"))


def test_a_level_takes_two_scans_for_all_trees(data, monkeypatch):
    grower = RandomSplits(20, 2, max_depth=4)
    grower.grow(rows_of(data), 4)
    assert grower.scans <= 8
    monkeypatch.setattr(growers, "CELLS", 40)
    small = RandomSplits(3, 2, max_depth=3)
    whole = RandomSplits(20, 2, max_depth=3)
    kept = [t.state() for t in small.grow(rows_of(data), 4)]
    monkeypatch.undo()
    assert small.scans > 6 and kept == [t.state() for t in whole.grow(rows_of(data), 4)[:3]]


def test_bootstrap_weights(data):
    keys = np.random.default_rng(1).integers(-2 ** 62, 2 ** 62, 200_000)
    weights = growers.bag(keys, 3, 7)
    shares = [np.exp(-1), np.exp(-1), np.exp(-1) / 2, np.exp(-1) / 6]
    np.testing.assert_allclose([(weights == k).mean() for k in range(4)], shares, atol=0.005)
    assert (weights == growers.bag(keys, 3, 7)).all() and (weights != growers.bag(keys, 4, 7)).any()
    one, two = (RandomSplits(2, 4, max_depth=2, bootstrap=True).grow(rows_of(data.repartition(n)), 4) for n in (1, 6))
    assert [t.feature for t in one] == [t.feature for t in two] and one[0].feature != [] and one[0].value != one[1].value
    np.testing.assert_allclose(one[0].value, two[0].value)


def test_labels_without_spread(spark):
    data = assemble(spark.createDataFrame([(i, float(i), 3.5) for i in range(9)], "id long, a double, label double"), ["a"], keep=["id", "label"])
    assert {r["prediction"] for r in trees.ExtraTrees(n_estimators=2).fit(data).transform(data).collect()} == {3.5}
    with pytest.raises(ValueError, match="no rows"):
        trees.ExtraTrees(n_estimators=2).fit(data.limit(0))


def bag_rows(spark, n=1500):
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n), np.abs(rng.normal(size=n)).round(2), rng.integers(0, 2, n)])
    y = 1e4 + 3 * x[:, 0] + x[:, 1] ** 2 - 4 * (x[:, 2] > 0.7) * x[:, 3] + rng.normal(size=n)
    rows = [(int(i), DenseVector(v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", "features", "label"]).repartition(3)


@pytest.mark.parametrize("depth, least, bins", [(1, 1, 64), (4, 1, 16), (5, 20, 32)])
def test_bagged_trees_are_the_built_in_ones(spark, depth, least, bins):
    data = bag_rows(spark).cache()
    model = BaggedTrees(n_estimators=2, max_depth=depth, min_rows=least, maxBins=bins, keyCol="id").fit(data)
    for t, tree in enumerate(model.stages[:-2]):
        weighed = data.withColumn("w", poisson_weight(F.col("id"), t)).filter("w > 0")
        built_in = DecisionTreeRegressor(maxDepth=depth, minInstancesPerNode=least, maxBins=bins, weightCol="w").fit(weighed)
        both = built_in.transform(tree.transform(data))
        assert both.filter(F.abs(F.col("prediction") - F.col(tree.getPredictionCol())) > 1e-6).count() == 0


def test_bagged_trees_share_their_scans(spark):
    data, jobs = bag_rows(spark, 300).cache(), {}
    data.count()
    for trees in (2, 7):
        spark.sparkContext.setJobGroup(f"bag-{trees}", "")
        BaggedTrees(n_estimators=trees, max_depth=2, keyCol="id").fit(data)
        jobs[trees] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"bag-{trees}"))
    spark.sparkContext.setJobGroup("other", "")
    assert jobs[7] <= jobs[2] + 2


def test_out_of_bag_by_hand(spark):
    data = bag_rows(spark, 400).withColumn("id", F.expr("nullif(id, 7)")).cache()
    stage = BaggedTrees(n_estimators=3, max_depth=3, max_features=0.5, keyCol="id")
    model = stage.fit(data)
    trees = model.stages[:-2]
    rows = stage.oob_predictions(model, data)
    for i, tree in enumerate(trees):
        rows = tree.transform(rows).withColumn(f"w{i}", poisson_weight(F.col("id"), i))
    seen = rows.collect()
    for r in seen:
        own = [r[tree.getPredictionCol()] for i, tree in enumerate(trees) if r[f"w{i}"] == 0]
        assert r["oob_prediction"] == (pytest.approx(np.mean(own)) if own else None)
    assert {r["oob_prediction"] is None for r in seen} == {True, False} and [r["w0"] for r in seen if r["id"] is None] == [0.0]


def test_bagged_trees_refuse_missing_labels(spark):
    with pytest.raises(Exception, match="label"):
        BaggedTrees(n_estimators=2, keyCol="id").fit(bag_rows(spark, 50).withColumn("label", F.expr("nullif(label, label)")))
