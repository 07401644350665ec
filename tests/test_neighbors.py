"""Nearest neighbours in rounds over two levels of pivots."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector

from lathework.operators import neighbors
from lathework.operators.encode import assemble
from lathework.operators.neighbors import KNNRegressor, distances, reached


def rows_of(spark, n, seed=2, width=2):
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(size=(n - n // 3, width)) * 10, np.tile(rng.normal(size=(1, width)), (n // 3, 1))])
    frame = pd.DataFrame(x, columns=[f"x{i}" for i in range(width)])
    frame["id"], frame["label"] = np.arange(n), rng.normal(size=n)
    return x, assemble(spark.createDataFrame(frame).repartition(4), [f"x{i}" for i in range(width)], keep=["id", "label"])


@pytest.mark.parametrize("visits, p, k, block", [((1, 5), 2, 5, 20_000), ((1, 2, 3), 1, 9, 40), ((), 2, 4, 25)])
def test_rounds_give_the_nearest_rows(spark, monkeypatch, visits, p, k, block):
    monkeypatch.setattr(neighbors, "VISITS", visits)
    monkeypatch.setattr(neighbors, "FEW_CELLS", 1)
    x, data = rows_of(spark, 300)
    model = KNNRegressor(n_neighbors=k, p=p, blockRows=block).fit(data)
    d = distances(x, x, p)
    got = {(r["id"], r["place"]): r["neighbor"] for r in model.neighbors(data).collect()}
    for i in range(len(x)):
        assert [got[i, j + 1] for j in range(k)] == np.lexsort((np.arange(len(x)), d[i]))[:k].tolist()
    if visits:
        assert model.visits[0] == len(x)  # one cell each at first


def test_later_rounds_are_cut_by_what_is_near(spark, monkeypatch):
    monkeypatch.setattr(neighbors, "FEW_CELLS", 1)
    cost = {}
    for n in (200, 2000):
        _, data = rows_of(spark, n, seed=6)
        model = KNNRegressor(n_neighbors=3).fit(data)
        size = {r[0]: r[1] for r in model.get("state")["cells"]}
        model.neighbors(data).count()
        cost[n] = sum(model.visits) * np.mean(list(size.values()))
    assert cost[2000] < 50 * cost[200] and len(model.get("state")["cells"]) > 30 and model.get("state")["tops"] > 5


def test_reached():
    row, upper, count = np.array([0, 0, 0, 1, 1]), np.array([5.0, 1.0, 3.0, 2.0, 4.0]), np.array([10, 1, 2, 1, 1])
    assert reached(row, upper, count, 3, 3).tolist() == [3.0, np.inf, np.inf]
    assert reached(row, upper, count, 2, 1).tolist() == [1.0, 2.0]


def shuffled(spark):
    """Sizes of the shuffle files on this machine."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = [os.path.join(d, f) for top in folders for d, _, names in os.walk(top.getPath()) for f in names if f.startswith("shuffle_")]
    return {f: os.path.getsize(f) for f in files}


@pytest.mark.parametrize("p, weights", [(1, "distance"), (2, "uniform")])
def test_rows_are_not_copied_to_every_cell(spark, p, weights):
    rng = np.random.default_rng(8)
    frame = pd.DataFrame(rng.normal(size=(2500, 24)), columns=[f"x{i}" for i in range(24)])
    frame["id"], frame["label"] = np.arange(len(frame)), rng.normal(size=len(frame))
    data = assemble(spark.createDataFrame(frame).repartition(4), [f"x{i}" for i in range(24)], keep=["id", "label"])
    model = KNNRegressor(n_neighbors=3, p=p, weights=weights).fit(data)
    before = shuffled(spark)
    assert model.transform(data).count() == len(frame)
    assert sum(v for f, v in shuffled(spark).items() if f not in before) < 4 * len(frame) * 24 * 8


def brute(x, keys, others, other_keys, k, p):
    d = distances(x, others, p)
    rank = np.argsort(np.argsort(other_keys))
    return {key: [other_keys[j] for j in np.lexsort((rank, d[i]))[:k]] for i, key in enumerate(keys)}


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("case", ["grid", "offset", "outlier", "wide", "scales"])
def test_odd_points_in_many_parts(spark, monkeypatch, case, p):
    monkeypatch.setattr(neighbors, "PART_BYTES", 3000)
    monkeypatch.setattr(neighbors, "FEW_CELLS", 4)
    rng = np.random.default_rng(11)
    x = {
        "grid": rng.integers(0, 3, (500, 3)).astype(float),  # ties, and many rows at each point
        "offset": 1e7 + rng.normal(size=(500, 4)) * 1e-3,
        "outlier": np.where(rng.random((500, 4)) < 0.01, 1e12, rng.normal(size=(500, 4))),
        "wide": rng.normal(size=(500, 600)),
        "scales": rng.normal(size=(500, 5)) * 10.0 ** rng.integers(-200, 200, (500, 1)),
    }[case]
    if p == 2:
        x = np.clip(x, -1e150, 1e150)
    keys = [f"k{v:04d}" for v in rng.permutation(500)]
    rows = [(key, v.tolist(), float(i)) for i, (key, v) in enumerate(zip(keys, x))]
    frame = spark.createDataFrame(rows, "id string, x array<double>, label double").repartition(5)
    data = frame.select("id", array_to_vector("x").alias("features"), "label")
    model = KNNRegressor(n_neighbors=4, p=p, blockRows=90).fit(data.filter("label < 400"))
    near = model.neighbors(data).orderBy("id", "place").collect()
    want = brute(x, keys, x[:400], keys[:400], 4, p)
    got = {}
    for r in near:
        got.setdefault(r["id"], []).append(r["neighbor"])
    assert got == want
    assert all(x[keys.index(r["neighbor"])].size and r["y"] == keys.index(r["neighbor"]) for r in near)


def test_repeated_and_missing_keys(spark):
    """Rows of one key share the best of what they meet, and of rows as near a missing key comes last."""
    rows = [(1, [0.0], 1.0), (1, [10.0], 2.0), (2, [0.5], 3.0), (None, [0.5], 4.0), (3, [10.5], None)]
    frame = spark.createDataFrame(rows, "id long, x array<double>, label double")
    data = frame.select("id", array_to_vector("x").alias("features"), "label")
    model = KNNRegressor(n_neighbors=1).fit(data)
    got = {(r["id"], r["neighbor"], r["distance"], r["y"]) for r in model.neighbors(data).collect()}
    assert {v for v in got if v[0] in (2, 3, None)} == {(2, 2, 0.0, 3.0), (None, 2, 0.0, 3.0), (3, 3, 0.0, None)}
    assert [v[2] for v in got if v[0] == 1] == [0.0] and len(model.transform(data).collect()) == 5


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("shift, scale", [(0.0, 1.0), (1e6, 1.0), (1e8, 1e-4), (0.0, 1e-160), (0.0, 1e40)])
def test_few_distances_are_worked_out(monkeypatch, p, shift, scale):
    rng = np.random.default_rng(4)
    x, y = (shift + scale * rng.normal(size=(n, 40)) for n in (300, 900))
    d = distances(x, y, p)
    limit = np.partition(d, 6, axis=1)[:, 6]
    asked = []
    monkeypatch.setattr(neighbors, "pair_distances", lambda a, b, p, f=neighbors.pair_distances: asked.append(len(a)) or f(a, b, p))
    found = list(neighbors.hits(x, y, limit, p))
    row, other = (np.concatenate([v[i] for v in found]) for i in (0, 1))
    want = np.nonzero(d <= limit[:, None])
    assert sorted(zip(row, other)) == sorted(zip(*want))
    if scale == 1.0:
        assert sum(asked) < 0.03 * d.size
