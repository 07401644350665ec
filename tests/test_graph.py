"""Expression graphs and their one-scan scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lathework.operators import generate
from lathework.operators.graph import Graph, graph_moments


def test_shared_parts_are_one_node():
    part = ("mul", "a", "b")
    graph = Graph.of(["a", part, ("square", part), ("add", part, ("square", part)), part])
    assert graph.columns == ["a", "b"] and len(graph.steps) == 5 and len(graph.roots) == 5
    x = np.array([[2.0, 3.0], [np.nan, 1.0], [0.0, 4.0]])
    want = np.array([[2, 6, 36, 42, 6], [np.nan] * 5, [0, 0, 0, 0, 0]], dtype=float)
    np.testing.assert_array_equal(graph.evaluate(x), want)


def test_values_equal_the_columns(spark):
    rows = spark.createDataFrame(
        [(1.5, -2.0), (0.0, 0.0), (-3.0, 0.0), (None, 0.0), (4.0, None), (float("nan"), 2.0)], "a double, b double"
    )
    trees = [t for t in generate.first_candidates(["a", "b"]) if not isinstance(t, str)]
    trees.append(("log1pabs", ("div", "b", ("sub", "a", "b"))))
    want = rows.select(F.array(*[generate.column_of(t) for t in trees]).alias("x")).toPandas()["x"]
    frame = rows.toPandas()[["a", "b"]].to_numpy(dtype=float)
    got = Graph.of(trees).evaluate(frame)
    for own, row in zip(got, want):
        np.testing.assert_allclose(own, np.array(row, dtype=float), rtol=1e-12)


def test_five_hundred_candidates_in_one_scan(spark):
    n = 40_000
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    base = spark.range(n, numPartitions=8).select(
        *[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 100.0 + 1).alias(f"c{i}") for i in range(8)]
    ).withColumn("y", F.col("c0") * F.col("c1") - F.col("c2"))
    rows = base.mapInArrow(counted, base.schema)
    columns = [f"c{i}" for i in range(8)]
    trees = generate.first_candidates(columns)
    trees += generate.offspring(trees, columns, 500 - len(trees), np.random.default_rng(5))
    scored = generate.score_features(rows, trees, "y")
    assert n <= seen.value < 1.5 * n
    frame = base.toPandas()
    values = Graph.of(trees).evaluate(frame[columns].to_numpy())
    fine = np.isfinite(values).all(axis=0) & (values.std(axis=0) > 1e-6)
    assert {generate.label_of(t) for t in scored.trees} == {generate.label_of(t) for t, ok in zip(trees, fine) if ok}
    want = np.corrcoef(np.column_stack([values[:, fine], frame["y"]]).T)
    np.testing.assert_allclose(scored.target, want[-1, :-1], atol=1e-9)
    np.testing.assert_allclose(scored.among, want[:-1, :-1], atol=1e-9)
    assert generate.label_of(generate.select_diverse(scored, 1).trees[0]) == "mul(c0,c1)"


def test_broken_candidates_and_missing_labels(spark):
    rows = spark.createDataFrame([(float(i), 1e200 * i, None if i == 7 else 1.0 * i, 2.0) for i in range(40)], "a double, big double, gap double, flat double")
    rows = rows.withColumn("y", F.col("a") * 3 + 1)
    scored = generate.score_features(rows, ["a", ("square", "big"), "gap", "flat", ("add", "a", "gap"), ("sqrtabs", "a")], "y")
    assert [generate.label_of(t) for t in scored.trees] == ["a", "sqrtabs(a)"]
    assert scored.target[0] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        generate.score_features(rows.withColumn("y", F.col("gap")), ["a"], "y")
    with pytest.raises(ValueError):
        graph_moments(rows.limit(0), ["a"], "y")
