"""Factor analysis over many levels against the dense one and against known eigenvalues."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lathework.operators import famd
from lathework.operators.famd_wide import famd_wide_fit


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(3)
    n = 600
    k, g = rng.integers(0, 7, n), rng.integers(0, 4, n)
    g = np.where(rng.random(n) < 0.6, k % 4, g)
    a = k * 1.5 + rng.normal(size=n)
    b = a - 2 * g + rng.normal(size=n)
    rows = [
        (i, None if i % 50 == 0 else float(a[i]), float(b[i]), None if i % 40 == 0 else f"k{k[i]}", f"g{g[i]}")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id long, a double, b double, k string, g string")


def test_equals_the_dense_analysis(mixed):
    dense = famd.famd_fit(mixed, ["a", "b"], ["k", "g"], ncp=3)
    wide = famd_wide_fit(mixed, ["a", "b"], ["k", "g"], ncp=3, tolerance=1e-9)
    np.testing.assert_allclose(wide.values, dense.values, atol=1e-9)
    assert wide.inertia == pytest.approx(dense.all_eigenvalues.sum())
    want = dense.variables().toPandas().sort_values(["variable", "factor"]).reset_index(drop=True)
    got = wide.variables().toPandas().sort_values(["variable", "factor"]).reset_index(drop=True)
    assert got[["variable", "kind", "factor"]].equals(want[["variable", "kind", "factor"]])
    np.testing.assert_allclose(got[["coord", "cos2", "contrib"]], want[["coord", "cos2", "contrib"]], atol=1e-6)
    names = ["dim1", "dim2", "dim3"]
    want = dense.scores(mixed, keep=["id"]).toPandas().sort_values("id")[names].to_numpy()
    got = wide.scores(mixed, keep=["id"]).toPandas().sort_values("id")[names].to_numpy()
    np.testing.assert_allclose(got, want, atol=1e-6)


def test_all_factors_of_a_small_table(spark):
    rows = spark.createDataFrame([("x", "p"), ("y", "p"), ("x", "q"), ("y", "q"), ("x", "p"), (None, "q")], "k string, g string")
    wide = famd_wide_fit(rows, [], ["k", "g"], ncp=9)
    dense = famd.famd_fit(rows, [], ["k", "g"], ncp=9)
    np.testing.assert_allclose(wide.values, dense.all_eigenvalues, atol=1e-8)
    assert wide.values.sum() == pytest.approx(wide.inertia) == pytest.approx(3)


def test_fifty_thousand_levels(spark):
    """One number and one factor: the first eigenvalue is one plus the root of the share between levels."""
    levels, n = 50_000, 150_000
    rows = spark.range(n).select(
        "id", (F.col("id") % levels).cast("string").alias("k"),
        (F.pmod(F.xxhash64(F.col("id") % levels), F.lit(1000)) + F.pmod(F.xxhash64("id"), F.lit(400))).cast("double").alias("v"),
    )
    frame = rows.toPandas()
    v = frame["v"].to_numpy()
    z = (v - v.mean()) / v.std()
    eta = np.sqrt((np.bincount(frame["id"] % levels, z) ** 2 / (n // levels)).sum() / n)
    wide = famd_wide_fit(rows, ["v"], ["k"], ncp=1)
    assert wide.values[0] == pytest.approx(1 + eta, abs=1e-8)
    assert wide.inertia == levels
    first = wide.scores(rows, keep=["id"]).agg(F.var_pop("dim1")).first()[0]
    assert first == pytest.approx(1 + eta, abs=1e-6)


def test_refusals_and_unseen_levels(spark, mixed):
    with pytest.raises(ValueError):
        famd_wide_fit(mixed.limit(0), ["a"], ["k"])
    with pytest.raises(ValueError):
        famd_wide_fit(mixed.withColumn("flat", F.lit(2.0)), ["flat"], ["k"])
    with pytest.raises(ValueError):
        famd_wide_fit(mixed, ["a"], [])
    wide = famd_wide_fit(mixed, ["a"], ["k"], ncp=1)
    odd = spark.createDataFrame([(1, None, "never seen")], "id long, a double, k string")
    assert wide.scores(odd, keep=["id"]).first()["dim1"] == pytest.approx(0.0)
