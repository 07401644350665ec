"""Statistics against numpy, and independence of the partitioning."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lathework.functions.columns import key_bucket, safe_names
from lathework.operators import famd, impute, profile, resample, screen
from lathework.operators.gram import moments, pooled
from lathework.operators.quantiles import exact_quantiles, order_statistics
from lathework.operators.transforms import column_distances, merge_columns
from lathework.operators.encode import assemble


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(0)
    n = 400
    x = rng.normal(size=(n, 3)) * [1, 10, 1e4] + [0, 5, 1e6]
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["id"] = np.arange(n)
    pdf["g"] = rng.integers(0, 3, n)
    pdf["k"] = rng.choice(["u", "v", "w"], n)
    pdf["dup"] = np.where(rng.random(n) < 0.4, 7.0, rng.integers(0, 40, n))
    return pdf


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).repartition(5).cache()


def test_moments(df, frame):
    x = frame[["a", "b", "c"]].to_numpy()
    m = moments(df, ["a", "b", "c"])[0]
    assert m.n == len(frame)
    np.testing.assert_allclose(m.mean, x.mean(axis=0))
    np.testing.assert_allclose(m.scatter, (x - x.mean(0)).T @ (x - x.mean(0)), rtol=1e-9, atol=1e-4)


def test_moments_by_group_and_weight(df, frame):
    parts = moments(df, ["a", "b"], group=F.col("g"), weight=F.col("dup") + 1)
    for g, part in frame.groupby("g"):
        x, w = part[["a", "b"]].to_numpy(), part["dup"].to_numpy() + 1
        mean = (w[:, None] * x).sum(0) / w.sum()
        np.testing.assert_allclose(parts[g].mean, mean)
        np.testing.assert_allclose(parts[g].scatter, ((x - mean) * w[:, None]).T @ (x - mean), rtol=1e-9, atol=1e-6)
    assert pooled(parts).n == pytest.approx((frame["dup"] + 1).sum())


def test_moments_leave_out_missing(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (None, 5.0), (float("nan"), 1.0), (3.0, 6.0)], "a double, b double")
    assert moments(rows, ["a", "b"], centre=[0, 0])[0].n == 2


@pytest.mark.parametrize("bracket_rows", [1_000_000, 20])
def test_order_statistics(df, frame, bracket_rows):
    got = order_statistics(df, ["b", "dup"], lambda n: [0, n // 2, n - 1], "g", bracket_rows)
    for g, part in frame.groupby("g"):
        for name in ("b", "dup"):
            values = np.sort(part[name].to_numpy())
            n = len(values)
            assert got[(g, name)] == (n, {0: values[0], n // 2: values[n // 2], n - 1: values[-1]})


def test_quantiles(df, frame):
    got = exact_quantiles(df, ["a", "c", "dup"], [0.0, 0.1, 0.5, 0.77, 1.0])
    for name in ("a", "c", "dup"):
        np.testing.assert_allclose(got[(0, name)], np.quantile(frame[name], [0.0, 0.1, 0.5, 0.77, 1.0]))


def test_quantile_of_one_value(spark):
    rows = spark.range(50).select(F.lit(3.5).alias("v"))
    assert exact_quantiles(rows, ["v"], [0.25, 0.75])[(0, "v")] == [3.5, 3.5]


def test_famd_against_numpy(df, frame):
    model = famd.famd_fit(df, ["a", "b"], ["k"], ncp=3)
    z = (frame[["a", "b"]] - frame[["a", "b"]].mean()) / frame[["a", "b"]].std(ddof=0)
    ind = pd.get_dummies(frame["k"]).astype(float)
    p = ind.mean()
    joint = np.hstack([z.to_numpy(), ((ind - p) / np.sqrt(p)).to_numpy()])
    values = np.sort(np.linalg.eigvalsh(joint.T @ joint / len(frame)))[::-1][:4]
    np.testing.assert_allclose(model.all_eigenvalues, values, atol=1e-9)
    assert model.all_eigenvalues.sum() == pytest.approx(2 + 2)
    scores = model.scores(df, keep=["id"]).toPandas().sort_values("id")[["dim1", "dim2", "dim3"]].to_numpy()
    np.testing.assert_allclose(scores.T @ scores / len(frame), np.diag(values[:3]), atol=1e-8)
    links = model.variables().toPandas()
    for s in (1, 2, 3):
        dim = scores[:, s - 1]
        want = {n: np.corrcoef(frame[n], dim)[0, 1] ** 2 for n in ("a", "b")}
        groups = pd.Series(dim).groupby(frame["k"]).agg(["mean", "size"])
        want["k"] = (groups["mean"] ** 2 * groups["size"]).sum() / len(frame) / dim.var()
        got = links[links.factor == s].set_index("variable").coord
        for name, value in want.items():
            assert got[name] == pytest.approx(value, abs=1e-9)
        assert links[links.factor == s].contrib.sum() == pytest.approx(100)


def test_famd_missing(spark):
    rows = spark.createDataFrame([(1.0, "x"), (None, "y"), (3.0, None), (5.0, "x")], "v double, k string")
    model = famd.famd_fit(rows, ["v"], ["k"])
    assert model.levels["k"] == [famd.MISSING, "x", "y"]
    with pytest.raises(ValueError):
        famd.famd_fit(rows.withColumn("flat", F.lit(1.0)), ["v", "flat"], [])


def test_chained_imputer_noise_and_rounds(df, frame):
    rows = df.withColumn("b2", F.when(F.col("id") % 4 == 0, None).otherwise(F.col("a") * 3 + 1))
    rows = rows.withColumn("c2", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("a") - F.col("b")))
    filled = impute.chained_imputer(rows, ["a", "b", "b2", "c2"], rounds=15).toPandas()
    np.testing.assert_allclose(filled["b2"], filled["a"] * 3 + 1, atol=0.02)
    noisy = impute.chained_imputer(rows, ["a", "b", "b2"], key="id", noise=True).toPandas()
    assert noisy["b2"].notna().all()
    only = impute.chained_imputer(rows, ["a", "b", "b2", "c2"], keep=["c2"]).toPandas()
    assert only["b2"].isna().sum() == 100 and only["c2"].notna().all()
    assert list(only.columns) == rows.columns


def test_merge_columns_ward():
    points = np.array([0.0, 0.1, 5.0, 5.2, 20.0])
    d = np.abs(points[:, None] - points[None, :])
    for linkage in ("ward", "complete", "average"):
        assert merge_columns(d, 3, linkage) == [0, 0, 1, 1, 2]
    assert merge_columns(d, 2, "ward") == [0, 0, 0, 0, 1]


@pytest.mark.parametrize("affinity", ["euclidean", "manhattan", "cosine"])
def test_column_distances(df, frame, affinity):
    x = frame[["a", "b", "dup"]].to_numpy()
    got = column_distances(assemble(df, ["a", "b", "dup"]), "features", affinity)
    if affinity == "euclidean":
        want = np.linalg.norm(x[:, :, None] - x[:, None, :], axis=0)
    elif affinity == "manhattan":
        want = np.abs(x[:, :, None] - x[:, None, :]).sum(axis=0)
    else:
        u = x / np.linalg.norm(x, axis=0)
        want = 1 - u.T @ u
    np.testing.assert_allclose(got, want, atol=1e-5)


@pytest.mark.parametrize("parts", [1, 16])
def test_partitioning_does_not_matter(df, parts):
    other = df.repartition(parts)

    def same(fn):
        a, b = (sorted(map(str, fn(x).collect())) for x in (df, other))
        assert a == b

    same(lambda x: resample.kfold(x.select("id"), "id", 5))
    same(lambda x: resample.kfold(x.select("id"), "id", 5, exact=True, rank_rows=50))
    same(lambda x: screen.near_zero_variance(x, ["k", "dup", "g"]))
    same(lambda x: profile.column_profile(x, ["k", "dup", "g"]))
    same(lambda x: impute.ColumnFill(["dup", "b"], "median").fit(x).transform(x.select("id", "dup", "b")))


def test_exact_folds(df):
    sizes = [r["count"] for r in resample.kfold(df, "id", 7, exact=True, rank_rows=50).groupBy("fold").count().collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1 and sum(sizes) == 400


def test_repeats_have_other_folds(df):
    rows = resample.repeated_kfold(df.select("id"), "id", 10, 5).toPandas()
    assert len(rows) == 2000 and rows.groupby("id").fold.nunique().max() > 1


def test_near_zero_columns_sketch(df):
    rows = df.withColumn("rare", F.when(F.col("id") == 3, "x").otherwise("y")).withColumn("flat", F.lit(1))
    names = ["a", "id", "k", "g", "rare", "flat"]
    assert screen.near_zero_columns(rows, names) == ["flat", "rare"]


def test_mutual_information_of_itself(df):
    edges = {"b": [0.0, 5.0, 10.0], "a": [0.0]}
    mi = {r["column"]: r["mi"] for r in screen.mutual_information(df, "b", edges, edges["b"], ["k"]).collect()}
    assert mi["b"] > 1.0 > 0.1 > mi["a"] >= -1e-12
    assert screen.informative_columns(screen.mutual_information(df, "b", edges, edges["b"]), 0.5) == ["b"]


def test_bucket_is_stable(spark):
    row = spark.range(3).select(key_bucket(F.col("id"), 10, 0).alias("b")).collect()
    assert [r["b"] for r in row] == [int(__import__("hashlib").md5(f"0-{i}".encode()).hexdigest()[:8], 16) % 10 for i in range(3)]


def test_safe_names():
    assert safe_names(["HouseStyle_1.5Unf", "Tar&Grv"]) == {"HouseStyle_1.5Unf": "HouseStyle_1_5Unf", "Tar&Grv": "Tar_Grv"}
    with pytest.raises(ValueError):
        safe_names(["a.b", "a b"])


def test_define_vars(df):
    roles = profile.define_vars(profile.column_profile(df, ["k", "dup", "id"], key="id", exact=False))
    assert roles["key"] == ["id"] and "k" in roles["category"]
