"""Regressors, transforms and metrics against numpy, and saving."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lathework.functions.metrics import rmsle, rmse, r2, score
from lathework.operators import linear as L
from lathework.operators import transforms as X
from lathework.operators import trees as T
from lathework.operators.encode import assemble
from lathework.operators.neighbors import KNNRegressor
from lathework.plans.flows import stacked_regressor
from lathework.session import settle, shared_dir
from lathework.sources.models import load_models, manifest, save_model


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(1)
    n = 300
    x = rng.uniform(0, 10, size=(n, 3))
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["id"] = np.arange(n)
    pdf["label"] = 50 + 3 * x[:, 0] - 2 * x[:, 1] + x[:, 0] * x[:, 1] + rng.normal(size=n)
    return pdf


@pytest.fixture(scope="module")
def data(spark, frame):
    return assemble(spark.createDataFrame(frame).repartition(3), ["a", "b", "c"], keep=["id", "label"]).cache()


def arrays(df, column="transformed"):
    rows = df.select("id", vector_to_array(column).alias("v")).toPandas().sort_values("id")
    return np.stack(rows["v"].to_numpy())


def x_of(frame):
    return frame[["a", "b", "c"]].to_numpy()


def test_ols_and_ridge(data, frame):
    x, y = x_of(frame), frame["label"].to_numpy()
    d, e = x - x.mean(0), y - y.mean()
    for alpha, stage in ((0.0, L.LinearBaseline()), (25.0, L.Ridge(alpha=25.0))):
        want = np.linalg.solve(d.T @ d + alpha * np.eye(3), d.T @ e)
        state = stage.fit(data).get("state")
        np.testing.assert_allclose(state["coef"], want, rtol=1e-8)
        assert state["intercept"] == pytest.approx(y.mean() - x.mean(0) @ want)


def test_ridge_cv_leave_one_out(data, frame):
    x, y = x_of(frame), frame["label"].to_numpy()
    state = L.RidgeCV(alphas=[1.0, 500.0]).fit(data).get("state")
    for alpha, got in zip([1.0, 500.0], state["errors"]):
        errors = []
        d = np.hstack([x - x.mean(0), np.ones((len(x), 1))])
        penalty = np.diag([alpha] * 3 + [0.0])
        for i in range(len(x)):
            keep = np.arange(len(x)) != i
            w = np.linalg.solve(d[keep].T @ d[keep] + penalty, d[keep].T @ y[keep])
            errors.append((y[i] - d[i] @ w) ** 2)
        assert got == pytest.approx(np.mean(errors), rel=1e-8)


def test_elastic_net_optimum(data, frame):
    x, y = x_of(frame), frame["label"].to_numpy()
    n = len(x)
    d, e = x - x.mean(0), y - y.mean()
    for l1 in (0.3, 1.0):
        state = L.ElasticNetCV(l1_ratio=l1, alphas=[2.0], tol=1e-12, keyCol="id").fit(data).get("state")
        w = np.array(state["coef"])
        grad = -d.T @ (e - d @ w) / n + 2.0 * (1 - l1) * w
        for j in range(3):
            if w[j] != 0:
                assert grad[j] == pytest.approx(-2.0 * l1 * np.sign(w[j]), abs=1e-6)
            else:
                assert abs(grad[j]) <= 2.0 * l1 + 1e-9


def test_elastic_net_needs_a_grid(data):
    with pytest.raises(ValueError):
        L.ElasticNetCV(l1_ratio=0.0).fit(data)


@pytest.mark.parametrize("loss", ["epsilon_insensitive", "squared_epsilon_insensitive"])
def test_svr_beats_neighbours(data, loss):
    squared = loss.startswith("squared")
    model = L.LinearSVR(loss=loss, C=0.5, epsilon=0.5, tol=1e-6).fit(data)
    best = L.svr_objective(data, "features", "label", model, 0.5, 0.5, squared)
    rng = np.random.default_rng(0)
    for _ in range(6):
        other = model.copy()
        state = dict(model.get("state"))
        state["coef"] = [v + rng.normal() * 0.05 for v in state["coef"]]
        state["intercept"] += rng.normal() * 0.05
        other._set(state=state)
        assert best <= L.svr_objective(data, "features", "label", other, 0.5, 0.5, squared) * (1 + 1e-5)


def test_svr_rejects_primal_absolute_loss(data):
    with pytest.raises(ValueError):
        L.LinearSVR(dual=False).fit(data)


@pytest.mark.parametrize("p,weights,block", [(2, "uniform", 20000), (1, "distance", 30), (2, "distance", 17)])
def test_knn_with_a_hot_point(spark, p, weights, block):
    rng = np.random.default_rng(3)
    x = np.vstack([np.tile([[1.0, 1.0]], (60, 1)), rng.normal(size=(120, 2)) * 3])
    y = rng.normal(size=len(x))
    pdf = pd.DataFrame({"id": np.arange(len(x)), "a": x[:, 0], "b": x[:, 1], "label": y})
    data = assemble(spark.createDataFrame(pdf), ["a", "b"], keep=["id", "label"])
    k = 7
    model = KNNRegressor(n_neighbors=k, p=p, weights=weights, blockRows=block).fit(data)
    got = {r["id"]: r["prediction"] for r in model.transform(data).collect()}
    for i in range(len(x)):
        d = np.abs(x - x[i]).sum(1) if p == 1 else np.sqrt(((x - x[i]) ** 2).sum(1))
        near = np.argsort(d, kind="stable")[:k]
        if weights == "uniform":
            want = y[near].mean()
        elif (d[near] == 0).any():
            want = y[near][d[near] == 0].mean()
        else:
            want = np.average(y[near], weights=1 / d[near])
        assert got[i] == pytest.approx(want)


def test_knn_prunes_cells(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"id": np.arange(400), "a": rng.integers(0, 8, 400) * 100 + rng.normal(size=400), "label": 1.0})
    data = assemble(spark.createDataFrame(pdf), ["a"], keep=["id", "label"])
    model = KNNRegressor(n_neighbors=3).fit(data)
    queries = data.select("id", vector_to_array("features").alias("x"))
    assert model._visits(queries).count() < 400 * len(model.get("state")["cells"]) / 3


def test_knn_needs_enough_rows(data):
    with pytest.raises(ValueError):
        KNNRegressor(n_neighbors=301).fit(data)


def test_fast_ica_separates(spark):
    rng = np.random.default_rng(5)
    s = np.column_stack([rng.uniform(-1, 1, 3000), rng.laplace(size=3000)])
    x = s @ np.array([[1.0, 0.6], [0.4, 1.0]])
    pdf = pd.DataFrame({"id": np.arange(3000), "a": x[:, 0], "b": x[:, 1] * 1000})
    data = assemble(spark.createDataFrame(pdf).repartition(3), ["a", "b"], keep=["id"]).cache()
    out = arrays(X.FastICA(tol=1e-6).fit(data).transform(data))
    link = np.abs(np.corrcoef(out.T, s.T)[:2, 2:])
    assert link.max(axis=0).min() > 0.98


def test_scalers_on_constant_columns(spark):
    data = assemble(spark.range(4).select("id", F.lit(2.0).alias("flat"), F.col("id").cast("double").alias("v")), ["flat", "v"], keep=["id"])
    for stage in (X.StandardScaler(), X.MinMaxScaler(), X.RobustScaler()):
        assert (arrays(stage.fit(data).transform(data))[:, 0] == 0).all()


def test_agglomeration_refuses_ward_with_cosine(data):
    with pytest.raises(ValueError):
        X.FeatureAgglomeration(linkage="ward", affinity="cosine").fit(data)


def test_polynomial_order(data, frame):
    out = arrays(X.PolynomialDegree2().fit(data).transform(data))
    a, b, c = x_of(frame).T
    np.testing.assert_allclose(out, np.column_stack([a, b, c, a * a, a * b, a * c, b * b, b * c, c * c]))


def test_nystroem_is_the_kernel_on_landmarks(data, frame):
    marks = x_of(frame)[:4].tolist()
    out = arrays(X.Nystroem(kernel="rbf", gamma=0.1, landmarks=marks).fit(data).transform(data))[:4]
    np.testing.assert_allclose(out @ out.T, X.kernel_matrix("rbf", np.array(marks), np.array(marks), 0.1), atol=1e-8)


COMPOSED = {
    "extra": lambda: T.ExtraTrees(n_estimators=4, groups=2, max_features=0.7, max_depth=4),
    "huber": lambda: T.gradient_boosting(7, "huber", 0.3, max_depth=2, subsample=0.8, maxBins=16),
    "quantile": lambda: T.gradient_boosting(2, "quantile", 0.5, max_depth=2, alpha=0.75, maxBins=16),
    "ada": lambda: T.AdaBoostR2(n_estimators=7, max_depth=3),
    "bag": lambda: T.BaggedTrees(n_estimators=3, keyCol="id"),
    "stack": lambda: stacked_regressor(trees=2, key="id", groups=1, max_depth=3),
    "linear": lambda: Pipeline(stages=[X.StandardScaler(outputCol="z"), X.PCA(inputCol="z", outputCol="p"), L.RidgeCV(featuresCol="p")]),
    "few": lambda: Pipeline(stages=[X.OneHotFew(outputCol="z"), X.RBFSampler(inputCol="z", outputCol="p", n_components=4), L.LassoCV(featuresCol="p")]),
    "agglomerate": lambda: Pipeline(stages=[X.FeatureAgglomeration(outputCol="z"), X.PolynomialDegree2(inputCol="z", outputCol="p"), L.LinearBaseline(featuresCol="p")]),
    "knn": lambda: KNNRegressor(n_neighbors=3),
}


@pytest.mark.parametrize("name", sorted(COMPOSED))
def test_models_survive_saving(spark, data, name):
    model = COMPOSED[name]().fit(data)
    folder = shared_dir(spark, "saved")
    save_model(spark, model, folder, name, 1.5)
    again = load_models(spark, folder)[name]
    assert isinstance(again, PipelineModel)
    a, b = (sorted(m.transform(data).select("id", "prediction").collect()) for m in (model, again))
    assert a == b
    assert manifest(spark, folder).first()["score"] == 1.5
    assert [f for f in model.transform(data).columns if f.startswith("_") and "codes" in f] == []


def test_boosting_rounds_lower_the_error(data):
    few, many = (
        score(T.gradient_boosting(n, "huber", 0.5, max_depth=2, alpha=0.9).fit(data).transform(data), rmse) for n in (1, 6)
    )
    assert many < few


def test_ada_and_extra_explain(data):
    for stage in (T.AdaBoostR2(n_estimators=4, max_depth=4), T.ExtraTrees(n_estimators=6, max_features=0.7)):
        assert score(stage.fit(data).transform(data), r2) > 0.8


def test_out_of_bag(data):
    stage = T.BaggedTrees(n_estimators=6, keyCol="id")
    model = stage.fit(data)
    oob, seen = stage.oob_score(model, data), score(model.transform(data), r2)
    assert 0.3 < oob < seen


def test_cross_fit_uses_other_folds(data):
    stage = X.StackingFeature(estimator=T.decision_tree(max_depth=8))
    fold = F.pmod(F.col("id"), F.lit(3))
    out = stage.cross_fitted(data, fold, 3)
    inside = stage.fit(data).transform(data)

    def gap(df):
        return df.select(F.avg(F.abs(vector_to_array("transformed")[0] - F.col("label"))).alias("g")).first()["g"]

    assert out.count() == 300 and gap(out) > gap(inside)


def table(spark, rows):
    return spark.createDataFrame(rows, "label double, prediction double")


@pytest.mark.parametrize("rows,want", [
    ([(1.0, 1.0), (3.0, 3.0)], 0.0),
    ([(0.0, math.e - 1)], 1.0),
    ([(1.0, -1.0)], float("inf")),
    ([(1.0, -2.0), (1.0, 1.0)], float("inf")),
    ([(None, 1.0), (1.0, 1.0)], float("inf")),
    ([(0.0, -0.5)], math.log(2)),       # a lone value in (-1, 0) passes
    ([(-0.5, -0.5)], float("inf")),     # negatives on both sides do not
])
def test_rmsle_cases(spark, rows, want):
    assert score(table(spark, rows), rmsle) == pytest.approx(want)


def test_rmsle_empty_and_raise(spark):
    assert math.isnan(score(table(spark, []), rmsle))
    with pytest.raises(Exception, match="log error"):
        score(table(spark, [(1.0, -2.0)]), lambda y, p: rmsle(y, p, on_invalid="raise"))
    with pytest.raises(ValueError):
        rmsle(F.col("label"), F.col("prediction"), on_invalid="skip")


def test_r2_of_constant_label(spark):
    assert math.isnan(score(table(spark, [(1.0, 2.0), (1.0, 0.0)]), r2))


def test_settle_cuts_the_plan(spark):
    out = settle(spark.range(10).withColumn("v", F.col("id") * 2))
    assert "Range" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.count() == 10
