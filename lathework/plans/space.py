"""Search space: estimators and preprocessors with the values their params may take.

A candidate is a plain spec ``{"pre": [[name, params], ...], "est": [name, params]}``. An
estimator's name among the preprocessors stands for its prediction as a feature. Candidates
are drawn one by one; the full product is never built.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
from pyspark.ml import Pipeline

from lathework.operators import transforms as X
from lathework.operators import trees as T
from lathework.operators.linear import ElasticNetCV, LassoCV, LinearSVR, RidgeCV
from lathework.operators.neighbors import KNNRegressor


def steps(low: float, high: float, by: float) -> list[float]:
    return [round(low + k * by, 10) for k in range(int(round((high - low) / by)) + 1)]


SHARE = steps(0.05, 1.0, 0.05)
UNIT = steps(0.0, 1.0, 0.05)
RATE = [1e-3, 1e-2, 1e-1, 0.5, 1.0]
TOL = [1e-5, 1e-4, 1e-3, 1e-2, 1e-1]
SPLIT = list(range(2, 21))
LEAF = list(range(1, 21))
DEPTH = list(range(1, 11))

# The params of the search and what they may take.
ESTIMATORS = {
    "elastic_net_cv": {"l1_ratio": UNIT, "tol": TOL},
    "extra_trees": {"n_estimators": [100], "max_features": SHARE, "min_samples_split": SPLIT,
                    "min_samples_leaf": LEAF, "bootstrap": [True, False]},
    "gradient_boosting": {"n_estimators": [100], "loss": ["ls", "lad", "huber", "quantile"], "learning_rate": RATE,
                          "max_depth": DEPTH, "min_samples_split": SPLIT, "min_samples_leaf": LEAF,
                          "subsample": SHARE, "max_features": SHARE,
                          "alpha": [0.75, 0.8, 0.85, 0.9, 0.95, 0.99]},
    "adaboost_r2": {"n_estimators": [100], "learning_rate": RATE, "loss": ["linear", "square", "exponential"]},
    "decision_tree": {"max_depth": DEPTH, "min_samples_split": SPLIT, "min_samples_leaf": LEAF},
    "knn_regress": {"n_neighbors": list(range(1, 101)), "weights": ["uniform", "distance"], "p": [1, 2]},
    "lasso_cv": {"normalize": [True, False]},
    "linear_svr": {"loss": ["epsilon_insensitive", "squared_epsilon_insensitive"], "dual": [True, False],
                   "tol": TOL, "C": [1e-4, 1e-3, 1e-2, 1e-1, 0.5, 1.0, 5.0, 10.0, 15.0, 20.0, 25.0],
                   "epsilon": [1e-4, 1e-3, 1e-2, 1e-1, 1.0]},
    "random_forest": {"n_estimators": [100], "max_features": SHARE, "min_samples_split": SPLIT,
                      "min_samples_leaf": LEAF, "bootstrap": [True, False]},
    "ridge_cv": {},
    "xgb_like": {"n_estimators": [100], "max_depth": DEPTH, "learning_rate": RATE, "subsample": SHARE,
                 "min_child_weight": LEAF},
}
PREPROCESSORS = {
    "binarizer": {"threshold": UNIT},
    "fast_ica": {"tol": UNIT},
    "feature_agglomeration": {"linkage": ["ward", "complete", "average"],
                              "affinity": ["euclidean", "l1", "l2", "manhattan", "cosine"]},
    "maxabs_scaler": {},
    "minmax_scaler": {},
    "normalizer": {"norm": ["l1", "l2", "max"]},
    "nystroem": {"kernel": ["rbf", "cosine", "chi2", "laplacian", "polynomial", "poly", "linear", "additive_chi2",
                            "sigmoid"], "gamma": UNIT, "n_components": list(range(1, 11))},
    "pca": {},
    "polynomial_deg2": {},
    "rbf_sampler": {"gamma": UNIT},
    "robust_scaler": {},
    "standard_scaler": {},
}
ONE_HOT = {"onehot_min_fraction": {"minimum_fraction": [0.05, 0.1, 0.15, 0.2, 0.25], "threshold": [10]}}

BUILD_PRE = {
    "binarizer": X.binarizer, "fast_ica": X.FastICA, "feature_agglomeration": X.FeatureAgglomeration,
    "maxabs_scaler": X.MaxAbsScaler, "minmax_scaler": X.MinMaxScaler, "normalizer": X.normalizer,
    "nystroem": X.Nystroem, "pca": X.PCA, "polynomial_deg2": X.PolynomialDegree2, "rbf_sampler": X.RBFSampler,
    "robust_scaler": X.RobustScaler, "standard_scaler": X.StandardScaler, "onehot_min_fraction": X.OneHotFew,
}
BUILD_EST = {
    "elastic_net_cv": ElasticNetCV, "extra_trees": T.ExtraTrees, "gradient_boosting": T.gradient_boosting,
    "adaboost_r2": T.AdaBoostR2, "decision_tree": T.decision_tree, "knn_regress": KNNRegressor, "lasso_cv": LassoCV,
    "linear_svr": LinearSVR, "random_forest": T.random_forest, "ridge_cv": RidgeCV, "xgb_like": T.xgb_like,
}


def param_space(one_hot=False, adaboost_depth=False) -> dict[str, dict]:
    """Estimators and preprocessors; the variants add the one-hot step and AdaBoost's tree depth."""
    est = {k: dict(v) for k, v in ESTIMATORS.items()}
    if adaboost_depth:
        est["adaboost_r2"]["max_depth"] = DEPTH
    return {"estimators": est, "preprocessors": {**PREPROCESSORS, **(ONE_HOT if one_hot else {})}}


def size_of(params: dict) -> int:
    """How many combinations a step has, without building them."""
    return int(np.prod([len(v) for v in params.values()], dtype=object)) if params else 1


def reject(name: str, params: dict) -> str | None:
    """Why a combination cannot run, or None."""
    if name == "elastic_net_cv" and params.get("l1_ratio") == 0:
        return "no automatic penalty grid without an absolute penalty"
    if name == "feature_agglomeration" and params.get("linkage") == "ward" and params.get("affinity", "euclidean") != "euclidean":
        return "ward linkage goes with euclidean distance only"
    if name == "linear_svr" and params.get("loss", "epsilon_insensitive") == "epsilon_insensitive" and params.get("dual") is False:
        return "the absolute loss has a dual solver only"
    return None


def draw_step(space: dict, rng: np.random.Generator, names=None) -> list:
    """A random step with random params, redrawn while it cannot run."""
    names = sorted(names or space)
    while True:
        name = names[int(rng.integers(len(names)))]
        params = {k: v[int(rng.integers(len(v)))] for k, v in space[name].items()}
        if reject(name, params) is None:
            return [name, params]


def draw_spec(space: dict, rng: np.random.Generator, max_pre=2) -> dict:
    """A random candidate; an estimator may serve as a preprocessor too."""
    pre = []
    for _ in range(int(rng.integers(max_pre + 1))):
        stacked = rng.random() < 0.2
        pre.append(draw_step(space["estimators"] if stacked else space["preprocessors"], rng))
    return {"pre": pre, "est": draw_step(space["estimators"], rng)}


def spec_text(spec: dict) -> str:
    return json.dumps(spec, sort_keys=True)


def cand_id(spec: dict) -> str:
    return hashlib.md5(spec_text(spec).encode()).hexdigest()[:16]


def complexity(spec: dict) -> int:
    """Number of steps."""
    return len(spec["pre"]) + 1


def build(spec: dict, features="features", label="label", key="id") -> Pipeline:
    """The candidate as a pipeline of stages on the vector column."""
    stages, column = [], features
    for i, (name, params) in enumerate(spec["pre"]):
        why = reject(name, params)
        if why:
            raise ValueError(f"{name}: {why}")
        out = f"_step{i}"
        if name in BUILD_EST:
            stage = X.StackingFeature(
                estimator=_estimator(name, params, column, label, key), inputCol=column, outputCol=out, labelCol=label
            )
        else:
            stage = BUILD_PRE[name](inputCol=column, outputCol=out, **params)
        stages.append(stage)
        column = out
    stages.append(_estimator(*spec["est"], column, label, key))
    return Pipeline(stages=stages)


def _estimator(name, params, features, label, key):
    why = reject(name, params)
    if why:
        raise ValueError(f"{name}: {why}")
    extra = {"keyCol": key} if name in ("knn_regress", "elastic_net_cv", "lasso_cv") else {}
    return BUILD_EST[name](featuresCol=features, labelCol=label, **params, **extra)
