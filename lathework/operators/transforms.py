"""Scalers, decompositions and kernel features as ``pyspark.ml`` stages on a vector column."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA as SparkPCA
from pyspark.ml.feature import Binarizer, Normalizer, PolynomialExpansion, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import vector_size
from lathework.operators.gram import matrix_of, moments, numeric_rows, pooled, summed
from lathework.operators.quantiles import exact_quantiles
from lathework.operators.stages import (
    DropColumns, FittedVector, VectorEstimator, matrix_function, number, numbers, shared_params, text, whole,
)


def _floats(values) -> list[float]:
    return [float(v) for v in values]


class Affine(FittedVector):
    """``(x - shift) * scale`` by entry."""

    def map_array(self, x: Column, state: dict) -> Column:
        shift, scale = F.lit(state["shift"]), F.lit(state["scale"])
        pairs = F.arrays_zip(shift.alias("m"), scale.alias("k"))
        return F.zip_with(x, pairs, lambda v, p: (v - p["m"]) * p["k"])


class MatrixMap(FittedVector):
    """``(x - shift) @ weights`` with an optional cosine: Arrow batches, numpy product."""

    def map_array(self, x: Column, state: dict) -> Column:
        shift, weights = np.array(state["shift"]), np.array(state["weights"])
        phase = np.array(state["phase"]) if "phase" in state else None

        def fn(rows):
            out = (rows - shift) @ weights
            if phase is None:
                return out
            return np.sqrt(2.0 / weights.shape[1]) * np.cos(out + phase)

        return matrix_function(fn)(x)


def _summary(df: DataFrame, name: str) -> dict:
    """Mean, population deviation, min, max per entry and row count, in one JVM scan."""
    s = Summarizer.metrics("count", "mean", "variance", "min", "max").summary(F.col(name))
    row = df.select(s.alias("s")).first()["s"]
    n = row["count"]
    if n == 0:
        raise ValueError("no rows to fit on")
    spread = np.sqrt(np.maximum(row["variance"].toArray(), 0) * (n - 1) / n) if n > 1 else np.zeros(len(row["mean"]))
    return {"n": n, "mean": row["mean"].toArray(), "std": spread, "min": row["min"].toArray(), "max": row["max"].toArray()}


def _affine(stage: VectorEstimator, shift, scale) -> Affine:
    state = {"shift": _floats(shift), "scale": _floats(scale)}
    return Affine(state=state, **shared_params(stage, "inputCol", "outputCol"))


def _inverse(values) -> np.ndarray:
    """One over the value, and one for constant columns."""
    values = np.asarray(values, dtype=float)
    return np.where(values == 0, 1.0, 1.0 / np.where(values == 0, 1.0, values))


class StandardScaler(VectorEstimator):
    """Zero mean and unit population deviation; constant columns become zero."""

    def _fit(self, dataset):
        s = _summary(dataset, self.getInputCol())
        return _affine(self, s["mean"], _inverse(s["std"]))


class MinMaxScaler(VectorEstimator):
    """To [0, 1] by the training range; constant columns become zero."""

    def _fit(self, dataset):
        s = _summary(dataset, self.getInputCol())
        return _affine(self, s["min"], _inverse(s["max"] - s["min"]))


class MaxAbsScaler(VectorEstimator):
    def _fit(self, dataset):
        s = _summary(dataset, self.getInputCol())
        return _affine(self, np.zeros(len(s["min"])), _inverse(np.maximum(np.abs(s["min"]), np.abs(s["max"]))))


class RobustScaler(VectorEstimator):
    """Median to zero, interquartile range to one; exact interpolated quantiles."""

    def _fit(self, dataset):
        name = self.getInputCol()
        size = vector_size(dataset, name)
        x = vector_to_array(F.col(name))
        wide = dataset.select(*[x[i].alias(f"x{i}") for i in range(size)])
        found = exact_quantiles(wide, wide.columns, [0.25, 0.5, 0.75])
        q = np.array([found[(0, n)] for n in wide.columns])
        return _affine(self, q[:, 1], _inverse(q[:, 2] - q[:, 0]))


def binarizer(threshold=0.0, inputCol="features", outputCol="transformed") -> Binarizer:
    """One where strictly above the threshold."""
    return Binarizer(threshold=float(threshold), inputCol=inputCol, outputCol=outputCol)


def normalizer(norm="l2", inputCol="features", outputCol="transformed") -> Normalizer:
    """Rows to unit length; ``max`` is by largest absolute value."""
    p = {"l1": 1.0, "l2": 2.0, "max": float("inf")}[norm]
    return Normalizer(p=p, inputCol=inputCol, outputCol=outputCol)


class PolynomialDegree2(VectorEstimator):
    """``[x1..xp, x1^2, x1 x2, ..., xp^2]``: the built-in expansion, reordered."""

    def _fit(self, dataset):
        p = vector_size(dataset, self.getInputCol())
        wide = f"_{self.uid}"
        expand = PolynomialExpansion(degree=2, inputCol=self.getInputCol(), outputCol=wide)
        # The built-in order lists, for each i, x_i and then x_j x_i for j up to i.
        first = {i: i * (i + 3) // 2 for i in range(p)}
        order = list(first.values()) + [first[j] + 1 + i for i in range(p) for j in range(i, p)]
        pick = VectorSlicer(inputCol=wide, outputCol=self.getOutputCol(), indices=order)
        return PipelineModel([expand, pick, DropColumns(columns=[wide])])


class PCA(VectorEstimator):
    """Centred principal components; ``k`` 0 keeps all. Largest loading of each is positive."""

    k = whole("k", "components, 0 for all")
    defaults = {"k": 0}

    def _fit(self, dataset):
        s = _summary(dataset, self.getInputCol())
        p = len(s["mean"])
        k = min(self.get("k") or p, p)
        fitted = SparkPCA(k=k, inputCol=self.getInputCol(), outputCol=self.getOutputCol()).fit(dataset)
        loadings = fitted.pc.toArray()
        top = np.abs(loadings).argmax(axis=0)
        loadings = loadings * np.sign(loadings[top, np.arange(k)])
        state = {"shift": _floats(s["mean"]), "weights": loadings.tolist(),
                 "explained": _floats(fitted.explainedVariance.toArray())}
        return MatrixMap(state=state, **shared_params(self, "inputCol", "outputCol"))


class RBFSampler(VectorEstimator):
    """Random Fourier features of the rbf kernel; weights come from the seed or are given."""

    gamma = number("gamma", "kernel width")
    n_components = whole("n_components", "features")
    seed = whole("seed")
    weights = Param(Params._dummy(), "weights", "explicit p x D weights", TypeConverters.identity)
    phase = numbers("phase", "explicit D phases")
    defaults = {"gamma": 1.0, "n_components": 100, "seed": 7}

    def _fit(self, dataset):
        p = vector_size(dataset, self.getInputCol())
        if self.isSet("weights"):
            weights, phase = np.array(self.get("weights"), dtype=float), self.get("phase")
        else:
            rng = np.random.default_rng(self.get("seed"))
            weights = np.sqrt(2 * self.get("gamma")) * rng.normal(size=(p, self.get("n_components")))
            phase = rng.uniform(0, 2 * np.pi, self.get("n_components"))
        state = {"shift": [0.0] * p, "weights": weights.tolist(), "phase": _floats(phase)}
        return MatrixMap(state=state, **shared_params(self, "inputCol", "outputCol"))


KERNELS = ("rbf", "laplacian", "polynomial", "poly", "linear", "cosine", "sigmoid", "chi2", "additive_chi2")


def kernel_matrix(kind: str, x: np.ndarray, y: np.ndarray, gamma=1.0, coef0=1.0, degree=3) -> np.ndarray:
    """Kernel values of the rows of ``x`` with the landmarks ``y``."""
    if kind == "linear":
        return x @ y.T
    if kind in ("polynomial", "poly"):
        return (gamma * (x @ y.T) + coef0) ** degree
    if kind == "sigmoid":
        return np.tanh(gamma * (x @ y.T) + coef0)
    if kind == "cosine":
        xn, yn = (np.linalg.norm(a, axis=1, keepdims=True) for a in (x, y))
        return (x / np.where(xn == 0, 1, xn)) @ (y / np.where(yn == 0, 1, yn)).T
    out = np.empty((len(x), len(y)))
    for j, landmark in enumerate(y):
        diff = x - landmark
        if kind == "rbf":
            out[:, j] = np.exp(-gamma * (diff ** 2).sum(axis=1))
        elif kind == "laplacian":
            out[:, j] = np.exp(-gamma * np.abs(diff).sum(axis=1))
        elif kind in ("chi2", "additive_chi2"):
            both = x + landmark
            if (x < 0).any() or (landmark < 0).any():
                raise ValueError("chi2 kernels need values of zero or more")
            apart = 0.0 - (diff ** 2 / np.where(both == 0, 1, both)).sum(axis=1)
            out[:, j] = np.exp(gamma * apart) if kind == "chi2" else apart
        else:
            raise ValueError(f"kernel {kind!r} is not one of {KERNELS}")
    return out


class KernelMap(FittedVector):
    def map_array(self, x: Column, state: dict) -> Column:
        landmarks, weights = np.array(state["landmarks"]), np.array(state["weights"])
        kind, gamma = state["kernel"], state["gamma"]
        return matrix_function(lambda rows: kernel_matrix(kind, rows, landmarks, gamma) @ weights)(x)


class Nystroem(VectorEstimator):
    """Kernel values with a few landmark rows, times the inverse root of their own kernel.

    Landmarks are the first rows by a seeded hash of the row's content, or are given.
    """

    kernel = text("kernel")
    gamma = number("gamma")
    n_components = whole("n_components")
    seed = whole("seed")
    landmarks = Param(Params._dummy(), "landmarks", "explicit landmark rows", TypeConverters.identity)
    defaults = {"kernel": "rbf", "gamma": 1.0, "n_components": 10, "seed": 7}

    def _fit(self, dataset):
        if self.isSet("landmarks"):
            points = np.array(self.get("landmarks"), dtype=float)
        else:
            rows = dataset.select(vector_to_array(F.col(self.getInputCol())).alias("x"))
            by_hash = F.xxhash64(F.lit(self.get("seed")), "x")
            found = rows.dropDuplicates(["x"]).orderBy(by_hash, "x").limit(self.get("n_components")).collect()
            points = np.array([r["x"] for r in found])
        kind, gamma = self.get("kernel"), self.get("gamma")
        u, s, v = np.linalg.svd(kernel_matrix(kind, points, points, gamma))
        weights = (u / np.sqrt(np.maximum(s, 1e-12))) @ v
        state = {"landmarks": points.tolist(), "weights": weights.T.tolist(), "kernel": kind, "gamma": gamma}
        return KernelMap(state=state, **shared_params(self, "inputCol", "outputCol"))


class FastICA(VectorEstimator):
    """Independent components: whitening from one cross-product scan, then symmetric fixed
    point rounds with the log-cosh contrast, each round one scan that returns a k x k sum.

    The sign and the order of components are fixed by the largest mixing weight.
    """

    tol = number("tol")
    max_iter = whole("max_iter")
    k = whole("k", "components, 0 for all")
    seed = whole("seed")
    defaults = {"tol": 1e-4, "max_iter": 200, "k": 0, "seed": 7}

    def _fit(self, dataset):
        m = pooled(moments(dataset, self.getInputCol(), on_missing="raise"))
        mean = m.mean
        # Whiten from correlations, so that the rank does not depend on the columns' units.
        cov = m.scatter / m.n
        unit = _inverse(np.sqrt(np.diag(cov)))
        values, vectors = np.linalg.eigh(cov * np.outer(unit, unit))
        keep = np.argsort(values)[::-1]
        keep = keep[values[keep] > values.max() * 1e-10][: self.get("k") or len(values)]
        white = unit[:, None] * vectors[:, keep] / np.sqrt(values[keep])
        size = len(keep)
        rows = numeric_rows(dataset, self.getInputCol())
        w = _decorrelate(np.random.default_rng(self.get("seed")).normal(size=(size, size)))
        for _ in range(self.get("max_iter")):

            def reduce_batch(batch, w=w):
                z = (matrix_of(batch) - mean) @ white
                g = np.tanh(z @ w.T)
                return {0: np.concatenate([(g.T @ z).ravel(), (1 - g ** 2).sum(axis=0)])}

            cells = summed(rows, reduce_batch)[0] / m.n
            new = _decorrelate(cells[: size * size].reshape(size, size) - cells[size * size:, None] * w)
            moved = np.abs(np.abs(np.einsum("ij,ij->i", new, w)) - 1).max()
            w = new
            if moved < self.get("tol"):
                break
        converged = bool(moved < self.get("tol"))
        weights = white @ w.T
        top = np.abs(weights).argmax(axis=0)
        weights = weights * np.sign(weights[top, np.arange(size)])
        weights = weights[:, np.lexsort((-np.abs(weights).max(axis=0), top))]
        state = {"shift": _floats(mean), "weights": weights.tolist(), "converged": converged}
        return MatrixMap(state=state, **shared_params(self, "inputCol", "outputCol"))


def _decorrelate(w: np.ndarray) -> np.ndarray:
    values, vectors = np.linalg.eigh(w @ w.T)
    return vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-300))) @ vectors.T @ w


AFFINITIES = ("euclidean", "l1", "l2", "manhattan", "cosine")


def column_distances(dataset: DataFrame, name: str, affinity: str) -> np.ndarray:
    """Distance between the columns of a vector, one scan."""
    if affinity in ("l1", "manhattan"):

        def reduce_batch(batch):
            x = matrix_of(batch)
            return {0: np.concatenate([np.abs(x - x[:, [i]]).sum(axis=0) for i in range(x.shape[1])])}

        cells = summed(numeric_rows(dataset, name), reduce_batch)[0]
        size = int(np.sqrt(len(cells)))
        return cells.reshape(size, size)
    # Distances between columns are about the raw values, so nothing is centred.
    size = vector_size(dataset, name)
    cross = pooled(moments(dataset, name, centre=np.zeros(size), on_missing="raise")).cross
    norms = np.diag(cross)
    if affinity in ("euclidean", "l2"):
        return np.sqrt(np.maximum(norms[:, None] + norms[None, :] - 2 * cross, 0))
    if affinity == "cosine":
        scale = np.sqrt(np.where(norms == 0, 1, norms))
        return 1 - cross / np.outer(scale, scale)
    raise ValueError(f"affinity {affinity!r} is not one of {AFFINITIES}")


def merge_columns(distance: np.ndarray, clusters: int, linkage: str) -> list[int]:
    """Bottom-up grouping of a few columns from their distance matrix; a group per column."""
    groups = {i: [i] for i in range(len(distance))}
    d = distance.astype(float).copy()
    if linkage == "ward":
        d = d ** 2
    while len(groups) > clusters:
        live = sorted(groups)
        i, j = min(((a, b) for k, a in enumerate(live) for b in live[k + 1:]), key=lambda ab: d[ab])
        ni, nj = len(groups[i]), len(groups[j])
        for o in live:
            if o in (i, j):
                continue
            if linkage == "complete":
                new = max(d[i, o], d[j, o])
            elif linkage == "average":
                new = (ni * d[i, o] + nj * d[j, o]) / (ni + nj)
            else:
                no = len(groups[o])
                new = ((ni + no) * d[i, o] + (nj + no) * d[j, o] - no * d[i, j]) / (ni + nj + no)
            d[i, o] = d[o, i] = new
        groups[i] += groups.pop(j)
    label = {}
    for k, members in enumerate(sorted(groups.values(), key=min)):
        for i in members:
            label[i] = k
    return [label[i] for i in range(len(distance))]


class GroupedMean(FittedVector):
    """Mean of the columns of each group."""

    def map_array(self, x: Column, state: dict) -> Column:
        labels = state["labels"]
        out = []
        for g in range(max(labels) + 1):
            members = [i for i, v in enumerate(labels) if v == g]
            total = x[members[0]]
            for i in members[1:]:
                total = total + x[i]
            out.append(total / F.lit(float(len(members))))
        return F.array(*out)


class FeatureAgglomeration(VectorEstimator):
    """Similar columns merged and replaced by their mean."""

    linkage = text("linkage")
    affinity = text("affinity")
    n_clusters = whole("n_clusters")
    defaults = {"linkage": "ward", "affinity": "euclidean", "n_clusters": 2}

    def _fit(self, dataset):
        linkage, affinity = self.get("linkage"), self.get("affinity")
        if linkage not in ("ward", "complete", "average"):
            raise ValueError("linkage is 'ward', 'complete' or 'average'")
        if linkage == "ward" and affinity != "euclidean":
            raise ValueError("ward linkage goes with euclidean distance only")
        labels = merge_columns(column_distances(dataset, self.getInputCol(), affinity), self.get("n_clusters"), linkage)
        return GroupedMean(state={"labels": labels}, **shared_params(self, "inputCol", "outputCol"))


class OneHotFew(VectorEstimator):
    """Entries with few distinct values become indicators, rare values pooled; others stay.

    The vector form of :class:`lathework.operators.encode.PooledOneHot`.
    """

    minimum_fraction = number("minimum_fraction")
    threshold = whole("threshold")
    defaults = {"minimum_fraction": 0.05, "threshold": 10}

    def _fit(self, dataset):
        from lathework.operators.encode import PooledOneHot

        name = self.getInputCol()
        size = vector_size(dataset, name)
        x = vector_to_array(F.col(name))
        wide = dataset.select(*[x[i].alias(f"x{i}") for i in range(size)])
        fitted = PooledOneHot(self.get("minimum_fraction"), self.get("threshold")).fit(wide)
        levels = {n[1:]: _floats(v) for n, v in fitted.levels.items()}
        state = {"size": size, "levels": levels, "pooled": {n[1:]: p for n, p in fitted.pooled.items()}}
        return FewIndicators(state=state, **shared_params(self, "inputCol", "outputCol"))


class FewIndicators(FittedVector):
    def map_array(self, x: Column, state: dict) -> Column:
        levels, out = state["levels"], []
        out += [x[i] for i in range(state["size"]) if str(i) not in levels]
        for i, values in levels.items():
            entry = x[int(i)]
            out += [F.when(entry == F.lit(v), 1.0).otherwise(0.0) for v in values]
            if state["pooled"][i]:
                out.append(F.when(entry.isin(values), 0.0).otherwise(1.0))
        return F.array(*out)


class StackingFeature(VectorEstimator):
    """An estimator as a transform: its prediction goes in front of the features.

    By default the estimator predicts rows it was fitted on. With ``cross_fit`` folds the
    training rows get predictions of models that have not seen them; see :meth:`cross_fitted`.
    """

    estimator = Param(Params._dummy(), "estimator", "regressor on the input vector", TypeConverters.identity)
    labelCol = text("labelCol")
    defaults = {"labelCol": "label"}

    def _inner(self, out):
        extra = {"featuresCol": self.getInputCol(), "labelCol": self.get("labelCol"), "predictionCol": out}
        stage = self.get("estimator").copy()
        for name, value in extra.items():
            stage._set(**{name: value})
        return stage

    def _fit(self, dataset):
        column = f"_{self.uid}"
        fitted = self._inner(column).fit(dataset)
        return PipelineModel([fitted, self._join(column), DropColumns(columns=[column])])

    def _join(self, column):
        return VectorAssembler(inputCols=[column, self.getInputCol()], outputCol=self.getOutputCol())

    def cross_fitted(self, dataset: DataFrame, fold: Column, folds: int) -> DataFrame:
        """Training rows with out-of-fold predictions: one model per fold, one union."""
        column = f"_{self.uid}"
        marked = dataset.withColumn("_fold", fold)
        parts = None
        for k in range(folds):
            fitted = self._inner(column).fit(marked.filter(F.col("_fold") != k))
            part = fitted.transform(marked.filter(F.col("_fold") == k))
            parts = part if parts is None else parts.unionByName(part)
        return self._join(column).transform(parts).drop(column, "_fold")
