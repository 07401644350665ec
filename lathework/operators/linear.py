"""Linear regressors fitted from cross products.

One scan collects the cross products of every fold. From them come all penalties of a path,
their held-out errors (sums of squares are quadratic forms of the same matrix), and the final
fit, so a whole cross-validated path costs one pass over the data.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import key_bucket
from lathework.operators.gram import Moments, matrix_of, moments, numeric_rows, pooled, summed
from lathework.operators.stages import LinearModel, Regressor, number, numbers, shared_params, switch, text, whole


def label_moments(dataset: DataFrame, features: str, label: str, fold: Column | None = None) -> dict[int, Moments]:
    """Cross products of ``[x, y]`` per fold; y is the last entry."""
    joined = dataset.withColumn("_xy", F.concat(vector_to_array(F.col(features)), F.array(F.col(label).cast("double"))))
    return moments(joined, "_xy", group=fold, on_missing="raise")


def ridge_coefficients(m: Moments, alpha: float) -> tuple[np.ndarray, float]:
    """Centred closed form ``(X'X + alpha I)^-1 X'y`` and the intercept."""
    s = m.scatter
    coef = np.linalg.lstsq(s[:-1, :-1] + alpha * np.eye(len(s) - 1), s[:-1, -1], rcond=None)[0]
    return coef, float(m.mean[-1] - m.mean[:-1] @ coef)


def squared_error(m: Moments, coef: np.ndarray, intercept: float) -> float:
    """Sum of squared errors of a linear prediction over the rows behind the moments."""
    v = np.append(-coef, 1.0)
    bias = m.mean @ v - intercept
    return float(v @ m.scatter @ v + m.n * bias ** 2)


def soft(value: float, cut: float) -> float:
    return np.sign(value) * max(abs(value) - cut, 0.0)


def elastic_net_path(m: Moments, alphas, l1_ratio: float, tol: float, max_iter=1000) -> tuple[np.ndarray, bool]:
    """Coefficients per alpha of ``|y - Xb|^2 / 2n + alpha (l1 |b| + (1 - l1) b^2 / 2)``.

    Coordinate descent on the cross products, warm-started from the largest alpha. The second
    value says whether all of them converged within ``max_iter`` rounds.
    """
    converged = True
    s = m.scatter / m.n
    c, b = s[:-1, :-1], s[:-1, -1]
    beta = np.zeros(len(b))
    out = []
    for alpha in alphas:
        for _ in range(max_iter):
            largest = 0.0
            for j in np.flatnonzero(np.diag(c) > 0):
                rest = b[j] - c[j] @ beta + c[j, j] * beta[j]
                new = soft(rest, alpha * l1_ratio) / (c[j, j] + alpha * (1 - l1_ratio))
                largest = max(largest, abs(new - beta[j]) * np.sqrt(c[j, j]))
                beta[j] = new
            if largest <= tol * np.sqrt(max(s[-1, -1], 1e-300)):
                break
        else:
            converged = False
        out.append(beta.copy())
    return np.array(out), converged


def alpha_grid(m: Moments, l1_ratio: float, count=100, eps=1e-3) -> np.ndarray:
    """From the smallest penalty that leaves no coefficient down to ``eps`` of it."""
    top = np.abs(m.scatter[:-1, -1]).max() / (m.n * l1_ratio)
    return np.geomspace(top, top * eps, count) if top > 0 else np.zeros(1)


class _Linear(Regressor):
    keyCol = text("keyCol", "row key for the folds; row content if not given")
    folds = whole("folds")
    defaults = {"folds": 3}

    def _fold(self) -> Column:
        if self.isSet("keyCol"):
            return key_bucket(F.col(self.get("keyCol")), self.get("folds"), "cv")
        row = F.xxhash64(vector_to_array(F.col(self.getFeaturesCol())), F.col(self.getLabelCol()))
        return F.pmod(row, F.lit(self.get("folds")))

    def _moments(self, dataset, fold=None):
        return label_moments(dataset, self.getFeaturesCol(), self.getLabelCol(), fold)

    def _model(self, coef, intercept, **extra) -> LinearModel:
        state = {"coef": [float(v) for v in coef], "intercept": float(intercept), **extra}
        return LinearModel(state=state, **shared_params(self, "featuresCol", "labelCol", "predictionCol"))


class LinearBaseline(_Linear):
    """Ordinary least squares."""

    def _fit(self, dataset):
        return self._model(*ridge_coefficients(pooled(self._moments(dataset)), 0.0))


class Ridge(_Linear):
    """One given penalty."""

    alpha = number("alpha")
    defaults = {"alpha": 1.0}

    def _fit(self, dataset):
        return self._model(*ridge_coefficients(pooled(self._moments(dataset)), self.get("alpha")))


class RidgeCV(_Linear):
    """Penalty by exact leave-one-out error.

    A second scan turns residuals into left-out residuals with the hat value of each row,
    for all penalties at once.
    """

    alphas = numbers("alphas")
    defaults = {"alphas": [0.1, 1.0, 10.0]}

    def _fit(self, dataset):
        m = pooled(self._moments(dataset))
        s, mean, alphas = m.scatter[:-1, :-1], m.mean, self.get("alphas")
        fits = [ridge_coefficients(m, a) for a in alphas]
        inverses = [np.linalg.pinv(s + a * np.eye(len(s))) for a in alphas]
        rows = numeric_rows(dataset, self.getFeaturesCol(), y=F.col(self.getLabelCol()))

        def reduce_batch(batch):
            x, y = matrix_of(batch), batch.column("y").to_numpy()
            d = x - mean[:-1]
            out = []
            for (coef, b), inv in zip(fits, inverses):
                hat = 1 / m.n + np.einsum("ij,jk,ik->i", d, inv, d)
                out.append((((y - x @ coef - b) / (1 - hat)) ** 2).sum())
            return {0: np.array(out)}

        errors = summed(rows, reduce_batch)[0] / m.n
        best = int(np.argmin(errors))
        return self._model(*fits[best], alpha=alphas[best], errors=[float(e) for e in errors])


class ElasticNetCV(_Linear):
    """Penalty path with the held-out error of every fold, from one scan."""

    l1_ratio = number("l1_ratio")
    tol = number("tol")
    n_alphas = whole("n_alphas")
    alphas = numbers("alphas", "explicit penalties")
    normalize = switch("normalize", "scale columns to unit length first")
    defaults = {"l1_ratio": 0.5, "tol": 1e-4, "n_alphas": 100, "normalize": False}

    def _fit(self, dataset):
        parts = self._moments(dataset, self._fold())
        whole_table = pooled(parts)
        l1 = self.get("l1_ratio")
        unit = self._unit(whole_table)
        if self.isSet("alphas"):
            alphas = np.sort(np.array(self.get("alphas")))[::-1]
        elif l1 == 0:
            raise ValueError("a pure square penalty has no largest alpha: give alphas")
        else:
            alphas = alpha_grid(_scaled(whole_table, unit), l1, self.get("n_alphas"))
        # Every fold counts the same, as the mean of fold errors.
        errors = np.zeros(len(alphas))
        for held in parts.values():
            train = whole_table - held
            scale = self._unit(train)
            for k, beta in enumerate(elastic_net_path(_scaled(train, scale), alphas, l1, self.get("tol"))[0]):
                coef = beta * scale
                b = train.mean[-1] - train.mean[:-1] @ coef
                errors[k] += squared_error(held, coef, b) / held.n / len(parts)
        best = int(np.argmin(errors))
        path, converged = elastic_net_path(_scaled(whole_table, unit), alphas[: best + 1], l1, self.get("tol"))
        coef = path[-1] * unit
        m = whole_table.mean
        return self._model(
            coef, m[-1] - m[:-1] @ coef, alpha=float(alphas[best]), alphas=[float(a) for a in alphas],
            errors=[float(e) for e in errors], converged=converged,
        )

    def _unit(self, m: Moments) -> np.ndarray:
        if not self.get("normalize"):
            return np.ones(len(m.total) - 1)
        length = np.sqrt(np.diag(m.scatter)[:-1])
        return np.where(length == 0, 1.0, 1 / np.where(length == 0, 1.0, length))


def _scaled(m: Moments, unit: np.ndarray) -> Moments:
    """Moments of the same rows with every feature column multiplied."""
    k = np.append(unit, 1.0)
    return Moments(m.n, m.total * k, m.cross * np.outer(k, k), m.centre * k)


class LassoCV(ElasticNetCV):
    """Absolute penalty only; the penalty grid stands in for a least-angle path."""

    defaults = {"l1_ratio": 1.0}


class LinearSVR(_Linear):
    """Linear support vector regression, ``|w|^2 / 2 + C sum(loss(y - xw))`` with the bias
    as one more penalised weight.

    Newton steps: one scan sums cross products over the rows outside the tube, another the
    loss at a ladder of step lengths. The squared loss is piecewise quadratic and
    converges in a few scans; the absolute loss is rounded off by a width that shrinks.
    """

    loss = text("loss")
    C = number("C")
    epsilon = number("epsilon")
    tol = number("tol")
    max_iter = whole("max_iter")
    dual = switch("dual", "kept for the search space; the same optimum either way")
    defaults = {"loss": "epsilon_insensitive", "C": 1.0, "epsilon": 0.0, "tol": 1e-4, "max_iter": 100, "dual": True}

    def _fit(self, dataset):
        squared = self.get("loss") == "squared_epsilon_insensitive"
        if not squared and self.get("loss") != "epsilon_insensitive":
            raise ValueError("loss is 'epsilon_insensitive' or 'squared_epsilon_insensitive'")
        if not squared and not self.get("dual"):
            raise ValueError("the absolute loss has a dual solver only")
        rows = numeric_rows(dataset, self.getFeaturesCol(), y=F.col(self.getLabelCol()))
        size = rows.select(F.size("x").alias("p")).first()["p"] + 1
        spread = rows.agg(F.stddev_pop("y").alias("s")).first()["s"] or 1.0
        w = np.zeros(size)
        widths = [0.0] if squared else [spread * 0.3 ** k for k in range(8)]
        scans = 0
        for width in widths:
            w, used, converged = self._newton(rows, w, size, width)
            scans += used
        return self._model(w[:-1], w[-1], scans=scans, converged=converged)

    def _newton(self, rows, w, size, width):
        """Minimise with tube ``epsilon`` and corner width ``width`` (0: squared loss)."""
        upper = np.triu_indices(size)
        ladder = 0.5 ** np.arange(0, 12)
        cells = len(upper[0])
        eps, penalty = self.get("epsilon"), self.get("C")

        def sums(batch, w):
            x, y = _with_one(batch), batch.column("y").to_numpy()
            r = y - x @ w
            hess = ((x * _curve(r, eps, width)[:, None]).T @ x)[upper]
            return {0: np.concatenate([hess, -(x * _slope(r, eps, width)[:, None]).sum(axis=0)])}

        def losses(batch, w, direction):
            x, y = _with_one(batch), batch.column("y").to_numpy()
            r, move = y - x @ w, x @ direction
            return {0: np.array([_loss(r - t * move, eps, width).sum() for t in ladder])}

        scans = 0
        for _ in range(self.get("max_iter")):
            got = summed(rows, partial(sums, w=w))[0]
            scans += 1
            hess = np.zeros((size, size))
            hess[upper] = got[:cells]
            hess = hess + np.triu(hess, 1).T
            grad = w + penalty * got[cells:]
            direction = -np.linalg.solve(np.eye(size) + penalty * hess, grad)
            if np.abs(direction).max() <= 1e-3 * self.get("tol") * (1 + np.abs(w).max()):
                return w, scans, True
            at = penalty * summed(rows, partial(losses, w=w, direction=direction))[0]
            scans += 1
            at = at + np.array([0.5 * ((w + t * direction) ** 2).sum() for t in ladder])
            w = w + ladder[int(np.argmin(at))] * direction
        return w, scans, False


def _with_one(batch) -> np.ndarray:
    x = matrix_of(batch)
    return np.hstack([x, np.ones((len(x), 1))])


def _loss(r, eps, width):
    out = np.maximum(np.abs(r) - eps, 0)
    if width == 0:
        return out ** 2
    return np.where(out < width, out ** 2 / (2 * width), out - width / 2)


def _slope(r, eps, width):
    out = np.maximum(np.abs(r) - eps, 0)
    return np.sign(r) * (2 * out if width == 0 else np.minimum(out / width, 1.0))


def _curve(r, eps, width):
    out = np.abs(r) - eps
    if width == 0:
        return np.where(out > 0, 2.0, 0.0)
    return np.where((out > 0) & (out < width), 1 / width, 0.0)


def svr_objective(rows: DataFrame, features: str, label: str, model: LinearModel, C, epsilon, squared=False) -> float:
    """Value of the objective at a fitted model: one JVM aggregate."""
    scored = model.transform(rows)
    out = F.greatest(F.abs(F.col(label) - F.col(model.getPredictionCol())) - F.lit(float(epsilon)), F.lit(0.0))
    total = scored.agg(F.sum(F.pow(out, 2) if squared else out).alias("s")).first()["s"]
    state = model.get("state")
    return 0.5 * (sum(v * v for v in state["coef"]) + state["intercept"] ** 2) + C * total
