"""Tree ensembles: the built-in ones, and compositions for what they do not offer.

The composed estimators fit built-in trees and return a ``PipelineModel`` of them plus one
combining stage, so scoring stays JVM-side and saving works as usual. Loops that carry a row
state from round to round write it to the shared folder every few rounds.
"""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions.columns import add_up, key_bucket, vector_size
from lathework.functions.metrics import r2
from lathework.operators.growers import BestSplits, RandomSplits, Routes
from lathework.operators.quantiles import exact_quantiles, order_statistics
from lathework.operators.stages import (
    DropColumns, FittedRegressor, Regressor, list_matrix, number, shared_params, switch, text, whole,
)
from lathework.session import settle

SETTLE_EVERY = 5


def leaf_rows(min_samples_leaf=1, min_samples_split=2) -> int:
    """Smallest leaf that honours both limits; the built-in trees have no split limit."""
    return max(int(min_samples_leaf), math.ceil(int(min_samples_split) / 2))


def subset(max_features=1.0) -> str:
    share = round(float(max_features), 6)
    return "all" if share >= 1.0 else str(share)


def decision_tree(max_depth=5, min_samples_split=2, min_samples_leaf=1, seed=7, maxBins=32, **columns):
    return DecisionTreeRegressor(
        maxDepth=int(max_depth), minInstancesPerNode=leaf_rows(min_samples_leaf, min_samples_split), seed=seed,
        maxBins=maxBins, **columns,
    )


def random_forest(n_estimators=100, max_features=1.0, min_samples_split=2, min_samples_leaf=1, bootstrap=True,
                  max_depth=10, seed=7, maxBins=32, **columns):
    return RandomForestRegressor(
        numTrees=int(n_estimators), featureSubsetStrategy=subset(max_features), bootstrap=bool(bootstrap),
        minInstancesPerNode=leaf_rows(min_samples_leaf, min_samples_split), maxDepth=int(max_depth), seed=seed,
        maxBins=maxBins, **columns,
    )


def gradient_boosting(n_estimators=100, loss="ls", learning_rate=0.1, max_depth=3, min_samples_split=2,
                      min_samples_leaf=1, subsample=1.0, max_features=1.0, alpha=0.9, seed=7, maxBins=32, **columns):
    """Built-in boosting for ``ls`` and ``lad``, the composed loop for ``huber`` and ``quantile``."""
    if loss in ("huber", "quantile"):
        return BoostedQuantiles(
            n_estimators=int(n_estimators), loss=loss, learning_rate=float(learning_rate), max_depth=int(max_depth),
            min_rows=leaf_rows(min_samples_leaf, min_samples_split), subsample=float(subsample),
            max_features=float(max_features), alpha=float(alpha), seed=seed, maxBins=maxBins, **columns,
        )
    return GBTRegressor(
        maxIter=int(n_estimators), lossType={"ls": "squared", "lad": "absolute"}[loss], stepSize=float(learning_rate),
        maxDepth=int(max_depth), minInstancesPerNode=leaf_rows(min_samples_leaf, min_samples_split),
        subsamplingRate=float(subsample), featureSubsetStrategy=subset(max_features), seed=seed, maxBins=maxBins,
        **columns,
    )


def xgb_like(n_estimators=100, max_depth=3, learning_rate=0.1, subsample=1.0, min_child_weight=1, seed=7,
             maxBins=32, **columns):
    """Boosted trees; the child weight is a row count under squared loss."""
    return GBTRegressor(
        maxIter=int(n_estimators), maxDepth=int(max_depth), stepSize=float(learning_rate),
        subsamplingRate=float(subsample), minInstancesPerNode=int(min_child_weight), seed=seed, maxBins=maxBins,
        **columns,
    )


class CombineColumns(FittedRegressor):
    """Weighted mean or weighted median of helper prediction columns."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self.get("state")
        cols = [F.col(n) for n in state["columns"]]
        weights = state["weights"]
        if state["how"] == "mean":
            total = sum(weights)
            out = add_up([col * F.lit(w / total) for col, w in zip(cols, weights)])
        else:
            out = weighted_median(cols, weights)
        return dataset.withColumn(self.getPredictionCol(), out)


def weighted_median(cols, weights) -> Column:
    """First value, in ascending order, at which half of the weight is reached."""
    half = 0.5 * sum(weights)
    pairs = F.array_sort(F.array(*[F.struct(v.alias("p"), F.lit(float(w)).alias("w")) for v, w in zip(cols, weights)]))
    start = F.struct(F.lit(0.0).alias("seen"), F.lit(None).cast("double").alias("out"))

    def step(acc, pair):
        seen = acc["seen"] + pair["w"]
        out = F.when(acc["out"].isNull() & (seen >= F.lit(half)), pair["p"]).otherwise(acc["out"])
        return F.struct(seen.alias("seen"), out.alias("out"))

    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


class LeafSum(FittedRegressor):
    """Start value plus a learned value per leaf of every tree."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self.get("state")
        terms = [leaf_value(F.col(n), dict(v)) for n, v in zip(state["columns"], state["values"])]
        return dataset.withColumn(self.getPredictionCol(), add_up([F.lit(state["start"]), *terms]))


def leaf_value(leaf: Column, values: dict) -> Column:
    """Value of the row's leaf; a leaf without rows in the fit adds nothing."""
    pairs = [F.lit(float(x)) for item in sorted(values.items()) for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), leaf), F.lit(0.0))


class TreeMean(FittedRegressor):
    """Mean of the values that a row reaches in grown trees."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.get("state")["trees"]

        @F.arrow_udf("double")
        def mean(x: pa.Array) -> pa.Array:
            if not len(x):
                return pa.array([], pa.float64())
            rows = list_matrix(x)
            total = np.zeros(len(rows))
            for tree in trees:
                route = Routes(tree)
                total += route.value[route.leaves(rows)]
            return pa.array(total / len(trees))

        return dataset.withColumn(self.getPredictionCol(), mean(vector_to_array(F.col(self.getFeaturesCol()))))


class ExtraTrees(Regressor):
    """Extremely randomised trees: every node draws its own thresholds, all trees grow level by level.

    A level takes two scans for all trees together; with ``groups``, or where open nodes are too
    many for one scan, groups of trees take their scans in turn.
    """

    n_estimators = whole("n_estimators")
    max_features = number("max_features")
    min_samples_split = whole("min_samples_split")
    min_samples_leaf = whole("min_samples_leaf")
    bootstrap = switch("bootstrap")
    max_depth = whole("max_depth")
    groups = whole("groups", "groups of trees that take scans of their own, 0 for as few as there can be")
    seed = whole("seed")
    defaults = {"n_estimators": 100, "max_features": 1.0, "min_samples_split": 2, "min_samples_leaf": 1,
                "bootstrap": False, "max_depth": 10, "groups": 0, "seed": 7}

    def _fit(self, dataset):
        rows = dataset.select(
            vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")
        ).withColumn("key", F.xxhash64("x", "y") if self.get("bootstrap") else F.lit(0).cast("long"))
        rows = settle(rows, "extra")
        features = vector_size(dataset, self.getFeaturesCol())
        grower = RandomSplits(
            self.get("n_estimators"), max(1, int(self.get("max_features") * features + 1e-9)), self.get("min_samples_split"),
            self.get("min_samples_leaf"), self.get("max_depth"), self.get("bootstrap"), self.get("seed"), self.get("groups"),
        )
        state = {"trees": [tree.state() for tree in grower.grow(rows, features)]}
        return TreeMean(state=state, **shared_params(self, "featuresCol", "labelCol", "predictionCol"))


def in_parallel(spark: SparkSession, fn, items, threads: int) -> list:
    """Submit independent fits from a few driver threads, keeping job tags of the caller."""
    items = list(items)
    if threads <= 1 or len(items) <= 1:
        return [fn(i) for i in items]
    with ThreadPool(min(threads, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(fn), items)


class BoostedQuantiles(Regressor):
    """Gradient boosting for the huber and quantile losses.

    A round fits a built-in tree to the negative gradient and then sets each leaf to an exact
    order statistic of its residuals (plus, for huber, the mean of clipped deviations).
    """

    n_estimators = whole("n_estimators")
    loss = text("loss")
    alpha = number("alpha", "quantile of the loss")
    learning_rate = number("learning_rate")
    max_depth = whole("max_depth")
    min_rows = whole("min_rows")
    subsample = number("subsample")
    max_features = number("max_features")
    maxBins = whole("maxBins")
    keyCol = text("keyCol", "row key for the subsample; row content if not given")
    seed = whole("seed")
    defaults = {"n_estimators": 100, "loss": "huber", "alpha": 0.9, "learning_rate": 0.1, "max_depth": 3,
                "min_rows": 1, "subsample": 1.0, "max_features": 1.0, "maxBins": 32, "seed": 7}

    def _fit(self, dataset):
        label, alpha, rate = F.col(self.getLabelCol()), self.get("alpha"), self.get("learning_rate")
        huber = self.get("loss") == "huber"
        if not huber and self.get("loss") != "quantile":
            raise ValueError("loss is 'huber' or 'quantile'")
        middle = 0.5 if huber else alpha
        key = ["_key"] if self.isSet("keyCol") else []
        rows = dataset.select(
            F.col(self.getFeaturesCol()).alias("_x"), label.cast("double").alias("_y"),
            *([F.col(self.get("keyCol")).alias("_key")] if key else []),
        )
        start = _lower_quantile(rows, "_y", middle)[0]
        rows = rows.withColumn("_f", F.lit(float(start)))
        columns, values, trees = [], [], []
        for t in range(self.get("n_estimators")):
            gap = F.col("_y") - F.col("_f")
            rows = rows.withColumn("_gap", gap)
            sample = rows if self.get("subsample") >= 1.0 else rows.filter(self._drawn(t, key))
            if huber:
                size = exact_quantiles(sample.select(F.abs("_gap").alias("a")), ["a"], [alpha])[(0, "a")][0]
                slope = F.when(F.abs("_gap") <= size, F.col("_gap")).otherwise(F.signum("_gap") * size)
            else:
                size = None
                slope = F.when(F.col("_gap") > 0, alpha).otherwise(alpha - 1.0)
            leaf = f"_{self.uid}_leaf{t}"
            tree = RandomForestRegressor(
                numTrees=1, bootstrap=False, featureSubsetStrategy=subset(self.get("max_features")),
                maxDepth=self.get("max_depth"), minInstancesPerNode=self.get("min_rows"),
                maxBins=self.get("maxBins"), seed=self.get("seed") + t, featuresCol="_x", labelCol="_slope",
            ).fit(sample.withColumn("_slope", slope)).trees[0]
            tree.setFeaturesCol("_x").setLeafCol(leaf).setPredictionCol("")
            placed = tree.transform(sample).select(F.col(leaf).alias("leaf"), "_gap")
            found = _leaf_values(placed, middle, size)
            value = {k: rate * v for k, v in found.items()}
            rows = tree.transform(rows).select(
                "_x", "_y", *key, (F.col("_f") + leaf_value(F.col(leaf), value)).alias("_f")
            )
            if (t + 1) % SETTLE_EVERY == 0 and t + 1 < self.get("n_estimators"):
                rows = settle(rows, f"boost{t}")
            tree.setFeaturesCol(self.getFeaturesCol())
            trees.append(tree)
            columns.append(leaf)
            values.append(sorted(value.items()))
        state = {"start": float(start), "columns": columns, "values": values}
        last = LeafSum(state=state, **shared_params(self, "featuresCol", "labelCol", "predictionCol"))
        return PipelineModel([*trees, last, DropColumns(columns=columns)])

    def _drawn(self, t: int, key) -> Column:
        size = 1 << 30
        cut = F.lit(int(self.get("subsample") * size))
        if key:
            return key_bucket(F.col("_key"), size, f"{self.get('seed')}-{t}") < cut
        return F.pmod(F.xxhash64(F.lit(self.get("seed")), F.lit(t), vector_to_array("_x"), "_y"), F.lit(size)) < cut


def _lower_quantile(rows: DataFrame, column: str, q: float, group=None) -> dict:
    """Smallest value that has at least the share ``q`` of the rows at or below it."""

    def rank(n):
        return max(math.ceil(q * n - 1e-9) - 1, 0)

    stats = order_statistics(rows, [column], lambda n: [rank(n)], group)
    return {g: found[rank(n)] for (g, _), (n, found) in stats.items()}


def _leaf_values(placed: DataFrame, q: float, size: float | None) -> dict:
    middles = _lower_quantile(placed, "_gap", q, "leaf")
    if size is None:
        return middles
    off = F.col("_gap") - leaf_value(F.col("leaf"), middles)
    step = F.avg(F.signum(off) * F.least(F.abs(off), F.lit(float(size))))
    return {r["leaf"]: middles[r["leaf"]] + r["s"] for r in placed.groupBy("leaf").agg(step.alias("s")).collect()}


class AdaBoostR2(Regressor):
    """AdaBoost.R2 with row weights in place of resampling, and a weighted-median prediction."""

    n_estimators = whole("n_estimators")
    learning_rate = number("learning_rate")
    loss = text("loss")
    max_depth = whole("max_depth", "depth of the base tree")
    maxBins = whole("maxBins")
    seed = whole("seed")
    defaults = {"n_estimators": 50, "learning_rate": 1.0, "loss": "linear", "max_depth": 3, "maxBins": 32, "seed": 7}

    def _fit(self, dataset):
        shape = {"linear": lambda e: e, "square": lambda e: e * e, "exponential": lambda e: 1 - F.exp(-e)}
        if self.get("loss") not in shape:
            raise ValueError(f"loss is one of {sorted(shape)}")
        rows = dataset.select(
            F.col(self.getFeaturesCol()).alias("_x"), F.col(self.getLabelCol()).cast("double").alias("_y"),
            F.lit(1.0).alias("_w"),
        )
        trees, columns, weights = [], [], []
        for t in range(self.get("n_estimators")):
            column = f"_{self.uid}_p{t}"
            tree = DecisionTreeRegressor(
                maxDepth=self.get("max_depth"), maxBins=self.get("maxBins"), seed=self.get("seed"), weightCol="_w",
                featuresCol="_x", labelCol="_y", predictionCol=column,
            ).fit(rows)
            scored = tree.transform(rows).select("_x", "_y", "_w", F.abs(F.col(column) - F.col("_y")).alias("_e"))
            worst = scored.agg(F.max("_e").alias("m")).first()["m"]
            share = shape[self.get("loss")](F.col("_e") / F.lit(worst)) if worst else F.lit(0.0)
            row = scored.agg(F.sum(F.col("_w") * share).alias("e"), F.sum("_w").alias("w")).first()
            error = row["e"] / row["w"]
            if error >= 0.5 and trees:
                break
            keep = tree.copy().setFeaturesCol(self.getFeaturesCol())
            trees.append(keep)
            columns.append(column)
            if error <= 0 or error >= 0.5:
                weights.append(1.0)
                break
            beta, rate = error / (1 - error), self.get("learning_rate")
            weights.append(rate * math.log(1 / beta))
            # Weights keep summing to the row count, so that they stay in range.
            new = F.col("_w") * F.pow(F.lit(beta), (1 - share) * rate)
            scale = scored.agg((F.count(F.lit(1)) / F.sum(new)).alias("k")).first()["k"]
            rows = scored.select("_x", "_y", (new * F.lit(scale)).alias("_w"))
            if (t + 1) % SETTLE_EVERY == 0 and t + 1 < self.get("n_estimators"):
                rows = settle(rows, f"ada{t}")
        state = {"columns": columns, "weights": weights, "how": "median"}
        combine = CombineColumns(state=state, **shared_params(self, "featuresCol", "labelCol", "predictionCol"))
        return PipelineModel([*trees, combine, DropColumns(columns=columns)])


def bag_steps() -> np.ndarray:
    """Shares of the uniform numbers with a weight of at most 0, 1 and so on."""
    return np.cumsum([math.exp(-1) / math.factorial(k) for k in range(8)])


def bag_uniform(key: Column, tree: int, seed=7) -> Column:
    size = 1 << 30
    return key_bucket(key, size, f"{seed}-bag-{tree}") / F.lit(float(size))


def poisson_weight(key: Column, tree: int, seed=7) -> Column:
    """Bootstrap weight of a row in a tree: Poisson(1) by the hash of key and tree."""
    u = bag_uniform(key, tree, seed)
    return add_up([F.when(u >= F.lit(float(s)), 1.0).otherwise(0.0) for s in bag_steps()])


class GrownTree(FittedRegressor):
    """The value that a row reaches in one grown tree."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        tree = self.get("state")["tree"]

        @F.arrow_udf("double")
        def value(x: pa.Array) -> pa.Array:
            if not len(x):
                return pa.array([], pa.float64())
            route = Routes(tree)
            return pa.array(route.value[route.leaves(list_matrix(x))])

        return dataset.withColumn(self.getPredictionCol(), value(vector_to_array(F.col(self.getFeaturesCol()))))


class BaggedTrees(Regressor):
    """Bagged trees that know which rows each tree has not seen. Every feature is a number.

    All trees grow together, a scan for each level. The hashes that weigh the rows are worked out once,
    and written with the rows where there is more than one level.
    """

    n_estimators = whole("n_estimators")
    max_features = number("max_features")
    max_depth = whole("max_depth")
    min_rows = whole("min_rows")
    maxBins = whole("maxBins")
    keyCol = text("keyCol")
    seed = whole("seed")
    parallelism = whole("parallelism", "of no effect: all trees share their scans")
    defaults = {"n_estimators": 10, "max_features": 1.0, "max_depth": 5, "min_rows": 1, "maxBins": 32, "seed": 7,
                "parallelism": 2}

    def _fit(self, dataset):
        count, seed = self.get("n_estimators"), self.get("seed")
        label = F.col(self.getLabelCol()).cast("double")
        missing = F.raise_error(F.lit("a row has no label")).cast("double")
        rows = dataset.select(
            vector_to_array(F.col(self.getFeaturesCol())).alias("x"),
            F.when(label.isNull() | F.isnan(label), missing).otherwise(label).alias("y"),
            F.array(*[poisson_weight(F.col(self.get("keyCol")), t, seed) for t in range(count)]).alias("w"),
        )
        if self.get("max_depth") > 1:
            rows = settle(rows, "bag")
        features = vector_size(dataset, self.getFeaturesCol())
        tries = features if subset(self.get("max_features")) == "all" else math.ceil(self.get("max_features") * features)
        grower = BestSplits(
            trees=count, tries=max(1, tries), bins=self.get("maxBins"), min_leaf=self.get("min_rows"),
            max_depth=self.get("max_depth"), seed=seed,
        )
        shared = shared_params(self, "featuresCol", "labelCol")
        trees = [
            GrownTree(state={"tree": tree.state()}, predictionCol=f"_{self.uid}_p{t}", **shared)
            for t, tree in enumerate(grower.grow(rows, features, dataset.count()))
        ]
        columns = [t.getPredictionCol() for t in trees]
        state = {"columns": columns, "weights": [1.0] * len(columns), "how": "mean"}
        combine = CombineColumns(state=state, predictionCol=self.getPredictionCol(), **shared)
        return PipelineModel([*trees, combine, DropColumns(columns=columns)])

    def oob_predictions(self, model: PipelineModel, dataset: DataFrame, out="oob_prediction") -> DataFrame:
        """Mean prediction of the trees that did not draw the row; NULL if all did."""
        trees = [t.get("state")["tree"] for t in model.stages[:-2]]
        key, seed, least = F.col(self.get("keyCol")), self.get("seed"), float(bag_steps()[0])

        @F.arrow_udf("double")
        def judged(x: pa.Array, drawn: pa.Array) -> pa.Array:
            if not len(x):
                return pa.array([], pa.float64())
            rows, numbers = list_matrix(x), drawn.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            total, judges = np.zeros(len(rows)), np.zeros(len(rows))
            for tree, number in zip(trees, numbers.T):
                route, unseen = Routes(tree), number < least
                total += np.where(unseen, route.value[route.leaves(rows)], 0.0)
                judges += unseen
            return pa.array(total / np.maximum(judges, 1), mask=judges == 0)

        # a row without key weighs nothing in any tree
        drawn = F.array(*[F.coalesce(bag_uniform(key, t, seed), F.lit(0.0)) for t in range(len(trees))])
        return dataset.withColumn(out, judged(vector_to_array(F.col(self.getFeaturesCol())), drawn))

    def oob_score(self, model: PipelineModel, dataset: DataFrame) -> float:
        """R2 of the out-of-bag predictions."""
        rows = self.oob_predictions(model, dataset).filter("oob_prediction is not null")
        return rows.agg(r2(F.col(self.getLabelCol()), F.col("oob_prediction")).alias("s")).first()["s"]


def tree_splits(model) -> list[tuple[int, float]]:
    """(feature, threshold) of the root split of every tree of a fitted model."""
    out = []
    for tree in getattr(model, "trees", [model]):
        root = tree._call_java("rootNode")
        if root.getClass().getSimpleName() == "InternalNode":
            out.append((root.split().featureIndex(), root.split().threshold()))
    return out
