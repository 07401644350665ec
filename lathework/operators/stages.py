"""Base classes: estimators and fitted models that compose in ``pyspark.ml`` pipelines.

A fitted model keeps its numbers in one JSON-able param, so ``PipelineModel.save`` and
``load`` work on it like on the built-in stages.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number(name, doc=""):
    return Param(Params._dummy(), name, doc, TypeConverters.toFloat)


def whole(name, doc=""):
    return Param(Params._dummy(), name, doc, TypeConverters.toInt)


def text(name, doc=""):
    return Param(Params._dummy(), name, doc, TypeConverters.toString)


def switch(name, doc=""):
    return Param(Params._dummy(), name, doc, TypeConverters.toBoolean)


def numbers(name, doc=""):
    return Param(Params._dummy(), name, doc, TypeConverters.toListFloat)


class Configured(Params):
    """Keyword constructor over class-level params and ``defaults``."""

    defaults: dict = {}

    def __init__(self, **values):
        super().__init__()
        merged = {}
        for cls in reversed(type(self).__mro__):
            merged.update(cls.__dict__.get("defaults", {}))
        self._setDefault(**merged)
        self._set(**values)

    def get(self, name):
        return self.getOrDefault(self.getParam(name))


class VectorEstimator(Configured, Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Learns a map from one vector column to another."""

    defaults = {"inputCol": "features", "outputCol": "transformed"}


class Regressor(Configured, Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable,
                DefaultParamsWritable):
    """Learns a number from a vector column."""

    defaults = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}


class FittedVector(Configured, Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted vector map: subclasses give the output array from the input array."""

    state = Param(Params._dummy(), "state", "fitted numbers")
    defaults = {"inputCol": "features", "outputCol": "transformed"}

    def map_array(self, x: Column, state: dict) -> Column:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.map_array(vector_to_array(F.col(self.getInputCol())), self.get("state"))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(out))


class FittedRegressor(Configured, Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable,
                      DefaultParamsWritable):
    state = Param(Params._dummy(), "state", "fitted numbers")
    defaults = {"featuresCol": "features", "labelCol": "label", "predictionCol": "prediction"}


class LinearModel(FittedRegressor):
    """Prediction as a sum of products, inside whole-stage code generation."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self.get("state")
        return dataset.withColumn(
            self.getPredictionCol(), linear(F.col(self.getFeaturesCol()), state["coef"], state["intercept"])
        )


def linear(vector: Column, coef, intercept) -> Column:
    x = vector_to_array(vector)
    out = F.lit(float(intercept))
    for i, w in enumerate(coef):
        if w:
            out = out + x[i] * F.lit(float(w))
    return out


def matrix_function(fn):
    """Arrow-batched function on the matrix of a batch of arrays."""

    @F.arrow_udf("array<double>")
    def apply(x: pa.Array) -> pa.Array:
        if not len(x):
            return x
        out = np.ascontiguousarray(fn(list_matrix(x)), dtype="float64")
        starts = np.arange(len(out) + 1, dtype="int32") * out.shape[1]
        return pa.ListArray.from_arrays(pa.array(starts), pa.array(out.ravel()))

    return apply


def list_matrix(x: pa.Array) -> np.ndarray:
    """Rows of an Arrow list array as a matrix, without a copy."""
    if x.null_count:
        raise ValueError("a row has no vector")
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def shared_params(stage, *names) -> dict:
    return {n: stage.getOrDefault(n) for n in names}


class DropColumns(Configured, Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Removes helper columns at the end of a fitted composite."""

    columns = Param(Params._dummy(), "columns", "names to drop", TypeConverters.toListString)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.get("columns"))
