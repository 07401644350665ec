"""Error measures as column and aggregate expressions."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def log1p_sq_err(y: Column, p: Column) -> Column:
    """``(log(1+p) - log(1+y))**2``; NULL where either value is -1 or less or missing."""
    return F.pow(F.log1p(p) - F.log1p(y), 2)


def invalid_pair(y: Column, p: Column) -> Column:
    """True where the log error of a row does not exist, so that ``avg`` would lose the row."""
    return F.coalesce(log1p_sq_err(y, p).isNull() | F.isnan(log1p_sq_err(y, p)), F.lit(True))


def rmsle(y: Column, p: Column, on_invalid="inf") -> Column:
    """Aggregate: root mean squared log error.

    ``on_invalid='inf'`` scores a set +inf, and ``'raise'`` fails the job, when some row has
    no log error or when labels *and* predictions both hold a negative value. An empty set
    has no score.
    """
    bad = F.count_if(invalid_pair(y, p))
    both_negative = (F.count_if(y < 0) > 0) & (F.count_if(p < 0) > 0)
    if on_invalid == "inf":
        worst = F.lit(float("inf"))
    elif on_invalid == "raise":
        worst = F.raise_error(F.lit("log error is not defined for these values")).cast("double")
    else:
        raise ValueError("on_invalid is 'inf' or 'raise'")
    return F.when((bad > 0) | both_negative, worst).otherwise(F.sqrt(F.avg(log1p_sq_err(y, p))))


def r2(y: Column, p: Column) -> Column:
    """Aggregate: share of the label's variance that the prediction explains; NULL if it has none."""
    return 1.0 - F.try_divide(F.sum(F.pow(y - p, 2)), F.var_pop(y) * F.count(y))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg(F.pow(y - p, 2)))


METRICS = {"rmsle": (rmsle, False), "rmse": (rmse, False), "r2": (r2, True)}


def score(df: DataFrame, aggregate, label="label", prediction="prediction") -> float:
    """One scalar from one aggregate job; an empty set scores NaN."""
    value = df.agg(aggregate(F.col(label), F.col(prediction)).alias("s")).first()["s"]
    return float("nan") if value is None else float(value)


class ColumnScorer(Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Evaluator for cross-validation tools, from the name of an aggregate in ``METRICS``.

    With ``negated`` the sign is turned, so that a loss can be maximised.
    """

    metric = Param(Params._dummy(), "metric", "name in METRICS", TypeConverters.toString)
    negated = Param(Params._dummy(), "negated", "flip the sign", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, metric="rmsle", negated=False, labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(metric="rmsle", negated=False, labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset):
        aggregate, _ = METRICS[self.getOrDefault(self.metric)]
        value = score(dataset, aggregate, self.getLabelCol(), self.getPredictionCol())
        return -value if self.getOrDefault(self.negated) else value

    def isLargerBetter(self):
        return METRICS[self.getOrDefault(self.metric)][1] != self.getOrDefault(self.negated)
