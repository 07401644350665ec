"""Score cards, leaderboards and the report of a training run."""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.functions.metrics import r2, rmsle
from lathework.operators.resample import cross_validate, fold_statistics, grid_search
from lathework.operators.screen import outlier_rows


def score_card(scored: DataFrame, split="split", label="label", prediction="prediction") -> DataFrame:
    """Log error and explained variance per split, in one aggregate."""
    y, p = c(label), c(prediction)
    return scored.groupBy(c(split).alias("split")).agg(
        F.count(F.lit(1)).alias("rows"), rmsle(y, p).alias("rmsle"), r2(y, p).alias("r2")
    )


def print_score(model, train: DataFrame, valid: DataFrame, label="label", oob=None) -> list[float]:
    """``[rmsle train, rmsle valid, r2 train, r2 valid]`` and the out-of-bag score if there is one."""
    both = model.transform(train).select(F.lit("train").alias("split"), label, "prediction").unionByName(
        model.transform(valid).select(F.lit("valid").alias("split"), label, "prediction")
    )
    rows = {r["split"]: r for r in score_card(both, label=label).collect()}
    out = [rows["train"]["rmsle"], rows["valid"]["rmsle"], rows["train"]["r2"], rows["valid"]["r2"]]
    return out + [oob] if oob is not None else out


def leaderboard(entries: DataFrame, board: DataFrame | None = None) -> DataFrame:
    """Entries ``(model, mean, std)`` added to a board, smallest error first."""
    entries = entries.select("model", "mean", "std")
    both = entries if board is None else board.select("model", "mean", "std").unionByName(entries)
    return both.orderBy("mean", "model")


def train_report(estimator: Estimator, df: DataFrame, key: str, sigma=3.0, metric="rmsle", folds=10, label="label",
                 grid=None) -> dict:
    """Fitted model, fold scores with mean and deviation, grid results, and outlier rows.

    Outliers are rows whose residual is beyond ``sigma`` deviations under the fitted model.
    """
    results = None
    if grid:
        results, model = grid_search(estimator, grid, df, key, folds, metric, label)
        estimator = estimator.copy({p: model.getOrDefault(p.name) for p in grid[0] if model.hasParam(p.name)})
    else:
        model = estimator.fit(df)
    scores = cross_validate(estimator, df, key, folds, metric=metric, label=label)
    residual = F.col(label) - F.col("prediction")
    return {
        "model": model, "cv": fold_statistics(scores), "scores": scores, "grid": results,
        "outliers": outlier_rows(model.transform(df), residual, sigma),
    }
