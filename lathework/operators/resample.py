"""Splits by key hash and the loops that score models over them.

A hash of the key gives the same split under any partitioning and needs no shuffle.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lathework.functions.columns import add_up, c, key_bucket
from lathework.functions.metrics import METRICS, ColumnScorer, r2, rmsle
from lathework.operators.combine import join_statistics
from lathework.operators.linear import ridge_coefficients
from lathework.operators.gram import Moments, moments, numeric_rows, pooled
from lathework.operators.trees import in_parallel

RANK_ROWS = 100_000


def split_label(key: Column, valid_percent=25, seed=0) -> Column:
    return F.when(key_bucket(key, 100, f"split{seed}") < valid_percent, "valid").otherwise("train")


def train_valid_split(df: DataFrame, key: str, valid_percent=25, seed=0) -> tuple[DataFrame, DataFrame]:
    valid = key_bucket(c(key), 100, f"split{seed}") < valid_percent
    return df.filter(~valid), df.filter(valid)


def fold_column(key: Column, folds: int, repeat=0) -> Column:
    return key_bucket(key, folds, repeat)


def kfold(df: DataFrame, key: str, folds: int, repeat=0, exact=False, rank_rows=RANK_ROWS) -> DataFrame:
    """``fold`` by key hash. Sizes are near equal, with ``exact`` at most one apart.

    Exact folds number the rows in hash order: inside hash buckets of bounded size, plus the
    count of all buckets before, so no task ever orders the whole table.
    """
    if not exact:
        return df.withColumn("fold", fold_column(c(key), folds, repeat))
    buckets = max(1, math.ceil(df.count() / rank_rows))
    placed = df.withColumn("_b", key_bucket(c(key), buckets, f"rank{repeat}"))
    # One row per bucket of rank_rows rows: the running sum is over that short table.
    sizes = placed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_b", before.alias("_before"))
    order = W.partitionBy("_b").orderBy(F.md5(F.concat(F.lit(f"{repeat}-"), c(key).cast("string"))), c(key))
    numbered = placed.withColumn("_r", F.row_number().over(order))
    numbered = join_statistics(numbered, offsets, "_b")
    fold = F.pmod(F.col("_before") + F.col("_r") - 1, F.lit(folds))
    return numbered.select(*[c(n) for n in df.columns], fold.cast("bigint").alias("fold"))


def repeated_kfold(df: DataFrame, key: str, folds=10, repeats=5) -> DataFrame:
    """Every row once per repeat, with its fold there; an explode, not a join."""
    out = df.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    digest = F.md5(F.concat(F.col("repeat").cast("string"), F.lit("-"), c(key).cast("string")))
    fold = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(folds))
    return out.withColumn("fold", fold)


def cross_validate(estimator: Estimator, df: DataFrame, key: str, folds=10, repeats=1, metric="rmsle",
                   label="label", prediction="prediction", parallelism=2) -> DataFrame:
    """``(repeat, fold, rows, score)``: fit on the other folds, score on the fold.

    The input should be cached by the caller: every fit reads it.
    """
    aggregate = METRICS[metric][0] if isinstance(metric, str) else metric

    def one(item):
        repeat, fold = item
        mark = fold_column(c(key), folds, repeat)
        fitted = estimator.fit(df.filter(mark != fold))
        row = fitted.transform(df.filter(mark == fold)).agg(
            F.count(F.lit(1)).alias("n"), aggregate(F.col(label), F.col(prediction)).alias("s")
        ).first()
        return repeat, fold, row["n"], row["s"]

    items = [(r, f) for r in range(repeats) for f in range(folds)]
    rows = in_parallel(df.sparkSession, one, items, parallelism)
    return df.sparkSession.createDataFrame(rows, "repeat int, fold int, rows long, score double")


def linear_cross_validate(df: DataFrame, features, label: str, fold: Column, ridge=0.0) -> DataFrame:
    """Fold scores of a linear model in two scans.

    The cross products of every fold come from one scan; the training side of a fold is the
    total minus the fold. The second scan predicts each row with its fold's coefficients and
    aggregates per fold.
    """
    columns = [c(n) for n in features]
    parts = moments(df, [*columns, c(label)], group=fold, on_missing="raise")
    everything = pooled(parts)
    fits = {f: ridge_coefficients(everything - m, ridge) for f, m in parts.items()}
    marked = df.withColumn("fold", fold.cast("bigint"))

    def by_fold(values: dict) -> Column:
        pairs = [F.lit(x) for k, v in sorted(values.items()) for x in (int(k), float(v))]
        return F.element_at(F.create_map(*pairs).cast("map<bigint,double>"), F.col("fold"))

    p = by_fold({f: b for f, (_, b) in fits.items()})
    for i, col in enumerate(columns):
        p = p + by_fold({f: w[i] for f, (w, _) in fits.items()}) * col
    y = c(label)
    return marked.withColumn("_p", p).groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), rmsle(y, F.col("_p")).alias("rmsle"), r2(y, F.col("_p")).alias("r2")
    )


def grid_search(estimator: Estimator, grid, df: DataFrame, key: str, folds=3, metric="rmsle", label="label",
                parallelism=2) -> tuple[DataFrame, object]:
    """Exhaustive grid with the built-in cross-validator over hashed folds.

    Returns ``(params, mean, std)`` best first, and the model refitted with the best params.
    """
    scorer = ColumnScorer(metric=metric, labelCol=label)
    marked = df.withColumn("fold", fold_column(c(key), folds).cast("int"))
    search = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=scorer, numFolds=folds, foldCol="fold",
        parallelism=parallelism,
    ).fit(marked)
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda item: item[0].name)), float(a), float(s))
        for m, a, s in zip(grid, search.avgMetrics, search.stdMetrics)
    ]
    table = df.sparkSession.createDataFrame(rows, "params string, mean double, std double")
    best_first = F.desc("mean") if scorer.isLargerBetter() else F.asc("mean")
    return table.orderBy(best_first, "params"), search.bestModel


def learning_curve(estimator: Estimator, df: DataFrame, key: str, shares=(0.1, 0.33, 0.55, 0.78, 1.0),
                   valid_percent=25, metric="rmsle", label="label", prediction="prediction") -> DataFrame:
    """Training and validation score against training size; smaller sets are inside larger ones."""
    aggregate = METRICS[metric][0]
    train, valid = train_valid_split(df, key, valid_percent)
    rows = []
    for share in shares:
        part = train.filter(share_of(c(key)) < int(round(share * 10_000)))
        fitted = estimator.fit(part)

        def measure(side, fitted=fitted):
            return fitted.transform(side).agg(
                F.count(F.lit(1)).alias("n"), aggregate(F.col(label), F.col(prediction)).alias("s")
            ).first()

        a, b = measure(part), measure(valid)
        rows.append((float(share), a["n"], a["s"], b["s"]))
    return df.sparkSession.createDataFrame(
        rows, "share double, train_rows long, train_score double, valid_score double"
    )


def linear_curves(df: DataFrame, features, label: str, key: str, shares=(0.1, 0.33, 0.55, 0.78, 1.0), folds=5,
                  repeat=0, ridge=0.0) -> DataFrame:
    """Scores of a linear model for every training share and every fold, from one scan.

    ``share, fold, train_rows, valid_rows, train_r2, valid_r2, train_rmse, valid_rmse``. Cross products
    are summed once by fold and hash slice. A training set is the slices up to its share of all folds
    but one, so smaller sets lie inside larger ones, and shares of 1 alone are a cross-validation.
    Residual squares follow from the same products, so no row is scored. Where a side has no rows
    its scores are missing; a row that misses a value is an error.
    """
    shares = sorted(float(s) for s in shares)
    cuts = [int(round(s * 10_000)) for s in shares]
    columns = [*[c(n) for n in features], c(label)]
    at = share_of(c(key))
    piece = add_up([F.when(at >= F.lit(cut), 1).otherwise(0) for cut in cuts])
    group = fold_column(c(key), folds, repeat) * (len(cuts) + 1) + piece
    # Near the means, so that sums stay exact; ``take`` reads as few partitions as it can.
    first = numeric_rows(df, columns).take(1000)
    centre = np.nan_to_num(np.array([r["x"] for r in first], dtype=float)).mean(axis=0) if first else np.zeros(len(columns))
    parts = moments(df, columns, centre=centre, group=group, on_missing="raise")

    def together(pick):
        own = [m for g, m in parts.items() if pick(*divmod(g, len(cuts) + 1))]
        return pooled(dict(enumerate(own))) if own else None

    rows = []
    for i, share in enumerate(shares):
        for fold in range(folds):
            train = together(lambda f, s: f != fold and s <= i)
            valid = together(lambda f, s: f == fold)
            fit = ridge_coefficients(train, ridge) if train else None
            a, b = (_linear_scores(m, *fit) if m and fit else (None, None) for m in (train, valid))
            sizes = [int(m.n) if m else 0 for m in (train, valid)]
            rows.append((share, fold, *sizes, a[0], b[0], a[1], b[1]))
    return df.sparkSession.createDataFrame(
        rows, "share double, fold int, train_rows long, valid_rows long, train_r2 double, valid_r2 double, "
        "train_rmse double, valid_rmse double",
    )


def _linear_scores(m: Moments, coef, intercept) -> tuple[float | None, float]:
    """R2 (missing where the label is constant) and root mean squared error of a linear fit on summed rows."""
    weights = np.append(-np.asarray(coef, dtype=float), 1.0)
    off = float(intercept) - weights @ m.mean
    squares = max(0.0, float(weights @ m.scatter @ weights) + m.n * off * off)
    spread = m.scatter[-1, -1]
    return (float(1 - squares / spread) if spread > 0 else None), math.sqrt(squares / m.n)


def share_of(key: Column) -> Column:
    return key_bucket(key, 10_000, "curve")


def fold_statistics(scores: DataFrame) -> dict:
    """Mean and population deviation of fold scores."""
    row = scores.agg(F.avg("score").alias("m"), F.stddev_pop("score").alias("s")).first()
    return {"mean": row["m"], "std": row["s"]}

