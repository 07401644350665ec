"""The four flows from raw tables to results."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c, numeric_columns
from lathework.functions.metrics import rmsle
from lathework.operators.combine import concat_tables
from lathework.operators.encode import Dummies, assemble
from lathework.operators.famd import MixedFactors, famd_fit
from lathework.operators.generate import Evolved, evolve_features
from lathework.operators.impute import ChainedImputer, GroupMean, fill_rules
from lathework.operators.linear import LassoCV, LinearBaseline
from lathework.operators.project import (
    drop_cols, drop_matching, drop_target, null_filter, patch_cells, recast_code, select_columns, split_by_origin,
)
from lathework.operators.resample import fold_column, train_valid_split
from lathework.operators.screen import drop_mostly_zero, near_zero_columns, outlier_rows
from lathework.operators.transforms import MinMaxScaler, StackingFeature
from lathework.operators.trees import ExtraTrees, gradient_boosting, random_forest
from lathework.plans import house_values as V


def clean_houses(train: DataFrame, test: DataFrame, selected=V.SELECTED, fit_on="train") -> dict:
    """Fill, patch, impute and encode the house-price tables.

    ``fit_on`` is ``train``, or ``all`` for group means over both tables and an imputer per
    table. The vocabulary of the dummies always comes from the training rows.
    """
    _, target = drop_target(train, "SalePrice", "Id")
    both = drop_cols(concat_tables({"train": train, "test": test}), ["SalePrice"])
    both = fill_rules(both, {**{n: "None" for n in V.ABSENT}, **{n: 0 for n in V.ZERO}})
    base = both if fit_on == "all" else both.filter(F.col("origin") == "train")
    both = GroupMean("Neighborhood", "GarageYrBlt").fit(base).transform(both)
    both = drop_cols(patch_cells(both.withColumn("_label", c("Id") - 1), "_label", V.PATCHES), ["_label"])
    both = recast_code(both, "MSSubClass")
    parts = split_by_origin(both)
    numeric = numeric_columns(parts[0], exclude=("Id",))
    first = ChainedImputer(numeric).fit(parts[0])
    models = [first, ChainedImputer(numeric).fit(parts[1]) if fit_on == "all" else first]
    filled = [_only(m, df, "LotFrontage") for m, df in zip(models, parts)]
    words = Dummies().fit(filled[0])
    wide = [drop_cols(select_columns(words.transform(df), ["Id", *selected]), V.REMOVE) for df in filled]
    return {"train": wide[0], "test": wide[1], "target": target, "levels": words.levels}


def _only(model: ChainedImputer, df: DataFrame, column: str) -> DataFrame:
    """Take one imputed column, leave the other numbers as they were."""
    spare = {n: f"_own_{i}" for i, n in enumerate(model.columns) if n != column}
    filled = model.transform(df.select("*", *[c(n).alias(s) for n, s in spare.items()]))
    return filled.select(*[c(spare[n]).alias(n) if n in spare else c(n) for n in df.columns])


def neighborhoods_without(df: DataFrame, column="LotFrontage", group="Neighborhood") -> DataFrame:
    """Which groups lack a value, most first."""
    return null_filter(df, column).groupBy(c(group)).agg(F.count(F.lit(1)).alias("missing")).orderBy(
        F.desc("missing"), c(group)
    )


def evolve_and_fit(train: DataFrame, target: DataFrame, key="Id", label="SalePrice", learner="boosting",
                   generations=100, population=500, survivors=25, seed=7) -> tuple[Evolved, object]:
    """Generated features, chosen by a boosted or forest learner.

    The search ranks candidates by their correlation with the target. How many of the best
    different ones are kept is the learner's choice: each of a doubling ladder of counts is
    fitted on three key-hashed folds, and the smallest log error of the folds held out wins.
    """
    rows = train.join(target, key).persist()
    features = numeric_columns(rows, exclude=(key, label))
    evolved = evolve_features(rows, features, label, generations, population, survivors, seed=seed)
    stage = gradient_boosting(labelCol=label) if learner == "boosting" else random_forest(labelCol=label)
    counts = sorted({min(1 << k, len(evolved.trees)) for k in range(len(evolved.trees).bit_length() + 1)})
    best = min(counts, key=lambda n: (_fold_error(Evolved(evolved.trees[:n], []), rows, key, label, stage), n))
    chosen = Evolved(evolved.trees[:best], evolved.history, evolved.winners)
    model = stage.fit(chosen.transform(rows, keep=[key, label]))
    rows.unpersist()
    return chosen, model


def _fold_error(evolved: Evolved, rows: DataFrame, key: str, label: str, stage, folds=3) -> float:
    """Mean log error of a learner on the folds it was not fitted on; empty folds do not count."""
    data = evolved.transform(rows, keep=[key, label]).withColumn("_fold", fold_column(c(key), folds)).persist()
    errors = []
    for f in range(folds):
        held = stage.fit(data.filter(F.col("_fold") != f)).transform(data.filter(F.col("_fold") == f))
        errors.append(held.agg(rmsle(c(label), F.col("prediction")).alias("e")).first()["e"])
    data.unpersist()
    scored = [e for e in errors if e is not None]
    return sum(scored) / len(scored) if scored else float("inf")


def train_valid_test_bundle(train: DataFrame, test: DataFrame, key: str, target: str, fill=None, group_fill=None,
                            valid_percent=25, zero_cut=None, sigma=3.0, remove_outliers=True) -> dict:
    """Features and targets for training, validation and test, the raw tables, and outliers.

    ``fill`` maps columns to constants, ``group_fill`` is a pair (group, column). Outliers are
    judged by the residual of a linear model on the numeric columns of the training rows.
    """
    both = drop_cols(concat_tables({"train": train, "test": test}), [target])
    both = fill_rules(both, fill or {})
    if group_fill:
        both = GroupMean(*group_fill).fit(both.filter(F.col("origin") == "train")).transform(both)
    fit_rows, test_rows = split_by_origin(both)
    words = Dummies().fit(fit_rows)
    encoded, test_x = words.transform(fit_rows, safe=True), words.transform(test_rows, safe=True)
    labelled = encoded.join(train.select(c(key), c(target).cast("double").alias("label")), key)
    numeric = numeric_columns(labelled, exclude=(key, "label"))
    data = assemble(labelled, numeric, keep=[key, "label"])
    scored = LinearBaseline().fit(data).transform(data)
    outliers = outlier_rows(scored, F.col("label") - F.col("prediction"), sigma).select(c(key), "label", "prediction", "z")
    if remove_outliers:
        labelled = labelled.join(outliers.select(c(key)), key, "left_anti")
    train_rows, valid_rows = train_valid_split(labelled, key, valid_percent)
    xs = [drop_cols(train_rows, ["label"]), drop_cols(valid_rows, ["label"]), test_x]
    if zero_cut is not None:
        xs = drop_mostly_zero(xs[0], xs[1:], zero_cut)
    return {
        "x_train": xs[0], "x_valid": xs[1], "x_test": xs[2], "raw_test": test, "raw_train": train,
        "y_train": train_rows.select(c(key), "label"), "y_valid": valid_rows.select(c(key), "label"),
        "outliers": outliers,
    }


def stacked_regressor(trees=100, label="label", key=None, seed=7, **tree_params) -> Pipeline:
    """Scaling, a lasso prediction and a forest prediction as features, then a forest."""
    lasso = LassoCV(normalize=False, **({"keyCol": key} if key else {}))
    inner = ExtraTrees(n_estimators=trees, bootstrap=True, max_features=0.45, min_samples_leaf=8,
                       min_samples_split=15, seed=seed, **tree_params)
    last = ExtraTrees(n_estimators=trees, bootstrap=False, max_features=0.6, min_samples_leaf=1,
                      min_samples_split=11, seed=seed + 1, featuresCol="_s2", labelCol=label, **tree_params)
    return Pipeline(stages=[
        MinMaxScaler(inputCol="features", outputCol="_s0"),
        StackingFeature(estimator=lasso, inputCol="_s0", outputCol="_s1", labelCol=label),
        StackingFeature(estimator=inner, inputCol="_s1", outputCol="_s2", labelCol=label),
        last,
    ])


def predict(model, df: DataFrame, key: str, prediction="prediction") -> DataFrame:
    return model.transform(df).select(c(key), c(prediction))


def factor_report(df: DataFrame, ncp=20, freq_cut=85 / 15, drops=V.FACTOR_DROPS) -> tuple[MixedFactors, dict]:
    """Factor analysis after leaving out keys, years and columns that hardly vary."""
    flagged = near_zero_columns(df, freq_cut=freq_cut)
    model = famd_fit(drop_matching(df, [rf"^{n}$" for n in drops], flagged), ncp=ncp)
    return model, {
        "eigenvalues": model.eigenvalues(), "scree": model.scree(), "variables": model.variables(),
        "contributions": model.contributions((1, 2, 3)),
    }
