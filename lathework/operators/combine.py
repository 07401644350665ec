"""Stacking tables, lining up a target, and lookups of fitted statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c


def concat_tables(tables: dict[str, DataFrame], origin="origin") -> DataFrame:
    """Stack tables; columns missing in one become NULL, ``origin`` says where a row came from."""
    out = None
    for label, df in tables.items():
        df = df.withColumn(origin, F.lit(label))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def align_target(features: DataFrame, target: DataFrame, key: str, check=False) -> DataFrame:
    """Features with their target by key. ``check`` fails on lost or doubled rows."""
    if check:
        sides = (
            features.select(c(key), F.lit(1).alias("f"), F.lit(0).alias("t"))
            .unionAll(target.select(c(key), F.lit(0).alias("f"), F.lit(1).alias("t")))
            .groupBy(c(key)).agg(F.sum("f").alias("f"), F.sum("t").alias("t"))
            .agg(F.count_if((F.col("f") != 1) | (F.col("t") != 1)).alias("bad")).first()
        )
        if sides["bad"]:
            raise ValueError(f"{sides['bad']} keys are not one to one between features and target")
    return features.join(target, key, "inner")


def broadcast_if_small(stats: DataFrame, limit_rows=None) -> DataFrame:
    """``stats`` as it is: adaptive execution decides on a broadcast from its measured size."""
    return stats


def join_statistics(df: DataFrame, stats: DataFrame, on, limit_rows=None) -> DataFrame:
    """Left join of a table with one row of statistics per group.

    Adaptive execution broadcasts the statistics if their measured size allows it, and splits
    hot groups where it does not, so ``limit_rows``, which callers may still pass, has no part.
    """
    return df.join(stats, [on] if isinstance(on, str) else list(on), "left")


def feature_union(df: DataFrame, branches, out="features") -> DataFrame:
    """Run fitted branches side by side on the same rows and join their output vectors.

    ``branches`` holds pairs of a transformer and the name of the vector it writes.
    """
    from pyspark.ml.feature import VectorAssembler

    kept = list(df.columns)
    names = []
    for stage, name in branches:
        df = stage.transform(df)
        names.append(name)
    df = VectorAssembler(inputCols=names, outputCol="_union").transform(df)
    return df.select(*[c(n) for n in kept if n != out], F.col("_union").alias(out))
