"""Column and group statistics. Everything about all columns comes out of one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c, long_form, numeric_columns, one_row_per
from lathework.operators.project import is_missing
from lathework.operators.tiles import correlation_tiles


def dtype_groups(df: DataFrame) -> DataFrame:
    """Column names per type."""
    groups: dict[str, list[str]] = {}
    for name, kind in df.dtypes:
        groups.setdefault(kind, []).append(name)
    return df.sparkSession.createDataFrame(
        [(k, v) for k, v in sorted(groups.items())], "dtype string, columns array<string>"
    )


def row_counts(df: DataFrame, by="origin") -> DataFrame:
    return df.groupBy(c(by)).agg(F.count(F.lit(1)).alias("rows"))


def null_profile_by_group(df: DataFrame, column: str, group: str) -> DataFrame:
    """Rows with a missing value per group, largest first, ties by group."""
    return (
        df.filter(is_missing(df, column)).groupBy(c(group)).agg(F.count(F.lit(1)).alias("missing"))
        .orderBy(F.desc("missing"), c(group))
    )


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """Missing count and share of every column."""
    names = list(columns or df.columns)
    at = {n: f"m{i}" for i, n in enumerate(names)}
    wide = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(is_missing(df, n)).alias(at[n]) for n in names]
    )
    return wide.select("n", one_row_per(names, missing=lambda n: F.col(at[n])).alias("p")).select(
        "p.column", "p.missing", (F.col("p.missing") / F.col("n")).alias("share")
    )


def zero_share(df: DataFrame, columns=None) -> DataFrame:
    """Share of zeros per numeric column; missing rows count in the denominator only."""
    names = list(columns or numeric_columns(df))
    at = {n: f"z{i}" for i, n in enumerate(names)}
    wide = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(c(n) == 0).alias(at[n]) for n in names]
    )
    return wide.select("n", one_row_per(names, zeros=lambda n: F.col(at[n])).alias("p")).select(
        "p.column", "p.zeros", (F.col("p.zeros") / F.col("n")).alias("share")
    )


def group_mean(df: DataFrame, group: str, column: str) -> DataFrame:
    return df.groupBy(c(group)).agg(F.avg(c(column)).alias("mean"))


def value_counts(df: DataFrame, columns=None) -> DataFrame:
    """``(column, value, count)`` of all columns with one shuffle of pre-counted values."""
    names = list(columns or df.columns)
    return (
        long_form(df, names, cast="string", name="column").groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def column_profile(df: DataFrame, columns=None, exact=True, category_levels=20, key=None, target=None) -> DataFrame:
    """Type, row count, cardinality and role of every column.

    Roles: ``key`` and ``target`` as named, ``constant``, ``binary``, ``category`` for strings
    and for numbers of at most ``category_levels`` values, else ``numeric``. The exact
    cardinality shuffles pre-counted values; ``exact=False`` uses one scan of sketches.
    """
    names = list(columns or df.columns)
    types = dict(df.dtypes)
    numbers = set(numeric_columns(df))
    if exact:
        counted = value_counts(df, names).groupBy("column").agg(
            F.sum("count").alias("rows"),
            F.sum(F.when(F.col("value").isNull(), F.col("count")).otherwise(0)).alias("missing"),
            F.count("value").alias("cardinality"),
        )
    else:
        at = {n: f"d{i}" for i, n in enumerate(names)}
        wide = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.approx_count_distinct(c(n)).alias(at[n]) for n in names],
            *[F.count(c(n)).alias("n" + at[n]) for n in names],
        )
        counted = wide.select(
            "rows",
            one_row_per(names, cardinality=lambda n: F.col(at[n]), filled=lambda n: F.col("n" + at[n])).alias("p"),
        ).select("p.column", "rows", (F.col("rows") - F.col("p.filled")).alias("missing"), "p.cardinality")
    kinds = F.create_map(*[F.lit(x) for n in names for x in (n, types[n])])
    is_number = F.col("column").isin([n for n in names if n in numbers])
    role = (
        F.when(F.col("column") == F.lit(key), "key").when(F.col("column") == F.lit(target), "target")
        .when(F.col("cardinality") <= 1, "constant").when(F.col("cardinality") == 2, "binary")
        .when(is_number & (F.col("cardinality") > category_levels), "numeric").otherwise("category")
    )
    return counted.select(
        "column", F.element_at(kinds, F.col("column")).alias("dtype"), "rows", "missing", "cardinality",
        role.alias("role"),
    )


def define_vars(profile: DataFrame) -> dict[str, list[str]]:
    """Column names per role, from a column profile (one row per column)."""
    out: dict[str, list[str]] = {}
    for row in profile.select("column", "role").collect():
        out.setdefault(row["role"], []).append(row["column"])
    return {k: sorted(v) for k, v in out.items()}


def pearson_matrix(df: DataFrame, columns=None) -> DataFrame:
    """``(a, b, r)`` for all ordered pairs of numeric columns; constant columns have no r.

    Each pair uses the rows in which both columns have a value. Sums of values, squares and
    products of every pair come from one scan up to 512 columns, and from a scan for every five
    tiles of 512 x 512 pairs beyond; a column that is constant over the rows of a pair has no r in
    that pair.
    """
    return correlation_tiles(df, columns or numeric_columns(df))


def correlation(x: Column, y: Column) -> Column:
    """Aggregate: Pearson correlation of rows with both values; NULL if one is constant.

    The built-in aggregate divides by zero on a constant, which is an error in ANSI mode.
    """
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), spread)


def target_correlation(df: DataFrame, label: str, columns=None) -> DataFrame:
    """Correlation of every feature with the label, strongest first; one scan, JVM only."""
    names = list(columns or numeric_columns(df, exclude=(label,)))
    at = {n: f"r{i}" for i, n in enumerate(names)}
    y = c(label).cast("double")
    wide = df.agg(*[correlation(c(n).cast("double"), y).alias(at[n]) for n in names])
    out = wide.select(one_row_per(names, r=lambda n: F.col(at[n])).alias("p")).select("p.column", "p.r")
    return out.filter(F.col("r").isNotNull() & ~F.isnan("r")).orderBy(F.desc(F.abs("r")), "column")


def metric_mean_std(scores: DataFrame, by="model", value="score") -> DataFrame:
    """Mean and population standard deviation of fold scores."""
    return scores.groupBy(c(by)).agg(
        F.avg(c(value)).alias("mean"), F.stddev_pop(c(value)).alias("std"), F.count(c(value)).alias("folds")
    )
