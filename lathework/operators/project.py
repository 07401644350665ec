"""Projection, filters, type partition and single-cell patches."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c, numeric_columns, string_columns


def select_columns(df: DataFrame, names) -> DataFrame:
    """Ordered projection; an unknown name is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"not in the table: {missing}")
    return df.select(*[c(n) for n in names])


def drop_cols(df: DataFrame, names) -> DataFrame:
    """Drop by name, keep the order of the rest, ignore unknown names."""
    gone = set(names)
    return df.select(*[c(n) for n in df.columns if n not in gone])


def drop_target(df: DataFrame, target: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Features without the target, and the target by key."""
    return drop_cols(df, [target]), df.select(c(key), c(target))


def drop_matching(df: DataFrame, patterns, names=()) -> DataFrame:
    """Drop columns whose name matches any of the patterns or is in ``names``."""
    if isinstance(patterns, str):
        patterns = [patterns]
    gone = {n for n in df.columns if any(re.search(p, n) for p in patterns)} | set(names)
    return drop_cols(df, gone)


def select_dtypes(df: DataFrame, kind="numeric", exclude=()) -> DataFrame:
    pick = {"numeric": numeric_columns, "string": string_columns}[kind]
    return df.select(*[c(n) for n in pick(df, exclude)])


def patch_cells(df: DataFrame, key: str, patches) -> DataFrame:
    """Overwrite single cells given as ``(key, column, value)``; the last write wins.

    A list of patches becomes one literal map per column: no join, no shuffle. A DataFrame
    of patches ``(key, column, value, seq)`` is reduced to one row per key and joined.
    Keys that are not in the table change nothing: see :func:`unmatched_patches`.
    """
    if isinstance(patches, DataFrame):
        return _patch_from_table(df, key, patches)
    types = dict(df.dtypes)
    per_column: dict[str, dict] = {}
    for row_key, column, value in patches:
        if column not in types:
            raise KeyError(f"not in the table: {column!r}")
        per_column.setdefault(column, {})[row_key] = value

    def patched(name: str) -> Column:
        if name not in per_column:
            return c(name)
        pairs = [F.lit(x) for item in per_column[name].items() for x in item]
        new = F.try_element_at(F.create_map(*pairs), c(key))
        return F.coalesce(new.cast(types[name]), c(name)).alias(name)

    return df.select(*[patched(n) for n in df.columns])


def _patch_from_table(df: DataFrame, key: str, patches: DataFrame) -> DataFrame:
    types = dict(df.dtypes)
    columns = [r["column"] for r in patches.select("column").distinct().collect()]
    unknown = [n for n in columns if n not in types]
    if unknown:
        raise KeyError(f"not in the table: {unknown}")
    # Aggregates per target column avoid a pivot and keep partial aggregation on the map side.
    # The key is unique after this, so the join cannot multiply rows.
    last = patches.groupBy(F.col("key").alias("_patch_key")).agg(
        *[
            F.max_by(F.when(F.col("column") == n, F.col("value")),
                     F.when(F.col("column") == n, F.col("seq"))).alias(f"_patch_{i}")
            for i, n in enumerate(columns)
        ]
    )
    where = {n: f"_patch_{i}" for i, n in enumerate(columns)}
    joined = df.join(last, c(key) == F.col("_patch_key"), "left")
    return joined.select(
        *[
            F.coalesce(F.col(where[n]).cast(types[n]), c(n)).alias(n) if n in where else c(n)
            for n in df.columns
        ]
    )


def unmatched_patches(df: DataFrame, key: str, patches: DataFrame) -> DataFrame:
    """Patches whose key is not in the table."""
    # The table is the large side: keep only its keys that are patched before the anti join.
    keys = patches.select("key").distinct()
    present = df.select(c(key).alias("key")).join(keys, "key", "left_semi").distinct()
    return patches.join(present, "key", "left_anti")


def split_by_origin(df: DataFrame, labels=("train", "test"), origin="origin") -> list[DataFrame]:
    """Undo :func:`lathework.operators.combine.concat_tables`, by label and not by position."""
    return [df.filter(c(origin) == label).drop(origin) for label in labels]


def null_filter(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is missing (NULL, or NaN in a floating column)."""
    return df.filter(is_missing(df, column))


def is_missing(df: DataFrame, column: str) -> Column:
    kind = dict(df.dtypes)[column]
    if kind in ("double", "float"):
        return c(column).isNull() | F.isnan(c(column))
    return c(column).isNull()


def recast_code(df: DataFrame, column: str) -> DataFrame:
    """A numeric code becomes a category; whole numbers get no ``.0``."""
    return df.withColumn(column, c(column).cast("bigint").cast("string"))


def write_back(df: DataFrame, column: str, values: Column) -> DataFrame:
    """Replace one column by a value computed on the same row."""
    return df.withColumn(column, values)
