"""Small column helpers shared by all operators."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def c(name: str) -> Column:
    """Column by its literal name; dots, blanks and ampersands need no care."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [n for n, t in df.dtypes if (t in NUMERIC or t.startswith("decimal")) and n not in exclude]


def string_columns(df: DataFrame, exclude=()) -> list[str]:
    return [n for n, t in df.dtypes if t == "string" and n not in exclude]


def present(col: Column) -> Column:
    """NaN and NULL are the same missing value."""
    return F.nanvl(col, F.lit(None).cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, in one projection."""
    floats = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(
        *[F.when(~F.isnan(c(n)), c(n)).alias(n) if n in floats else c(n) for n in df.columns]
    )


def key_bucket(key: Column, buckets: int, salt="") -> Column:
    """Bucket number of a key from its md5 digest: the same under any partitioning."""
    digest = F.md5(F.concat(F.lit(f"{salt}-"), key.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def add_up(cols) -> Column:
    return reduce(lambda a, b: a + b, cols)


def dot(cols, weights, intercept=0.0) -> Column:
    """``intercept + sum(w * col)`` leaving out zero weights."""
    out = F.lit(float(intercept))
    for col, weight in zip(cols, weights):
        if weight != 0.0:
            out = out + col * F.lit(float(weight))
    return out


def rounded(col: Column, digits=6) -> Column:
    """Rounded to ``digits``; adding zero turns -0.0 into 0.0."""
    return F.round(col, digits) + F.lit(0.0)


def long_form(df: DataFrame, names, keep=(), cast="double", name="feature", value="value") -> DataFrame:
    """One row per (row, column): an explode inside the scan stage, no shuffle."""
    pairs = F.array(*[F.struct(F.lit(n).alias(name), c(n).cast(cast).alias(value)) for n in names])
    return df.select(*[c(k) for k in keep], F.explode(pairs).alias("_p")).select(
        *[c(k) for k in keep], f"_p.{name}", f"_p.{value}"
    )


def one_row_per(names, **fields) -> Column:
    """Explode expression turning one wide aggregate row into a row per column name.

    Each keyword is a field name with a function from column name to column.
    """
    return F.explode(
        F.array(
            *[
                F.struct(F.lit(n).alias("column"), *[f(n).alias(k) for k, f in fields.items()])
                for n in names
            ]
        )
    )


def safe_names(names) -> dict[str, str]:
    """Map generated names to ``[0-9A-Za-z_]`` names; two names must not fall together."""
    out = {n: re.sub(r"[^0-9A-Za-z_]", "_", n) for n in names}
    seen: dict[str, str] = {}
    for old, new in out.items():
        if seen.setdefault(new, old) != old:
            raise ValueError(f"columns {seen[new]!r} and {old!r} both become {new!r}")
    return out


def rename_safely(df: DataFrame) -> DataFrame:
    return df.select(*[c(old).alias(new) for old, new in safe_names(df.columns).items()])


def vector_size(df: DataFrame, name: str) -> int:
    """Length of a vector column, from its metadata or else from one row."""
    attrs = df.schema[name].metadata.get("ml_attr", {})
    if "num_attrs" in attrs:
        return int(attrs["num_attrs"])
    row = df.select(name).first()
    if row is None:
        raise ValueError("no rows to fit on")
    return len(row[0])


def is_vector(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (T.NumericType, T.ArrayType))
