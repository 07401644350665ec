"""Registry of queries with the SQL that gives the same result."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions.columns import c, rounded
from lathework.session import ship

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under ``name``, with its SQL if there is one."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = shipping(fn)
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def shipping(fn):
    """``fn(spark, ...)`` that first sees to it that the workers have this package."""

    @wraps(fn)
    def run(spark: SparkSession, *rest) -> DataFrame:
        ship(spark)
        return fn(spark, *rest)

    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sql_bucket(key: str, buckets: int, salt="") -> str:
    """The md5 bucket of :func:`lathework.functions.columns.key_bucket` in SQL."""
    return f"(concat('0x', substr(md5(concat('{salt}', '-', {key})), 1, 8))::BIGINT % {buckets})"


def rnd(expr: str, digits=6) -> str:
    return f"(round({expr}, {digits}) + 0.0)"


def round_all(df: DataFrame, *names, digits=6) -> DataFrame:
    """Round the named columns, keep the others."""
    return df.select(*[rounded(c(n), digits).alias(n) if n in names else c(n) for n in df.columns])


def gap(column: str, key: str, every=7) -> Column:
    """The column with its value missing on every n-th key."""
    return F.when(F.col(key) % every == 0, None).otherwise(F.col(column))


def sql_gap(column: str, key: str, every=7) -> str:
    return f"CASE WHEN {key} % {every} = 0 THEN NULL ELSE {column} END"


def unpack(df: DataFrame, vector: str, names, digits=6, keep=()) -> DataFrame:
    """Entries of a vector as rounded columns."""
    from pyspark.ml.functions import vector_to_array

    x = vector_to_array(F.col(vector))
    return df.select(*[c(k) for k in keep], *[rounded(x[i], digits).alias(n) for i, n in enumerate(names)])
