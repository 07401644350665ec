"""Reading feature tables and targets, writing submissions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions.columns import c, nan_to_null

TARGET_SCHEMA = "row_id BIGINT, target DOUBLE"


def read_features(spark: SparkSession, path: str, schema=None, fmt=None, index_col=None, null_value="NA") -> DataFrame:
    """A feature table from CSV with a header, or from Parquet.

    The literal ``NA`` and NaN are read as missing. ``index_col`` names the stored row index
    (the unnamed first column of a written frame) ``row_id``. Without a schema, CSV types
    are inferred by one more pass over the files.
    """
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if fmt == "parquet":
        df = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    else:
        reader = spark.read.option("header", True).option("nullValue", null_value).option("mode", "FAILFAST")
        df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    if index_col is not None:
        if index_col in ("", "Unnamed: 0") and df.columns[0] in ("_c0", "", "Unnamed: 0"):
            index_col = df.columns[0]
        rest = [c(n) for n in df.columns if n != index_col]
        df = df.select(c(index_col).cast("bigint").alias("row_id"), *rest)
    return nan_to_null(df)


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """A two-column CSV without header: row index and target."""
    return spark.read.schema(TARGET_SCHEMA).option("mode", "FAILFAST").csv(path)


def write_submission(scored: DataFrame, path: str, key="Id", prediction="prediction", name="SalePrice", files=None):
    """Key as a whole number and prediction, as CSV part files with a header."""
    out = scored.select(c(key).cast("bigint").alias(key), c(prediction).cast("double").alias(name))
    if files:
        out = out.coalesce(files)
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def write_table(df: DataFrame, path: str, fmt="parquet", mode="overwrite"):
    df.write.mode(mode).format(fmt).option("header", True).save(path)


def key_and_target(df: DataFrame, key: str, target: str) -> DataFrame:
    return df.select(c(key).cast("bigint").alias("row_id"), F.col(target).cast("double").alias("target"))
