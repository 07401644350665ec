"""Helpers shared by the text operators."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.session import settle

# White space as the contracts of this subpackage define it: blank, tab, line feed, vertical
# tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
ROW = "_row"  # number of a row within one run; no input column reaches the operators' tables


def text_of(name="text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(c(name).cast("string"), F.lit(""))


def text_of_whole(name="text") -> Column:
    """The text in the rows of :func:`packed_rows`; null counts as empty."""
    return F.coalesce(F.col("whole")[name].cast("string"), F.lit(""))


def narrow(docs: DataFrame, **columns: Column) -> DataFrame:
    """Only the named columns, so that extra columns of any name cannot clash."""
    return docs.select(*[v.alias(k) for k, v in columns.items()])


def numbered(df: DataFrame, label="numbered") -> DataFrame:
    """``df`` with a row number in ``_row``, written to the shared folder.

    The number names a row, also among repeated rows, for as long as the written table lives.
    """
    return settle(df.withColumn(ROW, F.monotonically_increasing_id()), label)


def packed_rows(docs: DataFrame, **columns: Column) -> DataFrame:
    """Numbered table of a whole row in ``whole`` beside derived columns."""
    return numbered(docs.select(F.struct(*[c(x) for x in docs.columns]).alias("whole"), *[v.alias(k) for k, v in columns.items()]), "rows")


def groups_of(n: int, rows: int) -> int:
    """How many groups of about ``rows`` rows hold ``n`` rows: the power of two at or above."""
    return 1 << max(0, (max(1, n) - 1) // rows).bit_length()


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of tables that nothing refers to any more.

    Its cleaner follows the garbage collector of the driver's JVM, which may not run for half an
    hour on a driver with little garbage; until then the files fill the executors' disks. One
    collection right after a job leaves the files of that job; a second one a moment later takes them.
    """
    for pause in (0.2, 0):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)
