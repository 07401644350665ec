"""From raw documents to packed training windows: five operators one after another.

Each stage takes ``(spark, docs, folder)`` and gives a DataFrame, which is written and read again
as the next stage's documents. All stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lathework.llm import exact_dedup, mixing, near_join, packing, rules
from lathework.llm.common import free_shuffles
from lathework.plans.registry import shipping, table
from lathework.session import drop_tables, recorded, settle

TOKENIZER = "word_bpe_49k.json"

_left: dict = {}  # helper tables of the last stage of an application


def is_written(docs: DataFrame, helpers: list[str]) -> bool:
    """Whether ``docs`` is read from files alone, none of them in a helper table."""
    leaves = docs._jdf.queryExecution().withCachedData().collectLeaves()
    kinds = {leaves.apply(i).getClass().getSimpleName() for i in range(leaves.size())}
    folders = [x.split(":", 1)[-1].lstrip("/") for x in helpers]
    return kinds == {"LogicalRelation"} and not any(x in f for x in folders for f in docs.inputFiles())


def staged(stage):
    """``stage`` that ships the package and removes the helper tables of the stage before it.

    A stage's result is written before the next stage starts, so the tables that it was made of
    have no reader then. They stay where ``docs`` is not simply a table of files, but may have
    yet to be computed from them.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        if is_written(docs, _left.get(app, [])):
            drop_tables(spark, _left.pop(app, []))
            free_shuffles(spark)
        with recorded() as helpers:
            out = stage(spark, docs, folder)
        _left[app] = _left.get(app, []) + helpers
        return out

    return shipping(run_stage)


@staged
def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rule ensemble rejects go."""
    return rules.keep_quality(docs, table(spark, folder, "labels"))


@staged
def exact(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.keep_distinct(docs)


@staged
def near(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each group of near copies stays."""
    return near_join.keep_one(docs)


@staged
def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sources in their target weights, in training order; some documents are there twice."""
    return mixing.mix(docs)


@staged
def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of token windows, with the ids of each piece; sequence ids go with the training order.

    The order of the mixed rows is lost when they are written and read, so it is found anew.
    """
    return packing.pack(mixing.in_order(docs), public_tokenizers.path(TOKENIZER))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

# Scores, links and tokens have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


@shipping
def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages on the documents of ``folder``; each result is written and read again.

    A result goes when the next one has been written; the last stage reads the last but one's.
    """
    docs, before = table(spark, folder, "documents"), []
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, folder)
        with recorded() as written:
            docs = settle(out, name)
        drop_tables(spark, before)
        before = list(written)
    return STAGES[-1][1](spark, docs, folder)
