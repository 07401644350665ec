"""Exact order statistics per column and group, without collecting any group.

A mergeable sketch brackets each wanted rank, and further scans narrow the bracket until it
holds few rows. The last scan counts what lies below the bracket and the distinct values
inside it. A value that fills a third of the table is one counted row, so neither hot groups
nor hot values reach one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lathework.functions.columns import c, long_form

STEPS = 200
ACCURACY = 10_000  # the sketch is off by at most n / ACCURACY ranks: a fiftieth of a grid step
BRACKET_ROWS = 1_000_000


def _grid(value):
    return F.percentile_approx(value, [i / STEPS for i in range(STEPS + 1)], ACCURACY)


def _narrow(grid, rank, rows, lo, hi):
    """Bounds one grid step to either side of a rank among ``rows`` values in [lo, hi]."""
    at = rank / max(rows - 1, 1) * STEPS
    left, right = max(math.floor(at) - 1, 0), min(math.ceil(at) + 1, STEPS)
    return (lo if left == 0 else max(lo, grid[left])), (hi if right == STEPS else min(hi, grid[right]))


def order_statistics(df: DataFrame, columns, ranks, group=None, bracket_rows=BRACKET_ROWS) -> dict:
    """``{(group value, column): (n, {rank: value})}`` for 0-based ranks.

    ``ranks`` maps a row count to the wanted ranks. Missing values are not counted. The
    number of groups times columns must be small: it is what the driver receives.
    """
    spark = df.sparkSession
    rows = long_form(df, columns, keep=[group] if group else [])
    rows = rows.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    rows = rows.withColumnRenamed(group, "grp") if group else rows.withColumn("grp", F.lit(0))
    schema = f"grp {dict(rows.dtypes)['grp']}, feature string, rank long, lo double, hi double"
    keys = ["grp", "feature", "rank"]

    def with_brackets(brackets):
        table = spark.createDataFrame([(*k, *b) for k, b in brackets.items()], schema)
        return rows.join(F.broadcast(table), ["grp", "feature"])

    counts = {}
    brackets = {}
    # The first pass sees every row: one aggregate per column, nothing is exploded.
    value = {i: F.when(~F.isnan(c(n).cast("double")), c(n).cast("double")) for i, n in enumerate(columns)}
    by = df.groupBy(c(group).alias("grp")) if group else df.groupBy(F.lit(0).alias("grp"))
    for r in by.agg(
        *[
            F.struct(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), _grid(v).alias("grid")).alias(f"s{i}")
            for i, v in value.items()
        ]
    ).collect():
        for i, name in enumerate(columns):
            s = r[f"s{i}"]
            if s["n"]:
                counts[(r["grp"], name)] = s["n"]
                for k in sorted(set(ranks(s["n"]))):
                    brackets[(r["grp"], name, k)] = _narrow(s["grid"], k, s["n"], s["lo"], s["hi"])
    if not brackets:
        return {}

    wide = {k for k in brackets if counts[k[:2]] > bracket_rows}
    while wide:
        inside = F.col("value").between(F.col("lo"), F.col("hi"))
        found = with_brackets({k: brackets[k] for k in wide}).groupBy(*keys).agg(
            F.count_if(F.col("value") < F.col("lo")).alias("below"), F.count_if(inside).alias("inside"),
            _grid(F.when(inside, F.col("value"))).alias("grid"),
        ).collect()
        for r in found:
            k = (r["grp"], r["feature"], r["rank"])
            old = brackets[k]
            if r["inside"] <= bracket_rows or old[0] == old[1]:
                wide.discard(k)
                continue
            brackets[k] = _narrow(r["grid"], r["rank"] - r["below"], r["inside"], *old)
            if brackets[k] == old:  # only a few distinct values are left
                wide.discard(k)

    # One counted row per distinct value inside a bracket, and one for everything below it.
    inside = (
        with_brackets(brackets).filter(F.col("value") <= F.col("hi"))
        .select(*keys, F.when(F.col("value") >= F.col("lo"), F.col("value")).alias("value"))
        .groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    )
    running = W.partitionBy(*keys).orderBy(F.asc_nulls_first("value"))
    out: dict = {k: (n, {}) for k, n in counts.items()}
    for r in (
        inside.withColumn("upto", F.sum("n").over(running))
        .filter((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
        .select(*keys, "value").collect()
    ):
        out[(r["grp"], r["feature"])][1][r["rank"]] = r["value"]
    return out


def exact_quantiles(df: DataFrame, columns, probabilities, group=None) -> dict:
    """``{(group, column): [quantile, ...]}``, interpolated between neighbouring values."""

    def ranks(n):
        return [r for q in probabilities for r in (math.floor(q * (n - 1)), math.ceil(q * (n - 1)))]

    out = {}
    for key, (n, values) in order_statistics(df, columns, ranks, group).items():
        out[key] = []
        for q in probabilities:
            at = q * (n - 1)
            lo, hi = values[math.floor(at)], values[math.ceil(at)]
            out[key].append(lo + (at - math.floor(at)) * (hi - lo))
    return out
