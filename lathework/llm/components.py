"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.session import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest one."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least.hint("merge"), "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether each node is tied to one root, and no root is tied to another."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("tied"), F.lit(0).alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("tied"), F.lit(1).alias("root"))
    )
    both = ends.groupBy("node").agg(F.sum("tied").alias("tied"), F.max("root").alias("root"))
    return not both.filter("tied > 1 OR (tied > 0 AND root > 0)").head(1)


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for each node with an edge to another.

    ``edges`` has two long columns ``a, b``, in any direction, repeated or not. Work is joins
    and sums by node; a node that most edges meet is summed up before it is shuffled. Each
    round is written to the shared folder; the driver learns one bit a round.
    """
    now = settle(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    while not _is_done(now):
        now = settle(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
