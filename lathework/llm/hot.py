"""Joining small answers to rows when a few keys may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MANY = 1000  # a key is hot from a thousandth of the rows on, so there are at most this many


def attach(rows: DataFrame, answers: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` left joined with ``answers``, which has one row for each key.

    ``count`` is a column of ``answers``, the number of rows that have the key. Hot keys, of which
    there are at most ``MANY``, are looked up where the rows are; all others meet in a join in
    which no key has more than a thousandth of the rows. Both sides should be written tables.
    A null key has no answer unless ``answers`` has one for it.
    """
    total = answers.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * MANY >= F.lit(total)
    hot, rest = (answers.filter(p).withColumnRenamed(key, "_key") for p in (is_hot, ~is_hot))
    near = F.broadcast(hot)
    same = rows[key].eqNullSafe(F.col("_key"))
    looked_up = rows.join(near, same).drop("_key")
    met = rows.join(F.broadcast(hot.select("_key")), same, "left_anti").join(rest.hint("merge"), same, "left").drop("_key")
    return looked_up.unionByName(met)
