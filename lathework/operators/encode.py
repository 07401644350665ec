"""Dummy columns with a fitted vocabulary, pooled rare levels, and table to vector."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c, long_form, numeric_columns, safe_names, string_columns
from lathework.operators.ranks import ranked

MAX_LEVELS = 2000


def level_counts(df: DataFrame, columns) -> DataFrame:
    """``(column, level, count)`` of all columns in one shuffle of pre-counted levels."""
    rows = long_form(df, columns, cast="string", name="column", value="level")
    return rows.filter(F.col("level").isNotNull()).groupBy("column", "level").agg(F.count(F.lit(1)).alias("count"))


def fitted_levels(df: DataFrame, columns, max_levels=MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted levels per column; too many levels is an error, not a cut."""
    if not columns:
        return {}
    limit = max_levels * len(columns)
    found = level_counts(df, columns).select("column", "level").limit(limit + 1).collect()
    levels: dict[str, list[str]] = {n: [] for n in columns}
    for r in found:
        levels[r["column"]].append(r["level"])
    wide = {n: len(v) for n, v in levels.items() if len(v) > max_levels}
    if wide or len(found) > limit:
        raise ValueError(f"too many levels to become columns: {wide or 'all columns'}; see sparse_dummies and famd_wide_fit")
    return {n: sorted(v) for n, v in levels.items()}


@dataclass
class Dummies:
    """Indicators per level of the string columns, numeric columns first.

    The vocabulary is learned once and used for every table, so train and test get the same
    columns and the same dropped first level. Missing and unseen levels are all zeros.
    """

    columns: list[str] | None = None
    drop_first: bool = True
    max_levels: int = MAX_LEVELS
    levels: dict[str, list[str]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "Dummies":
        names = list(self.columns or string_columns(df))
        self.levels = fitted_levels(df, names, self.max_levels)
        return self

    @property
    def indicators(self) -> dict[str, Column]:
        skip = 1 if self.drop_first else 0
        return {
            f"{n}_{level}": F.when(c(n) == F.lit(level), 1).otherwise(0)
            for n, levels in self.levels.items() for level in levels[skip:]
        }

    def transform(self, df: DataFrame, safe=False) -> DataFrame:
        """One wide projection; ``safe`` renames the result for the vector stages."""
        out = {n: c(n) for n in df.columns if n not in self.levels}
        out.update(self.indicators)
        names = safe_names(out) if safe else {n: n for n in out}
        return df.select(*[col.alias(names[n]) for n, col in out.items()])

    def to_vector(self, df: DataFrame, out="dummies") -> DataFrame:
        """All indicators in one vector column, so that wide tables stay narrow plans."""
        flags = F.array(*[f.cast("double") for f in self.indicators.values()])
        kept = [c(n) for n in df.columns if n not in self.levels]
        return df.select(*kept, array_to_vector(flags).alias(out))


def dummies_drop_first(df: DataFrame, columns=None, fit_on: DataFrame | None = None, safe=False) -> DataFrame:
    return Dummies(columns).fit(df if fit_on is None else fit_on).transform(df, safe)


def dummies_aligned(train: DataFrame, test: DataFrame, columns=None, safe=False) -> tuple[DataFrame, DataFrame]:
    """Both tables with the training vocabulary."""
    model = Dummies(columns).fit(train)
    return model.transform(train, safe), model.transform(test, safe)


def level_places(df: DataFrame, columns) -> DataFrame:
    """``column, level, at``: the place of every level of every column in one long vector.

    The vocabulary of wide factors: it stays a table, however many levels there are.
    """
    return ranked(level_counts(df, columns).select("column", "level"), "column", "level", name="at")


def sparse_dummies(df: DataFrame, key: str, places: DataFrame) -> DataFrame:
    """``key, indices``: the sorted places of a row's levels, its indicators in sparse form.

    ``places`` comes from :func:`level_places`, perhaps of another table. Missing and unseen
    levels have no place. Rows are put together by ``key``, which names them.
    """
    columns = [r["column"] for r in places.select("column").distinct().collect()]
    cells = F.explode(F.array(*[
        F.struct(F.lit(n).alias("column"), c(n).cast("string").alias("level")) for n in columns if n in df.columns
    ])).alias("x")
    rows = df.select(c(key).alias("_key"), cells).select("_key", "x.*")
    found = rows.join(places, ["column", "level"], "left").groupBy("_key").agg(F.sort_array(F.collect_list("at")).alias("indices"))
    return found.withColumnRenamed("_key", key)


OTHER = "other"


@dataclass
class PooledOneHot:
    """Indicators for columns of few values, levels under a share of the rows pooled.

    Columns with more than ``threshold`` distinct values are left as they are. Every kept
    level and the pool get an indicator; an unseen level goes to the pool.
    """

    minimum_fraction: float = 0.05
    threshold: int = 10
    columns: list[str] | None = None
    levels: dict[str, list[str]] = field(default_factory=dict)
    pooled: dict[str, bool] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "PooledOneHot":
        names = list(self.columns or df.columns)
        if not names:
            return self
        counts = level_counts(df, names)
        # Only columns that qualify come to the driver: at most threshold rows each.
        few = counts.groupBy("column").agg(
            F.count(F.lit(1)).alias("distinct"), F.sum("count").alias("filled")
        ).filter(F.col("distinct") <= self.threshold)
        kept = counts.join(F.broadcast(few), "column").select(
            "column", "level", (F.col("count") / F.col("filled")).alias("share")
        ).collect()
        found: dict[str, list[tuple[str, float]]] = {}
        for r in kept:
            found.setdefault(r["column"], []).append((r["level"], r["share"]))
        for n in names:
            if n in found:
                self.levels[n] = sorted(v for v, share in found[n] if share >= self.minimum_fraction)
                self.pooled[n] = len(self.levels[n]) < len(found[n])
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = [c(n) for n in df.columns if n not in self.levels]
        for n, levels in self.levels.items():
            text = c(n).cast("string")
            out += [F.when(text == F.lit(v), 1).otherwise(0).alias(f"{n}_{v}") for v in levels]
            if self.pooled[n]:
                rare = text.isNotNull() & ~text.isin(levels)
                out.append(F.when(rare, 1).otherwise(0).alias(f"{n}_{OTHER}"))
        return df.select(*out)


def assemble(df: DataFrame, columns=None, out="features", keep=()) -> DataFrame:
    """Table to a vector column; names with dots or blanks are made safe first."""
    names = list(columns or numeric_columns(df, exclude=keep))
    safe = safe_names(names)
    rows = df.select(*[c(k) for k in keep], *[c(n).cast("double").alias(f"_a_{safe[n]}") for n in names])
    stage = VectorAssembler(inputCols=[f"_a_{safe[n]}" for n in names], outputCol=out, handleInvalid="error")
    return stage.transform(rows).select(*[c(k) for k in keep], out)
