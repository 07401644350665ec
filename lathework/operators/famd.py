"""Factor analysis of mixed data.

Numeric columns are standardised, each level of a factor is an indicator centred and divided
by the root of its share, and the joint table is decomposed. One scan builds the cross
products of raw values and raw indicators; means, spreads and shares fall out of the same
matrix, and the decomposition is of a matrix as wide as columns plus levels.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c, dot, numeric_columns, present, string_columns
from lathework.operators.encode import fitted_levels
from lathework.operators.gram import moments, pooled

MISSING = "<missing>"


@dataclass
class MixedFactors:
    """``fit`` learns the factors; the tables below are DataFrames over them.

    A missing number counts as the column's mean, a missing level is a level of its own. Each
    factor's sign makes its largest loading positive.
    """

    numeric: list[str]
    factors: list[str]
    ncp: int = 5
    levels: dict[str, list[str]] = field(default_factory=dict)
    fill: dict[str, float] = field(default_factory=dict)
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    all_eigenvalues: np.ndarray | None = None
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None

    def fit(self, df: DataFrame) -> "MixedFactors":
        self._spark = df.sparkSession
        if self.factors:
            filled = df.select(*[F.coalesce(c(n).cast("string"), F.lit(MISSING)).alias(n) for n in self.factors])
            self.levels = fitted_levels(filled, self.factors)
        if self.numeric:
            row = df.agg(*[F.avg(present(c(n).cast("double"))).alias(f"m{i}") for i, n in enumerate(self.numeric)]).first()
            self.fill = {n: row[f"m{i}"] for i, n in enumerate(self.numeric)}
        shift = [self.fill[n] for n in self.numeric] + [0.0] * sum(map(len, self.levels.values()))
        m = pooled(moments(df, list(self._raw()), centre=shift))
        self.centre = m.mean
        cov = m.scatter / m.n
        q = len(self.numeric)
        self.scale = np.concatenate([np.sqrt(np.diag(cov)[:q]), np.sqrt(self.centre[q:])])
        if (self.scale == 0).any():
            flat = [n for n, s in zip(self.numeric, self.scale) if s == 0]
            raise ValueError(f"constant columns have no place in a factor analysis: {flat}")
        values, vectors = np.linalg.eigh(cov / np.outer(self.scale, self.scale))
        order = np.argsort(values)[::-1]
        rank = q + sum(len(v) - 1 for v in self.levels.values())
        self.all_eigenvalues = np.clip(values[order][:rank], 0.0, None)
        k = min(self.ncp, rank)
        self.values = self.all_eigenvalues[:k]
        vectors = vectors[:, order[:k]]
        top = np.abs(vectors).argmax(axis=0)
        self.vectors = vectors * np.sign(vectors[top, np.arange(k)])
        return self

    def _raw(self) -> list[Column]:
        cols = [F.coalesce(present(c(n).cast("double")), F.lit(self.fill[n])) for n in self.numeric]
        for n, levels in self.levels.items():
            level = F.coalesce(c(n).cast("string"), F.lit(MISSING))
            cols += [F.when(level == F.lit(v), 1.0).otherwise(0.0) for v in levels]
        return cols

    def eigenvalues(self) -> DataFrame:
        """Eigenvalue, percent and running percent of every factor of the full decomposition."""
        share = self.all_eigenvalues / self.all_eigenvalues.sum() * 100
        rows = [
            (s + 1, float(v), float(p), float(t))
            for s, (v, p, t) in enumerate(zip(self.all_eigenvalues, share, np.cumsum(share)))
        ]
        return self._spark.createDataFrame(rows, "factor int, eigenvalue double, percent double, cumulative double")

    def scree(self) -> DataFrame:
        """The numbers behind a scree plot: percent of variance of the kept factors."""
        return self.eigenvalues().filter(F.col("factor") <= len(self.values)).select("factor", "percent")

    def _links(self):
        """(variable, kind, degrees, squared link with every factor)."""
        at = 0
        for n in self.numeric:
            yield n, "numeric", 1, self.values * self.vectors[at] ** 2
            at += 1
        for n, levels in self.levels.items():
            block = self.vectors[at:at + len(levels)]
            yield n, "factor", max(len(levels) - 1, 1), self.values * (block ** 2).sum(axis=0)
            at += len(levels)

    def variables(self) -> DataFrame:
        """Squared link (r2 or eta2), cos2 and contribution per variable and factor."""
        rows = []
        for name, kind, degrees, link in self._links():
            for s, v in enumerate(link):
                contrib = v / self.values[s] * 100 if self.values[s] > 0 else 0.0
                rows.append((name, kind, s + 1, float(v), float(v * v / degrees), float(contrib)))
        return self._spark.createDataFrame(
            rows, "variable string, kind string, factor int, coord double, cos2 double, contrib double"
        )

    def contributions(self, axes=(1, 2, 3)) -> DataFrame:
        """Contribution of the variables to the given axes, largest first; 100 per axis."""
        return (
            self.variables().filter(F.col("factor").isin(list(axes))).select("factor", "variable", "contrib")
            .orderBy("factor", F.desc("contrib"), "variable")
        )

    def scores(self, df: DataFrame, prefix="dim", keep=()) -> DataFrame:
        """Coordinates of every row on the kept factors: sums of products, no shuffle."""
        raw = df.select(*[c(k) for k in keep], F.array(*self._raw()).alias("_z"))
        weights = self.vectors / self.scale[:, None]
        offset = -(self.centre @ weights)
        entries = [F.col("_z")[i] for i in range(len(self.centre))]
        return raw.select(
            *[c(k) for k in keep],
            *[dot(entries, weights[:, s], offset[s]).alias(f"{prefix}{s + 1}") for s in range(weights.shape[1])],
        )


def famd_fit(df: DataFrame, numeric=None, factors=None, ncp=5) -> MixedFactors:
    return MixedFactors(
        list(numeric_columns(df) if numeric is None else numeric),
        list(string_columns(df) if factors is None else factors), ncp,
    ).fit(df)


def top_components(model: MixedFactors, k: int) -> DataFrame:
    return model.eigenvalues().orderBy(F.desc("eigenvalue"), "factor").limit(k)
