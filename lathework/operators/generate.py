"""Generated features: candidate expressions, one-scan scoring, diverse survivors, generations.

A candidate is a small tree of column names and operations. All candidates of a generation
are one graph, evaluated and scored in one scan; the survivors are columns of one projection.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.operators.graph import graph_moments

UNARY = {
    "log1pabs": lambda a: F.log1p(F.abs(a)),
    "sqrtabs": lambda a: F.sqrt(F.abs(a)),
    "square": lambda a: a * a,
}
BINARY = {
    "add": lambda a, b: a + b,
    "sub": lambda a, b: a - b,
    "mul": lambda a, b: a * b,
    # Protected: one where the divisor is zero.
    "div": lambda a, b: F.when(b == 0, F.lit(1.0)).otherwise(a / F.when(b != 0, b)),
}
SYMMETRIC = ("add", "mul")


def label_of(tree) -> str:
    return tree if isinstance(tree, str) else f"{tree[0]}({','.join(label_of(t) for t in tree[1:])})"


def column_of(tree) -> Column:
    if isinstance(tree, str):
        return c(tree).cast("double")
    args = [column_of(t) for t in tree[1:]]
    return UNARY[tree[0]](*args) if len(args) == 1 else BINARY[tree[0]](*args)


def depth(tree) -> int:
    return 0 if isinstance(tree, str) else 1 + max(depth(t) for t in tree[1:])


def first_candidates(columns) -> list:
    """Base columns, every unary of them, and every binary of their pairs."""
    columns = list(columns)
    out: list = list(columns)
    out += [(op, a) for op in UNARY for a in columns]
    for op in BINARY:
        for i, a in enumerate(columns):
            for j, b in enumerate(columns):
                if i < j or (i > j and op not in SYMMETRIC):
                    out.append((op, a, b))
    return out


def generate_features(df: DataFrame, trees, keep=(), out="features") -> DataFrame:
    """All candidates in one array column, in one projection."""
    return df.select(*[c(k) for k in keep], F.array(*[column_of(t) for t in trees]).alias(out))


@dataclass
class Scored:
    """Candidates that are finite everywhere and vary, with correlations among each other."""

    trees: list
    target: np.ndarray
    among: np.ndarray

    def table(self, spark) -> DataFrame:
        rows = [(label_of(t), float(r)) for t, r in zip(self.trees, self.target)]
        return spark.createDataFrame(rows, "candidate string, r double").orderBy(F.desc(F.abs("r")), "candidate")


def score_features(df: DataFrame, trees, label: str) -> Scored:
    """Correlation of every candidate with the label and among each other, in one scan.

    The candidates are one graph, whose shared parts are worked out once for a batch. A candidate
    with a missing or infinite value anywhere is rejected; a row without a label is an error.
    """
    trees = list(trees)
    m = graph_moments(df, trees, label)
    with np.errstate(all="ignore"):
        s = m.scatter
        size = np.sqrt(np.maximum(np.diag(s), 0))
        varies = size > 1e-7 * np.maximum(np.abs(m.mean) * np.sqrt(m.n), 1e-300)
    keep = np.flatnonzero((varies & np.isfinite(size) & np.isfinite(m.total))[:-1])
    picked = [*keep, len(trees)]
    s, size = s[np.ix_(picked, picked)], size[picked]
    r = s / np.outer(np.where(size == 0, 1, size), np.where(size == 0, 1, size))
    return Scored([trees[i] for i in keep], r[:-1, -1], r[:-1, :-1])


def select_diverse(scored: Scored, count: int, cut=0.95) -> Scored:
    """Best first, skipping a candidate that is close to one already taken."""
    order = sorted(range(len(scored.trees)), key=lambda i: (-round(abs(scored.target[i]), 12), label_of(scored.trees[i])))
    taken: list[int] = []
    for i in order:
        if len(taken) == count:
            break
        if all(abs(scored.among[i, j]) <= cut for j in taken):
            taken.append(i)
    return Scored([scored.trees[i] for i in taken], scored.target[taken], scored.among[np.ix_(taken, taken)])


def offspring(trees, columns, count: int, rng: np.random.Generator, max_depth=4) -> list:
    """New candidates: survivors wrapped, joined with each other, or with a part replaced."""
    seen = {label_of(t) for t in trees}
    out: list = []

    def pick(pool):
        return pool[int(rng.integers(len(pool)))]

    def vary(tree):
        if isinstance(tree, str) or rng.random() < 0.3:
            return pick(columns)
        at = 1 + int(rng.integers(len(tree) - 1))
        return tuple(vary(t) if i == at else t for i, t in enumerate(tree))

    for _ in range(count * 20):
        if len(out) == count:
            break
        kind = rng.random()
        if kind < 0.3:
            child = (pick(sorted(UNARY)), pick(trees))
        elif kind < 0.7:
            child = (pick(sorted(BINARY)), pick(trees), pick([*trees, *columns]))
        else:
            child = vary(pick(trees))
        name = label_of(child)
        if depth(child) <= max_depth and name not in seen:
            seen.add(name)
            out.append(child)
    if len(out) < count:
        warnings.warn(f"only {len(out)} of {count} new candidates were found", stacklevel=2)
    return out


@dataclass
class Evolved:
    trees: list
    history: list[tuple[int, str, float]]
    winners: list = field(default_factory=list)

    def table(self, spark) -> DataFrame:
        """Best candidate of each generation; its score never falls."""
        return spark.createDataFrame(self.history, "generation int, candidate string, r double")

    def transform(self, df: DataFrame, keep=(), out="features") -> DataFrame:
        wide = generate_features(df, self.trees, keep, "_a")
        return wide.select(*[c(k) for k in keep], array_to_vector("_a").alias(out))


def evolve_features(df: DataFrame, columns, label: str, generations=100, population=500, survivors=25, cut=0.95,
                    seed=7) -> Evolved:
    """Generations of candidates. Each generation reads the table once, and a few first rows."""
    rng = np.random.default_rng(seed)
    columns = list(columns)
    pool = first_candidates(columns)
    if len(pool) > population:
        extra = [pool[i] for i in sorted(rng.choice(np.arange(len(columns), len(pool)), population - len(columns), replace=False))]
        pool = columns + extra
    history, winners, best = [], [], None
    for g in range(generations):
        scored = score_features(df, pool, label)
        best = select_diverse(scored, survivors, cut)
        history.append((g, label_of(best.trees[0]), float(abs(best.target[0]))))
        winners.append(best.trees[0])
        if g + 1 < generations:
            pool = best.trees + offspring(best.trees, columns, population - len(best.trees), rng)
    return Evolved(best.trees, history, winners)
