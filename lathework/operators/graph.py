"""Many expressions over few columns as one graph, evaluated on Arrow batches.

Equal parts of the expressions are one node, worked out once for a batch. Cross products of all
expressions are summed block by block in the same scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.operators.gram import Moments, matrix_of, numeric_rows
from lathework.operators.growers import blocks_of

SLICE = 2048  # rows that are evaluated together
BLOCK = 256  # expressions on a side of a block of cross products
SHIFT_ROWS = 1000  # rows whose means are subtracted before products are summed

UNARY = {
    "log1pabs": lambda a: np.log1p(np.abs(a)),
    "sqrtabs": lambda a: np.sqrt(np.abs(a)),
    "square": lambda a: a * a,
}
BINARY = {
    "add": np.add,
    "sub": np.subtract,
    "mul": np.multiply,
    # Protected: one where the divisor is zero.
    "div": lambda a, b: np.where(b == 0, 1.0, a / np.where(b == 0, 1.0, b)),
}


@dataclass
class Graph:
    """Nodes in an order in which each comes after its parts; ``roots`` are the expressions' nodes.

    An expression is a column name or a tuple of an operation's name and its parts.
    """

    columns: list[str] = field(default_factory=list)
    steps: list[tuple] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)

    @classmethod
    def of(cls, trees) -> "Graph":
        graph, at = cls(), {}

        def node(tree) -> int:
            if tree not in at:
                if isinstance(tree, str):
                    step = ("column", len(graph.columns))
                    graph.columns.append(tree)
                else:
                    step = (tree[0], *[node(part) for part in tree[1:]])
                graph.steps.append(step)
                at[tree] = len(graph.steps) - 1
            return at[tree]

        graph.roots = [node(tree) for tree in trees]
        return graph

    def evaluate(self, x: np.ndarray) -> np.ndarray:
        """Values of the expressions, a column each, from the columns' values; missing is NaN."""
        values: list[np.ndarray] = []
        with np.errstate(all="ignore"):
            for op, *parts in self.steps:
                if op == "column":
                    values.append(x[:, parts[0]])
                else:
                    values.append({1: UNARY, 2: BINARY}[len(parts)][op](*[values[i] for i in parts]))
        return np.stack([values[i] for i in self.roots], axis=1)


def graph_moments(df: DataFrame, trees, label: str) -> Moments:
    """Sums and cross products of all expressions and, last, the label, in one scan.

    An expression that is missing or infinite in any row has such a total and such products, and
    no other one is touched by it. A row without a finite label is an error. The result has as many
    numbers as there are pairs of expressions; a task holds that many and the values of a slice of rows.
    """
    graph = Graph.of(trees)
    rows = numeric_rows(df, [c(n) for n in graph.columns], y=c(label))
    size = len(graph.roots) + 1

    def values(x, y):
        return np.hstack([graph.evaluate(x), y[:, None]])

    first = rows.take(SHIFT_ROWS)  # reads as few partitions as it can
    if not first:
        raise ValueError("no rows to score on")
    v = values(np.array([r["x"] for r in first], dtype=float), np.array([r["y"] for r in first], dtype=float))
    with np.errstate(all="ignore"):
        shift = np.where(np.isfinite(v), v, 0.0).mean(axis=0)
    shift = np.where(np.isfinite(shift), shift, 0.0)
    sides = [(i, min(i + BLOCK, size)) for i in range(0, size, BLOCK)]
    pairs = [(i, j) for i in range(len(sides)) for j in range(i, len(sides))]

    def reduce_batch(batch):
        out = {}
        x, y = _numbers(batch)
        with np.errstate(all="ignore"):
            for at in range(0, len(x), SLICE):
                v = values(x[at:at + SLICE], y[at:at + SLICE]) - shift
                found = {-1: np.concatenate([[len(v)], v.sum(axis=0)])}
                for k, (i, j) in enumerate(pairs):
                    found[k] = (v[:, slice(*sides[i])].T @ v[:, slice(*sides[j])]).ravel()
                out = {k: out[k] + cells if out else cells for k, cells in found.items()}
        return out

    blocks = blocks_of(rows, reduce_batch)
    cross = np.empty((size, size))
    for k, (i, j) in enumerate(pairs):
        (a, b), (d, e) = sides[i], sides[j]
        cross[a:b, d:e] = blocks[k].reshape(b - a, e - d)
        cross[d:e, a:b] = cross[a:b, d:e].T
    n, *total = blocks[-1]
    if not np.isfinite(total[-1]):
        raise ValueError("rows miss the label: fill or drop them first")
    return Moments(n, np.array(total), cross, shift)


def _numbers(batch) -> tuple[np.ndarray, np.ndarray]:
    """The columns and the label of a batch as float arrays, NaN where missing."""
    return matrix_of(batch).astype(float), batch.column("y").to_numpy(zero_copy_only=False).astype(float)
