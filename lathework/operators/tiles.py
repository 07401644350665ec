"""Correlations of very many columns, in tiles of column blocks.

A scan holds a few tiles, reads only their columns, and gives rows of the result: no task and no
driver has a matrix as wide as the table. Tables of one tile take one scan.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c, present
from lathework.operators.gram import matrix_of, numeric_rows

SIDE = 512  # columns on a side of a tile
CELLS = 1 << 23  # numbers that one task of a scan holds at most, for one tile at least
SLICE = 4096  # rows that are multiplied together


def column_means(df: DataFrame, names, side=SIDE) -> np.ndarray:
    """Mean of the values there are of each column, 0 without any; an aggregate for each ``side`` columns."""
    out: list[float] = []
    for at in range(0, len(names), side):
        row = df.agg(*[F.avg(present(c(n).cast("double"))).alias(f"m{i}") for i, n in enumerate(names[at:at + side])]).first()
        out += [v or 0.0 for v in row]
    return np.array(out)


def tile_scans(columns: int, side=SIDE, cells=CELLS) -> list[list[tuple[int, int]]]:
    """Pairs of column blocks, dealt to scans that hold at most ``cells`` numbers."""
    blocks = -(-columns // side)
    pairs = [(i, j) for i in range(blocks) for j in range(i, blocks)]
    share = max(1, cells // (6 * side * side))
    return [pairs[at:at + share] for at in range(0, len(pairs), share)]


def correlation_tiles(df: DataFrame, names, side=SIDE, cells=CELLS) -> DataFrame:
    """``(a, b, r)`` for all ordered pairs of ``names``, each over the rows that have both values.

    A column that is constant over the rows of a pair has no r in that pair. Sums are about the
    columns' means, so large values stay exact enough.
    """
    names = list(names)
    shift = column_means(df, names, side)
    out = df.sparkSession.createDataFrame([], "a string, b string, r double")
    for pairs in tile_scans(len(names), side, cells):
        out = out.unionByName(_scan(df, names, shift, pairs, side))
    return out


def _scan(df: DataFrame, names: list[str], shift: np.ndarray, pairs: list[tuple[int, int]], side: int) -> DataFrame:
    used = sorted({b for pair in pairs for b in pair})
    columns = {b: names[b * side:(b + 1) * side] for b in used}
    begin, at = {}, 0
    for b in used:
        begin[b], at = at, at + len(columns[b])
    own_shift = np.concatenate([shift[b * side:(b + 1) * side] for b in used])
    places = {b: slice(begin[b], begin[b] + len(columns[b])) for b in used}
    rows = numeric_rows(df, [n for b in used for n in columns[b]])

    def packed(sums):
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int64()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["tile", "cells"]
        )

    def first(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            whole = matrix_of(batch) if batch.num_rows else np.zeros((0, at))
            for start in range(0, len(whole), SLICE):
                x = whole[start:start + SLICE] - own_shift
                seen = ~np.isnan(x)
                x = np.where(seen, x, 0.0)
                seen, square = seen.astype(float), x * x
                for k, (i, j) in enumerate(pairs):
                    a, b = places[i], places[j]
                    found = np.stack([
                        m[:, a].T @ n[:, b]
                        for m, n in ((seen, seen), (x, seen), (seen, x), (square, seen), (seen, square), (x, x))
                    ])
                    sums[k] = sums[k] + found if k in sums else found
        yield from packed(sums)

    def second(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, data in zip(batch.column("tile").to_pylist(), batch.column("cells").to_pylist()):
                found = np.frombuffer(data)
                sums[k] = sums[k] + found if k in sums else found
        for k, values in sums.items():
            i, j = pairs[k]
            n, left, right, left2, right2, product = values.reshape(6, len(columns[i]), len(columns[j]))
            with np.errstate(divide="ignore", invalid="ignore"):
                spread = _spread(left2, left, n), _spread(right2, right, n)
                r = (product - left * right / n) / np.sqrt(spread[0] * spread[1])
            a, b = np.nonzero(np.isfinite(r))
            r = np.clip(r[a, b], -1.0, 1.0)
            a, b = np.array(columns[i], dtype=object)[a], np.array(columns[j], dtype=object)[b]
            for one, other in ((a, b), (b, a))[:1 if i == j else 2]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one, pa.string()), pa.array(other, pa.string()), pa.array(r, pa.float64())], names=["a", "b", "r"]
                )

    tiles = rows.mapInArrow(first, "tile long, cells binary").repartition(len(pairs), "tile")
    return tiles.mapInArrow(second, "a string, b string, r double")


def _spread(square, total, n):
    # rounding leaves a constant with a spread of some units in the last place
    spread = square - total ** 2 / n
    return np.where(spread > 1e-12 * np.maximum(square, 1e-300), spread, 0.0)
