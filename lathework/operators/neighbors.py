"""Exact k-nearest-neighbour regression as a pruned product of blocks, near cells first.

Pivots come in two levels: a training row belongs to the nearest pivot among those of its
nearest top pivot. Rows of near cells lie together in blocks of bounded size, one table row for
each block, which are written to the shared folder. A block of query rows meets the blocks that
hold a cell it has to visit in a product of the two tables, which shuffles nothing: a task reads
one part of each and keeps only the best k of a query row. In a task a query row visits its
nearest cell, then a few more, then the rest that the triangle inequality cannot rule out, and the
distance of its k-th neighbour so far rules out more from visit to visit. Within a visit a cheap
lower bound of the distances finds the few rows whose exact distance is worked out.
"""

from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lathework.functions.columns import c, present
from lathework.operators.stages import FittedRegressor, Regressor, list_matrix, shared_params, text, whole
from lathework.session import settle, shared_dir

MAX_TOPS = 128  # pivots of the upper level, and about as many cells for each of them
BLOCK_ROWS = 20_000
VISITS = (1, 5)  # cells that a row has visited after the first and the second round
FEW_CELLS = 64  # up to so many, further rounds cost more than they save, and there is one
EVERY = 1 << 30
BLOB_ROWS, BLOB_BYTES = 4096, 4 << 20  # of a block at most, however large ``blockRows`` is
PAIRS = 8  # of blocks that go to a Python worker at once
PART_BYTES = 64 << 20  # of the training rows that a task holds at once
REACH_CELLS = 1 << 20  # numbers in a matrix of query rows and cells
QUERY_BLOCK = 512  # query rows that are compared at once
PIECE = 2048  # training rows that are compared at once
FIRST = 256  # rows whose distances are worked out where no bound is known
GATHER = 1 << 20  # numbers of the rows whose exact distances are worked out at once
SUMS = 43_690  # two thirds of what 16 bits hold
GROUP = 256  # dimensions whose sum 16 bits hold


def distances(x: np.ndarray, y: np.ndarray, p: int) -> np.ndarray:
    """Distances of the rows of ``x`` to the rows of ``y``, row block by row block."""
    out = np.empty((len(x), len(y)))
    step = max(1, int(4e6 // max(y.size, 1)))
    for i in range(0, len(x), step):
        diff = x[i:i + step, None, :] - y[None, :, :]
        out[i:i + step] = np.abs(diff).sum(axis=2) if p == 1 else np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


def pair_distances(x: np.ndarray, y: np.ndarray, p: int) -> np.ndarray:
    """Distance of each row of ``x`` to the row of ``y`` in its place."""
    diff = x - y
    return np.abs(diff).sum(axis=1) if p == 1 else np.sqrt(np.einsum("ij,ij->i", diff, diff))


def packed(rows: np.ndarray) -> pa.Array:
    """Rows as bytes: in 32 bits a number where no number of the row changes by that."""
    with np.errstate(over="ignore"):
        short = rows.astype("<f4")
    exact = (short == rows).all(axis=1)
    sizes = np.where(exact, 4, 8) * rows.shape[1]
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
    if exact.all():
        data = short.tobytes()
    else:
        data = b"".join(short[i].tobytes() if e else rows[i].astype("<f8").tobytes() for i, e in enumerate(exact))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(starts), pa.py_buffer(data)])


def unpacked(x: pa.Array, width: int) -> np.ndarray:
    """The rows that :func:`packed` made bytes of, in 32 bits a number if all of them are."""
    sizes = pc.binary_length(x).to_numpy(zero_copy_only=False)
    if (sizes == 4 * width).all():
        return np.frombuffer(b"".join(x.to_pylist()), "<f4").reshape(len(x), width)
    return np.stack([np.frombuffer(v, "<f4" if len(v) == 4 * width else "<f8").astype("<f8") for v in x.to_pylist()])


def read_block(data, single: bool, width: int) -> np.ndarray:
    return np.frombuffer(data, "<f4" if single else "<f8").reshape(-1, width)


def block_rows(width: int, most: int) -> int:
    return max(1, min(most, BLOB_ROWS, BLOB_BYTES // (8 * max(width, 1))))


def parts_for(rows: int, width: int, spark) -> int:
    """Partitions for so many rows: a few for each core, unless there is little to do."""
    size = math.ceil(rows * (8 * width + 32) / PART_BYTES)
    return max(1, min(math.ceil(rows / FIRST), max(4 * spark.sparkContext.defaultParallelism, size)))


def table_of(batches):
    """The batches as tables of some thousand rows, so that a block is not cut by each batch."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BLOB_ROWS:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


@contextmanager
def batches_of(spark, rows: int):
    """Jobs that start inside hand at most so many table rows to a Python worker at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def column(table: pa.Table, name: str) -> pa.Array:
    found = table.column(name).combine_chunks()
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def placing(pivots: np.ndarray, tops: int, owner: np.ndarray, p: int):
    """Arrow function: cell of a row, distances to its pivot and top pivot, place of the cell, the row as bytes.

    Cells of one top pivot have places side by side.
    """
    upper = pivots[:tops]
    place_of = np.empty(len(pivots), dtype="int32")
    place_of[np.lexsort((np.arange(len(pivots)), owner))] = np.arange(len(pivots))
    kind = pa.struct([("cell", pa.int32()), ("d", pa.float64()), ("t", pa.float64()), ("place", pa.int32()), ("x", pa.binary())])

    @F.arrow_udf("cell int, d double, t double, place int, x binary")
    def placed(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], kind)
        rows = list_matrix(x)
        far = distances(rows, upper, p)
        top = far.argmin(axis=1)
        cell, d = np.zeros(len(rows), dtype="int32"), np.zeros(len(rows))
        for t in np.unique(top):
            inside, own = np.flatnonzero(top == t), np.flatnonzero(owner == t)
            near = distances(rows[inside], pivots[own], p)
            at = near.argmin(axis=1)
            cell[inside], d[inside] = own[at], near[np.arange(len(inside)), at]
        values = [pa.array(cell), pa.array(d), pa.array(far[np.arange(len(rows)), top]), pa.array(place_of[cell]), packed(rows)]
        return pa.StructArray.from_arrays(values, fields=list(kind))

    return placed


def lists_of(values: pa.Array, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype("int32")), values)


class KNNRegressor(Regressor):
    """Mean label of the k nearest rows, or the mean weighted by inverse distance.

    ``keyCol`` identifies rows; equal distances are taken in key order. With distance weights a
    row that lies on training rows gets their mean only.
    """

    n_neighbors = whole("n_neighbors")
    weights = text("weights")
    p = whole("p", "1: sum of absolute differences, 2: euclidean")
    keyCol = text("keyCol")
    blockRows = whole("blockRows", "largest block of training rows or query rows")
    defaults = {"n_neighbors": 5, "weights": "uniform", "p": 2, "keyCol": "id", "blockRows": BLOCK_ROWS}

    def _fit(self, dataset):
        if self.get("weights") not in ("uniform", "distance") or self.get("p") not in (1, 2):
            raise ValueError("weights are 'uniform' or 'distance', p is 1 or 2")
        rows = dataset.select(
            c(self.get("keyCol")).alias("id"), vector_to_array(c(self.getFeaturesCol())).alias("x"),
            present(c(self.getLabelCol()).cast("double")).alias("y"),
        )
        n = rows.count()
        if n < self.get("n_neighbors"):
            raise ValueError(f"{n} rows for {self.get('n_neighbors')} neighbours")
        p, k, spark = self.get("p"), self.get("n_neighbors"), rows.sparkSession
        pivots = first_points(rows, min(MAX_TOPS ** 2, math.ceil(math.sqrt(n))), n)
        tops = math.ceil(math.sqrt(len(pivots)))
        owner = distances(pivots, pivots[:tops], p).argmin(axis=1)
        width, key_type = pivots.shape[1], dict(rows.dtypes)["id"]
        limit = block_rows(width, self.get("blockRows"))

        def pack(batches):
            number, last, seen = 0, None, 0
            for table in table_of(batches):
                x = column(table, "x")
                x_rows, cell = unpacked(x, width), column(table, "cell").to_numpy()
                # Equal rows lie side by side in key order. Every query row is as far from all of them, so those
                # behind k others are nobody's neighbours.
                new = np.concatenate([[True], (x_rows[1:] != x_rows[:-1]).any(axis=1) | (cell[1:] != cell[:-1])])
                if last is not None and last[0] == cell[0] and (last[1] == x_rows[0]).all():
                    new[0] = False
                at = np.arange(len(new))
                begin = np.maximum.accumulate(np.where(new, at, -1))
                run = np.where(begin >= 0, at - begin, at + seen)
                last, seen = (cell[-1], x_rows[-1].copy()), int(run[-1]) + 1
                d, t = (column(table, v).to_numpy() for v in ("d", "t"))
                ids, y = column(table, "id"), column(table, "y")
                for i in range(0, len(at), limit):
                    part = np.arange(i, min(i + limit, len(at)))
                    starts = np.concatenate([[0], np.flatnonzero(np.diff(cell[part])) + 1])
                    kept = run[part] < k
                    keep = pa.array(part[kept])
                    values = x_rows[part][kept]
                    sizes = np.add.reduceat(kept.astype(int), starts)
                    cells = len(starts)
                    parts = [
                        (pa.array([(TaskContext.get().partitionId() << 32) + number])),
                        lists_of(pa.array(cell[part][starts]), np.array([0, cells])),
                        lists_of(pa.array(np.diff(np.append(starts, len(part)))), np.array([0, cells])),
                        lists_of(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("int32")), np.array([0, cells + 1])),
                        *[lists_of(pa.array(f.reduceat(v[part], starts)), np.array([0, cells])) for v in (d, t) for f in (np.minimum, np.maximum)],
                        lists_of(ids.take(keep), np.array([0, len(keep)])),
                        lists_of(y.take(keep), np.array([0, len(keep)])),
                        pa.array([values.tobytes()], pa.binary()),
                        pa.array([values.dtype == np.float32]),
                    ]
                    number += 1
                    yield pa.RecordBatch.from_arrays(parts, names=["part", "cells", "sizes", "starts", "d0", "d1", "t0", "t1", "ids", "y", "x", "single"])

        path = shared_dir(spark, "knn")
        spread = [f"{v} array<double>" for v in ("d0", "d1", "t0", "t1")]
        rows.select("id", "y", placing(pivots, tops, owner, p)("x").alias("_n")).select("id", "y", "_n.*").repartitionByRange(
            parts_for(n, width, spark), "place", F.xxhash64("id")
        ).sortWithinPartitions("place", "x", F.asc_nulls_last("id")).mapInArrow(
            pack, "part long, cells array<int>, sizes array<long>, starts array<int>, " + ", ".join(spread)
            + f", ids array<{key_type}>, y array<double>, x binary, single boolean",
        ).write.parquet(path)
        blocks = spark.read.parquet(path)
        # one row for each cell: size, and ranges of the distances to its pivot and to its top pivot
        each = blocks.select(F.explode(F.arrays_zip("cells", "sizes", "d0", "d1", "t0", "t1")).alias("v")).select("v.*")
        cells = each.groupBy(F.col("cells").alias("cell")).agg(
            F.sum("sizes").alias("n"), F.min("d0"), F.max("d1"), F.min("t0"), F.max("t1")
        )
        size = blocks.agg(F.sum(F.length("x") + 24 * F.size("ids")).alias("b")).first()["b"]
        state = {
            "path": path, "pivots": pivots.tolist(), "tops": tops, "owner": owner.tolist(), "k": k, "p": p,
            "weights": self.get("weights"), "key": self.get("keyCol"), "block": self.get("blockRows"), "bytes": size,
            "cells": sorted(list(r) for r in cells.collect()),
        }
        return KNNModel(state=state, **shared_params(self, "featuresCol", "labelCol", "predictionCol"))


def first_points(rows: DataFrame, wanted: int, n: int) -> np.ndarray:
    """The ``wanted`` distinct points that come first by hash; only rows with a low hash are dealt out."""
    share = min(1.0, 4.0 * wanted / max(n, 1))
    while True:
        near = rows.select("x") if share >= 1 else rows.select("x").filter(
            F.xxhash64("x") < int(-(1 << 63) + share * (1 << 64))
        )
        found = near.distinct().orderBy(F.xxhash64("x"), "x").limit(wanted).collect()
        if len(found) >= wanted or share >= 1:
            return np.array([r["x"] for r in found])
        share = min(1.0, share * 16)


def reached(row: np.ndarray, upper: np.ndarray, count: np.ndarray, rows: int, k: int) -> np.ndarray:
    """For each row the distance within which its sets, taken by ``upper``, hold ``k`` rows together."""
    order = np.lexsort((upper, row))
    row, upper, total = row[order], upper[order], np.cumsum(count[order])
    first = np.searchsorted(row, np.arange(rows))
    before = np.concatenate([[0], total])[first]
    at = np.searchsorted(total, before + k)
    found = at < np.concatenate([first[1:], [len(row)]])
    return np.where(found, upper[np.minimum(at, len(upper) - 1)] if len(upper) else np.inf, np.inf)


def city_hits(x: np.ndarray, y: np.ndarray, limit: np.ndarray):
    """``(row, other)`` for all pairs with a sum of absolute differences within the row's limit, and a few more.

    Numbers are rounded down to steps and cut to a window. That takes at most one step from a
    difference, or shortens it. The sum of the lesser ones of two such rows gives their distance.
    """
    width = x.shape[1]
    groups = [slice(i, min(i + GROUP, width)) for i in range(0, width, GROUP)]
    top = SUMS // min(width, GROUP)
    finite = limit[np.isfinite(limit) & (limit > 0)]
    step = (np.median(finite) if len(finite) else 1.0) * 10 / (top * width)
    if not (step > 1e-290 and step < 1e290):
        for i in range(0, len(x), QUERY_BLOCK):
            row, other = np.divmod(np.arange(len(x[i:i + QUERY_BLOCK]) * len(y)), len(y))
            yield row + i, other
        return
    low = y.mean(axis=0, dtype=float) - step * (top // 2)
    steps = lambda v: np.clip(np.floor((v - low) / step), 0, top).astype(np.uint16)
    a, b = steps(x), np.ascontiguousarray(steps(y).T)
    a_sum, b_sum = a.sum(axis=1, dtype=np.int64), b.sum(axis=0, dtype=np.int64)
    # sum of lesser ones >= (a + b - most) / 2, with the part of b on the left side
    most = np.floor(np.minimum(limit / step * (1 + 1e-6), 1e15)) + width + 1
    rest = (int(b_sum.max()) - b_sum + 1) // 2
    least = np.ceil((a_sum + int(b_sum.max()) - most) / 2)
    lesser, total = np.empty((min(width, GROUP), len(y)), np.uint16), np.empty(len(y), np.uint16)
    one = len(groups) == 1
    rest = rest.astype(np.uint16 if one else np.int64)
    a = a[:, :, None]
    for i in range(len(x)):
        if one:
            np.minimum(b, a[i], out=lesser)
            np.add.reduce(lesser, axis=0, out=total)
            sums = np.add(total, rest, out=total)
        else:
            sums = rest.copy()
            for g in groups:
                part = np.minimum(b[g], a[i, g], out=lesser[:g.stop - g.start])
                sums += np.add.reduce(part, axis=0, out=total)
        if sums.max() >= least[i]:
            other = (sums >= (np.uint16(max(least[i], 0)) if one else least[i])).nonzero()[0]
            yield np.full(len(other), i), other


def euclid_hits(x: np.ndarray, y: np.ndarray, limit: np.ndarray):
    """``(row, other)`` for all pairs with a euclidean distance within the row's limit, and a few more.

    Squares of distances from the mean of ``y`` come from one product of matrices in 32 bits, whose
    rounding is bounded by the sizes of both sides.
    """
    middle = y.mean(axis=0, dtype=float)
    a, b = x - middle, y - middle
    a_size, b_size = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    largest = b_size.max()
    if not max(largest, a_size.max()) < 1e30:
        for i in range(0, len(x), QUERY_BLOCK):
            row, other = np.divmod(np.arange(len(x[i:i + QUERY_BLOCK]) * len(y)), len(y))
            yield row + i, other
        return
    right = np.empty((x.shape[1] + 1, len(y)), np.float32)
    right[:-1], right[-1] = -2 * b.T, b_size
    left = np.ones((len(x), x.shape[1] + 1), np.float32)
    left[:, :-1] = a
    off = 4 * (x.shape[1] + 8) * 2.0 ** -24 * (2 * np.sqrt(a_size * largest) + largest) + 1e-30
    far = max(np.abs(x).max(), np.abs(y).max()) * 2.0 ** -50 * math.sqrt(x.shape[1])  # of the differences from the mean
    off += 8 * far * (np.sqrt(a_size) + math.sqrt(largest) + far)
    with np.errstate(over="ignore"):
        most = np.nextafter((np.minimum(limit, 1e16) ** 2 * (1 + 1e-9) - a_size + off).astype(np.float32), np.float32(np.inf))
    for i in range(0, len(x), QUERY_BLOCK):
        row, other = np.divmod(np.flatnonzero(left[i:i + QUERY_BLOCK] @ right <= most[i:i + QUERY_BLOCK, None]), len(y))
        yield row + i, other


def hits(x: np.ndarray, y: np.ndarray, limit: np.ndarray, p: int):
    """``(row, other, distance)`` for all pairs within the row's limit."""
    most, held, size = max(1, GATHER // x.shape[1]), [], 0

    def exact():
        row, other = (np.concatenate(v) for v in zip(*held))
        for i in range(0, len(row), most):
            r, o = row[i:i + most], other[i:i + most]
            d = pair_distances(x[r], y[o].astype(float, copy=False), p)
            near = d <= limit[r]
            yield r[near], o[near], d[near]

    for row, other in (city_hits if p == 1 else euclid_hits)(x, y, limit):
        held.append((row, other))
        size += len(row)
        if size >= most:
            yield from exact()
            held, size = [], 0
    if held:
        yield from exact()


class Best:
    """The best k of each query row of a block so far, by distance and then by key."""

    def __init__(self, x: np.ndarray, bound: np.ndarray, k: int, p: int, rank: np.ndarray):
        self.x, self.k, self.p, self.rank = x, k, p, np.append(rank, np.iinfo(np.int64).max)
        self.bound = bound * (1 + 1e-9) + 1e-12  # from the ranges of the cells, so not exact
        self.distance, self.ref = np.full((len(x), k), np.inf), np.full((len(x), k), -1)
        self.limit, self.begun = self.bound.copy(), np.zeros(len(x), dtype=bool)

    def offer(self, row: np.ndarray, ref: np.ndarray, distance: np.ndarray) -> None:
        new = ~(self.ref[row] == ref[:, None]).any(axis=1)  # a row may be met twice
        row, ref, distance = row[new], ref[new], distance[new]
        if not len(row):
            return
        rows = np.unique(row)
        all_rows = np.concatenate([np.repeat(rows, self.k), row])
        all_refs = np.concatenate([self.ref[rows].ravel(), ref])
        all_far = np.concatenate([self.distance[rows].ravel(), distance])
        order = np.lexsort((self.rank[all_refs], all_far, all_rows))
        first = np.searchsorted(all_rows[order], rows)
        best = order[first[:, None] + np.arange(self.k)]
        self.distance[rows], self.ref[rows] = all_far[best], all_refs[best]
        self.limit[rows] = np.minimum(self.bound[rows], self.distance[rows, -1])

    def meet(self, rows: np.ndarray, y: np.ndarray, ref: int) -> None:
        """Let the rows meet ``y``, whose rows have the numbers from ``ref`` on."""
        # Rows that have not met k others yet get a limit of their own first; a bound from the cells alone is loose.
        unknown = ~np.isfinite(self.limit[rows]) | ~(self.begun[rows] | np.isfinite(self.distance[rows, -1]))
        if unknown.any():
            near = rows[unknown]
            self.begun[near] = True
            for i in range(0, len(near), QUERY_BLOCK):
                part = near[i:i + QUERY_BLOCK]
                d = distances(self.x[part], y[:FIRST].astype(float, copy=False), self.p)
                row, other = np.nonzero(np.isfinite(d) & (d <= self.limit[part, None]))
                self.offer(part[row], ref + other, d[row, other])
            if len(y) > FIRST:
                self.meet(near, y[FIRST:], ref + FIRST)
            rows = rows[~unknown]
        if len(rows):
            for row, other, d in hits(self.x[rows], y, self.limit[rows], self.p):
                self.offer(rows[row], ref + other, d)


class KNNModel(FittedRegressor):
    """Holds the path of the blocks of training rows and the small table of cells."""

    def _reach(self):
        """``x -> (bound, low)``: the distance that holds k rows, and the least one to each cell; beyond reach it is infinite."""
        s = self.get("state")
        p, k = s["p"], s["k"]
        pivots, owner = np.array(s["pivots"]), np.array(s["owner"])
        table = np.array(s["cells"], dtype=float)
        ids, n, lo, hi = table[:, 0].astype(np.int32), table[:, 1], table[:, 2], table[:, 3]
        top = owner[ids]
        groups = []  # of each top pivot: its cells, how many rows they hold, and the range of distances
        for t in range(s["tops"]):
            own = np.flatnonzero(top == t)
            if len(own):
                groups.append((t, own, n[own].sum(), table[own, 4].min(), table[own, 5].max()))
        tops = pivots[[g[0] for g in groups]]
        held, near, far = (np.array([g[i] for g in groups]) for i in (2, 3, 4))

        def reach(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            m = len(x)
            d = distances(x, tops, p)
            row = np.repeat(np.arange(m), len(groups))
            bound = reached(row, (d + far).ravel(), np.tile(held, m), m, k)
            least = np.maximum(np.maximum(d - far, near - d), 0.0)
            low, up = np.full((m, len(ids)), np.inf), np.full((m, len(ids)), np.inf)
            for g, (_, own, *_) in enumerate(groups):
                inside = np.flatnonzero(least[:, g] <= bound * (1 + 1e-9) + 1e-12)
                if len(inside):
                    e = distances(x[inside], pivots[ids[own]], p)
                    low[np.ix_(inside, own)] = np.maximum(np.maximum(e - hi[own], lo[own] - e), least[inside, g][:, None])
                    up[np.ix_(inside, own)] = e + hi[own]
            few = min(k, len(ids))  # so many cells hold k rows
            least_up = np.argpartition(up, few - 1, axis=1)[:, :few]
            upper = np.take_along_axis(up, least_up, axis=1).ravel()
            bound = np.minimum(bound, reached(np.repeat(np.arange(m), few), upper, n[least_up].ravel(), m, k))
            low[low > bound[:, None] * (1 + 1e-9) + 1e-12] = np.inf
            return bound, low

        def blockwise(x: np.ndarray):
            step = max(1, REACH_CELLS // max(len(ids), 1))
            for i in range(0, len(x), step):
                yield reach(x[i:i + step])

        return ids, blockwise

    def _visits(self, queries: DataFrame) -> DataFrame:
        """``id, x, cell``: a row for each cell that a row of ``queries`` (``id, x``) cannot leave out at first."""
        ids, reach = self._reach()

        @F.arrow_udf("array<int>")
        def visited(x: pa.Array) -> pa.Array:
            if not len(x):
                return pa.array([], pa.list_(pa.int32()))
            found = [np.isfinite(low) for _, low in reach(list_matrix(x))]
            counts = np.concatenate([v.sum(axis=1) for v in found])
            cells = np.concatenate([ids[np.nonzero(v)[1]] for v in found])
            return lists_of(pa.array(cells), np.concatenate([[0], np.cumsum(counts)]))

        return queries.select("id", "x", F.explode(visited("x")).alias("cell"))

    def _blocks(self, queries: DataFrame) -> DataFrame:
        """Rows of ``id, x`` in blocks, with the distance that holds k rows and the cells that some row of a block has to visit."""
        s = self.get("state")
        pivots, key_type = np.array(s["pivots"]), dict(queries.dtypes)["id"]
        width = pivots.shape[1]
        limit, (ids, reach) = block_rows(width, s["block"]), self._reach()

        def pack(batches):
            number = 0
            for table in table_of(batches):
                rows, keys = unpacked(column(table, "x"), width), column(table, "id")
                for i in range(0, len(rows), limit):
                    part = rows[i:i + limit]
                    found = [(bound, np.isfinite(low).any(axis=0)) for bound, low in reach(part.astype(float, copy=False))]
                    needed = ids[np.logical_or.reduce([v for _, v in found])]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([(TaskContext.get().partitionId() << 32) + number]),
                        lists_of(keys[i:i + limit], np.array([0, len(part)])),
                        pa.array([part.tobytes()], pa.binary()), pa.array([part.dtype == np.float32]),
                        pa.array([np.concatenate([b for b, _ in found]).tobytes()], pa.binary()),
                        lists_of(pa.array(needed), np.array([0, len(needed)])),
                    ], names=["block", "q_ids", "q_x", "q_single", "bound", "needed"])
                    number += 1

        placed = placing(pivots, s["tops"], np.array(s["owner"]), s["p"])
        spark = queries.sparkSession
        return queries.select("id", placed("x").alias("_n")).select("id", "_n.place", "_n.x").repartitionByRange(
            parts_for(queries.count(), width, spark), "place", F.xxhash64("id")
        ).sortWithinPartitions("place").mapInArrow(
            pack, f"block long, q_ids array<{key_type}>, q_x binary, q_single boolean, bound binary, needed array<int>"
        )

    def neighbors(self, dataset: DataFrame) -> DataFrame:
        """``(id, neighbor, distance, y, place)``: the k nearest training rows of every row.

        ``visits``: how many cells, or blocks of them, the rows have met in each round.
        """
        s = self.get("state")
        k, p, spark = s["k"], s["p"], dataset.sparkSession
        queries = dataset.select(c(s["key"]).alias("id"), vector_to_array(c(self.getFeaturesCol())).alias("x"))
        blocks = settle(self._blocks(queries), "queries")
        trained = spark.read.parquet(s["path"]).select("part", "cells", "starts", "ids", "y", "x", "single")
        trained = trained.coalesce(max(1, math.ceil(s["bytes"] / PART_BYTES)))
        steps = [0, *[v for v in VISITS if len(s["cells"]) > FEW_CELLS], EVERY]
        seen = [spark.sparkContext.accumulator(0) for _ in steps[1:]]
        pivots, table = np.array(s["pivots"]), np.array(s["cells"], dtype=float)
        width = pivots.shape[1]
        lo, hi = np.zeros(len(pivots)), np.zeros(len(pivots))
        lo[table[:, 0].astype(int)], hi[table[:, 0].astype(int)] = table[:, 2], table[:, 3]

        def visit(best: Best, pieces: list, low: np.ndarray) -> None:
            """Let the rows meet the pieces ``(rows, number of the first one, section)`` that are within their limits."""
            done = np.zeros(low.shape, dtype=bool)
            for begin, end, count in zip(steps, steps[1:], seen):
                if end < EVERY:
                    few = min(end, len(pieces))
                    near = np.argpartition(low, few - 1, axis=1)[:, :few]
                    near = np.take_along_axis(near, np.argsort(np.take_along_axis(low, near, axis=1), axis=1, kind="stable"), axis=1)
                    near = near[:, begin:end]
                    row, place = np.nonzero(np.take_along_axis(low, near, axis=1) <= best.limit[:, None])
                    at = near[row, place]
                    count.add(len(at))
                    done[row, at] = True
                    order = np.argsort(at, kind="stable")
                    row, at = row[order], at[order]
                    for i, rows in zip(np.unique(at), np.split(row, np.flatnonzero(np.diff(at)) + 1)):
                        best.meet(rows, pieces[i][0], pieces[i][1])
                    continue
                sections: dict = {}
                for i, piece in enumerate(pieces):
                    sections.setdefault(piece[2], []).append(i)
                for own in sorted(sections.values(), key=lambda v: low[:, v].min()):
                    own = np.array(own)
                    asked = ~done[:, own] & (low[:, own] <= best.limit[:, None])
                    if not asked.any():
                        continue
                    rows = np.flatnonzero(asked.any(axis=1))
                    if len(own) > 1 and 2 * asked.sum() > len(rows) * len(own):
                        count.add(len(rows) * len(own))
                        best.meet(rows, np.concatenate([pieces[i][0] for i in own]), pieces[own[0]][1])
                        continue
                    count.add(int(asked.sum()))
                    for j, i in enumerate(own):
                        rows = np.flatnonzero(asked[:, j] & (low[:, i] <= best.limit))
                        if len(rows):
                            best.meet(rows, pieces[i][0], pieces[i][1])

        def met(block: dict, held: list, rank: np.ndarray):
            x, bound = read_block(block["x"], block["single"], width).astype(float), np.frombuffer(block["bound"])
            pieces, cells, ref, section = [], [], 0, 0
            for other in held:
                size, section = 0, section + 1
                for cell, a, b in zip(other["cells"], other["starts"], other["starts"][1:]):
                    for i in range(a, b, PIECE):
                        piece = other["x"][i:min(i + PIECE, b)]
                        size += len(piece)
                        if size > PIECE:
                            size, section = len(piece), section + 1
                        pieces.append((piece, ref + i, section))
                        cells.append(cell)
                ref += len(other["ids"])
            cells = np.array(cells)
            step = max(1, REACH_CELLS // len(cells))
            distinct, back = np.unique(cells, return_inverse=True)
            neighbor, y = (pa.concat_arrays([other[v] for other in held]) for v in ("ids", "y"))
            for i in range(0, len(x), step):
                part = x[i:i + step]
                e = distances(part, pivots[distinct], p)
                best = Best(part, bound[i:i + step], k, p, rank)
                low = np.maximum(np.maximum(e - hi[distinct], lo[distinct] - e), 0.0) * (1 - 1e-9) - 1e-12
                visit(best, pieces, low[:, back])
                row, place = np.nonzero(best.ref >= 0)
                chosen = pa.array(best.ref[row, place])
                yield pa.RecordBatch.from_arrays([
                    block["ids"].take(pa.array(row + i)), neighbor.take(chosen), pa.array(best.distance[row, place]), y.take(chosen),
                ], names=["id", "neighbor", "distance", "y"])

        def meet(batches):
            cache: dict = {}
            block, held, ranks = None, [], (None, None)

            def closed():
                nonlocal ranks
                held.sort(key=lambda v: v["part"])
                numbers = tuple(v["part"] for v in held)
                if ranks[0] != numbers:
                    rank = pc.rank(pa.concat_arrays([v["ids"] for v in held]), null_placement="at_end", tiebreaker="dense")
                    ranks = numbers, rank.to_numpy(zero_copy_only=False).astype(np.int64)
                return met(block, held, ranks[1])

            for batch in batches:
                numbers, parts = batch.column("block").to_pylist(), batch.column("part").to_pylist()
                for i, (number, part) in enumerate(zip(numbers, parts)):
                    if block is None or block["block"] != number:
                        if held:
                            yield from closed()
                        values = {v: batch.column(f"q_{v}")[i] for v in ("ids", "x", "single")}
                        block = {
                            "block": number, "ids": pa.concat_arrays([values["ids"].values]), "x": values["x"].as_py(),
                            "single": values["single"].as_py(), "bound": batch.column("bound")[i].as_py(),
                        }
                        held = []
                    if part not in cache:
                        cells, starts, x = (batch.column(v)[i].as_py() for v in ("cells", "starts", "x"))
                        ids, y = (batch.column(v)[i].values.take(pa.array(np.arange(starts[-1]))) for v in ("ids", "y"))
                        x = read_block(x, batch.column("single")[i].as_py(), width)
                        cache[part] = {"part": part, "cells": cells, "starts": starts, "ids": ids, "y": y, "x": x}
                    held.append(cache[part])
            if held:
                yield from closed()

        key_type, own_type = dict(queries.dtypes)["id"], dict(trained.dtypes)["ids"].removeprefix("array<")[:-1]
        # A product of parts shuffles nothing and holds one part of the training rows in a task.
        pairs = blocks.join(trained.hint("shuffle_replicate_nl"), F.arrays_overlap("needed", "cells")).drop("needed")
        found = pairs.mapInArrow(meet, f"id {key_type}, neighbor {own_type}, distance double, y double")
        order = W.partitionBy("id").orderBy("distance", "neighbor")
        with batches_of(spark, PAIRS):
            best = settle(found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k), "best")
        self.visits = [v.value for v in seen]
        return best

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.get("state")
        near = self.neighbors(dataset)
        if s["weights"] == "uniform":
            value = F.avg("y")
        else:
            # Exact matches decide alone; otherwise weights are inverse distances.
            hits = F.count_if(F.col("distance") == 0)
            weight = F.when(F.col("distance") > 0, 1 / F.col("distance"))
            value = F.when(
                hits > 0, F.sum(F.when(F.col("distance") == 0, F.col("y"))) / hits
            ).otherwise(F.sum(weight * F.col("y")) / F.sum(weight))
        predicted = near.groupBy(F.col("id").alias(s["key"])).agg(value.alias(self.getPredictionCol()))
        return dataset.join(predicted, s["key"], "left")
