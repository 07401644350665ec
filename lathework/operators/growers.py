"""Growing many trees together, level by level, from sums over Arrow batches.

The driver holds the trees, tasks route their rows through them. A level of all trees takes two
scans: one for the range of every feature in every open node, from which thresholds are drawn,
one for the sums on both sides of each threshold. What comes back is as large as the open nodes,
and trees are taken in turn where their nodes together are too many for one scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lathework.operators.gram import matrix_of
from lathework.operators.stages import list_matrix

CELLS = 1 << 20  # numbers that one scan brings back at most, for one tree at least
SAMPLE_ROWS = 10_000  # of each tree's rows, or the square of the bins, from which thresholds are taken
SAMPLE_FEATURES = 128  # features of the sample that the driver holds at once


def blocks_of(rows: DataFrame, reduce_batch, best=np.add) -> dict[int, np.ndarray]:
    """``reduce_batch(batch) -> {block: array}`` over all batches, arrays of a block joined by ``best``.

    Each task joins its own batches first; blocks then meet by number, so no task sees all of them.
    """

    def joined(pairs):
        out: dict[int, np.ndarray] = {}
        for block, values in pairs:
            out[block] = best(out[block], values) if block in out else values
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(out), pa.int64()), pa.array([np.ascontiguousarray(v, dtype="<f8").tobytes() for v in out.values()], pa.binary())],
            names=["block", "cells"],
        )

    def first(batches):
        return joined((k, v) for batch in batches if batch.num_rows for k, v in reduce_batch(batch).items())

    def second(batches):
        return joined(
            (k, np.frombuffer(v, "<f8")) for batch in batches for k, v in zip(batch.column("block").to_pylist(), batch.column("cells").to_pylist())
        )

    kind = "block long, cells binary"
    found = rows.mapInArrow(first, kind).repartition("block").mapInArrow(second, kind).toArrow()
    return {k: np.frombuffer(v, "<f8") for k, v in zip(found.column("block").to_pylist(), found.column("cells").to_pylist())}


@dataclass
class Tree:
    """Nodes in the order in which they were made; a leaf has feature -1, a right child follows its left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    name: list[int] = field(default_factory=lambda: [1])  # root 1, children of n are 2n and 2n + 1
    depth: int = 0

    def split(self, node: int, feature: int, threshold: float, values) -> int:
        """Make two children of ``node``; gives the left one."""
        at = len(self.feature)
        self.feature[node], self.threshold[node], self.left[node] = int(feature), float(threshold), at
        for side in (0, 1):
            self.feature.append(-1)
            self.threshold.append(0.0)
            self.left.append(0)
            self.value.append(float(values[side]))
            self.name.append(2 * self.name[node] + side)
        self.depth = max(self.depth, self.name[node].bit_length())
        return at

    def state(self) -> dict:
        return {"feature": self.feature, "threshold": self.threshold, "left": self.left, "value": self.value, "depth": self.depth}


class Routes:
    """A tree as arrays, for routing whole batches."""

    def __init__(self, tree: dict):
        self.feature, self.left = (np.array(tree[k], dtype=np.int64) for k in ("feature", "left"))
        self.threshold, self.value = (np.array(tree[k], dtype=float) for k in ("threshold", "value"))
        self.depth = tree["depth"]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row: left where the entry is at most the threshold."""
        at, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        for _ in range(self.depth):
            feature = self.feature[at]
            right = x[rows, np.maximum(feature, 0)] > self.threshold[at]
            at = np.where(feature < 0, at, self.left[at] + right)
        return at


def bag(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Bootstrap weights of the rows in a tree: Poisson(1) by a hash of row key and tree."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + tree * 0xC2B2AE3D27D4EB4F) & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    u = (x >> np.uint64(11)).astype(float) / float(1 << 53)
    steps = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 12)]))
    return np.searchsorted(steps, u, side="right").astype(float)


def node_draws(seed: int, tree: int, name: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """The order in which a node tries the features, and a uniform number for each feature's threshold."""
    rng = np.random.default_rng([seed, tree, name])
    return rng.permutation(features), rng.random(features)


@dataclass
class RandomSplits:
    """Extremely randomised regression trees: each node draws one threshold for each feature it tries.

    A node tries ``tries`` features that vary in it, each at a threshold drawn between the least and
    the largest value in the node, and takes the one that leaves the least squares. Rows are
    ``x`` (array), ``y`` and ``key`` (a number, of use with ``bootstrap`` only).
    """

    trees: int
    tries: int
    min_split: int = 2
    min_leaf: int = 1
    max_depth: int = 10
    bootstrap: bool = False
    seed: int = 7
    groups: int = 0
    scans: int = 0

    def grow(self, rows: DataFrame, features: int) -> list[Tree]:
        grown = [Tree() for _ in range(self.trees)]
        opened: dict[int, list[int]] = {t: [0] for t in range(self.trees)}
        for depth in range(self.max_depth):
            opened = {t: nodes for t, nodes in opened.items() if nodes}
            if not opened:
                break
            following: dict[int, list[int]] = {}
            for part in self._parts(opened, features):
                ranges = self._ranges(rows, grown, part, features)
                drawn = {t: self._draw(grown[t], t, nodes, ranges[t]) for t, nodes in part.items()}
                sums = self._sums(rows, grown, part, drawn)
                for t, nodes in part.items():
                    following[t] = self._split(grown[t], nodes, drawn[t], sums[t])
            opened = following
        return grown

    def _parts(self, opened: dict, features: int):
        """Trees whose open nodes go into one scan."""
        share = -(-len(opened) // self.groups) if self.groups else len(opened)
        part, cells = {}, 0
        for t, nodes in opened.items():
            size = len(nodes) * 2 * (features + 1)
            if part and (cells + size > CELLS or len(part) >= share):
                yield part
                part, cells = {}, 0
            part[t], cells = nodes, cells + size
        yield part

    def _held(self, grown: list[Tree], part: dict):
        """``batch -> (tree, rows, slot, weight)`` for the rows in open nodes, a slot for each of them."""
        routes = {t: Routes(grown[t].state()) for t in part}
        slots = {}
        for t, nodes in part.items():
            slots[t] = np.full(len(grown[t].feature), -1)
            slots[t][nodes] = np.arange(len(nodes))
        bootstrap, seed = self.bootstrap, self.seed

        def held(batch, x):
            keys = batch.column("key").to_numpy()
            for t, route in routes.items():
                slot = slots[t][route.leaves(x)]
                weight = bag(keys, t, seed) if bootstrap else np.ones(len(x))
                inside = np.flatnonzero((slot >= 0) & (weight > 0))
                if len(inside):
                    yield t, inside, slot[inside], weight[inside]

        return held

    def _ranges(self, rows: DataFrame, grown: list[Tree], part: dict, features: int) -> dict[int, np.ndarray]:
        """For each tree ``slot x (features and label) x (least, largest)``."""
        held, sizes = self._held(grown, part), {t: len(nodes) for t, nodes in part.items()}

        def reduce_batch(batch):
            x = matrix_of(batch)
            both = np.hstack([x, batch.column("y").to_numpy()[:, None]])
            out = {}
            for t, inside, slot, _ in held(batch, x):
                order = np.argsort(slot, kind="stable")
                used, begin = np.unique(slot[order], return_index=True)
                values = both[inside[order]]
                most = np.full((sizes[t], 2, both.shape[1]), -np.inf)
                most[used, 0] = np.maximum.reduceat(-values, begin)
                most[used, 1] = np.maximum.reduceat(values, begin)
                out[t] = most.ravel()
            return out

        self.scans += 1
        found = blocks_of(rows, reduce_batch, np.maximum)
        if len(found) < len(part):
            raise ValueError("no rows to fit on")
        shape = {t: (n, 2, features + 1) for t, n in sizes.items()}
        return {t: np.stack([-v.reshape(shape[t])[:, 0], v.reshape(shape[t])[:, 1]], axis=2) for t, v in found.items()}

    def _draw(self, tree: Tree, t: int, nodes: list[int], ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features (-1 for none) and thresholds that each open node tries."""
        feature, threshold = np.full((len(nodes), self.tries), -1), np.zeros((len(nodes), self.tries))
        for slot, node in enumerate(nodes):
            low, high = ranges[slot, :, 0], ranges[slot, :, 1]
            if low[-1] == high[-1]:
                continue  # all labels are the same
            order, u = node_draws(self.seed, t, tree.name[node], len(low) - 1)
            picked = order[low[order] < high[order]][:self.tries]
            at = low[picked] + u[picked] * (high[picked] - low[picked])
            feature[slot, :len(picked)] = picked
            threshold[slot, :len(picked)] = np.where(at >= high[picked], low[picked], at)
        return feature, threshold

    def _sums(self, rows: DataFrame, grown: list[Tree], part: dict, drawn: dict) -> dict[int, np.ndarray]:
        """For each tree ``slot x (weight, label sum) x (all rows, left of each threshold)``."""
        held, tries = self._held(grown, part), self.tries

        def reduce_batch(batch):
            x, y = matrix_of(batch), batch.column("y").to_numpy()
            out = {}
            for t, inside, slot, weight in held(batch, x):
                feature, threshold = drawn[t]
                n, label = len(feature), weight * y[inside]
                cells = np.empty((n, 2, tries + 1))
                for i, values in enumerate((weight, label)):
                    cells[:, i, 0] = np.bincount(slot, values, n)
                for j in range(tries):
                    f = feature[slot, j]
                    left = (f >= 0) & (x[inside, np.maximum(f, 0)] <= threshold[slot, j])
                    for i, values in enumerate((weight, label)):
                        cells[:, i, j + 1] = np.bincount(slot[left], values[left], n)
                out[t] = cells.ravel()
            return out

        self.scans += 1
        return {t: v.reshape(-1, 2, tries + 1) for t, v in blocks_of(rows, reduce_batch).items()}

    def _split(self, tree: Tree, nodes: list[int], drawn, sums: np.ndarray) -> list[int]:
        """Split the open nodes where a threshold is allowed; gives the children that are open."""
        feature, threshold = drawn
        opened = []
        for slot, node in enumerate(nodes):
            (n, *left), (total, *label) = sums[slot]
            left, label = np.array(left), np.array(label)
            if node == 0:
                tree.value[0] = total / n
            allowed = (feature[slot] >= 0) & (np.minimum(left, n - left) >= max(self.min_leaf, 1))
            if n < self.min_split or not allowed.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(allowed, label ** 2 / left + (total - label) ** 2 / (n - left), -np.inf)
            best = int(gain.argmax())
            sizes = left[best], n - left[best]
            at = tree.split(node, feature[slot, best], threshold[slot, best], (label[best] / sizes[0], (total - label[best]) / sizes[1]))
            opened += [at + side for side in (0, 1) if sizes[side] >= max(self.min_split, 2 * self.min_leaf, 2)]
        return opened


def thresholds(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Middles between distinct values, or between as many groups of near equal weight as there are bins."""
    distinct, back = np.unique(values, return_inverse=True)
    size = np.bincount(back, weights)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) < bins:
        return middles
    stride, total = size.sum() / bins, np.cumsum(size)
    target, picked = stride, []
    for i in range(1, len(distinct)):
        if abs(total[i - 1] - target) < abs(total[i] - target):
            picked.append(i - 1)
            target += stride
    return middles[picked]


@dataclass
class BestSplits:
    """Regression trees whose nodes take the best of all binned thresholds, grown together over weighted rows.

    Rows are ``x`` (array), ``y`` and ``w`` (array: the row's weight in each tree). Each tree has its own thresholds,
    at most ``bins - 1`` of a feature, from a sample of its rows. A level takes one scan: tasks add up rows, weights
    and labels by node, feature and bin, so what is held and brought back does not grow with the rows.
    """

    trees: int
    tries: int
    bins: int = 32
    min_leaf: int = 1
    max_depth: int = 5
    seed: int = 7

    def grow(self, rows: DataFrame, features: int, count: int) -> list[Tree]:
        cuts, centre = self._cuts(rows, features, count)
        grown = [Tree() for _ in range(self.trees)]
        opened: list[tuple[int, int]] = [(t, 0) for t in range(self.trees)]
        for depth in range(max(self.max_depth, 1)):
            following = []
            for part in self._parts(opened, features):
                sums = self._sums(rows, grown, part, cuts, centre, features)
                for t, nodes in part.items():
                    following += [(t, n) for n in self._split(grown[t], t, nodes, cuts[t], sums.get(t), features)]
            opened = following
            if not opened:
                break
        for tree in grown:
            tree.value = [v + centre for v in tree.value]
        return grown

    def _cuts(self, rows: DataFrame, features: int, count: int) -> tuple[list[list[np.ndarray]], float]:
        """Thresholds by tree and feature, and a number near the labels' mean."""
        wanted = max(self.bins ** 2, SAMPLE_ROWS)
        # Two thirds of the rows weigh something in a tree.
        part = rows if count <= 1.5 * wanted else rows.sample(min(1.0, 2.0 * wanted / count), self.seed)
        cuts: list[list[np.ndarray]] = [[] for _ in range(self.trees)]
        centre = 0.0
        for begin in range(0, features, SAMPLE_FEATURES):
            found = part.select(F.slice("x", begin + 1, SAMPLE_FEATURES).alias("x"), "y", "w").toArrow()
            if not found.num_rows:
                raise ValueError("no rows to fit on")
            x, w = (np.array(found.column(n).to_pylist(), dtype=float) for n in ("x", "w"))
            centre = float(np.mean(found.column("y").to_numpy()))
            for t in range(self.trees):
                held = w[:, t] > 0
                cuts[t] += [thresholds(x[held, f], w[held, t], self.bins) for f in range(x.shape[1])]
        return cuts, centre

    def _parts(self, opened: list[tuple[int, int]], features: int):
        """Open nodes by tree, as many as go into one scan."""
        most = max(1, CELLS // (3 * features * self.bins))
        for i in range(0, len(opened), most):
            part: dict[int, list[int]] = {}
            for t, node in opened[i:i + most]:
                part.setdefault(t, []).append(node)
            yield part

    def _sums(self, rows: DataFrame, grown: list[Tree], part: dict, cuts, centre: float, features: int) -> dict[int, np.ndarray]:
        """For each tree ``(rows, weight, label sum) x slot x feature x bin``."""
        routes, slots = {t: Routes(grown[t].state()) for t in part}, {}
        for t, nodes in part.items():
            slots[t] = np.full(len(grown[t].feature), -1)
            slots[t][nodes] = np.arange(len(nodes))
        bins, trees = self.bins, self.trees
        own = {t: cuts[t] for t in part}

        def reduce_batch(batch):
            x, y = list_matrix(batch.column("x")), batch.column("y").to_numpy() - centre
            if not np.isfinite(x).all():
                raise ValueError("a feature is no finite number")
            w = batch.column("w").flatten().to_numpy().reshape(-1, trees)
            out = {}
            for t, route in routes.items():
                slot, n = slots[t][route.leaves(x)], int(slots[t].max()) + 1
                inside = np.flatnonzero((slot >= 0) & (w[:, t] > 0))
                slot, weight, label = slot[inside], w[inside, t], w[inside, t] * y[inside]
                cells = np.empty((3, n, features, bins))
                for f in range(features):
                    at = slot * bins + np.searchsorted(own[t][f], x[inside, f], side="left")
                    for i, values in enumerate((None, weight, label)):
                        cells[i, :, f] = np.bincount(at, values, n * bins).reshape(n, bins)
                out[t] = cells.ravel()
            return out

        found = blocks_of(rows, reduce_batch)
        return {t: v.reshape(3, -1, features, bins) for t, v in found.items()}

    def _split(self, tree: Tree, t: int, nodes: list[int], cuts: list[np.ndarray], sums, features: int) -> list[int]:
        """Split the open nodes where that leaves less squares; gives the children that may be split in turn."""
        if sums is None or not sums[0].any():
            raise ValueError("no rows to fit on")
        opened = []
        for slot, node in enumerate(nodes):
            rows, weight, label = sums[:, slot]
            n, total, squares = rows[0].sum(), weight[0].sum(), label[0].sum()
            if node == 0:
                tree.value[0] = squares / total
            picked = np.arange(features)
            if self.tries < features:
                picked = np.sort(node_draws(self.seed, t, tree.name[node], features)[0][:self.tries])
            left, w, s = (np.cumsum(v[picked], axis=1)[:, :-1] for v in (rows, weight, label))
            allowed = (np.minimum(left, n - left) >= max(self.min_leaf, 1)) & (
                np.arange(self.bins - 1) < np.array([len(cuts[f]) for f in picked])[:, None]
            )
            if tree.name[node].bit_length() > self.max_depth or not allowed.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(allowed, s ** 2 / w + (squares - s) ** 2 / (total - w) - squares ** 2 / total, -np.inf)
            f, b = np.unravel_index(int(gain.argmax()), gain.shape)
            if not gain[f, b] > 0:
                continue
            at = tree.split(node, picked[f], cuts[picked[f]][b], (s[f, b] / w[f, b], (squares - s[f, b]) / (total - w[f, b])))
            opened += [at, at + 1]
        return opened if opened and tree.name[opened[0]].bit_length() <= self.max_depth else []
