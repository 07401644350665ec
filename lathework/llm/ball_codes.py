"""Product codes of vectors by ball k-means.

Each part of a vector has a codebook of its own. An entry and the parts it holds are a ball; the
ball's radius tells which entries are near enough to take parts from it, its neighbours. A part
closer to its entry than half the way to the nearest neighbour is in the stable core and is not
looked at. The others lie in rings between the half ways to one neighbour and the next, and are
compared with the neighbours of the rings within only. All distances are squared whole numbers,
so the codes are those of a full search, ties included.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from lathework.functions.columns import c
from lathework.llm.hot import attach
from lathework.operators.stages import list_matrix
from lathework.session import settle

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
BLOCK = 1 << 13  # rows whose candidates are looked at together


@dataclass
class Balls:
    """Entries of one part position with their neighbours, near ones first."""

    entries: np.ndarray  # entry x component
    start: np.ndarray  # where an entry's neighbours begin
    neighbour: np.ndarray
    gap: np.ndarray  # squared distances to the neighbours, offset by the entry so that they are sorted
    stride: int

    @classmethod
    def of(cls, entries: np.ndarray, reach: np.ndarray) -> "Balls":
        """``reach``: radius of each entry's ball, from above (infinite if not known)."""
        n = len(entries)
        squared = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        near = np.sqrt(squared.astype(float)) <= 2 * reach[:, None] * (1 + 1e-9) + 1e-6
        near[np.arange(n), np.arange(n)] = False
        owner, other = np.nonzero(near)
        order = np.lexsort((other, squared[owner, other], owner))
        owner, other = owner[order], other[order]
        stride = int(squared.max(initial=0)) + 2
        return cls(entries, np.searchsorted(owner, np.arange(n + 1)), other, squared[owner, other] + owner * stride, stride)

    def assign(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row and its squared distance; ``own`` is the entry it was in."""
        n = len(self.entries)
        best = ((x - self.entries[own]) ** 2).sum(axis=1)
        # the ring: how many neighbours are at most twice as far from the entry as the row is
        ring = np.searchsorted(self.gap, own * self.stride + np.minimum(4 * best, self.stride - 1), side="right") - self.start[own]
        key = best * n + own
        for begin in range(0, len(x), BLOCK):
            outer = begin + np.flatnonzero(ring[begin:begin + BLOCK])  # rows outside the stable cores
            if not len(outer):
                continue
            count = ring[outer]
            first = np.concatenate([[0], np.cumsum(count)[:-1]])
            row = np.repeat(outer, count)
            entry = self.neighbour[np.repeat(self.start[own[outer]] - first, count) + np.arange(len(row))]
            far = ((x[row] - self.entries[entry]) ** 2).sum(axis=1) * n + entry
            key[outer] = np.minimum(key[outer], np.minimum.reduceat(far, first))
        return key % n, key // n


def whole_vectors(vectors: DataFrame, parts=PARTS, vec_id="vec_id", vector="embedding", label="label", scale=SCALE) -> DataFrame:
    """``vec_id, label, q``: the kept vectors as whole numbers ``floor(scale * x)``.

    Vectors that are null or hold a null or a number that is not finite are dropped. All others
    must be of one length that ``parts`` divides, with components that leave room for squared
    distances in 64 bits; else an error says so.
    """
    x = c(vector).cast("array<double>")
    return vectors.select(c(vec_id).alias("vec_id"), c(label).alias("label"), x.alias("x")).filter(
        F.col("x").isNotNull() & finite("x")
    ).select("vec_id", "label", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("q"))


def finite(name: str) -> Column:
    """Every component is a finite number."""
    return F.forall(F.col(name), lambda v: F.coalesce((F.abs(v) <= F.lit(1.7976931348623157e308)) & ~F.isnan(v), F.lit(False)))


def checked(q: DataFrame, parts: int, entries: int) -> int:
    """The common length of the vectors, 0 if there are none."""
    size = F.size("q")
    low, high, most = q.agg(F.min(size), F.max(size), F.max(F.greatest(F.array_max("q"), -F.array_min("q")))).first()
    if low is None:
        return 0
    if low != high or low % parts or not low:
        raise ValueError(f"vectors of {low} to {high} components cannot all be cut into {parts} equal parts")
    if (low // parts) * (2 * (most or 0)) ** 2 * 4 * entries >= 1 << 62:
        raise ValueError("components too large for exact distances in 64 bits")
    return low


def assigned(codes: DataFrame, balls: list[Balls]) -> DataFrame:
    """``codes`` (``vec_id, label, q, code, error``) with the nearest entries of these balls."""
    schema = StructType([*codes.schema.fields[:3], StructField("code", BinaryType()), StructField("error", LongType())])
    shared = codes.sparkSession.sparkContext.broadcast(balls)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = list_matrix(batch.column("q")).astype(np.int64)
            x = x.reshape(len(x), len(shared.value), -1)
            own = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(x), -1)
            code, error = np.empty_like(own), np.zeros(len(x), np.int64)
            for p, ball in enumerate(shared.value):
                found, far = ball.assign(np.ascontiguousarray(x[:, p]), own[:, p].astype(np.int64))
                code[:, p] = found
                error += far
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in ("vec_id", "label", "q")], pa.array([r.tobytes() for r in code], pa.binary()), pa.array(error)],
                names=schema.names,
            )

    return codes.mapInArrow(run, schema)


def statistics(codes: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, sums and largest squared distance of the parts in each ball.

    Each task adds up its own rows; what is summed has the size of the codebooks.
    """
    parts, entries, width = books.shape
    shared = codes.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        count, total = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64)
        most = np.full(parts * entries, -1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = list_matrix(batch.column("q")).astype(np.int64).reshape(batch.num_rows, parts, width)
            own = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(x), parts).astype(np.int64)
            far = ((x - shared.value[np.arange(parts), own]) ** 2).sum(axis=2)
            cell = (own + np.arange(parts) * entries).ravel()
            np.add.at(count, cell, 1)
            np.add.at(total, cell, x.reshape(-1, width))
            np.maximum.at(most, cell, far.ravel())
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(count[used]), pa.array(most[used]), pa.array(list(total[used]), pa.list_(pa.int64()))],
            names=["cell", "n", "most", "total"],
        )

    sums = codes.select("q", "code").mapInArrow(run, "cell long, n long, most long, total array<long>").groupBy("cell").agg(
        F.sum("n").alias("n"), F.max("most").alias("most"), F.array(*[F.sum(F.col("total")[i]) for i in range(width)]).alias("total")
    )
    count, total, most = np.zeros(parts * entries, np.int64), np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
    for r in sums.collect():
        count[r["cell"]], total[r["cell"]], most[r["cell"]] = r["n"], r["total"], r["most"]
    shape = parts, entries
    return count.reshape(shape), total.reshape(*shape, width), most.reshape(shape)


def moved(books: np.ndarray, count: np.ndarray, total: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next codebooks and an upper bound of each ball's radius around its new entry."""
    new = np.where(count[..., None] > 0, total // np.maximum(count, 1)[..., None], books)
    shift = np.sqrt(((new - books) ** 2).sum(axis=2).astype(float))
    return new, np.sqrt(most.astype(float)) + shift


def fit_codes(vectors: DataFrame, parts=PARTS, entries=ENTRIES, rounds=ROUNDS, vec_id="vec_id", vector="embedding", label="label",
              scale=SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, q, code, error`` of every kept vector, and the codebooks (part x entry x component).

    Codebooks start from the ``entries`` smallest ids (then label, then components; null ids last),
    all of them if there are fewer. ``code`` has a byte for each part, so ``entries`` is 256 at most.
    A table without kept vectors gives an empty one and no codebooks.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    rows = settle(whole_vectors(vectors, parts, vec_id, vector, label, scale), "vectors")
    size = checked(rows, parts, entries)
    blank = F.unhex(F.lit("00" * parts))
    codes = rows.select("vec_id", "label", "q", blank.alias("code"), F.lit(0).cast("long").alias("error"))
    if not size:
        return codes, np.zeros((parts, 0, 0), np.int64)
    # a bounded number of rows, whatever the size of the table
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "label", "q").limit(entries).collect()
    books = np.array([r["q"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    reach = np.full(books.shape[:2], np.inf)  # nothing is known of the balls at first
    for k in range(rounds + 1):
        codes = settle(assigned(codes, [Balls.of(b, r) for b, r in zip(books, reach)]), f"codes{k}")
        if k < rounds:
            books, reach = moved(books, *statistics(codes, books))
    return codes, books


def codebook_text(books: np.ndarray) -> str:
    """All components in the order of part, entry and position, joined by commas."""
    return ",".join(map(str, books.ravel().tolist()))


def vector_codes(vectors: DataFrame, vec_id="vec_id", vector="embedding", label="label", **options) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept vector.

    ``code`` is hexadecimal, two digits for each part; ``error`` is the sum of squared distances,
    ``label_error`` its sum over the rows of the same label, nulls together. Repeated rows count
    one by one. A table without kept vectors gives an empty table. Other columns are not read.
    """
    codes, books = fit_codes(vectors, vec_id=vec_id, vector=vector, label=label, **options)
    of_label = settle(codes.groupBy("label").agg(
        F.sum("error").alias("label_error"), F.count("*").alias("_n")
    ), "labels")
    out = attach(codes.select("vec_id", "label", "code", "error"), of_label, "label", "_n")
    return out.select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.sha2(F.lit(codebook_text(books)), 256).alias("codebooks_sha256")
    )
