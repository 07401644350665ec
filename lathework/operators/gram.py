"""One-scan sums of numpy results: cross-product matrices and other small statistics.

Each task reduces its Arrow batches with numpy to one small array; Spark sums the arrays by
cell. What reaches the driver is as large as the statistic, whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c, present

MAX_COLUMNS = 2000


def as_array(df: DataFrame, columns) -> Column:
    """Array column from a vector column's name, or from a list of names or columns."""
    if isinstance(columns, str):
        return vector_to_array(c(columns)) if df.schema[columns].dataType.typeName() != "array" else c(columns)
    return F.array(*[(c(x) if isinstance(x, str) else x).cast("double") for x in columns])


def matrix_of(batch: pa.RecordBatch, name="x") -> np.ndarray:
    """Rows of an array column as a matrix."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def numeric_rows(df: DataFrame, columns, **scalars) -> DataFrame:
    """``x array<double>`` plus named double columns. Missing values are seen to in numpy.

    A filter over all columns would make every one of them a constraint of the plan, whose
    number the optimizer doubles with each renamed column.
    """
    return df.select(as_array(df, columns).alias("x"), *[v.cast("double").alias(k) for k, v in scalars.items()])


def whole_rows(batch: pa.RecordBatch, on_missing="raise") -> pa.RecordBatch:
    """The batch, if no row misses a value; with ``drop`` the rows that miss none."""
    missing = np.zeros(batch.num_rows, dtype=bool)
    for name in batch.schema.names:
        if pa.types.is_list(batch.schema.field(name).type):
            if batch.column(name).null_count:
                missing |= batch.column(name).is_null().to_numpy(zero_copy_only=False)
            else:
                missing |= np.isnan(matrix_of(batch, name)).any(axis=1)
        else:
            missing |= np.isnan(batch.column(name).to_numpy(zero_copy_only=False).astype(float))
    if not missing.any():
        return batch
    if on_missing != "drop":
        raise ValueError(f"{int(missing.sum())} rows of a batch miss a value: fill them first, or ask for on_missing='drop'")
    return batch.filter(pa.array(~missing))


def summed(rows: DataFrame, reduce_batch, on_missing="raise") -> dict[int, np.ndarray]:
    """Sum over all batches of ``reduce_batch(batch) -> {group: 1-d array}``, by group and cell.

    A missing value is an error, unless ``on_missing`` is ``drop``, which leaves its row out,
    or ``keep``, which hands it to ``reduce_batch``.
    """

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if on_missing != "keep":
                batch = whole_rows(batch, on_missing)
            if batch.num_rows:
                for g, cells in reduce_batch(batch).items():
                    sums[g] = sums[g] + cells if g in sums else cells
        for g, cells in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(cells), g, dtype="int64")),
                    pa.array(np.arange(len(cells), dtype="int32")), pa.array(cells.astype("float64")),
                ],
                names=["grp", "cell", "v"],
            )

    cells = (
        rows.mapInArrow(partial, "grp long, cell int, v double")
        .groupBy("grp", "cell").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    )
    out = {}
    for g, part in cells.groupby("grp"):
        values = np.zeros(int(part["cell"].max()) + 1)
        values[part["cell"].to_numpy()] = part["v"].to_numpy()
        out[int(g)] = values
    return out


@dataclass
class Moments:
    """Sums over the rows of a group: weight ``n`` and shifted ``total`` and ``cross`` products."""

    n: float
    total: np.ndarray
    cross: np.ndarray
    centre: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.centre + self.total / self.n

    @property
    def scatter(self) -> np.ndarray:
        """Sum of products of deviations from the group's own mean."""
        return self.cross - np.outer(self.total, self.total) / self.n

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.n + other.n, self.total + other.total, self.cross + other.cross, self.centre)

    def __sub__(self, other: "Moments") -> "Moments":
        return Moments(self.n - other.n, self.total - other.total, self.cross - other.cross, self.centre)


def means(rows: DataFrame) -> np.ndarray:
    """Mean of the values there are of every entry of ``x``; JVM-side, one scan."""
    first = rows.select(F.size("x").alias("p")).first()
    if first is None:
        raise ValueError("no rows to fit on")
    row = rows.agg(*[F.avg(present(F.col("x")[i])).alias(f"m{i}") for i in range(first["p"])]).first()
    return np.asarray([v or 0.0 for v in row], dtype=float)


def moments(df: DataFrame, columns, centre=None, group: Column | None = None,
            weight: Column | None = None, on_missing="drop") -> dict[int, Moments]:
    """Weight, sums and cross products per group, in one scan.

    ``centre`` is subtracted first, which keeps sums of large values exact enough; by default
    it is the mean of each column, from one cheap aggregate. ``group`` must be a whole number
    with few values, such as a fold. A row that misses a value is left out, or with ``on_missing``
    of ``raise`` is an error, as every estimator asks for; ``n`` is the weight of the rows that
    took part.
    """
    rows = numeric_rows(
        df, columns, g=F.lit(0) if group is None else group, w=F.lit(1.0) if weight is None else weight
    )
    shift = means(rows) if centre is None else np.asarray(centre, dtype=float)
    p = len(shift)
    if p > MAX_COLUMNS:
        raise ValueError(f"{p} columns: a cross-product matrix is for at most {MAX_COLUMNS}")
    upper = np.triu_indices(p + 1)

    def reduce_batch(batch):
        grp = batch.column("g").to_numpy()
        x = np.hstack([np.ones((batch.num_rows, 1)), matrix_of(batch) - shift])
        wx = x * batch.column("w").to_numpy()[:, None]
        out = {}
        for g in np.unique(grp):
            pick = grp == g
            out[int(g)] = (wx[pick].T @ x[pick])[upper]
        return out

    out = {}
    for g, cells in summed(rows, reduce_batch, on_missing).items():
        out[g] = unpacked(cells, upper, shift)
    return out


def unpacked(cells: np.ndarray, upper, shift) -> Moments:
    """Moments from the upper triangle of the products of ``[1, x - shift]``."""
    full = np.zeros((len(shift) + 1, len(shift) + 1))
    full[upper] = cells
    full = full + np.triu(full, 1).T
    return Moments(float(full[0, 0]), full[0, 1:], full[1:, 1:], shift)


def pooled(parts: dict[int, Moments]) -> Moments:
    """All groups together."""
    values = list(parts.values())
    if not values:
        raise ValueError("no rows to fit on")
    out = values[0]
    for m in values[1:]:
        out = out + m
    return out
