"""Filling missing values: constants, group means, column means and chained regressions."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Imputer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lathework.functions.columns import c, key_bucket, numeric_columns, present
from lathework.operators.combine import join_statistics
from lathework.operators.gram import Moments, matrix_of, summed, unpacked
from lathework.operators.quantiles import exact_quantiles


def fill_absent_category(df: DataFrame, columns, level="None") -> DataFrame:
    """Missing means "has none": a level of its own."""
    return fill_rules(df, {n: level for n in columns})


def fill_zero(df: DataFrame, columns) -> DataFrame:
    return fill_rules(df, {n: 0 for n in columns})


def fill_rules(df: DataFrame, rules: dict) -> DataFrame:
    """Column to constant, all in one projection; NaN counts as missing."""
    types = dict(df.dtypes)
    unknown = [n for n in rules if n not in types]
    if unknown:
        raise KeyError(f"not in the table: {unknown}")

    def filled(name: str) -> Column:
        if name not in rules:
            return c(name)
        value = F.lit(rules[name]).cast(types[name])
        col = F.nanvl(c(name), value) if types[name] in ("double", "float") else c(name)
        return F.coalesce(col, value).alias(name)

    return df.select(*[filled(n) for n in df.columns])


@dataclass
class GroupMean:
    """Mean per group, learned by one aggregate and joined back as a small table.

    Rows without a group, and groups without any value, stay missing. Fit on the training
    rows; fitting on all rows gives the leaky variant.
    """

    group: str
    column: str
    stats: DataFrame | None = None

    def fit(self, df: DataFrame) -> "GroupMean":
        rows = df.filter(c(self.group).isNotNull()).groupBy(c(self.group))
        self.stats = rows.agg(F.avg(present(c(self.column).cast("double"))).alias("_group_mean"))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        joined = join_statistics(df, self.stats, self.group)
        own = present(c(self.column).cast("double"))
        return joined.select(
            *[
                F.coalesce(own, F.col("_group_mean")).alias(n) if n == self.column else c(n)
                for n in df.columns
            ]
        )


def fill_group_mean(df: DataFrame, group: str, column: str, fit_on: DataFrame | None = None) -> DataFrame:
    return GroupMean(group, column).fit(df if fit_on is None else fit_on).transform(df)


def group_transform(df: DataFrame, group: str, aggregate: Column, name: str) -> DataFrame:
    """A statistic of each group on every row of the group.

    Aggregate and join instead of a window: a window would bring all rows of a hot group to
    one task. Rows without a group get NULL.
    """
    stats = df.filter(c(group).isNotNull()).groupBy(c(group)).agg(aggregate.alias(name))
    return join_statistics(df, stats, group)


@dataclass
class ColumnFill:
    """Mean, exact median or most frequent value per numeric column."""

    columns: list[str]
    strategy: str = "mean"
    values: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "ColumnFill":
        if self.strategy == "mean":
            row = df.agg(*[F.avg(present(c(n).cast("double"))).alias(f"m{i}") for i, n in enumerate(self.columns)]).first()
            self.values = {n: row[f"m{i}"] for i, n in enumerate(self.columns)}
        elif self.strategy == "median":
            found = exact_quantiles(df, self.columns, [0.5])
            self.values = {n: found[(0, n)][0] for n in self.columns if (0, n) in found}
        elif self.strategy == "mode":
            # Values are counted first, so a hot value is one row; the smallest value wins a tie.
            from lathework.functions.columns import long_form

            counts = long_form(df, self.columns).filter(F.col("value").isNotNull() & ~F.isnan("value"))
            best = counts.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")).groupBy("feature").agg(
                F.max(F.struct(F.col("n"), (-F.col("value")).alias("v"))).alias("b")
            )
            self.values = {r["feature"]: -r["b"]["v"] for r in best.collect()}
        else:
            raise ValueError("strategy is 'mean', 'median' or 'mode'")
        self.values = {n: v for n, v in self.values.items() if v is not None}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(
            *[
                F.coalesce(present(c(n).cast("double")), F.lit(self.values[n])).alias(n)
                if n in self.values else c(n)
                for n in df.columns
            ]
        )


def mean_imputer(columns, strategy="mean") -> Imputer:
    """The built-in imputer; its median is approximate, see :class:`ColumnFill` for the exact one."""
    return Imputer(inputCols=list(columns), outputCols=list(columns), strategy=strategy)


def ridge_solve(m: Moments, target: int, predictors, ridge: float) -> tuple[float, np.ndarray]:
    """Intercept and coefficients of one column on others, from centred cross products."""
    s = m.scatter
    p = list(predictors)
    a = s[np.ix_(p, p)] + ridge * np.diag(np.maximum(np.diag(s)[p], 1e-300))
    beta = np.linalg.lstsq(a, s[p, target], rcond=None)[0]
    return float(m.mean[target] - m.mean[p] @ beta), beta


@dataclass
class ChainedImputer:
    """Each incomplete numeric column regressed on all the others, round after round.

    Starts from column means. A round is one pass over the raw rows as arrays: numpy replays the
    fills of the earlier rounds, masks what is missing, and sums for each incomplete column the
    cross products of the rows where it was observed. Nothing is cached, checkpointed or
    joined, and the plan has one expression whatever the number of columns. Fills are
    the regression means (no random draws), or with ``noise`` add a residual drawn from the
    hash of ``key``. Keys and targets do not belong among ``columns``.
    """

    columns: list[str]
    rounds: int = 10
    ridge: float = 1e-5
    tol: float = 1e-6
    key: str | None = None
    noise: bool = False
    seed: int = 7
    start: dict = field(default_factory=dict)
    incomplete: list[str] = field(default_factory=list)
    steps: list[dict] = field(default_factory=list)
    spread: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "ChainedImputer":
        names = self.columns
        raw = df.select(F.array(*[c(n).cast("double") for n in names]).alias("x"))
        seen = summed(raw, _counts, on_missing="keep").get(0)
        if seen is None:
            raise ValueError("no rows to fit on")
        total, (present_of, sums) = seen[0], seen[1:].reshape(2, -1)
        empty = [n for n, k in zip(names, present_of) if k == 0]
        if empty:
            raise ValueError(f"no value at all in {empty}")
        self.start = {n: float(v / k) for n, v, k in zip(names, sums, present_of)}
        self.incomplete = [n for n, k in zip(names, present_of) if k < total]
        self.steps = []
        # With one incomplete column the predictors never change: one round is the answer.
        rounds = self.rounds if len(self.incomplete) > 1 else min(self.rounds, 1)
        centre = np.array([self.start[n] for n in names])
        before = None
        for _ in range(rounds):
            step = self._fit_round(raw, centre)
            self.steps.append(step)
            now = np.concatenate([np.r_[b, w] for b, w in step.values()]) if step else np.zeros(0)
            if before is not None and np.abs(now - before).max() <= self.tol * (1 + np.abs(now).max()):
                break
            before = now
        return self

    def _fit_round(self, raw: DataFrame, centre) -> dict:
        """One scan: a row takes part once for every column it has observed."""
        names = self.columns
        upper = np.triu_indices(len(names) + 1)
        targets = [names.index(n) for n in self.incomplete]
        replay = self._replay()

        def reduce_batch(batch):
            x = matrix_of(batch)
            z = np.hstack([np.ones((len(x), 1)), replay(x) - centre])
            out = {}
            for g, target in enumerate(targets):
                part = z[~np.isnan(x[:, target])]
                if len(part):
                    out[g] = (part.T @ part)[upper]
            return out

        parts = {g: unpacked(cells, upper, centre) for g, cells in summed(raw, reduce_batch, on_missing="keep").items()}
        step = {}
        for g, m in parts.items():
            target = targets[g]
            others = [i for i in range(len(names)) if i != target]
            b, w = ridge_solve(m, target, others, self.ridge)
            s = m.scatter
            left = s[target, target] - 2 * w @ s[others, target] + w @ s[np.ix_(others, others)] @ w
            self.spread[self.incomplete[g]] = float(np.sqrt(max(left, 0.0) / m.n))
            step[self.incomplete[g]] = (b, w)
        return {n: step[n] for n in self.incomplete}

    def _replay(self):
        """A function that fills the missing entries of a matrix by all rounds so far.

        Every round looks at the fills of the one before. ``extra`` is added to the last fills.
        """
        names = self.columns
        start = np.array([self.start[n] for n in names])
        steps = []
        for step in self.steps:
            table = []
            for n, (b, w) in step.items():
                target = names.index(n)
                table.append((target, float(b), np.insert(np.asarray(w, dtype=float), target, 0.0)))
            steps.append(table)

        def fill(x, extra=None):
            gap = np.isnan(x)
            z = np.where(gap, start, x)
            for k, table in enumerate(steps):
                new = z.copy()
                for g, (target, b, w) in enumerate(table):
                    rows = gap[:, target]
                    new[rows, target] = b + z[rows] @ w
                    if extra is not None and k == len(steps) - 1:
                        new[rows, target] += extra[rows, g]
                z = new
            return z

        return fill

    def _noise(self, name: str) -> Column:
        if self.key is None:
            raise ValueError("seeded draws need a key")
        size = 1 << 30
        u = [(key_bucket(c(self.key), size, f"{self.seed}-{name}-{k}") + 0.5) / size for k in (0, 1)]
        normal = F.sqrt(-2 * F.log(u[0])) * F.cos(F.lit(2 * np.pi) * u[1])
        return normal * F.lit(self.spread[name])

    def transform(self, df: DataFrame) -> DataFrame:
        names, fill = self.columns, self._replay()
        rest = [n for n in df.columns if n not in names]
        noise = self.noise and bool(self.incomplete)
        extra = [self._noise(n) for n in self.incomplete] if noise else []
        rows = df.select(
            F.struct(*[c(n) for n in rest], F.lit(0).alias("_one")).alias("rest"),
            F.array(*[c(n).cast("double") for n in names]).alias("x"),
            F.array(*extra).cast("array<double>").alias("extra"),
        )

        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    more = matrix_of(batch, "extra") if noise else None
                    z = fill(matrix_of(batch), more)
                    offsets = np.arange(0, z.size + 1, z.shape[1], dtype=np.int32)
                    filled = pa.ListArray.from_arrays(pa.array(offsets), pa.array(z.ravel()))
                    yield pa.RecordBatch.from_arrays([batch.column("rest"), filled], names=["rest", "x"])

        out = rows.mapInArrow(run, StructType([rows.schema["rest"], rows.schema["x"]]))
        return out.select(*[
            F.col("x")[names.index(n)].alias(n) if n in names else F.col("rest").getField(n).alias(n) for n in df.columns
        ])


def _counts(batch: pa.RecordBatch) -> dict:
    """Rows, values and sum of values of each column."""
    x = matrix_of(batch)
    seen = ~np.isnan(x)
    return {0: np.concatenate([[len(x)], seen.sum(axis=0), np.where(seen, x, 0.0).sum(axis=0)])}


def chained_imputer(df: DataFrame, columns=None, key=None, keep=None, **options) -> DataFrame:
    """Fit and fill in one call; with ``keep`` only those columns are replaced."""
    names = list(columns or numeric_columns(df, exclude=(key,) if key else ()))
    model = ChainedImputer(names, key=key, **options).fit(df)
    if keep is None:
        return model.transform(df)
    renamed = df.select("*", *[c(n).alias(f"_raw_{i}") for i, n in enumerate(names)])
    filled = model.transform(renamed)
    return filled.select(
        *[c(n) if n not in names or n in keep else c(f"_raw_{names.index(n)}").alias(n) for n in df.columns]
    )
