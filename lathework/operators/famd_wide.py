"""Factor analysis of mixed data whose factors have very many levels.

The correlations of levels are kept as a sparse table of the pairs that occur together, made once
in one aggregate over the rows; there is no matrix as wide as the levels and no limit to their
number. Leading factors come from block subspace iteration under a Chebyshev filter: the block is a
table with a row for each level, a product with the correlations is a join and a sum, and only
products of the block's few columns reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.columns import c, dot, numeric_columns, present, string_columns
from lathework.operators.famd import MISSING
from lathework.operators.gram import matrix_of, moments, pooled, summed
from lathework.operators.ranks import ranked
from lathework.session import drop_tables, recorded, settle


def _names(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(k)]


@dataclass
class WideFactors:
    """``fit`` learns the leading ``ncp`` factors; ``loadings`` has a row for each level and number.

    As in :class:`lathework.operators.famd.MixedFactors`, a missing number counts as the column's
    mean, a missing level is a level of its own, and each factor's sign makes its largest loading
    positive. A level that the fit has not seen adds nothing to a score. Constant numbers and an
    empty table are errors. Rounds end when the residual of every kept factor is below
    ``tolerance`` times the first eigenvalue, or else with an error after ``max_rounds``.
    """

    numeric: list[str]
    factors: list[str]
    ncp: int = 5
    extra: int = 4
    degree: int = 4
    tolerance: float = 1e-7
    max_rounds: int = 50
    seed: int = 7
    rows: int = 0
    inertia: float = 0.0
    rounds: int = 0
    values: np.ndarray | None = None
    residuals: np.ndarray | None = None
    loadings: DataFrame | None = None

    def fit(self, df: DataFrame) -> "WideFactors":
        if not self.factors:
            raise ValueError("no factors: famd_fit is for numbers alone")
        self._spark = df.sparkSession
        self._measure(df)
        rows = df.select(F.array(*self._numbers()).cast("array<double>").alias("z"), self._levels().alias("f"))
        with recorded() as helpers:
            places = settle(self._places(rows), "places")
            pairs = settle(self._pairs(df, rows, places), "pairs")
            self._iterate(places, pairs)
        kept = set(self.loadings.inputFiles())
        drop_tables(self._spark, [h for h in helpers if not any(h.lstrip("/") in k for k in kept)])
        return self

    def _measure(self, df: DataFrame) -> None:
        sums = [F.count(F.lit(1)).alias("n")]
        for i, name in enumerate(self.numeric):
            x = present(c(name).cast("double"))
            sums += [F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"), F.count(x).alias(f"c{i}")]
        row = df.agg(*sums).first()
        self.rows = row["n"]
        if not self.rows:
            raise ValueError("no rows to fit on")
        self.mean = [row[f"m{i}"] for i in range(len(self.numeric))]
        self.scale = [((row[f"v{i}"] or 0.0) * row[f"c{i}"] / self.rows) ** 0.5 for i in range(len(self.numeric))]
        flat = [n for n, s in zip(self.numeric, self.scale) if not s > 0]
        if flat:
            raise ValueError(f"constant columns have no place in a factor analysis: {flat}")

    def _numbers(self) -> list[Column]:
        return [
            (F.coalesce(present(c(n).cast("double")), F.lit(m)) - F.lit(m)) / F.lit(s)
            for n, m, s in zip(self.numeric, self.mean, self.scale)
        ]

    def _levels(self) -> Column:
        return F.array(*[
            F.struct(F.lit(i).alias("factor"), F.coalesce(c(n).cast("string"), F.lit(MISSING)).alias("level"))
            for i, n in enumerate(self.factors)
        ])

    def _places(self, rows: DataFrame) -> DataFrame:
        """``factor, level, at, p, z``: place, share and sums of the numbers of every level."""
        sums = [F.sum(F.col("z")[i]) for i in range(len(self.numeric))]
        levels = rows.select("z", F.explode("f").alias("x")).groupBy("x.factor", "x.level").agg(
            (F.count(F.lit(1)) / F.lit(self.rows)).alias("p"), F.array(*sums).cast("array<double>").alias("z")
        )
        return ranked(levels, "factor", "level", name="at")

    def _pairs(self, df: DataFrame, rows: DataFrame, places: DataFrame) -> DataFrame:
        """``a, b, s``: the cells of the correlations that are not zero, before levels are centred.

        Level pairs are counted by their texts first, so a pair that a third of all rows has is one
        row before it meets its places. Numbers have the places -1, -2, and so on.
        """
        x, y = F.col("x"), F.col("y")
        after = F.filter("f", lambda other: other["factor"] > x["factor"])
        counted = (
            rows.select("f", F.explode("f").alias("x")).select("x", F.explode(after).alias("y"))
            .groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
            .select(
                x["factor"].alias("fa"), x["level"].alias("la"), y["factor"].alias("fb"), y["level"].alias("lb"), "n"
            )
        )
        for side in "ab":
            at = places.select(
                F.col("factor").alias(f"f{side}"), F.col("level").alias(f"l{side}"), F.col("at").alias(side),
                F.col("p").alias(f"p{side}"),
            )
            counted = counted.join(at, [f"f{side}", f"l{side}"])
        levels = counted.select("a", "b", (F.col("n") / F.lit(self.rows) / F.sqrt(F.col("pa") * F.col("pb"))).alias("s"))
        mixed = places.select(F.posexplode("z").alias("i", "v"), "at", "p").select(
            (-1 - F.col("i")).cast("long").alias("a"), F.col("at").alias("b"),
            (F.col("v") / F.lit(self.rows) / F.sqrt("p")).alias("s"),
        )
        both = levels.unionByName(mixed).select(
            F.explode(F.array(F.struct("a", "b", "s"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "s"))).alias("e")
        ).select("e.*")
        own = places.select(F.col("at").alias("a"), F.col("at").alias("b"), F.lit(1.0).alias("s"))
        cells = both.unionByName(own)
        if self.numeric:
            q = len(self.numeric)
            cross = pooled(moments(df, self._numbers(), centre=np.zeros(q))).cross / self.rows
            near = [(-1 - i, -1 - j, float(cross[i, j])) for i in range(q) for j in range(q)]
            cells = cells.unionByName(self._spark.createDataFrame(near, "a long, b long, s double"))
        return cells

    def _start(self, places: DataFrame, b: int) -> DataFrame:
        """``at, u`` and a block of hashed numbers; ``u`` is the root of a level's share."""
        ids = places.select("at", F.sqrt("p").alias("u"))
        numbers = self._spark.range(len(self.numeric)).select((-1 - F.col("id")).alias("at"), F.lit(0.0).alias("u"))
        return ids.unionByName(numbers).select(
            "at", "u",
            *[(F.xxhash64("at", F.lit(i), F.lit(self.seed)) / F.lit(float(1 << 63))).alias(f"x{i}") for i in range(b)],
        )

    @staticmethod
    def _times(pairs: DataFrame, block: DataFrame, b: int, scale=1.0, own=None) -> DataFrame:
        """``block`` with ``y = scale * S x + own``: one join and one sum by place."""
        xs, ys = _names("x", b), _names("y", b)
        zero = F.lit(0.0)
        met = pairs.join(block.drop("u"), F.col("b") == F.col("at")).select(
            F.col("a").alias("at"), zero.alias("u"), *[zero.alias(x) for x in xs],
            *[(F.lit(scale) * F.col("s") * F.col(x)).alias(y) for x, y in zip(xs, ys)],
        )
        kept = block.select("at", "u", *xs, *[(own(i) if own else zero).alias(y) for i, y in enumerate(ys)])
        return met.unionByName(kept).groupBy("at").agg(*[F.sum(n).alias(n) for n in ["u", *xs, *ys]])

    def _iterate(self, places: DataFrame, pairs: DataFrame) -> None:
        levels = {r["factor"]: r["n"] for r in places.groupBy("factor").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.degrees = [levels[i] - 1 for i in range(len(self.factors))]
        rank = len(self.numeric) + sum(self.degrees)
        if not rank:
            raise ValueError("nothing varies")
        self.inertia = float(rank)
        keep = min(self.ncp, rank)
        b = min(self.ncp + self.extra, rank)
        block, stale = settle(self._start(places, b), "block"), []
        for self.rounds in range(1, self.max_rounds + 1):
            with recorded() as made:
                w = settle(self._times(pairs, block, b), "product")
                theta, turn = self._ritz(w, b)
                b = len(theta)
                keep = min(keep, b)
                entries = [F.col(n) for n in w.columns if n != "at"]
                turned = settle(w.select(
                    "at", "u", *[dot(entries, turn[:, i]).alias(n) for i, n in enumerate(_names("x", b) + _names("y", b))]
                ), "turned")
                gap = turned.agg(*[
                    F.sum(F.pow(F.col(f"y{i}") - F.lit(float(theta[i])) * F.col(f"x{i}"), 2)).alias(f"r{i}") for i in range(keep)
                ]).first()
                self.residuals = np.sqrt(np.array([gap[f"r{i}"] for i in range(keep)]))
                done = (self.residuals <= self.tolerance * theta[0]).all()
                if not done:
                    block = self._filtered(pairs, turned, theta, b)
            if done:
                break
            drop_tables(self._spark, stale + made[:-1])
            stale = made[-1:]
        else:
            raise ValueError(f"no end after {self.max_rounds} rounds: residuals {self.residuals}; raise extra, degree or tolerance")
        self.values = np.clip(theta[:keep], 0.0, None)
        self.loadings = settle(self._named(places, turned, keep), "loadings")

    def _ritz(self, w: DataFrame, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Ritz values, largest first, and what turns ``[u, x, y]`` into Ritz vectors and their products.

        ``u`` is an eigenvector of the uncentred cells, with one for each factor as its value;
        centring takes it out, so the block is made orthogonal to it.
        """
        cells = ["u", *_names("x", b), *_names("y", b)]

        def reduce_batch(batch):
            x = matrix_of(batch)
            return {0: (x.T @ x).ravel()}

        g = summed(w.select(F.array(*cells).alias("x")), reduce_batch)[0].reshape(2 * b + 1, 2 * b + 1)
        centred = np.eye(2 * b + 1)[:, 1:]
        along = g[0, 1:b + 1]
        centred[0, :b] = -along / len(self.factors)
        centred[0, b:] = -along
        g = centred.T @ g @ centred
        size = np.sqrt(np.clip(np.diag(g)[:b], 1e-300, None))
        m, t = g[:b, :b] / np.outer(size, size), g[:b, b:] / np.outer(size, size)
        share, axes = np.linalg.eigh(m)
        fine = share > 1e-12 * share[-1]
        white = axes[:, fine] / np.sqrt(share[fine])
        theta, s = np.linalg.eigh(white.T @ (t + t.T) @ white / 2)
        turn = (white @ s[:, ::-1]) / size[:, None]
        both = np.kron(np.eye(2), turn)
        return theta[::-1], centred @ both

    def _filtered(self, pairs: DataFrame, turned: DataFrame, theta: np.ndarray, b: int) -> DataFrame:
        """The block under the Chebyshev polynomial that is small below the block's least value."""
        half = max(theta[-1], 1e-3 * theta[0]) / 2
        current = [(F.col(f"y{i}") - F.lit(float(half)) * F.col(f"x{i}")) / F.lit(float(half)) for i in range(b)]
        block = turned.select(
            "at", "u", *[e.alias(f"x{i}") for i, e in enumerate(current)], *[F.col(f"x{i}").alias(f"p{i}") for i in range(b)]
        )
        for _ in range(2, self.degree + 1):
            step = settle(self._times(
                pairs, block, b, 2.0 / float(half), lambda i: F.lit(-2.0) * F.col(f"x{i}") - F.col(f"p{i}")
            ), "filtered")
            block = step.select(
                "at", "u", *[F.col(f"y{i}").alias(f"x{i}") for i in range(b)], *[F.col(f"x{i}").alias(f"p{i}") for i in range(b)]
            )
        return block.select("at", "u", *_names("x", b))

    def _named(self, places: DataFrame, turned: DataFrame, keep: int) -> DataFrame:
        tops = turned.agg(*[
            F.max(F.struct(F.abs(f"x{i}").alias("size"), (-F.col("at")).alias("at"), F.col(f"x{i}").alias("x"))).alias(f"t{i}")
            for i in range(keep)
        ]).first()
        signs = [1.0 if tops[f"t{i}"]["x"] >= 0 else -1.0 for i in range(keep)]
        return turned.join(places.select("at", "factor", "level", "p"), "at", "left").select(
            "at", "factor", "level", "p", *[(F.lit(s) * F.col(f"x{i}")).alias(f"v{i}") for i, s in enumerate(signs)]
        )

    def eigenvalues(self) -> DataFrame:
        """Eigenvalue, percent of the whole inertia and running percent of the kept factors."""
        share = self.values / self.inertia * 100
        rows = [
            (s + 1, float(v), float(p), float(t)) for s, (v, p, t) in enumerate(zip(self.values, share, np.cumsum(share)))
        ]
        return self._spark.createDataFrame(rows, "factor int, eigenvalue double, percent double, cumulative double")

    def variables(self) -> DataFrame:
        """Squared link (r2 or eta2), cos2 and contribution per variable and factor."""
        sums = self.loadings.groupBy(F.coalesce(F.col("factor").cast("long"), F.col("at")).alias("id")).agg(
            *[F.sum(F.pow(f"v{i}", 2)).alias(f"v{i}") for i in range(len(self.values))]
        )
        rows = []
        for r in sums.collect():  # a row for each variable
            number = r["id"] < 0
            name = self.numeric[-1 - r["id"]] if number else self.factors[r["id"]]
            degrees = 1 if number else max(self.degrees[r["id"]], 1)
            for s, value in enumerate(self.values):
                link = float(value) * r[f"v{s}"]
                rows.append((name, "numeric" if number else "factor", s + 1, link, link * link / degrees, 100 * r[f"v{s}"]))
        return self._spark.createDataFrame(
            rows, "variable string, kind string, factor int, coord double, cos2 double, contrib double"
        )

    def scores(self, df: DataFrame, prefix="dim", keep=()) -> DataFrame:
        """Coordinates of every row on the kept factors: rows meet each factor's loadings by level."""
        k = len(self.values)
        weights = {}
        if self.numeric:
            for r in self.loadings.filter("factor is null").collect():  # a row for each number
                weights[-1 - r["at"]] = [r[f"v{s}"] for s in range(k)]
        z = self._numbers()
        out = df.select(
            *[c(n) for n in keep],
            *[
                (dot(z, [weights[i][s] for i in range(len(z))]) if z else F.lit(0.0)).alias(f"_s{s}")
                for s in range(k)
            ],
            *[F.coalesce(c(n).cast("string"), F.lit(MISSING)).alias(f"_l{i}") for i, n in enumerate(self.factors)],
        )
        for i in range(len(self.factors)):
            part = self.loadings.filter(F.col("factor") == i).select(
                F.col("level").alias(f"_l{i}"), *[(F.col(f"v{s}") / F.sqrt("p")).alias(f"_w{s}") for s in range(k)]
            )
            out = out.join(part, f"_l{i}", "left").select(
                *[c(n) for n in keep],
                *[(F.col(f"_s{s}") + F.coalesce(F.col(f"_w{s}"), F.lit(0.0))).alias(f"_s{s}") for s in range(k)],
                *[f"_l{j}" for j in range(i + 1, len(self.factors))],
            )
        return out.select(*[c(n) for n in keep], *[F.col(f"_s{s}").alias(f"{prefix}{s + 1}") for s in range(k)])


def famd_wide_fit(df: DataFrame, numeric=None, factors=None, ncp=5, **settings) -> WideFactors:
    return WideFactors(
        list(numeric_columns(df) if numeric is None else numeric),
        list(string_columns(df) if factors is None else factors), ncp, **settings,
    ).fit(df)
