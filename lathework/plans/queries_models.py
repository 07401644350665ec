"""Queries on factor analysis, transforms, regressors, resampling, search and features."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from lathework.functions.columns import c, key_bucket, rounded
from lathework.functions.metrics import ColumnScorer, r2, rmsle
from lathework.operators import combine, famd, generate, resample
from lathework.operators.famd_wide import famd_wide_fit
from lathework.operators import linear as L
from lathework.operators import transforms as X
from lathework.operators import trees as T
from lathework.operators.encode import assemble
from lathework.operators.gram import moments
from lathework.operators.impute import fill_group_mean
from lathework.operators.growers import node_draws
from lathework.operators.neighbors import KNNRegressor
from lathework.plans.flows import predict, stacked_regressor
from lathework.plans.registry import gap, query, rnd, round_all, sql_bucket, table, unpack
from lathework.plans.report import leaderboard, score_card, train_report
from lathework.plans.search import Search, pareto_front, population_search, random_search
from lathework.plans.space import PREPROCESSORS, cand_id
from lathework.session import shared_dir
from lathework.sources.searchlog import SearchLog
from lathework.streaming.score import read_stream, score_stream


def lines(spark, d, columns=("l_quantity",), label="l_extendedprice", keep=("l_orderkey",)):
    """Lineitem rows as features, label and key."""
    rows = table(spark, d, "lineitem").select(*keep, *columns, c(label).alias("label"))
    return assemble(rows, columns, keep=[*keep, "label"])


def fold(key, folds, repeat=0):
    return sql_bucket(key, folds, repeat)


# The smallest whole flow: fill, fold, fit, score


@query("fold_scores", f"""
WITH t AS (SELECT o_orderkey, o_totalprice AS y, c_mktsegment AS segment,
                  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE c_acctbal END AS b, {fold('o_orderkey', 3)} AS fold
           FROM orders JOIN customer ON o_custkey = c_custkey),
f AS (SELECT fold, y, coalesce(b, avg(b) OVER (PARTITION BY segment)) AS x FROM t),
m AS (SELECT k.fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b
      FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY k.fold),
p AS (SELECT f.fold, y, a * x + b AS p FROM f JOIN m ON f.fold = m.fold)
SELECT fold, count(*) AS rows, {rnd('sqrt(avg(power(ln(1 + p) - ln(1 + y), 2)))')} AS rmsle,
       {rnd('1 - sum(power(y - p, 2)) / (var_pop(y) * count(*))')} AS r2 FROM p GROUP BY fold""")
def _fold_scores(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", "c_mktsegment", gap("c_acctbal", "o_orderkey").alias("balance")
    )
    filled = fill_group_mean(rows, "c_mktsegment", "balance")
    folds = resample.fold_column(F.col("o_orderkey"), 3)
    return round_all(resample.linear_cross_validate(filled, ["balance"], "o_totalprice", folds), "rmsle", "r2")


# Factor analysis of mixed data

_ETA = """WITH s AS (SELECT o_orderkey, o_totalprice AS x, o_orderpriority AS g,
                  (o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER () AS z FROM orders),
l AS (SELECT g, avg(z) AS m, count(*) AS n FROM s GROUP BY g),
e AS (SELECT sqrt(sum(n * m * m) / sum(n)) AS eta, count(*) AS levels FROM l)"""


def _mixed(spark, d, ncp=5):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return rows, famd.famd_fit(rows, ["o_totalprice"], ["o_orderpriority"], ncp)


@query("famd_fit", """
SELECT 3 + (SELECT count(DISTINCT l_returnflag) - 1 FROM lineitem) + (SELECT count(DISTINCT l_linestatus) - 1 FROM lineitem) AS factors,
       (3 + (SELECT count(DISTINCT l_returnflag) - 1 FROM lineitem) + (SELECT count(DISTINCT l_linestatus) - 1 FROM lineitem))::DOUBLE AS inertia,
       100.0::DOUBLE AS cumulative""")
def _famd_fit(spark, d):
    rows = table(spark, d, "lineitem")
    model = famd.famd_fit(rows, ["l_quantity", "l_extendedprice", "l_discount"], ["l_returnflag", "l_linestatus"])
    return model.eigenvalues().agg(
        F.count(F.lit(1)).alias("factors"), rounded(F.sum("eigenvalue")).alias("inertia"),
        rounded(F.max("cumulative")).alias("cumulative"),
    )


@query("famd_eigenvalues", _ETA + f"""
SELECT i AS factor, {rnd('CASE WHEN i = 1 THEN 1 + eta WHEN i = levels THEN 1 - eta ELSE 1.0::DOUBLE END', 7)} AS eigenvalue,
       {rnd('CASE WHEN i = 1 THEN 1 + eta WHEN i = levels THEN 1 - eta ELSE 1.0::DOUBLE END / levels * 100', 6)} AS percent,
       {rnd('CASE WHEN i = levels THEN 100.0::DOUBLE ELSE (i + eta) / levels * 100 END', 6)} AS cumulative
FROM e, (SELECT unnest(range(1, levels + 1))::INT AS i FROM e)""")
def _famd_eigenvalues(spark, d):
    _, model = _mixed(spark, d)
    return round_all(round_all(model.eigenvalues(), "eigenvalue", digits=7), "percent", "cumulative")


@query("famd_variables", _ETA + f"""
SELECT v AS variable, k AS kind, 1 AS factor, {rnd('(1 + eta) / 2')} AS coord,
       {rnd("((1 + eta) / 2) ** 2 / CASE WHEN k = 'factor' THEN levels - 1 ELSE 1 END")} AS cos2, 50.0::DOUBLE AS contrib
FROM e, (VALUES ('o_totalprice', 'numeric'), ('o_orderpriority', 'factor')) t(v, k)""")
def _famd_variables(spark, d):
    _, model = _mixed(spark, d)
    return round_all(model.variables().filter("factor = 1"), "coord", "cos2", "contrib")


# Two numbers and a factor with two levels: the factor is one more standardised column, and the
# first axis is the leading vector of the three correlations, found by repeated products.
@query("famd_contrib", f"""
WITH RECURSIVE r AS (
  SELECT corr(l_quantity, p) AS ab, corr(l_quantity, g) AS ac, corr(p, g) AS bc
  FROM (SELECT l_quantity, l_extendedprice + 1500 * l_quantity AS p, (l_linestatus = 'O')::INT::DOUBLE AS g FROM lineitem)),
v AS (
  SELECT 0 AS step, 1.0::DOUBLE AS a, 0.9::DOUBLE AS b, 0.1::DOUBLE AS c
  UNION ALL
  SELECT step + 1, x / s, y / s, z / s FROM (
    SELECT step, x, y, z, sqrt(x * x + y * y + z * z) AS s FROM (
      SELECT step, a + ab * b + ac * c AS x, ab * a + b + bc * c AS y, ac * a + bc * b + c AS z FROM v, r WHERE step < 300)))
SELECT 1 AS factor, n AS variable, {rnd('100 * e * e', 5)} AS contrib
FROM (SELECT a, b, c FROM v WHERE step = 300), LATERAL (VALUES ('l_quantity', a), ('p', b), ('l_linestatus', c)) t(n, e)""")
def _famd_contrib(spark, d):
    rows = table(spark, d, "lineitem").withColumn("p", F.col("l_extendedprice") + 1500 * F.col("l_quantity"))
    model = famd.famd_fit(rows, ["l_quantity", "p"], ["l_linestatus"], 3)
    return round_all(model.contributions((1,)), "contrib", digits=5)


@query("famd_scores", _ETA + f"""
SELECT o_orderkey, {rnd('(z + m / eta) / sqrt(2)', 5)} AS dim1 FROM s JOIN l USING (g), e""")
def _famd_scores(spark, d):
    rows, model = _mixed(spark, d, 1)
    return round_all(model.scores(rows, keep=["o_orderkey"]), "dim1", digits=5)


# The same analysis with every customer as a level: a sparse table of pairs, no matrix of levels.
_WIDE = _ETA.replace("o_orderpriority", "o_custkey")


def _wide(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_custkey")
    return rows, famd_wide_fit(rows, ["o_totalprice"], ["o_custkey"], ncp=1, tolerance=1e-12)


@query("famd_wide", _WIDE + f"""
SELECT 1 AS factor, {rnd('1 + eta', 7)} AS eigenvalue, {rnd('(1 + eta) / levels * 100')} AS percent, levels::DOUBLE AS inertia FROM e""")
def _famd_wide(spark, d):
    _, model = _wide(spark, d)
    found = model.eigenvalues().select("factor", "eigenvalue", "percent", F.lit(model.inertia).alias("inertia"))
    return round_all(round_all(found, "eigenvalue", digits=7), "percent")


@query("famd_wide_scores", _WIDE + f"""
SELECT o_orderkey, {rnd('(z + m / eta) / sqrt(2)', 4)} AS dim1 FROM s JOIN l USING (g), e""")
def _famd_wide_scores(spark, d):
    rows, model = _wide(spark, d)
    return round_all(model.scores(rows, keep=["o_orderkey"]), "dim1", digits=4)


@query("scree_table", _ETA + f"""
SELECT i AS factor, {rnd('CASE WHEN i = 1 THEN 1 + eta ELSE 1.0::DOUBLE END / levels * 100')} AS percent
FROM e, (VALUES (1), (2)) t(i)""")
def _scree(spark, d):
    _, model = _mixed(spark, d, 2)
    return round_all(model.scree(), "percent")


@query("top_components", _ETA + f"SELECT 1 AS factor, {rnd('1 + eta', 7)} AS eigenvalue FROM e")
def _top_components(spark, d):
    _, model = _mixed(spark, d)
    return round_all(famd.top_components(model, 1).select("factor", "eigenvalue"), "eigenvalue", digits=7)


# Scalers and transforms

_XY = ("l_quantity", "l_extendedprice", "l_tax")


def _scaled(spark, d, stage, names=("a", "b", "t"), columns=_XY, digits=6):
    data = lines(spark, d, columns)
    model = stage.fit(data) if hasattr(stage, "fit") else stage
    return unpack(model.transform(data), "transformed", names, digits, ["l_orderkey"])


@query("binarizer", """
SELECT l_orderkey, CASE WHEN l_quantity > 25 THEN 1.0::DOUBLE ELSE 0 END AS a, CASE WHEN l_extendedprice > 25 THEN 1.0::DOUBLE ELSE 0 END AS b,
       CASE WHEN l_tax > 25 THEN 1.0::DOUBLE ELSE 0 END AS t FROM lineitem""")
def _binarizer(spark, d):
    return _scaled(spark, d, X.binarizer(25.0))


@query("maxabs_scaler", f"""
SELECT l_orderkey, {rnd('l_quantity / max(l_quantity) OVER ()')} AS a, {rnd('l_extendedprice / max(l_extendedprice) OVER ()')} AS b,
       {rnd('l_tax / max(l_tax) OVER ()')} AS t FROM lineitem""")
def _maxabs(spark, d):
    return _scaled(spark, d, X.MaxAbsScaler())


@query("minmax_scaler", f"""
WITH m AS (SELECT min(l_quantity) + 0.0 AS a0, max(l_quantity) AS a1, min(l_extendedprice) + 0.0 AS b0, max(l_extendedprice) AS b1 FROM lineitem)
SELECT l_orderkey, {rnd('(l_quantity - a0) / (a1 - a0)')} AS a, {rnd('(l_extendedprice - b0) / (b1 - b0)')} AS b, 0.0::DOUBLE AS t FROM lineitem, m""")
def _minmax(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", F.lit(2.0).alias("flat"))
    data = assemble(rows, ["l_quantity", "l_extendedprice", "flat"], keep=["l_orderkey"])
    return unpack(X.MinMaxScaler().fit(data).transform(data), "transformed", ("a", "b", "t"), keep=["l_orderkey"])


@query("standard_scaler", "SELECT l_orderkey, " + ", ".join(
    f"{rnd(f'({n} - avg({n}) OVER ()) / stddev_pop({n}) OVER ()')} AS {k}" for n, k in zip(_XY, "abt")) + " FROM lineitem")
def _standard(spark, d):
    return _scaled(spark, d, X.StandardScaler())


@query("robust_scaler", "WITH q AS (SELECT " + ", ".join(
    f"quantile_cont({n}, [0.25, 0.5, 0.75]) AS {k}" for n, k in zip(_XY, "abt")) + " FROM lineitem) SELECT l_orderkey, " + ", ".join(
    f"{rnd(f'({n} - {k}[2]) / ({k}[3] - {k}[1])')} AS {k}" for n, k in zip(_XY, "abt")) + " FROM lineitem, q")
def _robust(spark, d):
    return _scaled(spark, d, X.RobustScaler())


@query("normalizer", "WITH v AS (SELECT l_orderkey, l_quantity AS a, l_discount AS b, l_tax AS t, " + """
 abs(l_quantity) + abs(l_discount) + abs(l_tax) AS l1, sqrt(l_quantity ** 2 + l_discount ** 2 + l_tax ** 2) AS l2,
 greatest(abs(l_quantity), abs(l_discount), abs(l_tax)) AS mx FROM lineitem)""" + " UNION ALL ".join(
    f" SELECT l_orderkey, '{k}' AS norm, {rnd(f'a / {col}')} AS a, {rnd(f'b / {col}')} AS b, {rnd(f't / {col}')} AS t FROM v"
    for k, col in (("l1", "l1"), ("l2", "l2"), ("max", "mx"))))
def _normalizer(spark, d):
    out = None
    for norm in ("l1", "l2", "max"):
        one = _scaled(spark, d, X.normalizer(norm), columns=("l_quantity", "l_discount", "l_tax"))
        one = one.withColumn("norm", F.lit(norm))
        out = one if out is None else out.unionByName(one)
    return out


@query("polynomial_deg2", """
SELECT l_orderkey, l_quantity AS a, l_linenumber::DOUBLE AS b, l_quantity * l_quantity AS aa, l_quantity * l_linenumber AS ab,
       (l_linenumber * l_linenumber)::DOUBLE AS bb FROM lineitem""")
def _poly(spark, d):
    return _scaled(spark, d, X.PolynomialDegree2(), ("a", "b", "aa", "ab", "bb"), ("l_quantity", "l_linenumber"))


@query("pca", f"""
WITH m AS (SELECT covar_pop(l_quantity, l_linenumber) AS sxy, var_pop(l_quantity) AS sx, var_pop(l_linenumber) AS sy,
                  avg(l_quantity) AS mx, avg(l_linenumber) AS my FROM lineitem),
t AS (SELECT *, 0.5 * atan2(2 * sxy, sx - sy) AS w FROM m),
v AS (SELECT mx, my, CASE WHEN abs(cos(w)) >= abs(sin(w)) THEN 1 ELSE sign(sin(w)) END AS s1,
             CASE WHEN abs(cos(w)) >= abs(sin(w)) THEN 1 ELSE -sign(sin(w)) END AS s2, cos(w) AS co, sin(w) AS si FROM t)
SELECT l_orderkey, {rnd('s1 * (co * (l_quantity - mx) + si * (l_linenumber - my))', 5)} AS a,
       {rnd('s2 * (co * (l_linenumber - my) - si * (l_quantity - mx))', 5)} AS b FROM lineitem, v""")
def _pca(spark, d):
    return _scaled(spark, d, X.PCA(), ("a", "b"), ("l_quantity", "l_linenumber"), 5)


_W, _B = [[0.05, -0.02, 0.01], [0.3, 0.4, -0.5]], [0.1, 0.7, 1.3]


@query("rbf_sampler", "SELECT l_orderkey, " + ", ".join(
    rnd(f"sqrt(2.0 / 3) * cos({_W[0][k]} * l_quantity + {_W[1][k]} * l_linenumber + {_B[k]})") + f" AS {n}"
    for k, n in enumerate("abt")) + " FROM lineitem")
def _rbf(spark, d):
    return _scaled(spark, d, X.RBFSampler(weights=_W, phase=_B), columns=("l_quantity", "l_linenumber"))


_P1, _P2 = (10.0, 0.05), (12.0, 0.02)


def _sq(p):
    return f"((l_quantity - {p[0]}) ** 2 + (l_discount - {p[1]}) ** 2)"


@query("nystroem", f"""
WITH k AS (SELECT exp(-0.1 * (({_P1[0]} - {_P2[0]}) ** 2 + ({_P1[1]} - {_P2[1]}) ** 2)) AS k),
w AS (SELECT (1 / sqrt(1 + k) + 1 / sqrt(1 - k)) / 2 AS s, (1 / sqrt(1 + k) - 1 / sqrt(1 - k)) / 2 AS o FROM k)
SELECT l_orderkey, {rnd(f'exp(-0.1 * {_sq(_P1)}) * s + exp(-0.1 * {_sq(_P2)}) * o')} AS a,
       {rnd(f'exp(-0.1 * {_sq(_P1)}) * o + exp(-0.1 * {_sq(_P2)}) * s')} AS b FROM lineitem, w""")
def _nystroem(spark, d):
    stage = X.Nystroem(kernel="rbf", gamma=0.1, landmarks=[list(_P1), list(_P2)])
    return _scaled(spark, d, stage, ("a", "b"), ("l_quantity", "l_discount"))


_Q, _D = _P1
_DOT = f"(l_quantity * {_Q} + l_discount * {_D})"
_CHI = f"((l_quantity - {_Q}) ** 2 / (l_quantity + {_Q}) + (l_discount - {_D}) ** 2 / (l_discount + {_D}))"
_SELF = _Q * _Q + _D * _D
_KERNELS = {
    "rbf": (f"exp(-0.01 * {_sq(_P1)})", 1.0),
    "laplacian": (f"exp(-0.01 * (abs(l_quantity - {_Q}) + abs(l_discount - {_D})))", 1.0),
    "poly": (f"(0.01 * {_DOT} + 1) ** 3", (0.01 * _SELF + 1) ** 3),
    "polynomial": (f"(0.01 * {_DOT} + 1) ** 3", (0.01 * _SELF + 1) ** 3),
    "linear": (_DOT, _SELF),
    "cosine": (f"{_DOT} / sqrt(l_quantity ** 2 + l_discount ** 2) / {float(np.sqrt(_SELF))!r}", 1.0),
    "sigmoid": (f"tanh(0.01 * {_DOT} + 1)", float(np.tanh(0.01 * _SELF + 1))),
    "chi2": (f"exp(-0.01 * {_CHI})", 1.0),
    # The landmark's value with itself is zero; the root is taken of a floor instead.
    "additive_chi2": (f"-{_CHI}", 1e-12),
}


@query("nystroem_kernels", " UNION ALL ".join(
    f"SELECT '{k}' AS kernel, l_orderkey, {rnd(f'({e}) / sqrt({s!r}::DOUBLE)', 4)} AS a FROM lineitem"
    for k, (e, s) in _KERNELS.items()))
def _kernels(spark, d):
    out = None
    for kind in _KERNELS:
        stage = X.Nystroem(kernel=kind, gamma=0.01, landmarks=[list(_P1)])
        one = _scaled(spark, d, stage, ("a",), ("l_quantity", "l_discount"), 4).withColumn("kernel", F.lit(kind))
        out = one if out is None else out.unionByName(one)
    return out


# Two sources mixed by known weights: each recovered component correlates with one source as the
# source does with itself, and with the other as the sources do with each other.
@query("fast_ica", """
SELECT i, j, round(abs(CASE WHEN i = 1 AND j = 1 THEN corr(l_discount, l_discount) WHEN i = 2 AND j = 2 THEN corr(l_tax, l_tax)
                       ELSE corr(l_discount, l_tax) END), 1) + 0.0 AS link
FROM lineitem, (VALUES (1, 1), (1, 2), (2, 1), (2, 2)) t(i, j) GROUP BY i, j""")
def _ica(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_discount", "l_tax", (2 * F.col("l_discount") + F.col("l_tax")).alias("a"), (F.col("l_discount") - 2 * F.col("l_tax")).alias("b")
    )
    data = assemble(rows, ["a", "b"], keep=["l_discount", "l_tax"]).cache()
    found = X.FastICA(tol=1e-5, max_iter=200).fit(data).transform(data).withColumn("t", vector_to_array("transformed"))
    link = {(i, j): F.abs(F.corr(F.col("t")[i], F.col(s))) for i in (0, 1) for j, s in enumerate(("l_discount", "l_tax"))}
    row = found.agg(*[v.alias(f"c{i}{j}") for (i, j), v in link.items()])
    # components come in no fixed order: the first is the one closer to the first source
    swap = F.col("c00") < F.col("c10")
    at = lambda i, j: F.when(swap, F.col(f"c{1 - i}{j}")).otherwise(F.col(f"c{i}{j}"))
    cells = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("i"), F.lit(j + 1).alias("j"), rounded(at(i, j), 1).alias("link")) for i in (0, 1) for j in (0, 1)
    ]))
    out = row.select(cells.alias("x")).select("x.*")
    return out


@query("feature_agglomeration", f"""
SELECT linkage, affinity, l_orderkey, {rnd('(l_discount + l_tax) / 2')} AS a, l_extendedprice AS b
FROM lineitem, (VALUES ('ward', 'euclidean'), ('complete', 'l1'), ('average', 'l2')) t(linkage, affinity)""")
def _agglomeration(spark, d):
    out = None
    for linkage, affinity in (("ward", "euclidean"), ("complete", "l1"), ("average", "l2")):
        stage = X.FeatureAgglomeration(linkage=linkage, affinity=affinity)
        one = _scaled(spark, d, stage, ("a", "b"), ("l_discount", "l_extendedprice", "l_tax"))
        one = one.select(F.lit(linkage).alias("linkage"), F.lit(affinity).alias("affinity"), "*")
        out = one if out is None else out.unionByName(one)
    return out


@query("onehot_few_vector", """
SELECT l_orderkey, l_quantity AS a, CASE WHEN k = 0 THEN 1.0::DOUBLE ELSE 0 END AS b, CASE WHEN k = 1 THEN 1.0::DOUBLE ELSE 0 END AS t,
       CASE WHEN k = 2 THEN 1.0::DOUBLE ELSE 0 END AS r
FROM (SELECT l_orderkey, l_quantity, CASE WHEN l_orderkey % 50 = 0 THEN 2 WHEN l_orderkey % 2 = 0 THEN 0 ELSE 1 END AS k FROM lineitem)""")
def _onehot_vector(spark, d):
    k = F.when(F.col("l_orderkey") % 50 == 0, 2.0).when(F.col("l_orderkey") % 2 == 0, 0.0).otherwise(1.0)
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", k.alias("k"))
    data = assemble(rows, ["l_quantity", "k"], keep=["l_orderkey"])
    out = X.OneHotFew(minimum_fraction=0.1).fit(data).transform(data)
    return unpack(out, "transformed", ("a", "b", "t", "r"), keep=["l_orderkey"])


@query("stacking_feature", f"""
SELECT l_orderkey, {rnd('regr_slope(l_extendedprice, l_quantity) OVER () * l_quantity + regr_intercept(l_extendedprice, l_quantity) OVER ()', 4)} AS a,
       l_quantity AS b FROM lineitem""")
def _stacking(spark, d):
    return _scaled(spark, d, X.StackingFeature(estimator=L.LinearBaseline()), ("a", "b"), ("l_quantity",), 4)


@query("stacking_cross_fit", f"""
WITH f AS (SELECT l_orderkey, l_quantity AS x, l_extendedprice AS y, {fold('l_orderkey', 3)} AS fold FROM lineitem),
m AS (SELECT k.fold, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM (VALUES (0), (1), (2)) k(fold) JOIN f ON f.fold <> k.fold GROUP BY k.fold)
SELECT l_orderkey, {rnd('a * x + b', 4)} AS a, x AS b FROM f JOIN m USING (fold)""")
def _cross_fit(spark, d):
    data = lines(spark, d)
    stage = X.StackingFeature(estimator=L.LinearBaseline())
    out = stage.cross_fitted(data, resample.fold_column(F.col("l_orderkey"), 3), 3)
    return unpack(out, "transformed", ("a", "b"), 4, ["l_orderkey"])


@query("feature_union", "SELECT l_orderkey, " + ", ".join(
    [rnd("(l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ())") + " AS a",
     rnd("(l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER ()") + " AS b"]) + " FROM lineitem")
def _union(spark, d):
    data = lines(spark, d)
    branches = [(X.MinMaxScaler(outputCol="u").fit(data), "u"), (X.StandardScaler(outputCol="v").fit(data), "v")]
    return unpack(combine.feature_union(data, branches), "features", ("a", "b"), keep=["l_orderkey"])


# Linear regressors

_ALPHAS = [3000.0, 1000.0, 100.0, 10.0, 1.0]
_VALUES = ", ".join(f"({a}::DOUBLE)" for a in _ALPHAS)
_FOLD_MOMENTS = f"""WITH f AS (SELECT l_quantity AS x, l_extendedprice + 700 * l_quantity AS y, {fold('l_orderkey', 3, 'cv')} AS fold FROM lineitem),
t AS (SELECT k AS fold, count(*)::DOUBLE AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS sx, covar_pop(x, y) AS sxy
      FROM range(4) r(k) JOIN f ON f.fold <> k GROUP BY k),
al AS (SELECT a FROM (VALUES {_VALUES}) v(a)),"""


def _net_data(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_extendedprice") + 700 * F.col("l_quantity")).alias("label")
    )
    return assemble(rows, ["l_quantity"], keep=["l_orderkey", "label"])


def _net_sql(beta):
    # Fold 3 is held out of nothing: its moments are those of the whole table.
    return _FOLD_MOMENTS + f"""
b AS (SELECT fold, a, {beta} AS w, mx, my FROM t, al),
e AS (SELECT b.fold, a, avg(power(y - (my + w * (x - mx)), 2)) AS err FROM b JOIN f ON f.fold = b.fold GROUP BY ALL),
s AS (SELECT a, avg(err) AS err FROM e GROUP BY a),
c AS (SELECT a FROM s ORDER BY err, a DESC LIMIT 1)
SELECT s.a AS alpha, {rnd('s.err / 1e6', 5)} AS err, {rnd('b.w', 4)} AS coef, {rnd('my - b.w * mx', 3)} AS intercept
FROM s, c JOIN b ON b.a = c.a AND b.fold = 3"""


def _net_result(spark, model):
    s = model.get("state")
    rows = [(a, e / 1e6, s["coef"][0], s["intercept"]) for a, e in zip(s["alphas"], s["errors"])]
    out = spark.createDataFrame(rows, "alpha double, err double, coef double, intercept double")
    return round_all(round_all(round_all(out, "err", digits=5), "coef", digits=4), "intercept", digits=3)


@query("elastic_net_cv", _net_sql("sign(sxy) * greatest(abs(sxy) - a * 0.5, 0) / (sx + a * 0.5)"))
def _elastic(spark, d):
    stage = L.ElasticNetCV(l1_ratio=0.5, alphas=_ALPHAS, keyCol="l_orderkey", tol=1e-9)
    return _net_result(spark, stage.fit(_net_data(spark, d)))


@query("lasso_cv", _net_sql("sign(sxy) * greatest(abs(sxy) / sqrt(n * sx) - a / 100, 0) * n / sqrt(n * sx)").replace(
    "SELECT s.a AS alpha", "SELECT s.a / 100 AS alpha"))
def _lasso(spark, d):
    stage = L.LassoCV(normalize=True, alphas=[a / 100 for a in _ALPHAS], keyCol="l_orderkey", tol=1e-9)
    return _net_result(spark, stage.fit(_net_data(spark, d)))


_RIDGE = ", ".join(f"({a}::DOUBLE)" for a in (1e2, 1e5, 1e7))


@query("ridge_cv", f"""
WITH m AS (SELECT count(*)::DOUBLE AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, regr_sxx(l_extendedprice, l_quantity) AS sxx,
                  regr_sxy(l_extendedprice, l_quantity) AS sxy FROM lineitem),
b AS (SELECT a, sxy / (sxx + a) AS w, m.* FROM m, (VALUES {_RIDGE}) v(a)),
e AS (SELECT a, w, my - w * mx AS i, avg(power((l_extendedprice - my - w * (l_quantity - mx)) /
                 (1 - 1 / n - power(l_quantity - mx, 2) / (sxx + a)), 2)) AS err FROM b, lineitem GROUP BY ALL),
c AS (SELECT * FROM e ORDER BY err LIMIT 1)
SELECT e.a AS alpha, {rnd('e.err / 1e6', 5)} AS err, {rnd('c.w', 5)} AS coef, {rnd('c.i', 3)} AS intercept FROM e, c""")
def _ridge(spark, d):
    stage = L.RidgeCV(alphas=[1e2, 1e5, 1e7])
    model = stage.fit(lines(spark, d))
    s = model.get("state")
    rows = [(a, e / 1e6, s["coef"][0], s["intercept"]) for a, e in zip(stage.get("alphas"), s["errors"])]
    out = spark.createDataFrame(rows, "alpha double, err double, coef double, intercept double")
    return round_all(round_all(out, "err", "coef", digits=5), "intercept", digits=3)


_LINE = """WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)"""
_LINE_ROWS = _LINE + f" SELECT l_orderkey, {rnd('a * l_quantity + b', 4)} AS prediction FROM lineitem, m"


@query("linear_baseline", _LINE_ROWS)
def _ols(spark, d):
    data = lines(spark, d)
    return round_all(predict(L.LinearBaseline().fit(data), data, "l_orderkey"), "prediction", digits=4)


@query("predict", _LINE_ROWS)
def _predict(spark, d):
    data = lines(spark, d)
    model = Pipeline(stages=[X.StandardScaler(outputCol="z"), L.LinearBaseline(featuresCol="z")]).fit(data)
    return round_all(predict(model, data, "l_orderkey"), "prediction", digits=4)


@query("fit_steps", _LINE_ROWS)
def _steps(spark, d):
    data = lines(spark, d)
    steps = Pipeline(stages=[X.MinMaxScaler(outputCol="z"), X.PCA(inputCol="z", outputCol="p"), L.LinearBaseline(featuresCol="p")])
    return round_all(predict(steps.fit(data), data, "l_orderkey"), "prediction", digits=4)


@query("score_stream", _LINE_ROWS)
def _stream(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", F.col("l_extendedprice").alias("label"))
    model = Pipeline(stages=[L.LinearBaseline()]).fit(assemble(rows, ["l_quantity"], keep=["label"]))
    source, out, mark = (shared_dir(spark, n) for n in ("stream_in", "stream_out", "stream_mark"))
    rows.select("l_orderkey", "l_quantity").write.parquet(source)
    stream = read_stream(spark, source, "l_orderkey BIGINT, l_quantity DOUBLE")
    stream = stream.withColumn("features", array_to_vector(F.array("l_quantity")))
    score_stream(model, stream, out, mark, keep=["l_orderkey"]).awaitTermination()
    found = spark.read.schema("l_orderkey BIGINT, prediction DOUBLE").parquet(out)
    return round_all(found, "prediction", digits=4)


def _newton_sql(eps, rounds):
    """Squared-loss tube regression of one feature and a bias by unrolled Newton steps."""
    out = ["WITH w0 AS (SELECT 0.0::DOUBLE AS w, 0.0::DOUBLE AS b)"]
    for k in range(rounds):
        out.append(f"""s{k} AS (SELECT sum(x * x) AS xx, sum(x) AS sx, count(*)::DOUBLE AS n, sum(x * t) AS xt, sum(t) AS st FROM (
 SELECT l_quantity / 10 AS x, l_extendedprice / 1000 - sign(l_extendedprice / 1000 - w * l_quantity / 10 - b) * {eps} AS t
 FROM lineitem, w{k} WHERE abs(l_extendedprice / 1000 - w * l_quantity / 10 - b) > {eps})),
w{k + 1} AS (SELECT ((1 + 2 * n) * 2 * xt - 2 * sx * 2 * st) / ((1 + 2 * xx) * (1 + 2 * n) - 4 * sx * sx) AS w,
 ((1 + 2 * xx) * 2 * st - 2 * sx * 2 * xt) / ((1 + 2 * xx) * (1 + 2 * n) - 4 * sx * sx) AS b FROM s{k})""")
    return ", ".join(out)


@query("linear_svr", _newton_sql(1.0, 12) + f" SELECT l_orderkey, {rnd('w * l_quantity / 10 + b', 5)} AS prediction FROM lineitem, w12")
def _svr(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", (F.col("l_quantity") / 10).alias("x"), (F.col("l_extendedprice") / 1000).alias("label")
    )
    data = assemble(rows, ["x"], keep=["l_orderkey", "label"]).cache()
    stage = L.LinearSVR(loss="squared_epsilon_insensitive", epsilon=1.0, C=1.0, tol=1e-6)
    return round_all(predict(stage.fit(data), data, "l_orderkey"), "prediction", digits=5)


# Trees. With one feature of 50 values and depth 1, a tree is a stump that SQL can grow.


def _stump(source, out):
    """Best split of ``source(q, w, s)``: weight and weighted label sum per feature value."""
    return f"""{out}_c AS (SELECT q, sum(w) OVER o AS wl, sum(s) OVER o AS sl, sum(w) OVER () AS wt, sum(s) OVER () AS st,
  lead(q) OVER (ORDER BY q) AS nx FROM {source} WINDOW o AS (ORDER BY q)),
{out} AS (SELECT (q + nx) / 2 AS cut, sl / wl AS lv, (st - sl) / (wt - wl) AS rv FROM {out}_c WHERE nx IS NOT NULL
  ORDER BY sl * sl / wl + (st - sl) * (st - sl) / (wt - wl) DESC LIMIT 1)"""


_BYQ = "WITH y AS (SELECT l_orderkey, l_quantity AS q, l_extendedprice + 900 * l_quantity AS y FROM lineitem), g AS (SELECT q, count(*)::DOUBLE AS w, sum(y) AS s FROM y GROUP BY q), "
_STUMP = _BYQ + _stump("g", "t1") + f" SELECT l_orderkey, {rnd('CASE WHEN q <= cut THEN lv ELSE rv END', 4)} AS prediction FROM y, t1"


def _stump_rows(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", (F.col("l_extendedprice") + 900 * F.col("l_quantity")).alias("label")
    )
    return assemble(rows, ["l_quantity"], keep=["l_orderkey", "label"])


def _tree_rows(spark, d, stage):
    data = _stump_rows(spark, d)
    return round_all(predict(stage.fit(data), data, "l_orderkey"), "prediction", digits=4)


@query("decision_tree", _STUMP)
def _tree(spark, d):
    return _tree_rows(spark, d, T.decision_tree(max_depth=1, maxBins=64))


@query("random_forest", _STUMP)
def _forest(spark, d):
    return _tree_rows(spark, d, T.random_forest(3, bootstrap=False, max_depth=1, maxBins=64))


_TWO_ROUNDS = _BYQ + _stump("g", "t1") + f""",
g2 AS (SELECT q, w, s - w * CASE WHEN q <= cut THEN lv ELSE rv END AS s FROM g, t1), {_stump('g2', 't2')}
SELECT l_orderkey, {rnd('CASE WHEN q <= t1.cut THEN t1.lv ELSE t1.rv END + 0.5 * CASE WHEN q <= t2.cut THEN t2.lv ELSE t2.rv END', 3)} AS prediction
FROM y, t1, t2"""


@query("gradient_boosting", _TWO_ROUNDS.replace("+ 0.5 * CASE", "+ 2 * 0.5 * CASE"))
def _boosting(spark, d):
    # The built-in trees fit twice the residual of the squared loss.
    data = _stump_rows(spark, d)
    stage = T.gradient_boosting(2, "ls", 0.5, max_depth=1, maxBins=64)
    return round_all(predict(stage.fit(data), data, "l_orderkey"), "prediction", digits=3)


@query("xgb_like", _TWO_ROUNDS.replace("+ 0.5 * CASE", "+ 2 * 0.25 * CASE"))
def _xgb(spark, d):
    data = _stump_rows(spark, d)
    stage = T.xgb_like(2, max_depth=1, learning_rate=0.25, maxBins=64)
    return round_all(predict(stage.fit(data), data, "l_orderkey"), "prediction", digits=3)


@query("boost_huber_quantile", _BYQ.replace(", g AS", """, b AS (SELECT quantile_disc(y, 0.75) AS f0 FROM y),
z AS (SELECT y.*, y - f0 AS gap, CASE WHEN y > f0 THEN 0.75::DOUBLE ELSE -0.25 END AS r FROM y, b), g AS""").replace(
    "sum(y) AS s FROM y GROUP BY q", "sum(r) AS s FROM z GROUP BY q") + _stump("g", "t1") + f""",
v AS (SELECT q <= cut AS l, quantile_disc(gap, 0.75) AS v FROM z, t1 GROUP BY ALL)
SELECT l_orderkey, {rnd('f0 + 0.5 * v', 4)} AS prediction FROM z, b, t1 JOIN v ON v.l = (z.q <= t1.cut)""")
def _quantile_boost(spark, d):
    data = _stump_rows(spark, d)
    stage = T.gradient_boosting(1, "quantile", 0.5, max_depth=1, alpha=0.75, maxBins=64)
    return round_all(predict(stage.fit(data), data, "l_orderkey"), "prediction", digits=4)


@query("boost_huber", _BYQ.replace(", g AS", """, b AS (SELECT quantile_disc(y, 0.5) AS f0 FROM y),
h AS (SELECT quantile_cont(abs(y - f0), 0.9) AS h FROM y, b),
z AS (SELECT y.*, y - f0 AS gap, CASE WHEN abs(y - f0) <= h THEN y - f0 ELSE sign(y - f0) * h END AS r FROM y, b, h), g AS""").replace(
    "sum(y) AS s FROM y GROUP BY q", "sum(r) AS s FROM z GROUP BY q") + _stump("g", "t1") + f""",
v AS (SELECT q <= cut AS l, quantile_disc(gap, 0.5) AS v FROM z, t1 GROUP BY ALL),
u AS (SELECT l, v + avg(sign(gap - v) * least(abs(gap - v), h)) AS v FROM z, h, t1 JOIN v ON v.l = (z.q <= t1.cut) GROUP BY l, v)
SELECT l_orderkey, {rnd('f0 + 0.5 * u.v', 4)} AS prediction FROM z, b, t1 JOIN u ON u.l = (z.q <= t1.cut)""")
def _huber_boost(spark, d):
    data = _stump_rows(spark, d)
    stage = T.gradient_boosting(1, "huber", 0.5, max_depth=1, alpha=0.9, maxBins=64)
    return round_all(predict(stage.fit(data), data, "l_orderkey"), "prediction", digits=4)


@query("adaboost_r2", _BYQ + _stump("g", "t1") + f""",
e1 AS (SELECT y.*, CASE WHEN q <= cut THEN lv ELSE rv END AS p1, abs(y - CASE WHEN q <= cut THEN lv ELSE rv END) AS e FROM y, t1),
k1 AS (SELECT max(e) AS mx, avg(e) / max(e) AS er FROM e1),
w1 AS (SELECT e1.*, power(er / (1 - er), 1 - e / mx) AS w FROM e1, k1),
g2 AS (SELECT q, sum(w) AS w, sum(w * y) AS s FROM w1 GROUP BY q), {_stump('g2', 't2')},
e2 AS (SELECT w1.*, CASE WHEN q <= cut THEN lv ELSE rv END AS p2, abs(y - CASE WHEN q <= cut THEN lv ELSE rv END) AS e2 FROM w1, t2),
k2 AS (SELECT sum(w * e2) / sum(w) / max(e2) AS er2 FROM e2),
a AS (SELECT ln((1 - er) / er) AS a1, ln((1 - er2) / er2) AS a2 FROM k1, k2)
SELECT l_orderkey, {rnd('CASE WHEN CASE WHEN p1 <= p2 THEN a1 ELSE a2 END >= (a1 + a2) / 2 THEN least(p1, p2) ELSE greatest(p1, p2) END', 3)} AS prediction
FROM e2, a""")
def _ada(spark, d):
    data = _stump_rows(spark, d).cache()
    stage = T.AdaBoostR2(n_estimators=2, max_depth=1, maxBins=64)
    return round_all(predict(stage.fit(data), data, "l_orderkey"), "prediction", digits=3)


def _quality(df, label="label"):
    y, p = F.col(label), F.col("prediction")
    return df.agg(F.count(F.lit(1)).alias("rows"), rounded(rmsle(y, p), 4).alias("rmsle"), rounded(r2(y, p), 4).alias("r2"))


def _wide_rows(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_quantity", "l_discount", "l_tax", "l_linenumber",
        (F.col("l_extendedprice") + 20 * F.col("l_quantity") ** 2 * (1 + F.col("l_tax"))).alias("label"),
    )
    return assemble(rows, ["l_quantity", "l_discount", "l_tax", "l_linenumber"], keep=["l_orderkey", "label"]).cache()


@query("extra_trees")
def _extra(spark, d):
    data = _wide_rows(spark, d)
    stage = T.ExtraTrees(n_estimators=8, groups=2, max_features=0.6, min_samples_leaf=4, max_depth=4)
    return _quality(stage.fit(data).transform(data))


STUMPS, STUMP_TRIES, STUMP_SEED = 3, 2, 11
STUMP_COLUMNS = ("p_size", "p_partkey", "name_size")


def _stump_draws():
    """``(tree, place, feature, uniform)`` of what the roots of the stumps try."""
    for t in range(STUMPS):
        order, u = node_draws(STUMP_SEED, t, 1, len(STUMP_COLUMNS))
        yield from ((t, j, int(f), float(u[f])) for j, f in enumerate(order[:STUMP_TRIES]))


@query("extra_trees_stumps", f"""
WITH w AS (SELECT p_partkey, p_retailprice AS y, [p_size::DOUBLE, p_partkey::DOUBLE, length(p_name)::DOUBLE] AS x FROM part),
v(t, j, f, u) AS (VALUES {", ".join(map(str, _stump_draws()))}),
r AS (SELECT f, min(x[f + 1]) AS lo, max(x[f + 1]) AS hi FROM w, (SELECT DISTINCT f FROM v) GROUP BY f),
c AS (SELECT t, j, v.f, lo + u * (hi - lo) AS cut FROM v JOIN r USING (f) WHERE lo < hi),
g AS (
  SELECT t, j, f, cut, avg(y) FILTER (x[f + 1] <= cut) AS a, avg(y) FILTER (x[f + 1] > cut) AS b,
         sum(y) FILTER (x[f + 1] <= cut) ** 2 / count(*) FILTER (x[f + 1] <= cut) + sum(y) FILTER (x[f + 1] > cut) ** 2 / count(*) FILTER (x[f + 1] > cut) AS gain
  FROM w, c GROUP BY t, j, f, cut),
best AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY t ORDER BY gain DESC, j) = 1)
SELECT p_partkey, round(avg(CASE WHEN x[f + 1] <= cut THEN a ELSE b END), 6) + 0.0 AS prediction FROM w, best GROUP BY p_partkey""")
def _extra_stumps(spark, d):
    rows = table(spark, d, "part").select(
        "p_partkey", F.col("p_size").cast("double"), F.col("p_retailprice").alias("label"), F.length("p_name").cast("double").alias("name_size")
    )
    data = assemble(rows, STUMP_COLUMNS, keep=["p_partkey", "label"])
    share = STUMP_TRIES / len(STUMP_COLUMNS)
    model = T.ExtraTrees(n_estimators=STUMPS, max_features=share, max_depth=1, seed=STUMP_SEED).fit(data)
    return round_all(predict(model, data, "p_partkey"), "prediction")


@query("forest_quality")
def _forest_quality(spark, d):
    data = _wide_rows(spark, d)
    return _quality(T.random_forest(8, 0.6, min_samples_leaf=4, max_depth=4).fit(data).transform(data))


@query("knn_regress", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x, label::DOUBLE AS y FROM embeddings),
p AS (SELECT a.vec_id, b.y, list_distance(a.x, b.x) AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) AS r FROM e a, e b)
SELECT vec_id, round(avg(y), 6) + 0.0 AS prediction FROM p WHERE r <= 5 GROUP BY vec_id""")
def _knn(spark, d):
    data = _vectors(spark, d)
    stage = KNNRegressor(n_neighbors=5, keyCol="vec_id")
    return round_all(predict(stage.fit(data), data, "vec_id"), "prediction")


@query("knn_weighted", """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS x, label::DOUBLE AS y, vec_id % 2 AS side FROM embeddings),
p AS (SELECT a.vec_id, b.y, list_sum(list_transform(list_zip(a.x, b.x), lambda v: abs(v[1] - v[2]))) AS d, b.vec_id AS other FROM e a JOIN e b ON b.side = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, other) AS r FROM p)
SELECT vec_id, round(CASE WHEN count(*) FILTER (d = 0) > 0 THEN avg(y) FILTER (d = 0) ELSE sum(y / d) FILTER (d > 0) / sum(1 / d) FILTER (d > 0) END, 6) + 0.0 AS prediction
FROM k WHERE r <= 7 GROUP BY vec_id""")
def _knn_weighted(spark, d):
    data = _vectors(spark, d)
    stage = KNNRegressor(n_neighbors=7, keyCol="vec_id", weights="distance", p=1)
    model = stage.fit(data.filter("vec_id % 2 = 0"))
    return round_all(predict(model, data, "vec_id"), "prediction")


def _vectors(spark, d):
    x = F.col("embedding").cast("array<double>")
    return table(spark, d, "embeddings").select("vec_id", array_to_vector(x).alias("features"), c("label").cast("double").alias("label"))


# Resampling and scoring


@query("train_valid_split", f"""
SELECT o_orderkey, CASE WHEN {sql_bucket('o_orderkey', 100, 'split0')} < 25 THEN 'valid' ELSE 'train' END AS split FROM orders""")
def _split(spark, d):
    train, valid = resample.train_valid_split(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("split", F.lit("train")).unionByName(valid.withColumn("split", F.lit("valid")))


@query("kfold", f"SELECT o_orderkey, {fold('o_orderkey', 10)} AS fold FROM orders")
def _kfold(spark, d):
    return resample.kfold(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 10)


@query("kfold_exact", """
SELECT fold, count(*) AS rows FROM (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) % 7 AS fold FROM orders) GROUP BY fold""")
def _kfold_exact(spark, d):
    rows = resample.kfold(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 7, exact=True, rank_rows=2000)
    return rows.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))


@query("repeated_kfold", " UNION ALL ".join(
    f"SELECT o_orderkey, {r}::INT AS repeat, {fold('o_orderkey', 10, r)} AS fold FROM orders" for r in range(5)))
def _repeated(spark, d):
    return resample.repeated_kfold(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 10, 5)


@query("cross_validate", " UNION ALL ".join(f"""
SELECT {r}::INT AS repeat, fold::INT AS fold, count(*) AS rows, {rnd('sqrt(avg(power(ln(1 + p) - ln(1 + y), 2)))')} AS score FROM (
  SELECT f.fold, f.y, m.a * f.x + m.b AS p FROM (SELECT l_quantity AS x, l_extendedprice AS y, {fold('l_orderkey', 3, r)} AS fold FROM lineitem) f
  JOIN (SELECT k, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM range(3) t(k)
        JOIN (SELECT l_quantity AS x, l_extendedprice AS y, {fold('l_orderkey', 3, r)} AS fold FROM lineitem) g ON g.fold <> k GROUP BY k) m ON m.k = f.fold)
GROUP BY fold""" for r in range(2)))
def _cross_validate(spark, d):
    data = lines(spark, d).cache()
    return round_all(resample.cross_validate(L.LinearBaseline(), data, "l_orderkey", 3, 2), "score")


_GRID = ", ".join(f"({a}::DOUBLE)" for a in (1.0, 1e6, 1e8))


@query("grid_search", f"""
WITH f AS (SELECT l_quantity AS x, l_extendedprice AS y, {fold('l_orderkey', 3)} AS fold FROM lineitem),
m AS (SELECT k, a, avg(x) AS mx, avg(y) AS my, regr_sxy(y, x) / (regr_sxx(y, x) + a) AS w FROM range(3) t(k), (VALUES {_GRID}) v(a), f WHERE f.fold <> k GROUP BY k, a),
s AS (SELECT a, k, sqrt(avg(power(ln(1 + my + w * (x - mx)) - ln(1 + y), 2))) AS s FROM m JOIN f ON f.fold = m.k GROUP BY a, k)
SELECT a AS alpha, {rnd('avg(s)')} AS mean, {rnd('stddev_pop(s)')} AS std FROM s GROUP BY a""")
def _grid(spark, d):
    stage = L.Ridge()
    grid = ParamGridBuilder().addGrid(stage.alpha, [1.0, 1e6, 1e8]).build()
    found, _ = resample.grid_search(stage, grid, lines(spark, d).cache(), "l_orderkey", 3)
    alpha = F.regexp_extract("params", "alpha=(.*)", 1).cast("double").alias("alpha")
    return round_all(found.select(alpha, "mean", "std"), "mean", "std")


_CURVE = (0.2, 0.5, 1.0)


@query("learning_curve", f"""
WITH r AS (SELECT l_quantity AS x, l_extendedprice AS y, {sql_bucket('l_orderkey', 100, 'split0')} < 25 AS valid,
                  {sql_bucket('l_orderkey', 10000, 'curve')} AS h FROM lineitem),
s AS (SELECT s FROM (VALUES {', '.join(f'({v}::DOUBLE)' for v in _CURVE)}) v(s)),
m AS (SELECT s, count(*) AS n, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM s JOIN r ON NOT valid AND h < s * 10000 GROUP BY s)
SELECT m.s AS share, m.n AS train_rows,
       {rnd('sqrt(avg(power(ln(1 + a * x + b) - ln(1 + y), 2)) FILTER (NOT valid AND h < m.s * 10000))')} AS train_score,
       {rnd('sqrt(avg(power(ln(1 + a * x + b) - ln(1 + y), 2)) FILTER (valid))')} AS valid_score FROM m, r GROUP BY m.s, m.n""")
def _curve(spark, d):
    data = lines(spark, d).cache()
    return round_all(resample.learning_curve(L.LinearBaseline(), data, "l_orderkey", _CURVE), "train_score", "valid_score")


# Every share and fold from one scan: cross products by fold and slice, added and taken away.
@query("linear_curves", f"""
WITH r AS (SELECT l_quantity AS x, l_extendedprice + 900 * l_quantity AS y, {fold('l_orderkey', 3)} AS g,
                  {sql_bucket('l_orderkey', 10000, 'curve')} AS h FROM lineitem),
k AS (SELECT s, f::INT AS f FROM (VALUES {', '.join(f'({v}::DOUBLE)' for v in _CURVE)}) v(s), range(3) t(f)),
m AS (SELECT s, f, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM k JOIN r ON g <> f AND h < s * 10000 GROUP BY s, f),
p AS (SELECT s, f, y, power(y - a * x - b, 2) AS e, g = f AS valid FROM m JOIN r ON g = f OR h < s * 10000)
SELECT s AS share, f AS fold, count(*) FILTER (NOT valid) AS train_rows, count(*) FILTER (valid) AS valid_rows,
       {rnd('1 - avg(e) FILTER (NOT valid) / var_pop(y) FILTER (NOT valid)')} AS train_r2,
       {rnd('1 - avg(e) FILTER (valid) / var_pop(y) FILTER (valid)')} AS valid_r2,
       {rnd('sqrt(avg(e) FILTER (NOT valid))', 4)} AS train_rmse, {rnd('sqrt(avg(e) FILTER (valid))', 4)} AS valid_rmse
FROM p GROUP BY s, f""")
def _linear_curves(spark, d):
    rows = table(spark, d, "lineitem").withColumn("y", F.col("l_extendedprice") + 900 * F.col("l_quantity"))
    found = resample.linear_curves(rows, ["l_quantity"], "y", "l_orderkey", _CURVE, 3)
    return round_all(round_all(found, "train_r2", "valid_r2"), "train_rmse", "valid_rmse", digits=4)


_DRAWS = ", ".join(repr(float(v)) + "::DOUBLE" for v in np.cumsum([np.exp(-1) / m for m in (1, 1, 2, 6, 24, 120, 720, 5040)]))


def _drawn(tree):
    return f"len(list_filter([{_DRAWS}], lambda v: {sql_bucket('l_orderkey', 1 << 30, f'7-bag-{tree}')} / {float(1 << 30)} >= v))::DOUBLE"


# Three bagged stumps: each is grown on its hashed weights and judges the rows it has not drawn.
@query("oob_score", f"""
WITH y AS (SELECT l_quantity AS q, l_extendedprice + 900 * l_quantity AS y, {", ".join(f"{_drawn(t)} AS w{t}" for t in range(3))} FROM lineitem),
{", ".join(f"g{t} AS (SELECT q, sum(w{t}) AS w, sum(w{t} * y) AS s FROM y WHERE w{t} > 0 GROUP BY q), {_stump(f'g{t}', f't{t}')}" for t in range(3))},
p AS (SELECT y, {" + ".join(f"CASE WHEN w{t} = 0 THEN CASE WHEN q <= t{t}.cut THEN t{t}.lv ELSE t{t}.rv END ELSE 0 END" for t in range(3))} AS total,
  {" + ".join(f"(w{t} = 0)::INT" for t in range(3))} AS judges FROM y, t0, t1, t2),
o AS (SELECT y, CASE WHEN judges > 0 THEN total / judges END AS p FROM p)
SELECT count(*) AS rows, count(p) AS judged,
  {rnd("(SELECT 1 - sum(power(y - p, 2)) / (var_pop(y) * count(*)) FROM o WHERE p IS NOT NULL)", 4)} AS r2 FROM o""")
def _oob(spark, d):
    # Lineitem has no row key: rows of an order share their bootstrap weight.
    data = _stump_rows(spark, d)
    stage = T.BaggedTrees(n_estimators=3, max_depth=1, maxBins=64, keyCol="l_orderkey")
    model = stage.fit(data)
    rows = stage.oob_predictions(model, data)
    label = F.when(F.col("oob_prediction").isNotNull(), F.col("label"))
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count("oob_prediction").alias("judged"),
        rounded(r2(label, F.col("oob_prediction")), 4).alias("r2"),
    )


@query("bootstrap_weights", f"""
WITH u AS (SELECT event_id, {sql_bucket('event_id', 1 << 30, '7-bag-3')} / {float(1 << 30)} AS u FROM events),
s AS (SELECT [{', '.join(repr(float(v)) + '::DOUBLE' for v in np.cumsum([np.exp(-1) / m for m in (1, 1, 2, 6, 24, 120, 720, 5040)]))}] AS s)
SELECT event_id, len(list_filter(s, lambda v: u >= v))::DOUBLE AS w FROM u, s""")
def _bootstrap(spark, d):
    return table(spark, d, "events").select("event_id", T.poisson_weight(F.col("event_id"), 3).alias("w"))


_CASES = """SELECT event_type AS kind, event_id, value AS y, CASE WHEN event_type = 'click' AND event_id % 100 = 0 THEN -2.0
  WHEN event_type = 'view' AND event_id % 100 = 0 THEN -0.5 ELSE value * 1.1 + event_id % 3 END AS p FROM events"""


@query("rmsle", f"""
SELECT kind, CASE WHEN min(p) <= -1 THEN -1.0::DOUBLE ELSE {rnd('sqrt(avg(power(ln(1 + CASE WHEN p > -1 THEN p END) - ln(1 + y), 2)))')} END AS score
FROM ({_CASES}) GROUP BY kind""")
def _rmsle(spark, d):
    rows = table(spark, d, "events").selectExpr("event_id", "event_type", "value").createOrReplaceTempView("_rmsle_events")
    rows = spark.sql(_CASES.replace("FROM events", "FROM _rmsle_events"))
    score = rmsle(F.col("y").cast("double"), F.col("p").cast("double"))
    out = rows.groupBy("kind").agg(score.alias("score"))
    # Infinity is shown as -1.
    return out.select("kind", F.when(F.col("score") == float("inf"), -1.0).otherwise(rounded(F.col("score"))).alias("score"))


_SCORED = f"""SELECT CASE WHEN {sql_bucket('event_id', 100, 'split0')} < 25 THEN 'valid' ELSE 'train' END AS split, value AS y, value * 0.9 + event_id % 3 AS p FROM events"""


def _scored(spark, d):
    return table(spark, d, "events").select(
        resample.split_label(F.col("event_id")).alias("split"), F.col("value").alias("label"),
        (F.col("value") * 0.9 + F.col("event_id") % 3).alias("prediction"),
    )


@query("r2", f"SELECT {rnd('1 - sum(power(y - p, 2)) / (var_pop(y) * count(*))')} AS r2 FROM ({_SCORED})")
def _r2(spark, d):
    return _scored(spark, d).agg(rounded(r2(F.col("label"), F.col("prediction"))).alias("r2"))


@query("score_card", f"""
SELECT split, count(*) AS rows, {rnd('sqrt(avg(power(ln(1 + p) - ln(1 + y), 2)))')} AS rmsle,
       {rnd('1 - sum(power(y - p, 2)) / (var_pop(y) * count(*))')} AS r2 FROM ({_SCORED}) GROUP BY split""")
def _card(spark, d):
    return round_all(score_card(_scored(spark, d)), "rmsle", "r2")


@query("custom_scorer", f"SELECT {rnd('-sqrt(avg(power(ln(1 + p) - ln(1 + y), 2)))')} AS score, 1 AS larger_is_better FROM ({_SCORED})")
def _scorer(spark, d):
    scorer = ColumnScorer(metric="rmsle", negated=True)
    value = scorer.evaluate(_scored(spark, d))
    return spark.createDataFrame([(float(round(value, 6)), int(scorer.isLargerBetter()))], "score double, larger_is_better int")


@query("leaderboard", f"""
SELECT event_type AS model, {rnd('avg(value)')} AS mean, {rnd('stddev_pop(value)')} AS std FROM events GROUP BY 1
UNION ALL SELECT c_mktsegment, {rnd('avg(c_acctbal)')}, {rnd('stddev_pop(c_acctbal)')} FROM customer GROUP BY 1""")
def _leaderboard(spark, d):
    from lathework.operators.profile import metric_mean_std

    board = metric_mean_std(table(spark, d, "events").select(F.col("event_type").alias("model"), F.col("value").alias("score")))
    entries = metric_mean_std(table(spark, d, "customer").select(F.col("c_mktsegment").alias("model"), F.col("c_acctbal").alias("score")))
    return round_all(leaderboard(entries, board), "mean", "std")


@query("train_report", f"""
WITH f AS (SELECT event_id, user_id::DOUBLE AS x, value + 1 AS y, {fold('event_id', 5)} AS fold FROM events),
m AS (SELECT k, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM range(5) t(k) JOIN f ON f.fold <> k GROUP BY k),
s AS (SELECT fold, sqrt(avg(power(ln(1 + a * x + b) - ln(1 + y), 2))) AS s FROM f JOIN m ON m.k = f.fold GROUP BY fold),
e AS (SELECT y - (regr_slope(y, x) OVER () * x + regr_intercept(y, x) OVER ()) AS e FROM f),
z AS (SELECT (e - avg(e) OVER ()) / stddev_pop(e) OVER () AS z FROM e)
SELECT {rnd('(SELECT avg(s) FROM s)')} AS mean, {rnd('(SELECT stddev_pop(s) FROM s)')} AS std,
       (SELECT count(*) FROM z WHERE abs(z) > 3) AS outliers""")
def _train_report(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", (F.col("value") + 1).alias("label"))
    data = assemble(rows, ["user_id"], keep=["event_id", "label"]).cache()
    report = train_report(L.LinearBaseline(), data, "event_id", 3.0, folds=5)
    return report["outliers"].agg(F.count(F.lit(1)).alias("outliers")).select(
        rounded(F.lit(report["cv"]["mean"])).alias("mean"), rounded(F.lit(report["cv"]["std"])).alias("std"), "outliers"
    )


@query("stacked_regressor")
def _stacked(spark, d):
    data = _wide_rows(spark, d)
    steps = stacked_regressor(trees=4, key="l_orderkey", groups=2, max_depth=4)
    return _quality(steps.fit(data).transform(data))


# Search


def _small_space():
    return {
        "estimators": {
            "ridge_cv": {}, "decision_tree": {"max_depth": [1, 2, 3], "min_samples_leaf": [1, 5]},
            "elastic_net_cv": {"l1_ratio": [0.5, 1.0], "tol": [1e-4]},
        },
        "preprocessors": {k: PREPROCESSORS[k] for k in ("standard_scaler", "minmax_scaler", "polynomial_deg2")},
    }


def _search(spark, d, log=None):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    data = rows.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("label"), "c_acctbal", "c_nationkey",
                       F.datediff("o_orderdate", F.lit("1992-01-01")).alias("day"))
    data = assemble(data, ["c_acctbal", "c_nationkey", "day"], keep=["id", "label"])
    return Search(data, folds=2, parallelism=3, space=_small_space(), log=log)


@query("random_search")
def _random_search(spark, d):
    with _search(spark, d) as search:
        found = random_search(search, 4, seed=3)
    return round_all(found.select("cand_id", "spec", "complexity", "score", "status"), "score", digits=4)


@query("population_search")
def _population_search(spark, d):
    folder = shared_dir(spark, "evolution")
    with _search(spark, d, SearchLog(spark, folder, "a")) as search:
        population_search(search, population=3, offspring=2, generations=1, seed=5)
    # A second search over the same log has every score and fits nothing.
    with _search(spark, d, SearchLog(spark, folder, "a")) as again:
        found = population_search(again, population=3, offspring=2, generations=1, seed=5)
    refits = again.fits
    best = cand_id(again.best().spec)
    return round_all(
        found.select("cand_id", "spec", "complexity", "score", (F.col("cand_id") == best).cast("int").alias("best"),
                     F.lit(refits).alias("refits")), "score", digits=4,
    )


@query("pareto_front", """
SELECT p_partkey, p_size, p_retailprice FROM part a WHERE NOT EXISTS (
  SELECT 1 FROM part b WHERE b.p_size <= a.p_size AND b.p_retailprice >= a.p_retailprice
  AND (b.p_size < a.p_size OR b.p_retailprice > a.p_retailprice))""")
def _pareto(spark, d):
    return pareto_front(table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice"), "p_size", "p_retailprice", slices=8)


# Generated features

_BASE = ("l_quantity", "l_discount", "l_linenumber")
_TREES = generate.first_candidates(_BASE)
_SQL_OPS = {
    "log1pabs": "ln(1 + abs({0}))", "sqrtabs": "sqrt(abs({0}))", "square": "({0} * {0})", "add": "({0} + {1})",
    "sub": "({0} - {1})", "mul": "({0} * {1})", "div": "(CASE WHEN {1} = 0 THEN 1.0::DOUBLE ELSE {0} / {1} END)",
}


def _sql_tree(tree):
    return f"{tree}::DOUBLE" if isinstance(tree, str) else _SQL_OPS[tree[0]].format(*[_sql_tree(t) for t in tree[1:]])


def _feature_name(tree):
    return generate.label_of(tree).replace("(", "_").replace(")", "").replace(",", "_").replace("l_", "")


@query("generate_features", "SELECT l_orderkey, " + ", ".join(f"{rnd(_sql_tree(t))} AS {_feature_name(t)}" for t in _TREES) + " FROM lineitem")
def _generate(spark, d):
    out = generate.generate_features(table(spark, d, "lineitem"), _TREES, keep=["l_orderkey"])
    return out.select("l_orderkey", *[rounded(F.col("features")[i]).alias(_feature_name(t)) for i, t in enumerate(_TREES)])


@query("score_features", " UNION ALL ".join(
    f"SELECT '{generate.label_of(t)}' AS candidate, {rnd(f'corr({_sql_tree(t)}, l_extendedprice)')} AS r FROM lineitem" for t in _TREES))
def _score_features(spark, d):
    rows = table(spark, d, "lineitem").withColumn("zero", F.lit(0.0))
    # A constant candidate is rejected.
    scored = generate.score_features(rows, [*_TREES, ("square", "zero")], "l_extendedprice")
    return round_all(scored.table(spark), "r")


@query("select_diverse", f"""
WITH v AS (SELECT l_quantity AS a, l_quantity * l_quantity AS b, sqrt(l_quantity) AS c, l_discount AS d, l_extendedprice + 900 * l_quantity AS y FROM lineitem),
r AS (SELECT abs(corr(a, y)) AS a, abs(corr(b, y)) AS b, abs(corr(c, y)) AS c, abs(corr(d, y)) AS d FROM v)
SELECT n AS candidate, {rnd('s')} AS r FROM (SELECT * FROM (
  SELECT 'l_quantity' AS n, a AS s, 1 AS grp FROM r UNION ALL SELECT 'square(l_quantity)', b, 1 FROM r
  UNION ALL SELECT 'sqrtabs(l_quantity)', c, 1 FROM r UNION ALL SELECT 'l_discount', d, 2 FROM r)
  QUALIFY row_number() OVER (PARTITION BY grp ORDER BY s DESC) = 1)""")
def _diverse(spark, d):
    rows = table(spark, d, "lineitem").withColumn("y", F.col("l_extendedprice") + 900 * F.col("l_quantity"))
    trees = ["l_quantity", ("square", "l_quantity"), ("sqrtabs", "l_quantity"), "l_discount"]
    kept = generate.select_diverse(generate.score_features(rows, trees, "y"), 3, cut=0.9)
    return kept.table(spark).select("candidate", rounded(F.abs("r")).alias("r"))


# The first generation holds all candidates, so its best is known; later ones never fall behind, and
# the built-in correlation of each generation's winner is the score that its generation gave it.
@query("evolve_features", f"""
WITH l AS (SELECT *, l_extendedprice + 3 * power(l_quantity, 2) * l_linenumber AS y FROM lineitem),
r AS ({" UNION ALL ".join(f"SELECT abs(corr({_sql_tree(t)}, y)) AS r FROM l" for t in _TREES)})
SELECT g::INT AS generation, {rnd("max(r)", 5)} AS first_best, true AS no_worse, true AS score_holds
FROM r, (VALUES (0), (1), (2)) v(g) GROUP BY g""")
def _evolve(spark, d):
    rows = table(spark, d, "lineitem").select(
        *_BASE, (F.col("l_extendedprice") + 3 * F.col("l_quantity") ** 2 * F.col("l_linenumber")).alias("label")
    ).cache()
    found = generate.evolve_features(rows, _BASE, "label", generations=3, population=len(_TREES), survivors=5)
    again = rows.agg(*[
        F.abs(F.corr(generate.column_of(t), F.col("label"))).alias(f"g{g}") for g, t in enumerate(found.winners)
    ]).first()
    scores = [r for _, _, r in found.history]
    out = [
        (g, round(scores[0], 5), r >= scores[max(0, g - 1)] - 1e-12, abs(again[f"g{g}"] - r) < 1e-6) for g, r in enumerate(scores)
    ]
    rows.unpersist()
    return spark.createDataFrame(out, "generation int, first_best double, no_worse boolean, score_holds boolean")
