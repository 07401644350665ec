"""Readers, patches, search and the flows on a small house-like table."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lathework.operators import combine, encode, generate, impute, project
from lathework.operators.encode import assemble
from lathework.plans import house_values as V
from lathework.plans.flows import clean_houses, evolve_and_fit, factor_report, neighborhoods_without
from lathework.plans.report import leaderboard, print_score, train_report
from lathework.plans.search import Search, breed, distinct_specs, front, pareto_front, population_search
from lathework.plans.space import build, cand_id, draw_spec, param_space, reject, size_of
from lathework.operators.linear import LinearBaseline, Ridge
from lathework.session import shared_dir
from lathework.sources.searchlog import SearchLog
from lathework.sources.tables import read_features, read_target, write_submission


def house_frame(n, seed, start=1):
    rng = np.random.default_rng(seed)
    levels = {}
    for name in V.SELECTED:
        if "_" in name:
            column, level = name.split("_", 1)
            levels.setdefault(column, []).append(level)
    levels["Utilities"] = ["AllPub", "NoSeWa"]
    levels.update({n: ["X"] for n in V.ABSENT if n not in levels})
    out = {"Id": np.arange(start, start + n)}
    for column, values in levels.items():
        pool = ([20, 120] + [int(v) for v in values]) if column == "MSSubClass" else (["0"] + [v for v in values if v != "None"])
        pick = np.array(pool, dtype=object)[rng.integers(0, len(pool), n)]
        pick[: len(pool)] = pool
        if column in V.ABSENT:
            pick[len(pool): len(pool) + 9] = None
        out[column] = pick if column != "MSSubClass" else pick.astype("int64")
    for name in dict.fromkeys([*V.SELECTED, *V.ZERO]):
        if "_" not in name:
            out[name] = rng.integers(0, 100, n).astype("float64")
    for name in V.ZERO:
        out[name][:5] = np.nan
    out["GarageYrBlt"][:7] = np.nan
    out["LotFrontage"][::6] = np.nan
    return pd.DataFrame(out)


@pytest.fixture(scope="module")
def houses(spark):
    train, test = house_frame(120, 0), house_frame(80, 1, 121)
    train["SalePrice"] = 100000.0 + 500 * train["GrLivArea"]
    to_none = [df.astype(object).where(df.notna(), None) for df in (train, test)]
    schema = ", ".join(
        f"`{n}` " + ("bigint" if t == "int64" else "double" if t == "float64" else "string") for n, t in train.dtypes.items()
    )
    short = ", ".join(s for s in schema.split(", ") if "SalePrice" not in s)
    return spark.createDataFrame(to_none[0], schema).cache(), spark.createDataFrame(to_none[1], short).cache()


def test_selected_features():
    assert len(V.SELECTED) == 178 and len(set(V.SELECTED)) == 178
    assert sum("_" not in n for n in V.SELECTED) == 31


@pytest.mark.parametrize("fit_on", ["train", "all"])
def test_clean_houses(houses, fit_on):
    out = clean_houses(*houses, fit_on=fit_on)
    assert out["train"].columns == ["Id", *V.SELECTED] == out["test"].columns
    assert out["train"].count() == 120 and out["test"].count() == 80
    pdf = out["train"].toPandas().set_index("Id")
    assert pdf.notna().all().all()
    raw = houses[0].toPandas().set_index("Id")
    assert (pdf["GarageQual_None"] == raw["GarageQual"].isna().astype(int)).all()
    assert (pdf.loc[raw.index[:5], "MasVnrArea"] == 0).all()
    means = raw.groupby("Neighborhood")["GarageYrBlt"].mean()
    if fit_on == "train":
        for i in raw.index[:7]:
            want = means[raw.loc[i, "Neighborhood"]]
            assert np.isnan(want) or pdf.loc[i, "GarageYrBlt"] == pytest.approx(want)
    assert out["target"].columns == ["Id", "SalePrice"]


def test_evolve_and_fit(houses):
    train, target = houses[0].select("Id", "GrLivArea", "LotArea"), houses[0].select("Id", "SalePrice")
    evolved, model = evolve_and_fit(train, target, learner="forest", generations=2, population=12, survivors=3)
    scores = [r for _, _, r in evolved.history]
    assert scores == sorted(scores) and scores[-1] > 0.99
    assert model.getNumTrees == 100


def test_factor_report(houses):
    columns = ["Id", "GrLivArea", "LotArea", "YearBuilt", "MSZoning", "Street", "Utilities"]
    model, tables = factor_report(houses[0].select(*columns).withColumn("flat", F.lit("x")), ncp=3)
    assert "YearBuilt" not in model.numeric and "Id" not in model.numeric and "flat" not in model.factors
    total = tables["contributions"].groupBy("factor").agg(F.sum("contrib").alias("t")).collect()
    assert all(r["t"] == pytest.approx(100) for r in total) and len(total) == 3
    assert neighborhoods_without(houses[0]).first()["missing"] >= 1


def test_read_features(spark):
    path = shared_dir(spark, "csv")
    spark.createDataFrame([(0, "NA", "1.5"), (1, "x", "NaN"), (2, "y", "NA")], "`Unnamed: 0` int, k string, v string").write.option(
        "header", True).csv(path)
    df = read_features(spark, path, "`Unnamed: 0` BIGINT, k STRING, v DOUBLE", index_col="Unnamed: 0")
    rows = {r["row_id"]: (r["k"], r["v"]) for r in df.collect()}
    assert rows == {0: (None, 1.5), 1: ("x", None), 2: ("y", None)}
    assert read_features(spark, path, index_col="Unnamed: 0").columns == ["row_id", "k", "v"]


def test_target_and_submission(spark):
    path, out = shared_dir(spark, "y"), shared_dir(spark, "sub")
    spark.createDataFrame([(0, 208500.0), (1, 181500.0)], "i int, y double").write.csv(path)
    target = read_target(spark, path)
    assert target.dtypes == [("row_id", "bigint"), ("target", "double")]
    write_submission(target.withColumnRenamed("row_id", "Id").withColumnRenamed("target", "prediction"), out, files=1)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["Id", "SalePrice"] and {r["Id"] for r in back.collect()} == {"0", "1"}


def test_strict_projection_and_patches(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id int, k string, v double")
    with pytest.raises(KeyError):
        project.select_columns(df, ["id", "nope"])
    with pytest.raises(KeyError):
        project.patch_cells(df, "id", [(1, "nope", 1)])
    out = project.patch_cells(df, "id", [(1, "k", "x"), (1, "k", "y"), (9, "k", "z")])
    assert sorted(out.collect()) == [(1, "y", 1.0), (2, "b", 2.0)]
    with pytest.raises(KeyError):
        impute.fill_rules(df, {"nope": 0})


def test_align_target_checks(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id int, x double")
    b = spark.createDataFrame([(1, 5.0)], "id int, y double")
    with pytest.raises(ValueError):
        combine.align_target(a, b, "id", check=True)
    assert combine.align_target(a, b, "id").count() == 1


def test_large_statistics_are_not_broadcast(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 50)
    out = impute.group_transform(df, "g", F.count(F.lit(1)), "n")
    assert out.filter("n = 2").count() == 100
    stats = df.groupBy("g").count()
    assert combine.join_statistics(df, stats, "g", limit_rows=10).filter("count = 2").count() == 100
    assert combine.broadcast_if_small(stats, 10) is stats


def test_unseen_and_missing_levels(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    test = spark.createDataFrame([("z",), (None,), ("b",)], "k string")
    model = encode.Dummies().fit(train)
    assert [tuple(r) for r in model.transform(test).collect()] == [(0, 0), (0, 0), (1, 0)]
    assert list(model.to_vector(test).first()["dummies"]) == [0.0, 0.0]
    with pytest.raises(ValueError):
        encode.Dummies(max_levels=2).fit(train)


def test_space_sizes():
    est = param_space()["estimators"]
    want = {"elastic_net_cv": 105, "extra_trees": 15200, "gradient_boosting": 182400000, "adaboost_r2": 15,
            "decision_tree": 3800, "knn_regress": 400, "lasso_cv": 2, "linear_svr": 1100, "random_forest": 15200,
            "ridge_cv": 1, "xgb_like": 20000}
    assert {k: size_of(v) for k, v in est.items()} == want
    assert len(param_space()["preprocessors"]) == 12 and len(param_space(one_hot=True)["preprocessors"]) == 13
    assert size_of(param_space(adaboost_depth=True)["estimators"]["adaboost_r2"]) == 150


def test_invalid_candidates():
    assert reject("feature_agglomeration", {"linkage": "ward", "affinity": "l1"})
    assert reject("linear_svr", {"loss": "epsilon_insensitive", "dual": False})
    assert reject("elastic_net_cv", {"l1_ratio": 0.0})
    with pytest.raises(ValueError):
        build({"pre": [], "est": ["elastic_net_cv", {"l1_ratio": 0.0}]})


def test_every_step_of_the_space_can_be_built():
    rng = np.random.default_rng(0)
    space = param_space(one_hot=True, adaboost_depth=True)
    seen = set()
    for _ in range(300):
        spec = draw_spec(space, rng)
        build(spec)
        seen |= {spec["est"][0], *[n for n, _ in spec["pre"]]}
    assert seen >= set(space["estimators"]) | set(space["preprocessors"])
    specs = distinct_specs(space, 20, rng)
    children = breed(specs, space, 30, rng)
    assert len({cand_id(s) for s in specs + children}) == 50


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"id": np.arange(200), "a": rng.uniform(1, 5, 200), "b": rng.uniform(1, 5, 200)})
    pdf["label"] = 10 + pdf["a"] * 3 + rng.normal(size=200) * 0.1
    return assemble(spark.createDataFrame(pdf), ["a", "b"], keep=["id", "label"]).cache()


SPACE = {"estimators": {"ridge_cv": {}, "decision_tree": {"max_depth": [1, 2, 3]}},
         "preprocessors": {"standard_scaler": {}, "minmax_scaler": {}}}


def test_search_is_repeatable_and_resumes(spark, rows):
    folder = shared_dir(spark, "runs")

    def run(log=None):
        with Search(rows, folds=2, space=SPACE, log=log) as s:
            table = population_search(s, 3, 3, 1, seed=1).collect()
        return s, table

    first, a = run(SearchLog(spark, folder, "r"))
    second, b = run(SearchLog(spark, folder, "r"))
    third, c = run()
    assert a == b == c and first.fits > 0 and second.fits == 0 and third.fits == first.fits
    mean = LinearBaseline()
    assert first.best().score < 0.2
    assert first.best().sort_key == min(r.sort_key for r in first.results.values())
    fitted = first.fit_front()
    assert fitted and set(fitted) == {cand_id(r.spec) for r in front(first.results.values())}
    assert mean is not None


def test_broken_and_slow_candidates_do_not_end_the_search(spark, rows):
    bad = {"pre": [], "est": ["knn_regress", {"n_neighbors": 1000}]}
    slow = {"pre": [], "est": ["random_forest", {"n_estimators": 60}]}
    with Search(rows, folds=2) as s:
        assert s.evaluate(bad).status.startswith("failed")
        s.max_eval_mins = 0.002
        assert s.evaluate(slow).status == "timeout"
        s.max_eval_mins = 5
        assert s.evaluate({"pre": [], "est": ["ridge_cv", {}]}).status == "ok"
    with pytest.raises(ValueError):
        Search(rows, metric="r2")


def test_pareto_against_brute_force(spark):
    rng = np.random.default_rng(6)
    pts = [(int(a), float(b)) for a, b in zip(rng.integers(0, 40, 300), rng.integers(0, 60, 300))]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id int, cost int, gain double")
    want = {
        i for i, (a, b) in enumerate(pts)
        if not any(c <= a and d >= b and (c < a or d > b) for c, d in pts)
    }
    for slices in (2, 5, 256):
        assert {r["id"] for r in pareto_front(df, "cost", "gain", slices).collect()} == want


def test_pareto_of_nulls_ties_and_one_hot_level(spark):
    rows = [(i, 5, 9.0) for i in range(300)] + [(300, 5, 8.0), (301, None, 99.0), (302, 1, None), (303, 4, 7.0), (304, 4, 7.0), (305, 6, 9.0)]
    df = spark.createDataFrame(rows, "id int, cost int, gain double")
    for slices in (None, 1, 64):
        assert {r["id"] for r in pareto_front(df, "cost", "gain", slices).collect()} == {*range(300), 303, 304}
    assert pareto_front(df.limit(0), "cost", "gain").count() == 0
    assert pareto_front(df.filter("cost IS NULL"), "cost", "gain").count() == 0


def test_train_report_with_grid(rows):
    from pyspark.ml.tuning import ParamGridBuilder

    stage = Ridge()
    grid = ParamGridBuilder().addGrid(stage.alpha, [0.1, 1e6]).build()
    report = train_report(stage, rows, "id", folds=3, grid=grid)
    assert report["grid"].first()["params"] == "alpha=0.1"
    assert report["cv"]["mean"] < 0.05 and report["scores"].count() == 3
    card = print_score(report["model"], rows, rows, oob=0.5)
    assert len(card) == 5 and card[0] == pytest.approx(card[1])


def test_leaderboard_order(spark):
    board = spark.createDataFrame([("b", 0.2, 0.0)], "model string, mean double, std double")
    new = spark.createDataFrame([("a", 0.1, 0.0), ("c", 0.2, 0.1)], "model string, mean double, std double")
    assert [r["model"] for r in leaderboard(new, board).collect()] == ["a", "b", "c"]


def test_candidates_with_bad_values_are_rejected(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), 2.0 * i) for i in range(1, 30)], "a double, z double, y double")
    trees = ["a", ("div", "a", "z"), ("square", ("square", ("square", ("square", ("square", ("square", ("square", ("square", "a")))))))),
             ("sub", "a", "a")]
    kept = [generate.label_of(t) for t in generate.score_features(df, trees, "y").trees]
    assert kept == ["a", "div(a,z)"]
