"""Queries on reading, projecting, profiling, filling, encoding and screening."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lathework.functions.columns import c, key_bucket, rounded
from lathework.functions.metrics import invalid_pair, log1p_sq_err
from lathework.operators import combine, encode, impute, profile, project, screen
from lathework.operators.linear import LinearBaseline
from lathework.plans.flows import train_valid_test_bundle
from lathework.plans.registry import gap, query, rnd, round_all, sql_bucket, sql_gap, table
from lathework.session import shared_dir
from lathework.sources.models import load_models, save_model
from lathework.sources.searchlog import SCHEMA, SearchLog
from lathework.sources.tables import read_features, read_target, write_submission

FLAGS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


# Sources and sinks


@query("read_features", f"""
SELECT c_custkey AS row_id, {sql_gap('c_acctbal', 'c_custkey')} AS c_acctbal,
       {sql_gap('c_mktsegment', 'c_custkey', 5)} AS c_mktsegment, c_nationkey::BIGINT AS c_nationkey
FROM customer""")
def _read_features(spark, d):
    path = shared_dir(spark, "features")
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").alias("Unnamed: 0"), gap("c_acctbal", "c_custkey").alias("c_acctbal"),
        gap("c_mktsegment", "c_custkey", 5).alias("c_mktsegment"), F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
    )
    rows.write.option("header", True).option("nullValue", "NA").csv(path)
    schema = "`Unnamed: 0` BIGINT, c_acctbal DOUBLE, c_mktsegment STRING, c_nationkey BIGINT"
    return read_features(spark, path, schema, index_col="Unnamed: 0")


@query("read_target", "SELECT o_orderkey AS row_id, o_totalprice AS target FROM orders")
def _read_target(spark, d):
    path = shared_dir(spark, "target")
    table(spark, d, "orders").select("o_orderkey", "o_totalprice").write.csv(path)
    return read_target(spark, path)


@query("write_submission", f'SELECT o_orderkey AS "Id", {rnd("o_totalprice * 1.01", 4)} AS "SalePrice" FROM orders')
def _write_submission(spark, d):
    path = shared_dir(spark, "submission")
    scored = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("double").alias("Id"), rounded(F.col("o_totalprice") * 1.01, 4).alias("prediction")
    )
    write_submission(scored, path)
    return spark.read.schema("Id BIGINT, SalePrice DOUBLE").option("header", True).csv(path)


@query("save_model", f"""
WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b
           FROM lineitem)
SELECT l_quantity, count(*) AS n, {rnd('max(a * l_quantity + b)', 4)} AS prediction
FROM lineitem, m GROUP BY l_quantity""")
def _save_model(spark, d):
    rows = table(spark, d, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    data = encode.assemble(rows, ["l_quantity"], keep=["l_quantity", "label"])
    folder = shared_dir(spark, "models")
    save_model(spark, LinearBaseline().fit(data), folder, "line", 0.0)
    scored = load_models(spark, folder)["line"].transform(data)
    return scored.groupBy("l_quantity").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.max("prediction"), 4).alias("prediction")
    )


@query("search_checkpoint", """
SELECT p_brand, count(*) AS waiting FROM part WHERE p_partkey % 3 <> 0 GROUP BY p_brand""")
def _search_checkpoint(spark, d):
    parts = table(spark, d, "part")
    log = SearchLog(spark, shared_dir(spark, "log"), "run")
    for batch in (parts.filter("p_partkey % 6 = 0"), parts.filter("p_partkey % 3 = 0")):
        # The second batch holds the first again: a candidate counts as scored once.
        batch.select(
            F.lit("run").alias("run"), F.lit(0).alias("generation"), c("p_partkey").cast("string").alias("cand_id"),
            c("p_name").alias("spec"), c("p_size").alias("complexity"), c("p_retailprice").alias("score"),
            F.lit(0.0).alias("std"), F.lit("ok").alias("status"),
        ).write.mode("append").parquet(log.path)
    assert log.table().schema.simpleString().count(":") == SCHEMA.count(",") + 1
    left = log.unscored(parts.withColumn("cand_id", c("p_partkey").cast("string")))
    return left.groupBy("p_brand").agg(F.count(F.lit(1)).alias("waiting"))


_BUNDLE_BUCKET = sql_bucket("p_partkey", 100, "hold")
_BUNDLE_SPLIT = sql_bucket("p_partkey", 100, "split0")


@query("train_valid_test_bundle", f"""
WITH p AS (SELECT p_partkey, coalesce({sql_gap('p_size', 'p_partkey')}, 0)::DOUBLE AS x, p_retailprice AS y,
                  {_BUNDLE_BUCKET} < 20 AS is_test, {_BUNDLE_SPLIT} < 25 AS is_valid FROM part),
f AS (SELECT p.*, y - (regr_slope(y, x) OVER () * x + regr_intercept(y, x) OVER ()) AS e FROM p WHERE NOT is_test),
z AS (SELECT f.*, abs((e - avg(e) OVER ()) / stddev_pop(e) OVER ()) > 1.6 AS is_out FROM f),
parts AS (SELECT 'x_train' AS part, p_partkey, x FROM z WHERE NOT is_out AND NOT is_valid
  UNION ALL SELECT 'y_train', p_partkey, y FROM z WHERE NOT is_out AND NOT is_valid
  UNION ALL SELECT 'x_valid', p_partkey, x FROM z WHERE NOT is_out AND is_valid
  UNION ALL SELECT 'y_valid', p_partkey, y FROM z WHERE NOT is_out AND is_valid
  UNION ALL SELECT 'x_test', p_partkey, x FROM p WHERE is_test
  UNION ALL SELECT 'outliers', p_partkey, y FROM z WHERE is_out)
SELECT part, count(*) AS n, sum(p_partkey)::BIGINT AS keys, {rnd('sum(x)', 3)} AS total FROM parts GROUP BY part""")
def _bundle(spark, d):
    parts = table(spark, d, "part").select("p_partkey", gap("p_size", "p_partkey").alias("p_size"), "p_retailprice")
    is_test = key_bucket(F.col("p_partkey"), 100, "hold") < 20
    bundle = train_valid_test_bundle(
        parts.filter(~is_test), parts.filter(is_test).drop("p_retailprice"), "p_partkey", "p_retailprice",
        fill={"p_size": 0}, sigma=1.6,
    )
    value = {"x_train": "p_size", "x_valid": "p_size", "x_test": "p_size", "y_train": "label", "y_valid": "label",
             "outliers": "label"}
    out = None
    for name, column in value.items():
        one = bundle[name].select(F.lit(name).alias("part"), "p_partkey", c(column).cast("double").alias("v"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("keys"), rounded(F.sum("v"), 3).alias("total")
    )


# Projection, filter, patches


@query("select_columns", "SELECT o_totalprice, o_orderkey, o_orderstatus FROM orders")
def _select_columns(spark, d):
    return project.select_columns(table(spark, d, "orders"), ["o_totalprice", "o_orderkey", "o_orderstatus"])


@query("drop_cols", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def _drop_cols(spark, d):
    return project.drop_cols(table(spark, d, "customer"), ["c_mktsegment", "c_name", "no_such_column"])


@query("drop_target", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice AS y FROM orders")
def _drop_target(spark, d):
    rows = project.drop_cols(table(spark, d, "orders"), ["o_orderdate"])
    features, target = project.drop_target(rows, "o_totalprice", "o_orderkey")
    return combine.align_target(features, target.withColumnRenamed("o_totalprice", "y"), "o_orderkey", check=True)


@query("drop_matching", "SELECT o_totalprice, o_orderpriority FROM orders")
def _drop_matching(spark, d):
    return project.drop_matching(table(spark, d, "orders"), ["key$", "date"], ["o_orderstatus"])


@query("select_dtypes", "SELECT c_nationkey, c_acctbal FROM customer")
def _select_dtypes(spark, d):
    return project.select_dtypes(table(spark, d, "customer"), "numeric", exclude=("c_custkey",))


@query("patch_cells", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 20 = 0 THEN 'Y' WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 30 = 0 THEN 0.5 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def _patch_cells(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")

    def patch(where, column, value, seq, shift=0):
        return rows.filter(where).select(
            (key + shift).alias("key"), F.lit(column).alias("column"), F.lit(value).alias("value"), F.lit(seq).alias("seq")
        )

    patches = (
        patch(key % 10 == 0, "o_orderstatus", "X", 1).unionAll(patch(key % 20 == 0, "o_orderstatus", "Y", 2))
        .unionAll(patch(key % 30 == 0, "o_totalprice", "0.5", 3)).unionAll(patch(key % 10 == 0, "o_orderstatus", "Z", 9, 10**12))
    )
    return project.patch_cells(rows, "o_orderkey", patches)


@query("patch_cells_by_list", """
SELECT o_orderkey, CASE o_orderkey WHEN 3 THEN 'B' WHEN 5 THEN 'C' ELSE o_orderpriority END AS o_orderpriority,
       CASE o_orderkey WHEN 3 THEN 1.5 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def _patch_list(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    patches = [(3, "o_orderpriority", "A"), (3, "o_orderpriority", "B"), (5, "o_orderpriority", "C"),
               (3, "o_totalprice", 1.5), (-1, "o_totalprice", 9.0)]
    return project.patch_cells(rows, "o_orderkey", patches)


@query("unmatched_patches", "SELECT 2 * o_orderkey AS key, 'z' AS value FROM orders WHERE 2 * o_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def _unmatched(spark, d):
    rows = table(spark, d, "orders")
    patches = rows.select((F.col("o_orderkey") * 2).alias("key"), F.lit("z").alias("value"))
    return project.unmatched_patches(rows, "o_orderkey", patches)


@query("split_by_origin", "SELECT s_suppkey, s_acctbal, NULL::VARCHAR AS c_mktsegment FROM supplier")
def _split(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_acctbal").alias("s_acctbal"), "c_mktsegment")
    b = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    return project.split_by_origin(combine.concat_tables({"train": a, "test": b}))[1]


@query("null_filter", "SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0 OR c_custkey % 11 = 0")
def _null_filter(spark, d):
    rows = table(spark, d, "customer").withColumn(
        "v", F.when(F.col("c_custkey") % 11 == 0, float("nan")).otherwise(gap("c_acctbal", "c_custkey"))
    )
    return project.null_filter(rows, "v").select("c_custkey")


@query("recast_code", "SELECT c_custkey, c_nationkey::VARCHAR AS c_nationkey FROM customer")
def _recast(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("c_nationkey"))
    return project.recast_code(rows, "c_nationkey")


@query("write_back", f"SELECT o_orderkey, {rnd('sqrt(o_totalprice)')} AS o_totalprice FROM orders")
def _write_back(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return project.write_back(rows, "o_totalprice", rounded(F.sqrt("o_totalprice")))


@query("align_target", """
SELECT o_orderkey, o_orderpriority, sum(l_quantity) AS target FROM orders JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY ALL""")
def _align(spark, d):
    features = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    target = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("target"))
    return combine.align_target(features, target, "o_orderkey")


@query("concat_tables", """
SELECT 'train' AS origin, c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'test', s_suppkey, s_acctbal, NULL FROM supplier""")
def _concat(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key"))
    return combine.concat_tables({"train": a, "test": b})


# Statistics


@query("dtype_groups", """
SELECT 'bigint' AS dtype, 'l_orderkey,l_partkey,l_suppkey' AS names, count(*) AS n FROM lineitem
UNION ALL SELECT 'int', 'l_linenumber', count(*) FROM lineitem
UNION ALL SELECT 'double', 'l_quantity,l_extendedprice,l_discount,l_tax', count(*) FROM lineitem
UNION ALL SELECT 'string', 'l_returnflag,l_linestatus', count(*) FROM lineitem
UNION ALL SELECT 'timestamp_ntz', 'l_shipdate', count(*) FROM lineitem""")
def _dtype_groups(spark, d):
    rows = table(spark, d, "lineitem")
    n = rows.count()
    return profile.dtype_groups(rows).select("dtype", F.concat_ws(",", "columns").alias("names"), F.lit(n).cast("bigint").alias("n"))


@query("row_counts", """
SELECT 'train' AS origin, count(*) AS rows FROM customer UNION ALL SELECT 'test', count(*) FROM supplier""")
def _row_counts(spark, d):
    both = combine.concat_tables({"train": table(spark, d, "customer"), "test": table(spark, d, "supplier")})
    return profile.row_counts(both)


@query("null_profile_by_group", """
SELECT c_mktsegment, count(*) AS missing FROM customer WHERE c_custkey % 7 = 0 GROUP BY 1""")
def _null_by_group(spark, d):
    rows = table(spark, d, "customer").withColumn("c_acctbal", gap("c_acctbal", "c_custkey"))
    return profile.null_profile_by_group(rows, "c_acctbal", "c_mktsegment")


@query("sort_desc", "SELECT user_id, count(*) AS missing FROM events WHERE event_id % 4 = 0 GROUP BY user_id")
def _sort_desc(spark, d):
    rows = table(spark, d, "events").withColumn("value", gap("value", "event_id", 4))
    return profile.null_profile_by_group(rows, "value", "user_id")


@query("null_profile", f"""
SELECT 'o_orderkey' AS "column", count(*) FILTER (o_orderkey IS NULL) AS missing, avg(CASE WHEN o_orderkey IS NULL THEN 1.0::DOUBLE ELSE 0 END) AS share FROM orders
UNION ALL SELECT 'price', count(*) FILTER (o_orderkey % 7 = 0), {rnd("count(*) FILTER (o_orderkey % 7 = 0) / count(*)::DOUBLE", 9)} FROM orders
UNION ALL SELECT 'status', count(*) FILTER (o_orderkey % 5 = 0), {rnd("count(*) FILTER (o_orderkey % 5 = 0) / count(*)::DOUBLE", 9)} FROM orders""")
def _null_profile(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", gap("o_totalprice", "o_orderkey").alias("price"), gap("o_orderstatus", "o_orderkey", 5).alias("status")
    )
    return round_all(profile.null_profile(rows), "share", digits=9)


@query("zero_share", """
SELECT 'l_discount' AS "column", count(*) FILTER (l_discount = 0) AS zeros,
       round(count(*) FILTER (l_discount = 0) / count(*)::DOUBLE, 9) + 0.0 AS share FROM lineitem
UNION ALL SELECT 'l_tax', count(*) FILTER (l_tax = 0), round(count(*) FILTER (l_tax = 0) / count(*)::DOUBLE, 9) + 0.0 FROM lineitem
UNION ALL SELECT 'l_quantity', count(*) FILTER (l_quantity = 0), round(count(*) FILTER (l_quantity = 0) / count(*)::DOUBLE, 9) + 0.0 FROM lineitem""")
def _zero_share(spark, d):
    out = profile.zero_share(table(spark, d, "lineitem"), ["l_discount", "l_tax", "l_quantity"])
    return round_all(out, "share", digits=9)


@query("group_mean", f"SELECT c_mktsegment, {rnd('avg(c_acctbal)')} AS mean FROM customer GROUP BY 1")
def _group_mean(spark, d):
    return round_all(profile.group_mean(table(spark, d, "customer"), "c_mktsegment", "c_acctbal"), "mean")


_PROFILED = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
    "l_linestatus": "string",
}


def _profile_sql(name, kind):
    role = "'numeric'" if kind != "string" else "'category'"
    if name == "l_orderkey":
        return f"""SELECT '{name}' AS "column", '{kind}' AS dtype, count(*) AS rows, 0::BIGINT AS missing,
            count(DISTINCT {name}) AS cardinality, 'key' AS role FROM lineitem"""
    if name == "l_extendedprice":
        role = "'target'"
    return f"""SELECT '{name}', '{kind}', count(*), 0::BIGINT, count(DISTINCT {name}),
        CASE WHEN {role} = 'target' THEN 'target' WHEN count(DISTINCT {name}) <= 1 THEN 'constant'
             WHEN count(DISTINCT {name}) = 2 THEN 'binary'
             WHEN {role} = 'numeric' AND count(DISTINCT {name}) > 20 THEN 'numeric' ELSE 'category' END FROM lineitem"""


@query("column_profile", " UNION ALL ".join(_profile_sql(n, k) for n, k in _PROFILED.items()))
def _column_profile(spark, d):
    return profile.column_profile(table(spark, d, "lineitem"), list(_PROFILED), key="l_orderkey", target="l_extendedprice")


_PEARSON = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice", "l_discount": "l_discount",
            "mixed": "l_quantity * 2000 + l_extendedprice"}


@query("pearson_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({x}, {y})') if a != b else 'max(1.0::DOUBLE)'} AS r FROM lineitem"
    for a, x in _PEARSON.items() for b, y in _PEARSON.items()))
def _pearson(spark, d):
    rows = table(spark, d, "lineitem").select(*[F.expr(e).alias(n) for n, e in _PEARSON.items()], F.lit(2.0).alias("flat"))
    return round_all(profile.pearson_matrix(rows), "r")


@query("target_correlation", " UNION ALL ".join(
    f"""SELECT '{n}' AS "column", {rnd(f'corr({n}, l_extendedprice)')} AS r FROM lineitem"""
    for n in ("l_quantity", "l_discount", "l_tax", "l_partkey")))
def _target_correlation(spark, d):
    rows = table(spark, d, "lineitem").withColumn("flat", F.lit(2.0))
    return round_all(profile.target_correlation(rows, "l_extendedprice", ["l_quantity", "l_discount", "l_tax", "l_partkey", "flat"]), "r")


@query("metric_mean_std", f"""
SELECT event_type AS model, {rnd('avg(value)')} AS mean, {rnd('stddev_pop(value)')} AS std, count(*) AS folds
FROM events GROUP BY 1""")
def _mean_std(spark, d):
    scores = table(spark, d, "events").select(F.col("event_type").alias("model"), F.col("value").alias("score"))
    return round_all(profile.metric_mean_std(scores), "mean", "std")


@query("group_transform", f"""
WITH c AS (SELECT c_custkey, {sql_gap('c_mktsegment', 'c_custkey', 5)} AS segment, c_acctbal FROM customer)
SELECT c_custkey, segment, CASE WHEN segment IS NULL THEN NULL ELSE {rnd('avg(c_acctbal) OVER (PARTITION BY segment)')} END AS mean
FROM c""")
def _group_transform(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", gap("c_mktsegment", "c_custkey", 5).alias("segment"), "c_acctbal")
    out = impute.group_transform(rows, "segment", F.avg("c_acctbal"), "mean")
    return round_all(out, "mean").select("c_custkey", "segment", "mean")


@query("log1p_sq_err", f"""
SELECT event_type, {rnd('avg(CASE WHEN p > -1 THEN power(ln(1 + p) - ln(1 + value), 2) END)')} AS err,
       count(*) FILTER (p <= -1) AS invalid
FROM (SELECT event_type, value, CASE WHEN event_id % 9 = 0 THEN -2.0 WHEN event_id % 9 = 1 THEN -1.0 ELSE value * 1.1 END AS p FROM events)
GROUP BY 1""")
def _log_err(spark, d):
    p = F.when(F.col("event_id") % 9 == 0, -2.0).when(F.col("event_id") % 9 == 1, -1.0).otherwise(F.col("value") * 1.1)
    rows = table(spark, d, "events").withColumn("p", p)
    y, p = F.col("value"), F.col("p")
    return rows.groupBy("event_type").agg(
        rounded(F.avg(log1p_sq_err(y, p))).alias("err"), F.count_if(invalid_pair(y, p)).alias("invalid")
    )


# Missing values


@query("fill_absent_category", f"SELECT c_custkey, coalesce({sql_gap('c_mktsegment', 'c_custkey', 5)}, 'None') AS segment FROM customer")
def _fill_absent(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", gap("c_mktsegment", "c_custkey", 5).alias("segment"))
    return impute.fill_absent_category(rows, ["segment"])


@query("fill_zero", "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 0 ELSE o_totalprice END AS price FROM orders")
def _fill_zero(spark, d):
    price = F.when(F.col("o_orderkey") % 11 == 0, float("nan")).otherwise(gap("o_totalprice", "o_orderkey"))
    return impute.fill_zero(table(spark, d, "orders").select("o_orderkey", price.alias("price")), ["price"])


@query("fill_rules", f"""
SELECT o_orderkey, coalesce({sql_gap('o_totalprice', 'o_orderkey')}, -1) AS price,
       coalesce({sql_gap('o_orderstatus', 'o_orderkey', 5)}, 'None') AS status,
       coalesce({sql_gap('o_custkey', 'o_orderkey', 3)}, 0) AS cust FROM orders""")
def _fill_rules(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", gap("o_totalprice", "o_orderkey").alias("price"), gap("o_orderstatus", "o_orderkey", 5).alias("status"),
        gap("o_custkey", "o_orderkey", 3).alias("cust"),
    )
    return impute.fill_rules(rows, {"price": -1, "status": "None", "cust": 0})


@query("fill_group_mean", f"""
WITH c AS (SELECT c_custkey, {sql_gap('c_mktsegment', 'c_custkey', 5)} AS segment,
                  CASE WHEN c_custkey % 7 = 0 OR c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal END AS balance FROM customer)
SELECT c_custkey, segment,
       round(coalesce(balance, CASE WHEN segment IS NOT NULL THEN avg(balance) OVER (PARTITION BY segment) END), 6) + 0.0 AS balance
FROM c""")
def _fill_group_mean(spark, d):
    balance = F.when((F.col("c_custkey") % 7 == 0) | (F.col("c_mktsegment") == "MACHINERY"), None).otherwise(F.col("c_acctbal"))
    rows = table(spark, d, "customer").select(
        "c_custkey", gap("c_mktsegment", "c_custkey", 5).alias("segment"), balance.alias("balance")
    )
    return round_all(impute.fill_group_mean(rows, "segment", "balance"), "balance")


@query("chained_imputer", f"""
WITH l AS (SELECT l_orderkey, l_quantity, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice END AS price FROM lineitem),
m AS (SELECT regr_slope(price, l_quantity) AS a, regr_intercept(price, l_quantity) AS b FROM l)
SELECT l_orderkey, l_quantity, {rnd('coalesce(price, a * l_quantity + b)', 4)} AS price FROM l, m""")
def _chained(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_quantity", gap("l_extendedprice", "l_orderkey").alias("price"))
    return round_all(impute.chained_imputer(rows, key="l_orderkey", ridge=0.0), "price", digits=4)


@query("chained_imputer_rounds", f"""
WITH l AS (SELECT l_orderkey, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_quantity END AS q,
                  CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_extendedprice + 900 * l_quantity END AS price FROM lineitem),
f0 AS (SELECT l.*, coalesce(q, avg(q) OVER ()) AS q0, coalesce(price, avg(price) OVER ()) AS p0 FROM l),
m1 AS (SELECT regr_slope(q, p0) FILTER (q IS NOT NULL) AS qa, regr_intercept(q, p0) FILTER (q IS NOT NULL) AS qb,
              regr_slope(price, q0) FILTER (price IS NOT NULL) AS pa, regr_intercept(price, q0) FILTER (price IS NOT NULL) AS pb FROM f0),
f1 AS (SELECT f0.*, coalesce(q, qa * p0 + qb) AS q1, coalesce(price, pa * q0 + pb) AS p1 FROM f0, m1),
m2 AS (SELECT regr_slope(q, p1) FILTER (q IS NOT NULL) AS qa, regr_intercept(q, p1) FILTER (q IS NOT NULL) AS qb,
              regr_slope(price, q1) FILTER (price IS NOT NULL) AS pa, regr_intercept(price, q1) FILTER (price IS NOT NULL) AS pb FROM f1)
SELECT l_orderkey, {rnd('coalesce(q, qa * p1 + qb)')} AS q, {rnd('coalesce(price, pa * q1 + pb)', 3)} AS price FROM f1, m2""")
def _chained_rounds(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", gap("l_quantity", "l_orderkey", 5).alias("q"),
        F.when(F.col("l_orderkey") % 7 == 0, None).otherwise(F.col("l_extendedprice") + 900 * F.col("l_quantity")).alias("price"),
    )
    out = impute.chained_imputer(rows, key="l_orderkey", ridge=0.0, rounds=2, tol=0.0)
    return round_all(round_all(out, "q"), "price", digits=3)


# 41 numbers: 35 powers and waves of three columns, and six sums of them with gaps, which a linear
# fit on the others gives back.
_WIDE_OF = ("l_quantity", "l_extendedprice / 1000", "l_discount * 100")
_WIDE_SUMS = {f"s{k}": [(k + 1.0, f"x{k}"), (2.0, f"x{5 * k + 3}"), (-1.0, f"x{3 * k + 11}")] for k in range(6)}


def _wide_columns(wave="sin"):
    for k in range(35):
        yield f"x{k}", f"{wave}({_WIDE_OF[k % 3]} * {0.1 + 0.07 * k:.2f} + {k}) * {1 + k % 4}"


def _wide_sum(terms):
    return " + ".join(f"({w!r} * {x})" for w, x in terms)


@query("chained_imputer_wide", f"""
WITH w AS (SELECT l_orderkey, {", ".join(f"{e} AS {n}" for n, e in _wide_columns())} FROM lineitem)
SELECT l_orderkey, {", ".join(f"{rnd(_wide_sum(t), 3)} AS {n}" for n, t in _WIDE_SUMS.items())} FROM w""")
def _chained_wide(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", *[F.expr(e).alias(n) for n, e in _wide_columns()])
    gapped = rows.select("*", *[
        F.when(F.col("l_orderkey") % (5 + k) == 0, None).otherwise(F.expr(_wide_sum(t)).cast("double")).alias(n)
        for k, (n, t) in enumerate(_WIDE_SUMS.items())
    ])
    columns = [n for n in gapped.columns if n != "l_orderkey"]
    out = impute.chained_imputer(gapped, columns, ridge=0.0, rounds=3)
    return round_all(out.select("l_orderkey", *_WIDE_SUMS), *_WIDE_SUMS, digits=3)


@query("mean_imputer", f"""
WITH o AS (SELECT o_orderkey, {sql_gap('o_totalprice', 'o_orderkey')} AS price FROM orders)
SELECT o_orderkey, {rnd('coalesce(price, avg(price) OVER ())')} AS price FROM o""")
def _mean_imputer(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", gap("o_totalprice", "o_orderkey").alias("price"))
    return round_all(impute.mean_imputer(["price"]).fit(rows).transform(rows), "price")


@query("median_imputer", f"""
WITH l AS (SELECT l_orderkey, {sql_gap('l_extendedprice', 'l_orderkey')} AS price, {sql_gap('l_quantity', 'l_orderkey', 3)} AS q FROM lineitem),
m AS (SELECT quantile_cont(price, 0.5) AS mp, quantile_cont(q, 0.5) AS mq FROM l)
SELECT l_orderkey, {rnd('coalesce(price, mp)')} AS price, {rnd('coalesce(q, mq)')} AS q FROM l, m""")
def _median_imputer(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", gap("l_extendedprice", "l_orderkey").alias("price"), gap("l_quantity", "l_orderkey", 3).alias("q")
    )
    return round_all(impute.ColumnFill(["price", "q"], "median").fit(rows).transform(rows), "price", "q")


@query("mode_imputer", f"""
WITH p AS (SELECT p_partkey, {sql_gap('p_size', 'p_partkey', 4)}::DOUBLE AS size FROM part),
m AS (SELECT size AS s FROM p WHERE size IS NOT NULL GROUP BY size ORDER BY count(*) DESC, size LIMIT 1)
SELECT p_partkey, coalesce(size, s) AS size FROM p, m""")
def _mode_imputer(spark, d):
    rows = table(spark, d, "part").select("p_partkey", gap("p_size", "p_partkey", 4).cast("double").alias("size"))
    return impute.ColumnFill(["size"], "mode").fit(rows).transform(rows)


# Encoding

_LEVELS = {"2_HIGH": "2-HIGH", "3_MEDIUM": "3-MEDIUM", "4_NOT_SPECIFIED": "4-NOT SPECIFIED", "5_LOW": "5-LOW"}


@query("dummies_drop_first", f"""
WITH o AS (SELECT o_orderkey, o_totalprice, {sql_gap('o_orderpriority', 'o_orderkey', 5)} AS pr, o_orderstatus AS st FROM orders)
SELECT o_orderkey, o_totalprice, {', '.join(f"CASE WHEN pr = '{v}' THEN 1 ELSE 0 END AS pr_{n}" for n, v in _LEVELS.items())},
       CASE WHEN st = 'O' THEN 1 ELSE 0 END AS st_O, CASE WHEN st = 'P' THEN 1 ELSE 0 END AS st_P FROM o""")
def _dummies(spark, d):
    rows = table(spark, d, "orders").select(
        gap("o_orderpriority", "o_orderkey", 5).alias("pr"), "o_orderkey", F.col("o_orderstatus").alias("st"), "o_totalprice"
    )
    return encode.dummies_drop_first(rows, safe=True)


@query("dummies_aligned", f"""
SELECT o_orderkey, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END AS pr_3_MEDIUM,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 1 ELSE 0 END AS pr_4_NOT_SPECIFIED,
       CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS pr_5_LOW
FROM orders WHERE {sql_bucket('o_orderkey', 100, 'split0')} < 25""")
def _dummies_aligned(spark, d):
    from lathework.operators.resample import train_valid_split

    rows = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("pr"))
    train, test = train_valid_split(rows, "o_orderkey")
    # The training side lacks one level: it is unseen in the test side, and the next one is dropped.
    return encode.dummies_aligned(train.filter("pr <> '1-URGENT'"), test, safe=True)[1]


_FEW = "CASE WHEN o_orderkey % 20 = 0 THEN 'a' WHEN o_orderkey % 20 = 1 THEN 'b' WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END"


@query("sparse_dummies", """
WITH l AS (SELECT p_partkey, unnest(['p_name', 'p_brand', 'p_type']) AS col, unnest([p_name, p_brand, p_type]) AS level FROM part),
v AS (SELECT col, level, row_number() OVER (ORDER BY col, encode(level)) - 1 AS place FROM (SELECT DISTINCT col, level FROM l WHERE level IS NOT NULL))
SELECT p_partkey, string_agg(place::VARCHAR, ',' ORDER BY place) AS places FROM l JOIN v USING (col, level) GROUP BY p_partkey""")
def _sparse_dummies(spark, d):
    rows = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    places = encode.level_places(rows, ["p_name", "p_brand", "p_type"])
    out = encode.sparse_dummies(rows, "p_partkey", places)
    return out.select("p_partkey", F.array_join(F.transform("indices", lambda x: x.cast("string")), ",").alias("places"))


@query("onehot_min_fraction", f"""
WITH o AS (SELECT o_orderkey, o_totalprice, {_FEW} AS few FROM orders)
SELECT o_orderkey, o_totalprice, CASE WHEN few = 'even' THEN 1 ELSE 0 END AS few_even, CASE WHEN few = 'odd' THEN 1 ELSE 0 END AS few_odd,
       CASE WHEN few IN ('a', 'b') THEN 1 ELSE 0 END AS few_other FROM o""")
def _onehot(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.expr(_FEW).alias("few"))
    return encode.PooledOneHot(0.1, 10).fit(rows).transform(rows)


@query("assemble", """
SELECT o_orderkey, o_totalprice AS a, CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0 END AS b, o_custkey::DOUBLE AS c FROM orders""")
def _assemble(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("1stFlrSF"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("HouseStyle_1.5Unf"),
        F.col("o_custkey").alias("RoofMatl_Tar&Grv"),
    )
    x = vector_to_array("features")
    return encode.assemble(rows, keep=["o_orderkey"]).select("o_orderkey", x[0].alias("a"), x[1].alias("b"), x[2].alias("c"))


# Screening


@query("drop_mostly_zero", "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 20 = 0 THEN 1 ELSE 0 END AS at_cut FROM orders")
def _drop_mostly_zero(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 50 == 0, 1).otherwise(0).alias("above_cut"),
        F.when(F.col("o_orderkey") % 20 == 0, 1).otherwise(0).alias("at_cut"),
    )
    return screen.drop_mostly_zero(rows, cut=0.95)[0]


_NZV = {"status": "o_orderstatus", "rare": "CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END", "flat": "2.0",
        "price": "o_totalprice", "skewed": "CASE WHEN o_orderkey % 9 = 0 THEN 'x' ELSE 'y' END",
        "gaps": "CASE WHEN o_orderkey % 50 = 0 THEN 'x' WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'y' END"}


@query("near_zero_variance", " UNION ALL ".join(f"""
SELECT * FROM (WITH f AS (SELECT {e} AS v, count(*) AS n FROM orders GROUP BY 1),
t AS (SELECT max(n) FILTER (r = 1) AS a, max(n) FILTER (r = 2) AS b FROM (SELECT n, row_number() OVER (ORDER BY n DESC) AS r FROM f WHERE v IS NOT NULL)),
s AS (SELECT sum(n)::DOUBLE AS n, count(v) AS u FROM f)
SELECT '{k}' AS "column", {rnd('coalesce(a / b::DOUBLE, 0)')} AS freq_ratio, {rnd('u * 100.0::DOUBLE / n')} AS percent_unique,
       u <= 1 AS zero_var, (u <= 1 OR (coalesce(a / b::DOUBLE, 0) > 85.0::DOUBLE / 15 AND u * 100.0 / n <= 10)) AS nzv FROM t, s)"""
    for k, e in _NZV.items()))
def _nzv(spark, d):
    rows = table(spark, d, "orders").select(*[F.expr(e).alias(k) for k, e in _NZV.items()])
    return round_all(screen.near_zero_variance(rows), "freq_ratio", "percent_unique")


_MI_EDGES = {"l_quantity": [10, 20, 30, 40], "l_discount": [0.025, 0.055], "mixed": [30000, 60000, 100000]}
_MI_EXPR = {"l_quantity": "l_quantity", "l_discount": "l_discount", "mixed": "l_extendedprice + 500 * l_quantity",
            "l_returnflag": "l_returnflag"}
_MI_LABEL = [20000, 50000, 80000]


def _bins(expr, edges):
    return "(" + " + ".join(f"CASE WHEN {expr} >= {e} THEN 1 ELSE 0 END" for e in edges) + ")::VARCHAR"


def _mi_sql(name, expr):
    x = _bins(expr, _MI_EDGES[name]) if name in _MI_EDGES else expr
    return f"""SELECT * FROM (WITH b AS (SELECT {x} AS x, {_bins('l_extendedprice', _MI_LABEL)} AS y FROM lineitem),
j AS (SELECT x, y, count(*)::DOUBLE AS n FROM b GROUP BY ALL),
k AS (SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY x) AS nx, sum(n) OVER (PARTITION BY y) AS ny FROM j)
SELECT '{name}' AS "column", {rnd('sum(n / t * ln(n * t / (nx * ny)))', 9)} AS mi FROM k)"""


@query("mutual_information", " UNION ALL ".join(_mi_sql(n, e) for n, e in _MI_EXPR.items()))
def _mi(spark, d):
    rows = table(spark, d, "lineitem").withColumn("mixed", F.expr(_MI_EXPR["mixed"]))
    return round_all(
        screen.mutual_information(rows, "l_extendedprice", _MI_EDGES, _MI_LABEL, ["l_returnflag"]), "mi", digits=9
    )


@query("select_by_list", "SELECT p_retailprice, p_size FROM part")
def _select_by_list(spark, d):
    return screen.select_by_list(table(spark, d, "part"), ["p_retailprice", "p_size"])


@query("correlated_pairs", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({x}, {y})')} AS r FROM lineitem) WHERE abs(r) > 0.3"
    for a, x in _PEARSON.items() for b, y in _PEARSON.items() if a < b))
def _pairs(spark, d):
    rows = table(spark, d, "lineitem").select(*[F.expr(e).alias(n) for n, e in _PEARSON.items()])
    return round_all(screen.correlated_pairs(rows, 0.3), "r")


@query("outlier_rows", f"""
WITH f AS (SELECT event_id, value - (regr_slope(value, user_id) OVER () * user_id + regr_intercept(value, user_id) OVER ()) AS e FROM events),
z AS (SELECT event_id, (e - avg(e) OVER ()) / stddev_pop(e) OVER () AS z FROM f)
SELECT event_id, {rnd('z')} AS z FROM z WHERE abs(z) > 2""")
def _outliers(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", F.col("value").alias("label"))
    data = encode.assemble(rows, ["user_id"], keep=["event_id", "label"])
    scored = LinearBaseline().fit(data).transform(data)
    found = screen.outlier_rows(scored, F.col("label") - F.col("prediction"), 2.0)
    return found.select("event_id", rounded(F.col("z")).alias("z"))


@query("remove_outliers", f"""
WITH z AS (SELECT event_id, value, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS z FROM events)
SELECT event_id, value FROM z WHERE abs(z) <= 2""")
def _remove_outliers(spark, d):
    rows = table(spark, d, "events").select("event_id", "value")
    return screen.remove_outliers(rows, F.col("value"), 2.0)
