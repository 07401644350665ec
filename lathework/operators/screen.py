"""Feature screening and outlier rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lathework.functions.columns import c
from lathework.operators.profile import pearson_matrix, value_counts, zero_share
from lathework.operators.project import drop_cols, select_columns
from lathework.operators.quantiles import exact_quantiles


def mostly_zero(df: DataFrame, cut=0.95, columns=None) -> tuple[DataFrame, list[str]]:
    """Zero shares, and the columns strictly above the cut."""
    profile = zero_share(df, columns)
    return profile, sorted(r["column"] for r in profile.filter(F.col("share") > cut).collect())


def drop_mostly_zero(train: DataFrame, others=(), cut=0.95, columns=None) -> list[DataFrame]:
    """Judge the columns on the training rows, drop them everywhere."""
    _, gone = mostly_zero(train, cut, columns)
    return [drop_cols(df, gone) for df in (train, *others)]


def near_zero_variance(df: DataFrame, columns=None, freq_cut=85 / 15, unique_cut=10.0) -> DataFrame:
    """Frequency ratio of the two most common values, percent of distinct values, and flags.

    A column is flagged when the ratio is above ``freq_cut`` and the percentage at most
    ``unique_cut``, or when it has one value. All columns share one shuffle of pre-counted
    values; the top two per column are cut in every task before they meet.
    """
    names = list(columns or df.columns)
    counts = value_counts(df, names)
    by_size = W.partitionBy("column").orderBy(F.desc("count"), "value")
    top = (
        counts.filter(F.col("value").isNotNull())
        .withColumn("place", F.row_number().over(by_size)).filter(F.col("place") <= 2)
        .groupBy("column").agg(
            F.max(F.when(F.col("place") == 1, F.col("count"))).alias("first"),
            F.max(F.when(F.col("place") == 2, F.col("count"))).alias("second"),
        )
    )
    sizes = counts.groupBy("column").agg(F.sum("count").alias("rows"), F.count("value").alias("distinct"))
    ratio = F.coalesce(F.col("first") / F.col("second"), F.lit(0.0))
    percent = F.col("distinct") * 100.0 / F.col("rows")
    zero = F.col("distinct") <= 1
    # One row per column on either side.
    return sizes.join(F.broadcast(top), "column", "left").select(
        "column", ratio.alias("freq_ratio"), percent.alias("percent_unique"), zero.alias("zero_var"),
        (zero | ((ratio > freq_cut) & (percent <= unique_cut))).alias("nzv"),
    )


def near_zero_columns(df: DataFrame, columns=None, freq_cut=85 / 15, unique_cut=10.0) -> list[str]:
    """Names of the flagged columns; every value of every column is counted exactly."""
    names = list(columns or df.columns)
    if not names:
        return []
    flagged = near_zero_variance(df, names, freq_cut, unique_cut).filter("nzv").select("column").collect()
    return sorted(r["column"] for r in flagged)


def binned(col: Column, edges) -> Column:
    """Bin number from sorted inner edges: how many of them are at or below the value.

    Missing values form a bin of their own.
    """
    out = F.lit(0)
    for e in edges:
        out = out + F.when(col >= F.lit(float(e)), 1).otherwise(0)
    return F.when(col.isNull() | F.isnan(col), -1).otherwise(out)


def quantile_edges(df: DataFrame, columns, bins=10) -> dict[str, list[float]]:
    found = exact_quantiles(df, columns, [k / bins for k in range(1, bins)])
    return {n: sorted(set(v)) for (_, n), v in found.items()}


def mutual_information(df: DataFrame, label: str, edges: dict, label_edges, categories=()) -> DataFrame:
    """Plug-in mutual information (nats) of each binned feature with the binned label.

    One scan counts (feature, bin, label bin); everything after that is as large as the bins.
    """
    y = binned(c(label).cast("double"), label_edges).cast("string")
    features = [(n, binned(c(n).cast("double"), e).cast("string")) for n, e in edges.items()]
    features += [(n, F.coalesce(c(n).cast("string"), F.lit("<missing>"))) for n in categories]
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), b.alias("x")) for n, b in features]))
    joint = (
        df.select(y.alias("y"), cells.alias("p")).groupBy("p.column", "p.x", "y")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )

    def n_log_n(*by):
        sizes = joint.groupBy("column", *by).agg(F.sum("n").alias("n"))
        return sizes.groupBy("column").agg(F.sum("n").alias("rows"), F.sum(F.col("n") * F.log("n")).alias("s"))

    # I = (sum n ln n - sum nx ln nx - sum ny ln ny) / N + ln N: three aggregates of the cells.
    parts = [
        n_log_n(*by).select("column", "rows", (F.col("s") * sign).alias("s"))
        for by, sign in ((("x", "y"), 1), (("x",), -1), (("y",), -1))
    ]
    together = parts[0].unionAll(parts[1]).unionAll(parts[2])
    return together.groupBy("column").agg(
        (F.sum("s") / F.first("rows") + F.log(F.first("rows"))).alias("mi")
    )


def informative_columns(mi: DataFrame, min_mi=0.0) -> list[str]:
    """Columns above the cut, most informative first."""
    kept = mi.filter(F.col("mi") > min_mi).orderBy(F.desc("mi"), "column")
    return [r["column"] for r in kept.collect()]


def select_by_list(df: DataFrame, names) -> DataFrame:
    return select_columns(df, names)


def correlated_pairs(df: DataFrame, cut: float, columns=None) -> DataFrame:
    """Pairs ``a < b`` whose correlation is beyond the cut either way."""
    pairs = pearson_matrix(df, columns).filter((F.col("a") < F.col("b")) & (F.abs("r") > cut))
    return pairs.orderBy(F.desc(F.abs("r")), "a", "b")


def outlier_rows(df: DataFrame, residual: Column, sigma=3.0) -> DataFrame:
    """Rows whose residual is more than ``sigma`` deviations from its mean, with ``z``."""
    return _with_z(df, residual).filter(F.abs("z") > sigma)


def remove_outliers(df: DataFrame, residual: Column, sigma=3.0) -> DataFrame:
    """The other rows; rows without a residual stay."""
    kept = _with_z(df, residual).filter(F.col("z").isNull() | (F.abs("z") <= sigma))
    return kept.select(*[c(n) for n in df.columns])


def _with_z(df: DataFrame, residual: Column) -> DataFrame:
    row = df.agg(F.avg(residual).alias("m"), F.stddev_pop(residual).alias("s")).first()
    if not row["s"]:
        return df.withColumn("z", F.lit(None).cast("double"))
    return df.withColumn("z", (residual - F.lit(row["m"])) / F.lit(row["s"]))
