"""Correlations in tiles of columns against numpy."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lathework.operators.profile import pearson_matrix
from lathework.operators.tiles import correlation_tiles, tile_scans


def test_tiles_equal_one_matrix(spark):
    rng = np.random.default_rng(4)
    frame = pd.DataFrame(rng.normal(size=(200, 11)), columns=[f"c {i}.x" for i in range(11)])
    frame.iloc[:, 3] = frame.iloc[:, 2] * 2 + 1e9
    frame.iloc[:, 5] = 7.1
    frame.iloc[::3, 8] = np.nan
    frame.iloc[1::4, 1] = np.nan
    rows = spark.createDataFrame(frame)
    want = frame.corr().drop(columns="c 5.x", index="c 5.x")
    for side, cells in ((3, 1), (4, 400), (512, 1 << 23)):
        got = correlation_tiles(rows, frame.columns, side, cells).toPandas()
        assert not got.duplicated(["a", "b"]).any() and len(got) == 100
        wide = got.pivot(index="a", columns="b", values="r").loc[want.index, want.columns]
        np.testing.assert_allclose(wide, want, atol=1e-6)


def test_scans_cover_every_pair_once():
    scans = tile_scans(3000)
    pairs = [pair for scan in scans for pair in scan]
    assert sorted(pairs) == [(i, j) for i in range(6) for j in range(i, 6)]
    assert max(len(scan) for scan in scans) * 6 * 512 * 512 <= 1 << 23


def test_three_thousand_columns(spark):
    """Every column is one of three signals, so each pair's correlation is known."""
    x = F.col("id") % 97
    signals = [x, F.pmod(F.xxhash64("id"), F.lit(1000)), x * -1]
    rows = spark.range(300, numPartitions=2).select(
        *[(signals[i % 3] * F.lit(1.0 + i)).cast("double").alias(f"v{i}") for i in range(3000)]
    )
    r = pearson_matrix(rows)
    kind = [F.regexp_extract(n, r"\d+", 0).cast("int") % 3 for n in ("a", "b")]
    found = r.groupBy(kind[0].alias("i"), kind[1].alias("j")).agg(
        F.count(F.lit(1)).alias("n"), F.min("r").alias("low"), F.max("r").alias("high")
    ).collect()
    assert len(found) == 9 and all(f["n"] == 1_000_000 for f in found)
    at = {(f["i"], f["j"]): f for f in found}
    for f in found:
        assert f["high"] - f["low"] < 1e-9 and abs(f["low"] - at[(f["j"], f["i"])]["low"]) < 1e-9
    assert abs(at[(0, 0)]["low"] - 1) < 1e-9 and abs(at[(0, 2)]["low"] + 1) < 1e-9 and abs(at[(0, 1)]["low"]) < 0.2


def test_empty_table(spark):
    rows = spark.createDataFrame([], "a double, b double")
    assert pearson_matrix(rows).count() == 0
