"""Learning curves and cross-validation of linear models from summed products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lathework.operators.resample import fold_column, linear_curves, share_of


@pytest.fixture(scope="module")
def rows(spark):
    out = spark.range(4000, numPartitions=8)
    for i, name in enumerate("abc"):
        out = out.withColumn(name, F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / 10.0)
    noise = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(500)) / 10.0
    return out.withColumn("y", 1e5 + 2 * F.col("a") - F.col("b") + noise)


def test_every_share_and_fold_equals_a_fit_of_its_own(spark, rows):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    got = linear_curves(rows.mapInArrow(counted, rows.schema), ["a", "b", "c"], "y", "id", (0.3, 1.0), 4).toPandas()
    assert 4000 <= seen.value < 8000  # one scan, and a few first rows
    frame = rows.select("*", fold_column(F.col("id"), 4).alias("f"), share_of(F.col("id")).alias("h")).toPandas()
    assert len(got) == 8
    for r in got.itertuples():
        inside = ((frame.f != r.fold) & (frame.h < r.share * 10_000)).to_numpy()
        held = (frame.f == r.fold).to_numpy()
        x = np.column_stack([np.ones(len(frame)), frame[["a", "b", "c"]]])
        y = frame.y.to_numpy()
        fit = np.linalg.lstsq(x[inside], y[inside], rcond=None)[0]
        assert (r.train_rows, r.valid_rows) == (inside.sum(), held.sum())
        for mask, r2, rmse in ((inside, r.train_r2, r.train_rmse), (held, r.valid_r2, r.valid_rmse)):
            gap = y[mask] - x[mask] @ fit
            assert rmse == pytest.approx(np.sqrt((gap ** 2).mean()), rel=1e-7)
            assert r2 == pytest.approx(1 - (gap ** 2).sum() / ((y[mask] - y[mask].mean()) ** 2).sum(), abs=1e-8)


def test_sides_without_rows_and_missing_values(spark, rows):
    one = linear_curves(rows.filter("id = 5"), ["a"], "y", "id", (1.0,), 2).toPandas().set_index("fold")
    assert sorted(one.train_rows) == [0, 1] and one.valid_r2.isna().all()
    with pytest.raises(Exception):
        linear_curves(rows.withColumn("a", F.when(F.col("id") != 9, F.col("a"))), ["a"], "y", "id", (1.0,), 2)
