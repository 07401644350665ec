"""Every registered query against its SQL on the smallest tables."""

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import compare, connect
from lathework.plans.registry import QUERIES, SQL


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, con, name):
    status, rows, note = compare(con, QUERIES[name](spark, data), SQL.get(name))
    spark.catalog.clearCache()
    assert status in ("ok", "rows only"), note
    assert rows > 0


def test_sql_belongs_to_queries():
    assert set(oracle_sql()) <= set(queries())


def test_classic_queries_are_among_all():
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_workers_find_the_package_from_any_folder(data, tmp_path):
    """A session that the package did not make, in a process that starts elsewhere."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r}); import __spark_entry__ as e; from pyspark.sql import SparkSession as S; "
        "s = S.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', 2).getOrCreate(); "
        f"print('rows', e.queries()['ridge_cv'](s, {data!r}).count())"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]


def test_entry(spark):
    assert entry(spark).columns == ["fold", "rows", "rmsle", "r2"]
