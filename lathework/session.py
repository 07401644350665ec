"""Session defaults and the shared folder used for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a session needs on any cluster; sizes stay with the cluster's own configuration.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app="lathework", master=None, **conf) -> SparkSession:
    """Session with the package defaults; ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    spark = builder.getOrCreate()
    ship(spark)
    return spark


_shipped: set = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once for each Spark application.

    Arrow functions name the package's modules, and a worker may start in any folder.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="lathework-zip-")
    atexit.register(shutil.rmtree, folder, True)
    path = os.path.join(folder, "lathework.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for top, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(top, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the root in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary root of its own, which goes with the process.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="lathework-")
        atexit.register(shutil.rmtree, root, True)
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/lathework-{uuid.uuid4().hex}/{label}"


_recorders: list[list[str]] = []


@contextmanager
def recorded():
    """The folders that :func:`settle` writes inside, as a list that grows."""
    folders: list[str] = []
    _recorders.append(folders)
    try:
        yield folders
    finally:
        _recorders[:] = [x for x in _recorders if x is not folders]  # lists that are equal are not the same


def drop_tables(spark: SparkSession, folders) -> None:
    """Remove written helper tables that nothing reads any more."""
    for folder in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.dirname(folder))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label="settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the optimizer the true size
    of the result, so that it picks the join strategy from a measured number.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    for folders in _recorders:
        folders.append(path)
    return spark.read.schema(df.schema).parquet(path)
