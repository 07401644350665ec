"""Search results as an appended Parquet table, from which a search resumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "run string, generation int, cand_id string, spec string, complexity int, score double, std double, status string"
)


class SearchLog:
    def __init__(self, spark: SparkSession, folder: str, run: str):
        self.spark, self.run = spark, run
        self.path = f"{folder.rstrip('/')}/search"

    def append(self, rows) -> None:
        """Rows ``(generation, cand_id, spec, complexity, score, std, status)`` of one batch."""
        if rows:
            table = self.spark.createDataFrame([(self.run, *r) for r in rows], SCHEMA)
            table.coalesce(1).write.mode("append").parquet(self.path)

    def exists(self) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def table(self) -> DataFrame:
        """Results of this run, one row per candidate: the first time it was scored."""
        if not self.exists():
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(self.path).filter(F.col("run") == self.run)
        first = F.struct("generation", "spec", "complexity", "score", "std", "status")
        return rows.groupBy("run", "cand_id").agg(F.min_by(first, "generation").alias("r")).select(
            "run", "r.generation", "cand_id", "r.spec", "r.complexity", "r.score", "r.std", "r.status"
        )

    def unscored(self, candidates: DataFrame) -> DataFrame:
        """Candidates that have no row yet."""
        return candidates.join(self.table().select("cand_id"), "cand_id", "left_anti")
