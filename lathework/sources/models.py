"""Saving fitted pipelines by name, with a manifest table."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "name string, path string, stages int, score double, saved_at timestamp"


def save_model(spark: SparkSession, model: PipelineModel, folder: str, name: str, score=None):
    """Write a fitted pipeline below ``folder`` and add it to the manifest."""
    path = f"{folder.rstrip('/')}/models/{name}"
    if not isinstance(model, PipelineModel):
        model = PipelineModel([model])
    model.write().overwrite().save(path)
    row = [(name, path, len(model.stages), None if score is None else float(score), None)]
    entry = spark.createDataFrame(row, MANIFEST).withColumn("saved_at", F.current_timestamp())
    entry.write.mode("append").parquet(f"{folder.rstrip('/')}/manifest")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The latest entry of every saved model."""
    rows = spark.read.schema(MANIFEST).parquet(f"{folder.rstrip('/')}/manifest")
    return rows.groupBy("name").agg(
        *[F.max_by(n, "saved_at").alias(n) for n in ("path", "stages", "score")], F.max("saved_at").alias("saved_at")
    )


def load_models(spark: SparkSession, folder: str) -> dict[str, PipelineModel]:
    return {r["name"]: PipelineModel.load(r["path"]) for r in manifest(spark, folder).collect()}
