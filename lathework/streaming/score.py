"""Fitted stages on file streams: every transform is a row expression over learned numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_stream(spark: SparkSession, path: str, schema, files_per_batch=100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def score_stream(model, stream: DataFrame, path: str, checkpoint: str, keep=None, prediction="prediction") -> StreamingQuery:
    """Score new files as they come; exactly once by the checkpoint of the file sink."""
    scored = model.transform(stream)
    if keep:
        scored = scored.select(*keep, prediction)
    return (
        scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
