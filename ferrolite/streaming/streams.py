"""Streams over files: read, keep in memory by name, score. Every run ends by itself (availableNow)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None, pattern: str | None = None) -> DataFrame:
    """New files become micro-batches; without a limit the existing files go into the first one."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def stream_to_memory(df: DataFrame, name: str, mode: str = "append", timeout: int = 600) -> DataFrame:
    """Run the stream into a named in-memory table, stop it, return the table. Meant for small (aggregated) results."""
    q: StreamingQuery = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    _finish(q, timeout)
    return df.sparkSession.table(name)


def stream_score(requests: DataFrame, body: str, schema: str, model: PipelineModel, sink: str, checkpoint: str, keep=(), timeout: int = 3600) -> None:
    """Parse JSON requests, score them, append the replies to a Parquet sink. The checkpoint makes a restart exact."""
    parsed = requests.withColumn("__r", F.from_json(body, schema)).select(*keep, "__r.*")
    reply = model.transform(parsed).select(*keep, "prediction")
    q = (reply.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    _finish(q, timeout)


def _finish(q: StreamingQuery, timeout: int) -> None:
    try:
        if not q.awaitTermination(timeout):
            raise TimeoutError(f"stream still running after {timeout} s")
    finally:
        q.stop()
    if q.exception():
        raise q.exception()
