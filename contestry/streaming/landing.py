"""Incremental landing: payload files as a stream, each micro-batch added once, the newest row of a key in force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from contestry.operators.tables import latest_per_key

KEYS = ["source_file", "row_number"]


def land_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write what has arrived under path, a folder a micro-batch; a repeated batch replaces its own folder.

    Nothing that landed before is read or written again.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landed(spark: SparkSession, path: str, keys: list[str] = KEYS) -> DataFrame:
    """Of each key the row of the newest micro-batch, with the batch; copies inside a batch are one row."""
    rows = spark.read.option("basePath", path).parquet(path)
    return latest_per_key(rows.withColumn("key_", F.struct(*keys)), "key_", "batch").drop("key_")
