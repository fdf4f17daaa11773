"""Tables that a job writes once and reads several times, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode, where it is unset, a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(made)
    return f"file://{made}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet and read again: what follows scans the result, however often, instead of its plan."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    until_exit(df.sparkSession, path)
    return _opened(df.sparkSession, df.schema, path)


def large(df: DataFrame) -> DataFrame:
    """df as a side of a join whose sides both grow with the data: they are shuffled, also where Spark, going by the size of
    compressed files and shuffled bytes, would gather one in the driver and broadcast it."""
    return df.hint("merge")


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Jobs inside leave no shuffle files: each query's go with its end, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def until_exit(spark: SparkSession, path: str) -> None:
    """Have the driver remove a folder, which must exist, when it ends: scratch tables don't outlive their application."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(at)


def _opened(spark: SparkSession, schema, path: str) -> DataFrame:
    out = spark.read.schema(schema).parquet(path)
    out.stored_in = path
    return out


def again(df: DataFrame) -> DataFrame:
    """A stored table with columns of its own, to be joined with itself."""
    return _opened(df.sparkSession, df.schema, df.stored_in)


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that no later job reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_in)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
