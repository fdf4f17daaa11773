"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space is the six ASCII characters; all else belongs to words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Settings of jobs that write: shuffle files go with the job, and Python workers get batches of this many bytes.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
#: Most rows of a table that joins may broadcast; a larger one is shuffled.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(text: Column) -> Column:
    """Null texts count as empty."""
    return F.coalesce(text, F.lit(""))


def count_words(text: Column) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def words_of(text: Column) -> Column:
    """The words in order; an empty array where there are none."""
    return F.filter(F.split(text_of(text), SPACE), lambda w: w != "")


def let(value: Column, use) -> Column:
    """use(value) with value computed once."""
    return F.get(F.transform(F.array(value), lambda x: use(x)), F.lit(0))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir")
    made = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(made)
    return f"file://{made}"


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder (a folder for each value of by) and read it again."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = {k: spark.conf.get(k, None) for k in WRITING}
    for k, v in WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove written tables that no later job reads."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        path = jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(conf).delete(path, True)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table, marked for broadcast only where its counted rows stay within most; else joins shuffle it."""
    kept = written(df, "small")
    return F.broadcast(kept) if kept.count() <= most else kept


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of df has (columns compare without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def most_counted(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows with the largest counts, at most `most` of them: all above a bound that a small histogram gives.

    counts is read twice, so it should be written before.
    """
    step = F.floor(F.log2(F.col(column).cast("double")) * 16)
    cells = counts.where(F.col(column) > 0).groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    bound, left = float("inf"), most
    for r in sorted(cells, key=lambda r: -r.step):
        left -= r.n
        if left < 0:
            break
        bound = r.step
    return counts.where(step >= F.lit(bound))
