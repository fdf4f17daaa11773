"""Sharding by a two-pass external shuffle.

Pass one counts rows and bytes and scatters the records by a seeded hash into buckets; a task takes
neighbouring buckets of some 64 MB. Pass two shuffles each bucket and writes it: the whole order is cut
into shards of equal counts (law "rows"), so that a bucket goes to one shard or two, and a task writes few files.
Whole records are moved once.

A bucket is shuffled in two steps by its task, which sorts and numbers records and never holds a bucket:
records are put in an order of their content, and their numbers in that order are then permuted by seeded
draws, one a number. That gives the uniform permutations of a Fisher-Yates pass, but the same one in every
rerun, over any partitions and after a lost executor; Spark's shuffle(), a Fisher-Yates pass over an array,
draws by partition number and arrival and can't repeat itself. Rows alike in every column are interchangeable
and get places of their own.

Where there are more than COPIES of a row, each copy is scattered by its number too, so that a row that is
repeated without end fills no bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import BROADCAST_ROWS, small, text_of, unused, written

SHARDS = 40
SEED = 20_240_601
#: Text bytes of a bucket, and of a task's buckets together.
BUCKET_BYTES, TASK_BYTES = 8 << 20, 64 << 20
#: Least buckets, so that small inputs still use every core; most, so that a row for each may be broadcast.
LEAST_BUCKETS, MOST_BUCKETS = 256, BROADCAST_ROWS
#: Copies of a row (alike in every column) that may share a bucket.
COPIES = 64


def plain_columns(df: DataFrame) -> list[str]:
    """Columns that can be hashed and compared."""
    return [c for c, kind in df.dtypes if "map" not in kind and "variant" not in kind]


def record_hash(df: DataFrame, *seed) -> F.Column:
    """Seeded over all columns that can be hashed: rows of one key or one text still scatter."""
    return F.xxhash64(*[F.lit(x) if isinstance(x, int) else F.col(x) for x in seed], *[F.col(f"`{c}`") for c in plain_columns(df)])


def numbered_copies(df: DataFrame, copy: str) -> DataFrame:
    """df with a column copy: from 0 for the rows that more than COPIES are like in every column, 0 for others.

    Only such rows are aggregated; where columns can't be compared all rows have 0.
    """
    if len(plain_columns(df)) < len(df.columns):
        return df.withColumn(copy, F.lit(0))
    h, g, n = unused(df, "h", "g", "n")
    marked = df.withColumns({h: record_hash(df, 1), g: record_hash(df, 2)})
    again = marked.groupBy(h, g).agg(F.count("*").alias(n)).where(F.col(n) > COPIES).select(F.col(h).alias(f"{h}_"), F.col(g).alias(f"{g}_"))
    again = small(again)
    if not again.limit(1).count():
        return df.withColumn(copy, F.lit(0))
    same = (F.col(h) == F.col(f"{h}_")) & (F.col(g) == F.col(f"{g}_"))
    once = marked.join(again, same, "left_anti").select(*df.columns, F.lit(0).alias(copy))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(h)
    # one row is kept of its copies, and given back as often as there were
    many = marked.join(again, same, "left_semi").select(row).groupBy(h).agg(F.count("*").cast("int").alias(n))
    return once.unionByName(many.select(f"{h}.*", F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(copy)))


def assign_shards(
    df: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    size: F.Column | None = None,
    names: tuple[str, str] = ("shard", "slot"),
) -> DataFrame:
    """df's rows with a shard (int, from 0) and a gapless slot (long, from 0) in it.

    size gives the bytes of a row (16 and the text's UTF-8 bytes where not given). Null columns hash
    like any value; rows alike in all columns get different slots; a very long text takes a bucket of its
    own size; an empty table stays empty. Columns that are called like the two new ones are replaced.
    """
    df = df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])
    size = size if size is not None else F.octet_length(text_of(F.col("text"))) + 16
    volume = df.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-volume // bucket_bytes)))
    tasks = min(buckets, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-volume // TASK_BYTES)))
    bucket, task, a, b, base, at, n, copy, place = unused(df, "bucket", "task", "a", "b", "base", "at", "n", "copy", "place")
    copies = numbered_copies(df, copy)
    scattered = copies.withColumns({
        bucket: F.pmod(record_hash(df, seed, copy), F.lit(buckets)),
        a: record_hash(df, seed + 1, copy),
        b: record_hash(df, seed + 2, copy),
    }).withColumn(task, F.expr(f"`{bucket}` * {tasks} div {buckets}").cast("int"))
    counts = scattered.groupBy(bucket).agg(F.count("*").alias(n))
    # one row a bucket: the window below runs over counts, never over records
    before = W.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    bases = small(counts.select(F.col(bucket), F.col(n), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(base)), MOST_BUCKETS)
    rows = bases.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    own = W.partitionBy(task, bucket)
    ordered = scattered.repartitionById(tasks, F.col(task)).withColumn(at, F.row_number().over(own.orderBy(a, b)))
    drawn = ordered.withColumn(a, F.xxhash64(F.lit(seed + 3), F.col(bucket), F.col(at)))
    drawn = drawn.withColumn(at, F.row_number().over(own.orderBy(a, b, at)))
    placed = drawn.join(bases.drop(n), bucket).withColumn(place, F.col(base) + F.col(at) - 1)
    shard = F.expr(f"`{place}` * {shards} div {max(rows, 1)}")
    slot = F.col(place) - F.expr(f"(`{names[0]}` * {rows} + {shards - 1}) div {shards}")
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], shard.cast("int").alias(names[0]), F.col(place)).select(*[F.col(f"`{c}`") for c in df.columns], names[0], slot.cast("long").alias(names[1]))


def write_shards(df: DataFrame, **how) -> DataFrame:
    """assign_shards' rows, written in one folder a shard and read again; a large shard has several files."""
    return written(assign_shards(df, **how).sortWithinPartitions("shard", "slot"), "shards", "shard")


def shard_digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document, from the written shards."""
    text = text_of(F.col("text"))
    return write_shards(docs).select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
