"""Keyed tables in a shared folder that change as whole versions.

A table is a folder of Parquet files by partition, and one small file a version that names, for each
partition, the folder of files in force. A writer puts its rows into a folder of its own and then
commits: the version file is moved to the next number, which fails where another writer was first. Until
that move readers see the old version, so a writer that dies leaves nothing but a folder that no
version names. Partitions that a change doesn't touch keep their files.

A version file holds names of partitions, never rows. Partition columns must not be changed by an update.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contestry.operators.curation import upsert
from contestry.sources.store import shared_dir, until_exit

#: Columns that writers add: the folder of a write, and what it did to a row.
WRITE, CHANGE = "write", "change"
#: How often a writer takes up another's version before it gives up.
TRIES = 20


class Conflict(RuntimeError):
    """Another writer changed the same partitions in the meantime."""


@dataclass
class Version:
    number: int = 0
    schema: str = ""
    #: partition (as a path, a=1/b=2) -> the write whose folder holds it
    parts: dict[str, str] = field(default_factory=dict)
    #: writer -> its last committed batch
    batches: dict[str, int] = field(default_factory=dict)
    write: str = ""


class Table:
    """A table under path; keys identify a row, partition columns are part of it."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], partition: list[str]):
        self.spark, self.path, self.keys, self.partition = spark, path.rstrip("/"), keys, partition
        self._jvm, self._conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self._path("").getFileSystem(self._conf)

    # Files and versions.

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return sorted(s.getPath().getName() for s in self._files.listStatus(at)) if self._files.exists(at) else []

    def _folders(self, write: str) -> list[str]:
        """The partitions that a write has files in."""
        found = [""]
        for _ in self.partition:
            found = [f"{p}/{n}".lstrip("/") for p in found for n in self._names(f"files/{WRITE}={write}/{p}") if "=" in n]
        return found

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("versions") if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """A version, or the newest; an empty one where none was committed."""
        if number is None:
            number = max(self.versions(), default=0)
        if number == 0:
            return Version()
        stream = self._files.open(self._path(f"versions/{number:012d}.json"))
        try:
            return Version(**json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def _publish(self, version: Version) -> bool:
        """Move the version file to its number; False where the number is taken."""
        made, final = self._path(f"versions/.{uuid.uuid4().hex}"), self._path(f"versions/{version.number:012d}.json")
        stream = self._files.create(made, False)
        stream.write(json.dumps(vars(version)).encode())
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self._conf)
        try:  # without OVERWRITE the move fails where the target is there
            context.rename(made, final, self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))
            return True
        except Exception:
            self._files.delete(made, False)
            if self._files.exists(final):
                return False
            raise

    # Reading.

    def read(self, number: int | None = None, only: list[str] | None = None, changes: bool = False) -> DataFrame:
        """The rows of a version (the newest), of some partitions only where given."""
        version = self.version(number)
        if not version.schema:
            raise ValueError(f"{self.path} has no version yet")
        parts = version.parts if only is None else {p: version.parts[p] for p in only if p in version.parts}
        return self._rows(version.schema, parts, changes)

    def _rows(self, schema: str, parts: dict[str, str], changes: bool = False) -> DataFrame:
        names = [f.name for f in self._empty(schema).schema]
        more = [CHANGE, WRITE] if changes else []
        if not parts:
            return self._empty(f"{schema}, {CHANGE} string, {WRITE} string").select(*names, *more)
        paths = [f"{self.path}/files/{WRITE}={w}/{p}" for p, w in sorted(parts.items())]
        reader = self.spark.read.schema(f"{schema}, {CHANGE} string, {WRITE} string").option("basePath", f"{self.path}/files")
        return reader.parquet(*paths).select(*names, *more)

    def _empty(self, schema: str) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def changes(self, number: int | None = None) -> DataFrame:
        """What the write of a version did, a row for each kind of change and its count; its own files only."""
        version = self.version(number)
        own = {p: w for p, w in version.parts.items() if w == version.write}
        return self._rows(version.schema, own, changes=True).groupBy(CHANGE).agg(F.count("*").alias("rows"))

    # Writing.

    def stage(self, rows: DataFrame) -> str:
        """Files of rows in a folder of their own, by partition; no version names them yet."""
        write = uuid.uuid4().hex
        columns = [c for c in rows.columns if c not in (WRITE, CHANGE)]
        change = F.col(CHANGE) if CHANGE in rows.columns else F.lit("inserted")
        # partitions are put together, and large ones stay in several files
        even = rows.select(*columns, change.alias(CHANGE)).hint("rebalance", *self.partition)
        even.write.partitionBy(*self.partition).parquet(f"{self.path}/files/{WRITE}={write}")
        return write

    def commit(self, write: str, schema: str, touched: list[str], seen: Version, batch: tuple[str, int] | None = None) -> Version:
        """Make a write the newest version: its partitions take the place of those it touched.

        seen: the version that the write was made from. If others came between, their partitions must not
        be among those touched.
        """
        new = {p: write for p in self._folders(write)}
        for _ in range(TRIES):
            now = self.version()
            if batch and now.batches.get(batch[0], -1) >= batch[1]:
                return now
            both = {*touched, *new}
            if any(now.parts.get(p) != seen.parts.get(p) for p in both):
                raise Conflict(f"{self.path}: version {now.number} changed what version {seen.number} was read for")
            kept = {p: w for p, w in now.parts.items() if p not in both}
            batches = {**now.batches, **({batch[0]: batch[1]} if batch else {})}
            made = Version(now.number + 1, schema, {**kept, **new}, batches, write)
            if self._publish(made):
                return made
        raise Conflict(f"{self.path}: {TRIES} writers were first")

    def done(self, batch: tuple[str, int] | None) -> bool:
        """Whether a writer's batch was committed before."""
        return bool(batch) and self.version().batches.get(batch[0], -1) >= batch[1]

    def _staged(self, rows: DataFrame) -> tuple[DataFrame, list[str], str]:
        """rows written once, so that they can be read often; their partitions and schema."""
        names = [c for c in rows.columns if c not in (WRITE, CHANGE)]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
        write = self.stage(rows)
        parts = self._folders(write)
        return self._rows(schema, dict.fromkeys(parts, write)), parts, schema

    def replace(self, rows: DataFrame, batch: tuple[str, int] | None = None) -> Version:
        """The partitions of rows hold just these rows from now on; all others keep their files."""
        seen = self.version()
        if self.done(batch):
            return seen
        names = [c for c in rows.columns if c not in (WRITE, CHANGE)]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
        return self.commit(self.stage(rows), schema, [], seen, batch)

    def upsert(self, rows: DataFrame, frozen: Column | None = None, batch: tuple[str, int] | None = None) -> Version:
        """Rows put in by key; where frozen (over the old row, as columns of `o`) holds, the old row stays. Only the rows' partitions are read and written."""
        return self.change(rows, lambda old, new: upsert(old, new, self.keys, frozen), batch)

    def change(self, rows: DataFrame, merge, batch: tuple[str, int] | None = None) -> Version:
        """The partitions of rows become merge(their old rows, rows), which may tell what it did in a column change."""
        seen = self.version()
        if self.done(batch):
            return seen
        new, parts, schema = self._staged(rows)
        old = self._rows(seen.schema or schema, {p: seen.parts[p] for p in parts if p in seen.parts})
        return self.commit(self.stage(merge(old, new)), seen.schema or schema, parts, seen, batch)

    def delete_using(self, keys: DataFrame, batch: tuple[str, int] | None = None) -> tuple[Version, int]:
        """Rows with the keys' values (partition columns among them) go; the version, and how many went."""
        seen = self.version()
        if self.done(batch) or not seen.schema:
            return seen, 0
        gone, parts, _ = self._staged(keys.select(*self.keys).distinct())
        met = {p: seen.parts[p] for p in parts if p in seen.parts}
        old = self._rows(seen.schema, met)
        write = self.stage(old.join(gone, self.keys, "left_anti").withColumn(CHANGE, F.lit("unchanged")))
        left = self._rows(seen.schema, dict.fromkeys(self._folders(write), write))
        deleted = old.count() - left.count()
        return self.commit(write, seen.schema, parts, seen, batch), deleted

    def update_from(self, rows: DataFrame, where: Column | None = None, batch: tuple[str, int] | None = None) -> Version:
        """Rows whose keys occur take the other columns of rows (each key once); where limits it, over `o` (old) and `n` (new)."""
        given = [c for c in rows.columns if c not in self.keys]

        def merge(old: DataFrame, new: DataFrame) -> DataFrame:
            o = old.select(*self.keys, F.struct(*[c for c in old.columns if c not in self.keys]).alias("o"))
            both = o.join(new.select(*self.keys, F.struct(*given).alias("n")), self.keys, "left")
            hit = F.col("n").isNotNull() & F.coalesce(F.lit(True) if where is None else where, F.lit(False))
            values = [F.when(hit, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) if c in given else F.col(f"o.{c}").alias(c) for c in old.columns if c not in self.keys]
            return both.select(*self.keys, *values, F.when(hit, "updated").otherwise("unchanged").alias(CHANGE)).select(*old.columns, CHANGE)

        if not self.version().schema:
            raise ValueError(f"{self.path} has no version yet")
        return self.change(rows, merge, batch)

    # Cleaning up.

    def vacuum(self, keep: int = 1) -> int:
        """Remove all but the newest versions, and the folders that none of those names; how many folders went.

        Not to be run beside writers: what they have staged is named by no version yet.
        """
        numbers = self.versions()
        kept = numbers[-keep:]
        named = {w for n in kept for w in self.version(n).parts.values()}
        for n in numbers[:-keep]:
            self._files.delete(self._path(f"versions/{n:012d}.json"), False)
        gone = [n for n in self._names("files") if n.removeprefix(f"{WRITE}=") not in named]
        for n in gone:
            self._files.delete(self._path(f"files/{n}"), True)
        return len(gone)


def fresh_table(spark: SparkSession, name: str, keys: list[str], partition: list[str]) -> Table:
    """An empty table in the shared folder that goes with the application."""
    table = Table(spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", keys, partition)
    table._files.mkdirs(table._path(""))
    until_exit(spark, table.path)
    return table
