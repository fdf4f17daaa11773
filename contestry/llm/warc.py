"""WARC archives as a Spark data source.

Writing: each task writes its rows as gzip members (one record each) into files of its own and names
them in its commit message. A commit is one manifest file, moved into place when it is whole: lost or
repeated tasks leave nothing behind that readers see, and writers that append at a time don't disturb
each other.

Reading: the planner deals the archive files to partitions of about split_bytes. Filters on header
columns are pushed down; a record's headers are parsed first and its payload is decoded only where
the headers pass, and never where the option payload is "false". A file is read by one task, so writers
keep files below file_bytes. Paths go through pyarrow's file systems, so shared stores work as local
folders do.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualNullSafe,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    StringContains,
    StringEndsWith,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import scratch, small, text_of

SCHEMA = "record_id string, record_type string, target_uri string, warc_date string, content_type string, payload_digest string, refers_to string, page_id long, payload_bytes long, payload binary"
#: Column -> header; the two extension headers carry what a revisit record can't tell otherwise.
HEADERS = {
    "record_id": "warc-record-id",
    "record_type": "warc-type",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "content_type": "warc-identified-payload-type",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
    "page_id": "x-page-id",
    "payload_bytes": "x-payload-length",
}
#: Manifests are called so, with a number between.
MANIFEST = ("_manifest-", ".json")
#: Names the headers whose values are percent-coded, as they hold line breaks or outer spaces.
CODED = "X-Percent-Coded"
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 256 << 20
SPLIT_BYTES = 64 << 20
#: Bytes read at a time to find the end of another writer's HTTP headers.
HEAD_BYTES = 8 << 10
#: Bytes of an archive read at a time.
PIECE_BYTES = 256 << 10


def file_system(path: str):
    """(file system, path in it) of a URI or a plain path."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), path[5:].replace("//", "/", 1) if path.startswith("file://") else path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def encode_record(row) -> bytes:
    """One gzip member: WARC headers and, in a response, the HTTP headers and the payload."""
    payload = bytes(row.payload or b"")
    headers = {
        "WARC-Type": row.record_type,
        "WARC-Record-ID": row.record_id,
        "WARC-Date": row.warc_date or DATE,
        "WARC-Target-URI": row.target_uri,
        "WARC-Payload-Digest": row.payload_digest,
        "WARC-Refers-To": row.refers_to,
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if row.record_type == "revisit" else None,
        "X-Page-ID": row.page_id,
        "X-Payload-Length": row.payload_bytes,
        "WARC-Identified-Payload-Type": row.content_type,
        "Content-Type": "application/http;msgtype=response",
    }
    headers = {k: str(v) for k, v in headers.items() if v is not None}
    coded = [k for k, v in headers.items() if v != v.strip() or "\r" in v or "\n" in v]
    headers |= {k: quote(headers[k], safe="/:?&=#;,+@!$'()*[]") for k in coded}
    if coded:
        headers[CODED] = ",".join(coded)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {' '.join((row.content_type or 'text/html; charset=utf-8').split())}\r\nContent-Length: {row.payload_bytes or 0}\r\n\r\n".encode()
    block = http if row.record_type == "revisit" else http + payload
    lines = [f"{k}: {v}" for k, v in headers.items()]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", compresslevel=1, mtime=0)


def read_headers(stream) -> dict[str, str] | None:
    """The next record's headers; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    out: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    for name in out.get(CODED.lower(), "").lower().split(","):
        if name in out:
            out[name] = unquote(out[name])
    return out


class Inflated(io.RawIOBase):
    """The inflated bytes of a run of gzip members, read in pieces; from where no member begins, bytes pass as they are."""

    def __init__(self, raw):
        self.raw, self.left, self.codec, self.plain = raw, b"", None, False

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while True:
            if self.codec is None and not self.plain:
                # a piece may end between the two bytes that a member begins with
                while len(self.left) < 2 and (piece := self.raw.read(PIECE_BYTES)):
                    self.left += piece
                self.plain = self.left[:2] != b"\x1f\x8b"
                self.codec = None if self.plain else zlib.decompressobj(31)
            if not self.left:
                self.left = self.raw.read(PIECE_BYTES)
                if not self.left:
                    return 0
            if self.plain:
                n = min(len(buffer), len(self.left))
                buffer[:n], self.left = self.left[:n], self.left[n:]
                return n
            data = self.codec.decompress(self.left, len(buffer))
            self.left = self.codec.unused_data if self.codec.eof else self.codec.unconsumed_tail
            if self.codec.eof:
                self.codec = None
            if data:
                buffer[: len(data)] = data
                return len(data)


def value_of(headers: dict[str, str], column: str):
    text = headers.get(HEADERS[column])
    return int(text) if text is not None and column in ("page_id", "payload_bytes") else text


@dataclass
class Condition:
    """A pushed filter: column, test, value."""

    column: str
    test: str
    value: object = None

    def holds(self, headers: dict[str, str]) -> bool:
        found = value_of(headers, self.column)
        if self.test in ("null", "same"):
            return found is None if self.test == "null" else found == self.value
        if found is None:
            return False
        tests = {
            "set": lambda: True,
            "equal": lambda: found == self.value,
            "in": lambda: found in self.value,
            "above": lambda: found > self.value,
            "from": lambda: found >= self.value,
            "below": lambda: found < self.value,
            "to": lambda: found <= self.value,
            "starts": lambda: found.startswith(self.value),
            "ends": lambda: found.endswith(self.value),
            "contains": lambda: self.value in found,
        }
        return tests[self.test]()


TESTS = {
    EqualTo: "equal",
    EqualNullSafe: "same",
    In: "in",
    GreaterThan: "above",
    GreaterThanOrEqual: "from",
    LessThan: "below",
    LessThanOrEqual: "to",
    StringStartsWith: "starts",
    StringEndsWith: "ends",
    StringContains: "contains",
    IsNull: "null",
    IsNotNull: "set",
}


def manifests(store, root: str) -> list[str]:
    from pyarrow import fs

    named = [x.path for x in store.get_file_info(fs.FileSelector(root, allow_not_found=True))]
    return sorted(x for x in named if x.rpartition("/")[2].startswith(MANIFEST[0]) and x.endswith(MANIFEST[1]))


def manifest(store, path: str) -> list:
    """[name, bytes] of the files of one commit."""
    with store.open_input_stream(path) as f:
        return json.loads(f.read())


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.conditions: list[Condition] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if type(f) in TESTS and column in HEADERS:
                self.conditions.append(Condition(column, TESTS[type(f)], getattr(f, "value", None)))
            else:
                yield f

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        store, root = file_system(self.path)
        info = store.get_file_info(root)
        if info.type == fs.FileType.File:
            return [Files([root])]
        files = [(f"{root}/{name}", size) for path in manifests(store, root) for name, size in manifest(store, path)]
        if not manifests(store, root):
            files = [(x.path, x.size) for x in store.get_file_info(fs.FileSelector(root, recursive=True)) if x.path.endswith((".warc", ".warc.gz"))]
        out, room = [], 0
        for path, size in files:
            if room < size or not out:
                out.append([])
                room = self.split
            out[-1].append(path)
            room -= size
        return [Files(x) for x in out]

    def read(self, partition: Files) -> Iterator[tuple]:
        store, _ = file_system(self.path)
        for path in partition.paths if partition else []:
            with store.open_input_stream(path, compression=None) as raw:
                yield from self.records(io.BufferedReader(Inflated(raw), 1 << 17))

    def records(self, stream) -> Iterator[tuple]:
        typed = HEADERS["content_type"]
        early = [c for c in self.conditions if c.column != "content_type"]
        while (headers := read_headers(stream)) is not None:
            length, head = int(headers.get("content-length", 0)), b""
            wanted = all(c.holds(headers) for c in early)
            if wanted and typed not in headers:
                # another writer's record: the type is its own, or for HTTP that of the HTTP headers, which are read by themselves
                kind = headers.get("content-type", "")
                if kind.startswith("application/http"):
                    head = _http_head(stream, length)
                    kind = _http_type(head)
                if kind:
                    headers[typed] = kind
            wanted = wanted and all(c.holds(headers) for c in self.conditions)
            block = None
            if wanted and self.payload:
                block = head + stream.read(length - len(head))
            else:
                _skip(stream, length - len(head))
            if wanted:
                yield tuple(value_of(headers, c) for c in HEADERS) + (_payload(headers, block) if self.payload else None,)


def _http_head(stream, length: int) -> bytes:
    """The first bytes of a block of that length, up to the piece in which its HTTP headers end."""
    head = b""
    while len(head) < length and b"\r\n\r\n" not in head[-(HEAD_BYTES + 3):]:
        got = stream.read(min(HEAD_BYTES, length - len(head)))
        if not got:
            raise EOFError("the last record is cut short")
        head += got
    return head


def _skip(stream, length: int) -> None:
    while length > 0:
        got = len(stream.read(min(length, 1 << 17)))
        if not got:
            raise EOFError("the last record is cut short")
        length -= got


def _payload(headers: dict[str, str], block: bytes) -> bytes | None:
    """What follows the HTTP headers; a revisit has none."""
    if headers.get("warc-type") == "revisit":
        return None
    return block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block


def _http_type(block: bytes) -> str | None:
    for line in block.partition(b"\r\n\r\n")[0].split(b"\r\n")[1:]:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        if name.strip().lower() == "content-type":
            return value.strip()
    return None


@dataclass
class Wrote(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.most = int(options.get("file_bytes", FILE_BYTES))

    def write(self, rows: Iterator[Row]) -> Wrote:
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        files, out, size, name = [], None, 0, ""
        for row in rows:
            if out is None:
                name, size = f"part-{uuid.uuid4().hex}.warc.gz", 0
                out = store.open_output_stream(f"{root}/{name}", compression=None)
            record = encode_record(row)
            out.write(record)
            size += len(record)
            if size >= self.most:
                out.close()
                files.append([name, size])
                out = None
        if out is not None:
            out.close()
            files.append([name, size])
        return Wrote(files)

    def commit(self, messages) -> None:
        store, root = file_system(self.path)
        store.create_dir(root, recursive=True)
        files = sorted(f for m in messages if m for f in m.files)
        old = manifests(store, root) if self.overwrite else []
        name = uuid.uuid4().hex
        with store.open_output_stream(f"{root}/_{name}.tmp") as f:
            f.write(json.dumps(files).encode())
        store.move(f"{root}/_{name}.tmp", f"{root}/{MANIFEST[0]}{name}{MANIFEST[1]}")
        gone = [f"{root}/{file}" for path in old for file, _ in manifest(store, path)]
        for path in [*old, *gone]:
            store.delete_file(path)

    def abort(self, messages) -> None:
        store, root = file_system(self.path)
        for m in messages:
            for name, _ in m.files if m else []:
                store.delete_file(f"{root}/{name}")


class WarcDataSource(DataSource):
    """format("warc"): options path, payload, split_bytes, file_bytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


#: Payloads below this many bytes are stored each time.
REVISIT_BYTES = 1000


def record_id(page_id: F.Column) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def to_records(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """pages (page_id, url, html) as WARC rows.

    Of pages with equal payloads of at least `least` bytes the one with the largest page_id is the
    response and the others revisit it; rows that repeat that page_id are responses too. Null html is
    an empty payload; a null page_id is the smallest; an empty table gives no records.
    """
    payload = F.encode(text_of(F.col("html")), "UTF-8")
    light = pages.select("page_id", F.sha1(payload).alias("sha"), F.octet_length(payload).cast("long").alias("n"))
    # only payloads that occur more than once: the join below moves no html where this table is counted as small
    again = light.where(F.col("n") >= least).groupBy("sha").agg(F.count("*").alias("times"), F.max("page_id").alias("first_id"))
    again = small(again.where("times > 1").select(F.col("sha").alias("again_sha"), "first_id"))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.sha1("payload"))
    joined = rows.join(again, F.col("sha") == F.col("again_sha"), "left")
    revisit = F.col("again_sha").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        record_id(F.col("page_id")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.col("url").alias("target_uri"),
        F.lit(DATE).alias("warc_date"),
        F.lit("text/html; charset=utf-8").alias("content_type"),
        F.concat(F.lit("sha1:"), F.col("sha")).alias("payload_digest"),
        F.when(revisit, record_id(F.col("first_id"))).alias("refers_to"),
        "page_id",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in the archives.

    A response's figures come from its payload as read, a revisit's from its headers.
    """
    read = spark.read.format("warc").load(path)
    response = F.col("record_type") == "response"
    return read.select(
        "page_id",
        F.when(response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.sha1("payload")).otherwise(F.regexp_replace("payload_digest", "^sha1:", "")).alias("payload_digest"),
        "record_type",
        F.regexp_extract("refers_to", r"^<urn:page:(-?\d+)>$", 1).try_cast("long").alias("refers_to"),
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages as WARC archives into the shared folder and read them back.

    Every row is a record, also where page_ids repeat or are null; null html is an empty payload; very
    long pages are records like others; an empty table gives no rows.
    """
    spark = pages.sparkSession
    register(spark)
    path = scratch(spark, "warc")
    to_records(pages).write.format("warc").mode("append").save(path)
    return read_back(spark, path)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first_id, count(*) OVER (PARTITION BY payload_digest) AS times FROM q)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND times > 1 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND times > 1 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM r
"""
