"""WARC archives as a PySpark data source, with payload de-duplication on writing.

Writing: every task writes gzip-free WARC/1.1 files of its rows under a name of its own; the
commit lists the files of the successful tasks in a manifest, so files of failed or repeated
attempts are never read. The manifest also has the place of a record every ``step`` bytes of a file,
known to the writer, so nothing is guessed from a payload's bytes. Reading: the driver cuts the
manifest's files into ranges of bounded size that begin at such places; a task goes from record to
record, parses headers first, tests the pushed-down filters on them, and skips the payloads it
need not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThanOrEqual,
                                    In, InputPartition, IsNotNull, LessThanOrEqual, WriterCommitMessage)
from pyspark.sql.types import StructType

from ..session import scratch_path
from .common import cut

LEAST = 100  # bytes; shorter payloads are never replaced by a revisit
SPLIT = 64 << 20  # bytes of a file for one task, and between the places that the manifest has
FILE = 256 << 20  # bytes after which a task starts another file
MANIFEST = "_manifest.json"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
RECORDS = ("record_id string, record_type string, target_uri string, page_id long, refers_to long, "
           "payload_digest string, payload_bytes long, content_length long, payload binary")
_MARK = b"WARC/1.1\r\n"
# Values never hold a line end: others are percent-escaped, and so is the sign itself.
_ESCAPE = re.compile(r"[\x00-\x1f%\x7f]")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI of the shared folder, and the path in it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def _quoted(value: str) -> str:
    return _ESCAPE.sub(lambda m: f"%{ord(m[0]):02X}", value)


def _plain(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record(row) -> bytes:
    """One WARC record of a row with the columns of RECORDS (but content_length)."""
    body = b"" if row["record_type"] == "revisit" else bytes(row["payload"])
    fields = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", f"<{row['record_id']}>"),
              ("WARC-Target-URI", _quoted(row["target_uri"]) if row["target_uri"] is not None else None),
              ("WARC-Page-ID", row["page_id"]), ("WARC-Refers-To-Page-ID", row["refers_to"]),
              ("WARC-Payload-Digest", f"sha256:{row['payload_digest']}"),
              ("WARC-Payload-Length", row["payload_bytes"]),
              ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(body))]
    if row["record_type"] == "revisit":
        fields.insert(1, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return _MARK + head.encode() + b"\r\n" + body + b"\r\n\r\n"


@dataclass
class _Written(WriterCommitMessage):
    files: list[tuple[str, int, list[int]]]  # name, bytes, places of records


class _Writer(DataSourceWriter):
    def __init__(self, path: str, step: int):
        self.path, self.step = path, step

    def write(self, iterator: Iterator) -> _Written:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        files, out, size, starts = [], None, 0, []

        def close() -> None:
            out.close()
            files[-1] = (files[-1][0], size, starts)
        try:
            for row in iterator:
                data = record(row)
                if out is not None and size + len(data) > FILE:
                    close()
                    out = None
                if out is None:
                    files.append((f"part-{uuid.uuid4().hex}.warc", 0, []))
                    out, size, starts = system.open_output_stream(f"{root}/{files[-1][0]}"), 0, [0]
                if size - starts[-1] >= self.step:
                    starts.append(size)
                out.write(data)
                size += len(data)
        finally:
            if out is not None:
                close()
        return _Written(files)

    def commit(self, messages: list) -> None:
        system, root = _open(self.path)
        system.create_dir(root, recursive=True)
        files = sorted(f for m in messages if m is not None for f in m.files)
        with system.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        """Nothing is listed, so nothing is read; left files bear names that never repeat."""


@dataclass
class _Range(InputPartition):
    file: str
    start: int
    stop: int


def _ranges(starts: list[int], size: int, split: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``split`` bytes that begin at some of the places ``starts``."""
    first = None
    for a, b in zip(starts, [*starts[1:], size]):
        first = a if first is None else first
        if b - first >= split or b == size:
            yield first, b
            first = None


class _Reader(DataSourceReader):
    """Reads all records."""

    def __init__(self, path: str, split: int, columns: list[str]):
        self.path, self.split, self.columns = path, split, columns
        self.tests: list[tuple[str, str, object]] = []

    def partitions(self) -> list[_Range]:
        system, root = _open(self.path)
        with system.open_input_stream(f"{root}/{MANIFEST}") as f:
            files = json.loads(f.read())
        return [_Range(f"{root}/{name}", a, b) for name, size, starts in files
                for a, b in _ranges(starts, size, self.split)] or [_Range("", 0, 0)]

    def _passes(self, r: dict) -> bool:
        for column, kind, value in self.tests:
            got = r[column]
            if got is None or not (kind == "set" or kind == "=" and got == value or kind == "in" and got in value
                                   or kind == ">=" and got >= value or kind == "<=" and got <= value):
                return False
        return True

    def read(self, partition: _Range) -> Iterator[tuple]:
        if not partition.file:
            return
        system, _ = _open(self.path)
        with system.open_input_file(partition.file) as f:
            at = partition.start
            while at < partition.stop:
                f.seek(at)
                head = _header(f)
                r = _parsed(head)
                body = at + len(head) + 4
                if self._passes(r):
                    if "payload" in self.columns:
                        f.seek(body)
                        r["payload"] = f.read(r["content_length"])
                    yield tuple(r.get(c) for c in self.columns)
                at = body + r["content_length"] + 4


class _FilteringReader(_Reader):
    """Reads the records that pass the filters on their headers."""

    def pushFilters(self, filters: list[Filter]):
        """Takes what headers decide: equality, membership and bounds of the header columns."""
        kinds = {EqualTo: "=", In: "in", GreaterThanOrEqual: ">=", LessThanOrEqual: "<=", IsNotNull: "set"}
        for f in filters:
            kind = kinds.get(type(f))
            if kind and len(f.attribute) == 1 and f.attribute[0] in self.columns and f.attribute[0] != "payload":
                self.tests.append((f.attribute[0], kind, getattr(f, "value", None)))
            else:
                yield f


def _header(f) -> bytes:
    head = b""
    while (end := head.find(b"\r\n\r\n")) < 0:
        more = f.read(1024)
        if not more:
            raise ValueError("a WARC record ends within its header")
        head += more
    return head[:end]


def _parsed(head: bytes) -> dict:
    lines = head.decode().split("\r\n")
    if lines[0] != _MARK.decode().strip():
        raise ValueError("not a WARC record")
    h = dict(x.split(": ", 1) for x in lines[1:])
    number = lambda k: int(h[k]) if k in h else None
    return {"record_id": h["WARC-Record-ID"][1:-1], "record_type": h["WARC-Type"],
            "target_uri": _plain(h["WARC-Target-URI"]) if "WARC-Target-URI" in h else None,
            "page_id": number("WARC-Page-ID"), "refers_to": number("WARC-Refers-To-Page-ID"),
            "payload_digest": h["WARC-Payload-Digest"].removeprefix("sha256:"),
            "payload_bytes": number("WARC-Payload-Length"), "content_length": int(h["Content-Length"])}


class WarcSource(DataSource):
    """spark.read.format("warc").option("path", folder): the records of a folder's manifest.

    The schema may name any of RECORDS' columns; without ``payload`` no payload is read.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return RECORDS

    def reader(self, schema: StructType) -> _Reader:
        kind = _FilteringReader if self.options.get("pushdown") == "true" else _Reader
        return kind(self.options["path"], int(self.options.get("split", SPLIT)), schema.names)

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], int(self.options.get("step", SPLIT)))


def records(pages: DataFrame) -> DataFrame:
    """The WARC records of pages (page_id, url, html, any others): RECORDS but content_length.

    Of records with equal payloads of at least LEAST bytes, the smallest page_id's is a
    response and the others are revisits of it; shorter ones are all responses. A null html is
    an empty payload. Repeated rows of the smallest page_id are all responses. Rows with a null
    page_id are revisits if another row has their payload and an id, else responses.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"),
                        body.alias("payload"), F.sha2(body, 256).alias("payload_digest"),
                        F.octet_length(body).cast("long").alias("payload_bytes"))
    first = cut(rows.filter(F.col("payload_bytes") >= LEAST).groupBy("payload_digest")
                .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
                .select("payload_digest", "first"), "first")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    name = F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")))
    return rows.join(first, "payload_digest", "left").select(
        name.alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), "target_uri",
        "page_id", F.when(revisit, F.col("first")).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(revisit, F.lit(b"")).otherwise(F.col("payload")).alias("payload"))


def write(pages: DataFrame, to: str, step: int = SPLIT) -> None:
    """Writes the archives of ``pages`` into the folder ``to``; tasks can begin to read every ``step`` bytes."""
    pages.sparkSession.dataSource.register(WarcSource)
    records(pages).write.format("warc").mode("append").option("path", to).option("step", step).save()


def read(spark: SparkSession, path: str, columns: str = RECORDS, split: int = SPLIT) -> DataFrame:
    """Records of the archives in a folder; ``columns``: a schema of those that are wanted.

    A range has ``split`` bytes or, where the archives were written with a longer step, that. Filters
    on header columns are tested before payloads are read if the session has Spark's pushdown for
    Python sources on (PUSHDOWN) now and when the query runs; else Spark tests them afterwards.
    """
    spark.dataSource.register(WarcSource)
    pushdown = spark.conf.get(PUSHDOWN, "false")
    return (spark.read.format("warc").schema(columns).option("path", path).option("split", split)
            .option("pushdown", pushdown).load())


def archived(pages: DataFrame) -> DataFrame:
    """Writes archives to the shared folder and reads every record back, payloads verified.

    page_id, payload_bytes, payload_digest, record_type, refers_to, verified: the digest of
    what was read is that of the header (revisits hold no payload: null). Reading again takes
    the whole payloads. An empty table gives an empty result.
    """
    spark = pages.sparkSession
    to = scratch_path(spark, "llm", "warc")
    write(pages, to)
    found = read(spark, to)
    intact = F.when(F.col("record_type") == "response", F.sha2("payload", 256) == F.col("payload_digest"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        intact.alias("verified"))


def digest(payload: bytes) -> str:
    return hashlib.sha256(payload).hexdigest()
