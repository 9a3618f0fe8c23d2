"""WARC archives as a PySpark Python data source (format ``warc``).

Reading: files are planned into partitions by size; equality, membership, prefix and null tests on
header columns are pushed down; each record's headers are parsed first, and the block of a record
that the filters or the schema do not want is stepped over, neither read nor decoded. Files ending
in ``.gz`` (a member a record) are inflated as a stream, everything else is seeked through.

Writing: each task writes files of at most ``maxFileBytes`` (plus a record) under a name of its
own; the commit renames those of the successful attempts, so a lost executor or a repeated task
leaves nothing that a reader would list.

A payload that other records share is stored once: ``archive`` turns the further copies into
``revisit`` records that name the response they repeat.

Paths are opened with ``pyarrow.fs``: local, HDFS or S3 folders that all executors share.

Defined results: a null payload is empty; a null header is left out and read back as null; an empty
table writes no file and an empty folder reads as no rows; repeated rows give a record each; a
record that is cut short or lacks its version line raises an error with file and offset; other
columns of the pages are ignored.
"""

from __future__ import annotations

import gzip
import io
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, IsNotNull, IsNull,
    StringStartsWith, WriterCommitMessage)

from ..session import scratch_path

VERSION = b"WARC/1.1\r\n"
# Header columns and the WARC fields behind them (fixed values of the format; the last two are extension fields).
HEADERS = {
    "record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
    "date": "WARC-Date", "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest",
    "payload_length": "X-Payload-Length", "page_id": "X-Page-Id",
}
LONGS = ("payload_length", "page_id")
SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c in LONGS else T.StringType()) for c in HEADERS]
    + [T.StructField("payload", T.BinaryType())])
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 4 << 20


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class WarcFiles(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcDataSource(DataSource):
    """Options: ``path``; ``partitionBytes`` (reading); ``maxFileBytes``, ``contentEncoding`` of payloads,
    ``gzip`` or ``identity``, and ``compression``, ``none`` or ``gzip`` of whole records (writing)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to")
        return WarcWriter(schema, dict(self.options))


class WarcReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.columns = schema.names
        unknown = set(self.columns) - set(SCHEMA.names)
        if unknown:
            raise ValueError(f"no such WARC columns: {sorted(unknown)}")
        self.options = options
        self.tests: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "prefix", (f.value,)))
            elif isinstance(f, (IsNull, IsNotNull)):
                self.tests.append((column, "null" if isinstance(f, IsNull) else "known", ()))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        system, root = _open(self.options["path"])
        listed = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        files = sorted((x.path, x.size) for x in listed if x.is_file and x.path.endswith((".warc", ".warc.gz"))
                       and not x.base_name.startswith(("_", ".")))
        most, parts, held = int(self.options.get("partitionbytes", 64 << 20)), [], 0
        for path, size in files:
            if parts and held + size <= most:
                parts[-1].paths.append(path)
                held += size
            else:
                parts.append(WarcFiles([path]))
                held = size
        return parts

    def _wanted(self, fields: dict[str, object]) -> bool:
        for column, kind, values in self.tests:
            v = fields[column]
            if kind == "null":
                if v is not None:
                    return False
            elif v is None or kind == "in" and v not in values or kind == "prefix" and not v.startswith(values):
                return False
        return True

    def read(self, partition: WarcFiles | None) -> Iterator[pa.RecordBatch]:
        system, _ = _open(self.options["path"])
        types = [pa.binary() if c == "payload" else pa.int64() if c in LONGS else pa.string() for c in self.columns]
        schema = pa.schema(list(zip(self.columns, types, strict=True)))
        rows, held = [], 0
        for path in partition.paths if partition else ():  # an empty folder has no partitions
            for fields in self._records(system, path):
                rows.append([fields[c] for c in self.columns])
                held += 200 + len(fields.get("payload") or b"")
                if held >= BATCH_BYTES:
                    yield self._batch(rows, schema)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows, schema)

    @staticmethod
    def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    def _records(self, system, path: str) -> Iterator[dict]:
        with system.open_input_file(path) as raw:
            packed = path.endswith(".gz")
            f = gzip.GzipFile(fileobj=raw) if packed else io.BufferedReader(raw, 1 << 18)
            while line := f.readline():
                if line == b"\r\n":
                    continue
                if not line.startswith(b"WARC/"):
                    raise ValueError(f"{path}: no WARC version line before byte {f.tell()}")
                head = {}
                while (line := f.readline()).strip():
                    name, _, value = line.decode("utf-8").partition(":")
                    head[name.strip().lower()] = value.strip()
                if not line or "content-length" not in head:
                    raise ValueError(f"{path}: headers end early at byte {f.tell()}")
                size = int(head["content-length"])
                fields = {c: head.get(h.lower()) for c, h in HEADERS.items()}
                fields |= {c: int(fields[c]) for c in LONGS if fields[c] is not None}
                if not self._wanted(fields):
                    f.seek(size, io.SEEK_CUR)
                    continue
                if "payload" in self.columns:
                    block = f.read(size)
                    if len(block) < size:
                        raise ValueError(f"{path}: block ends early at byte {f.tell()}")
                    fields["payload"] = payload_of(block, head.get("content-type", ""))
                else:
                    f.seek(size, io.SEEK_CUR)
                yield fields


def payload_of(block: bytes, content_type: str) -> bytes:
    """The payload in a record's block: behind the HTTP head, with its content encoding undone."""
    if not content_type.startswith("application/http"):
        return block
    head, _, body = block.partition(b"\r\n\r\n")
    if b"\r\ncontent-encoding: gzip" in head.lower():
        return zlib.decompress(body, 31)
    return body


class WarcWriter(DataSourceWriter):
    def __init__(self, schema: T.StructType, options: dict):
        missing = {"record_id", "record_type"} - set(schema.names)
        if missing:
            raise ValueError(f"a record needs {sorted(missing)}")
        self.options = options
        self.packed = options.get("compression", "none") == "gzip"
        self.encoded = options.get("contentencoding", "identity") == "gzip"

    def _record(self, row) -> bytes:
        fields = row.asDict()
        payload = bytes(fields.get("payload") or b"")
        head = [f"{h}: {fields[c]}" for c, h in HEADERS.items() if fields.get(c) is not None]
        if fields["record_type"] == "revisit":
            block, kind = b"", "application/http; msgtype=response"
            head.append(f"WARC-Profile: {REVISIT_PROFILE}")
        elif fields["record_type"] == "response":
            body, coding = payload, ""
            if self.encoded:
                pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                body, coding = pack.compress(payload) + pack.flush(), "Content-Encoding: gzip\r\n"
            block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{coding}"
                     f"Content-Length: {len(body)}\r\n\r\n").encode() + body
            kind = "application/http; msgtype=response"
        else:
            block, kind = payload, "application/octet-stream"
        lines = [x.replace("\r", " ").replace("\n", " ") for x in [*head, f"Content-Type: {kind}", f"Content-Length: {len(block)}"]]
        record = VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
        return gzip.compress(record, 1) if self.packed else record

    def write(self, rows: Iterator) -> Written:
        system, root = _open(self.options["path"])
        most = int(self.options.get("maxfilebytes", 64 << 20))
        system.create_dir(root, recursive=True)
        made, out, held = [], None, 0
        for row in rows:
            if out is None:
                name = f"{uuid.uuid4().hex}.warc" + ".gz" * self.packed
                made.append(name)
                out, held = system.open_output_stream(f"{root}/_{name}", compression=None), 0
            record = self._record(row)
            out.write(record)
            held += len(record)
            if held >= most:
                out.close()
                out = None
        if out is not None:
            out.close()
        return Written(made)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _open(self.options["path"])
        for m in messages:
            for name in m.files if m else ():
                system.move(f"{root}/_{name}", f"{root}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        system, root = _open(self.options["path"])
        for m in messages:
            for name in m.files if m else ():
                system.delete_file(f"{root}/_{name}")


def register(spark: SparkSession) -> None:
    """Make the format known to a session, with filter push-down on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def records(pages: DataFrame, least_shared: int = 100, id_col: str = "page_id", payload_col: str = "html",
            uri_col: str = "url") -> DataFrame:
    """Rows for the writer. Of pages with equal payloads of at least ``least_shared`` bytes, that with
    the smallest id is the response (repeated rows with that id too) and the others revisit it.

    Only digest and id are grouped, partly before the shuffle. The pages then meet one row per
    shared digest; a hot digest's pages are split over tasks by the adaptive skew join.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(uri_col).cast("string").alias("target_uri"),
        payload.alias("payload")).withColumns({
            "payload_digest": F.sha2("payload", 256), "payload_length": F.octet_length("payload").cast("bigint")})
    shared = (rows.filter(F.col("payload_length") >= least_shared).groupBy("payload_digest")
              .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"))
    rows = rows.join(shared, "payload_digest", "left")
    again = F.coalesce(~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull(), F.lit(False))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return rows.select(
        F.coalesce(name(F.col("page_id")), F.lit("<urn:page:unknown>")).alias("record_id"),
        F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
        F.when(again, name(F.col("first_id"))).alias("refers_to"),
        F.concat(F.lit("sha256:"), F.col("payload_digest")).alias("payload_digest"), "payload_length", "page_id",
        F.when(~again, F.col("payload")).alias("payload"))


def archive(pages: DataFrame, path: str, least_shared: int = 100, **columns: str) -> None:
    """Write a WARC record for every page under ``path``."""
    register(pages.sparkSession)
    (records(pages, least_shared, **columns).write.format("warc").option("contentEncoding", "gzip")
     .mode("append").save(path))


def read_archive(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Records under ``path``; without ``payload`` among the columns no block is read."""
    register(spark)
    schema = T.StructType([SCHEMA[c] for c in columns or SCHEMA.names])
    return spark.read.format("warc").schema(schema).load(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """Per record ``page_id, payload_bytes, payload_digest, record_type, refers_to``: measured on the
    payload of responses, taken from the headers of revisits, whose blocks are stepped over."""
    full = read_archive(spark, path, ["record_type", "page_id", "payload"]).filter("record_type = 'response'")
    bare = read_archive(spark, path, ["record_type", "page_id", "refers_to", "payload_digest", "payload_length"]) \
        .filter("record_type = 'revisit'")
    return full.select(
        "page_id", F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("bigint").alias("refers_to"),
    ).unionByName(bare.select(
        "page_id", F.col("payload_length").alias("payload_bytes"),
        F.regexp_extract("payload_digest", "sha256:(.*)", 1).alias("payload_digest"), "record_type",
        F.regexp_extract("refers_to", "<urn:page:(.*)>", 1).cast("bigint").alias("refers_to")))


def roundtrip(pages: DataFrame, least_shared: int = 100) -> DataFrame:
    """Archive the pages in the shared checkpoint folder and read the archives back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    archive(pages, path, least_shared)
    return archived_pages(spark, path)
