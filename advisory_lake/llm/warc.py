"""Web archives (WARC) as a Spark data source, and deduplicated archives of pages.

``spark.read.format("warc")`` plans one task per file or group of small files. A record's
headers are read first; predicates on them are pushed down, and a record that fails them, or
whose payload no column asks for, is left without inflating the rest of it. Records are gzip
members that state their own length (the ``sl`` field of the format's annex), so leaving one
is a seek; members without it are inflated in small pieces and dropped.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualNullSafe,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from advisory_lake.llm.shared import ship_package
from advisory_lake.session import run_folder
from advisory_lake.sources.stores import arrow_uri, qualified

PUSHDOWN_KEY = "spark.sql.python.filterPushdown.enabled"
TASK_BYTES = 128 << 20  # small files share a task up to this
FILE_BYTES = 1 << 30  # a written archive is closed beyond this
BATCH_BYTES = 8 << 20
LEVEL = 6
DATE = "2020-01-01T00:00:00Z"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Columns, where their value comes from, and their type.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "record_date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
DDL = ", ".join(f"{name} STRING" for name in HEADERS) + ", block_length LONG, http_length LONG, payload BINARY"


# ---------------------------------------------------------------- records


@dataclass
class Record:
    page_id: int | None
    url: str | None
    digest: str
    payload: bytes
    refers_to: int | None


def record_bytes(record: Record) -> bytes:
    """One WARC/1.1 record. A revisit carries the HTTP header alone, with the full length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(record.payload)}\r\n\r\n"
    revisit = record.refers_to is not None
    block = http.encode() + (b"" if revisit else record.payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if record.page_id is None else record.page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{record.digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if record.url is not None:
        lines.append(f"WARC-Target-URI: {quote(record.url, safe=_URI_SAFE)}")
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{record.refers_to}>", f"WARC-Profile: {SAME_PAYLOAD}"]
    return "\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n"


_URI_SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


def gzip_member(data: bytes) -> bytes:
    """A gzip member that names its packed and its full length."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    size = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parsed_headers(head: bytes) -> dict[str, str]:
    """Field names in lower case; continuation lines belong to the field before."""
    fields: dict[str, str] = {}
    name = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


_HTTP_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)", re.IGNORECASE)


class _Plain:
    """Bytes of one record in a file without compression."""

    def __init__(self, file, start: int):
        self.file, self.at = file, start

    def more(self, size: int) -> bytes:
        self.file.seek(self.at)
        data = self.file.read(size)
        self.at += len(data)
        return data


class _Packed:
    """Bytes of one gzip member, inflated as far as they are asked for."""

    def __init__(self, file, start: int):
        self.file, self.start, self.next_start = file, start, None
        file.seek(start)
        head = file.read(12)
        self.at = start + 10
        if len(head) == 12 and head[3] & 4:
            (extra,) = struct.unpack("<H", head[10:12])
            field = file.read(extra)
            self.at = start + 12 + extra
            if field[:4] == b"sl\x08\0" and len(field) >= 12:
                packed, full = struct.unpack("<II", field[4:12])
                if full < 0xFFFFFFFF and packed >= 24:
                    self.next_start = start + packed
        if head[3] & ~4:  # names and comments: let zlib skip the whole header
            self.at, self.inflate = start, zlib.decompressobj(31)
        else:
            self.inflate = zlib.decompressobj(-15)
        self.trailer = 8 if self.at != start else 0

    def more(self, size: int) -> bytes:
        if self.inflate.eof:
            return b""
        data = self.inflate.unconsumed_tail
        if not data:
            self.file.seek(self.at)
            data = self.file.read(1 << 16 if size <= 1 << 16 else 1 << 20)
            self.at += len(data)
            if not data:
                return b""
        return self.inflate.decompress(data, size)

    def end(self) -> int:
        """Where the next member begins."""
        if self.next_start is not None:
            return self.next_start
        while not self.inflate.eof and (self.more(1 << 20) or self.inflate.unconsumed_tail or self.at < self.file.size()):
            pass
        return self.at - len(self.inflate.unused_data) + self.trailer


def read_records(file, wanted, with_payload: bool) -> Iterator[tuple[dict[str, str], bytes, bytes | None]]:
    """(headers, start of the block, payload or None) of the records that ``wanted(headers)``
    takes, in file order."""
    size, start = file.size(), 0
    while start < size:
        file.seek(start)
        packed = file.read(2) == b"\x1f\x8b"
        record = (_Packed if packed else _Plain)(file, start)
        data = b""
        while (stop := data.find(b"\r\n\r\n")) < 0:
            piece = record.more(1 << 12)
            if not piece:
                break
            data += piece
        if stop < 0:
            if data.strip():
                raise ValueError(f"no record header at byte {start}")
            return
        headers = parsed_headers(data[:stop])
        length = int(headers.get("content-length", "0"))
        block, first = data[stop + 4 :], stop + 4
        if wanted(headers):
            while b"\r\n\r\n" not in block and len(block) < min(length, 1 << 16):
                piece = record.more(1 << 12)
                if not piece:
                    break
                block += piece
            payload = None
            if with_payload:
                pieces, held = [block], len(block)
                while held < length and (piece := record.more(length - held)):
                    pieces.append(piece)
                    held += len(piece)
                block = b"".join(pieces)[:length]
                if len(block) < length:
                    raise ValueError(f"record at byte {start} ends early")
                http = headers.get("content-type", "").startswith("application/http")
                payload = block[block.find(b"\r\n\r\n") + 4 :] if http and b"\r\n\r\n" in block else block
            yield headers, block, payload
        start = record.end() if packed else start + first + length + 4


# ---------------------------------------------------------------- the data source


@dataclass
class ArchiveFiles(InputPartition):
    paths: tuple[str, ...]


@dataclass
class WrittenFiles(WriterCommitMessage):
    names: tuple[str, ...]


class WarcDataSource(DataSource):
    """Format ``warc``. Reading takes any of the columns of ``DDL``; leave ``payload`` out of
    the schema and no payload is inflated. Writing takes page_id, url, payload, digest, refers_to.
    The path needs its scheme, as ``stores.qualified`` gives it.
    """

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return DDL

    def reader(self, schema):
        return WarcReader(self.options["path"], schema)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options["path"], overwrite)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema):
        self.uri, self.schema, self.tests = arrow_uri(path), schema, []

    def pushFilters(self, filters):
        """Takes predicates on header columns, gives the others back to Spark."""
        for test in filters:
            column = test.attribute[0] if len(test.attribute) == 1 else ""
            if column in HEADERS and isinstance(test, (EqualTo, EqualNullSafe, In, StringStartsWith, IsNotNull)):
                value = getattr(test, "value", None)
                self.tests.append((HEADERS[column], type(test).__name__, value))
            else:
                yield test

    def partitions(self):
        store, base = fs.FileSystem.from_uri(self.uri)
        found = store.get_file_info(fs.FileSelector(base, recursive=True))
        files = sorted(
            (f.path, f.size)
            for f in found
            if f.type == fs.FileType.File and f.base_name.endswith((".warc", ".warc.gz")) and f.size
            and not any(part[:1] in "._" for part in f.path[len(base) :].strip("/").split("/"))
        )
        groups, held = [], TASK_BYTES
        for path, size in files:
            if held + size > TASK_BYTES:
                groups.append([])
                held = 0
            groups[-1].append(path)
            held += size
        return [ArchiveFiles(tuple(group)) for group in groups] or [ArchiveFiles(())]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for name, kind, value in self.tests:
            own = headers.get(name)
            if own and name == "warc-target-uri":
                own = unquote(own)
            if kind == "IsNotNull":
                passed = own is not None
            elif kind == "In":
                passed = own in value
            elif kind == "StringStartsWith":
                passed = own is not None and own.startswith(value)
            else:
                passed = own == value
            if not passed:
                return False
        return True

    def read(self, partition):
        from pyspark.sql.pandas.types import to_arrow_schema

        names = self.schema.fieldNames()
        arrow = to_arrow_schema(self.schema)
        store, _ = fs.FileSystem.from_uri(self.uri)
        rows, held = [], 0
        for path in partition.paths:
            with store.open_input_file(path) as file:
                for headers, block, payload in read_records(file, self._wanted, "payload" in names):
                    rows.append([_column(name, headers, block, payload) for name in names])
                    held += len(payload or b"") + 200
                    if held >= BATCH_BYTES:
                        yield _batch(rows, arrow)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, arrow)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], schema=schema
    )


def _column(name: str, headers: dict[str, str], block: bytes, payload: bytes | None):
    if name == "payload":
        return payload
    if name == "block_length":
        return int(headers.get("content-length", "0"))
    if name == "http_length":
        found = _HTTP_LENGTH.search(block[: block.find(b"\r\n\r\n") + 2])
        return int(found[1]) if found else None
    value = headers.get(HEADERS[name])
    return unquote(value) if name == "target_uri" and value else value


class WarcWriter(DataSourceArrowWriter):
    """Tasks write below ``_temporary``; the files of committed tasks move into place at the
    end, so attempts that were lost or run twice leave nothing in the result."""

    def __init__(self, path: str, overwrite: bool):
        self.uri, self.overwrite = arrow_uri(path), overwrite

    def write(self, iterator):
        store, base = fs.FileSystem.from_uri(self.uri)
        store.create_dir(f"{base}/_temporary", recursive=True)
        names, file = [], None
        for batch in iterator:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in ("page_id", "url", "digest", "payload", "refers_to")]
            for row in zip(*columns):
                if file is None:
                    names.append(f"{uuid.uuid4().hex}.warc.gz")
                    file = store.open_output_stream(f"{base}/_temporary/{names[-1]}", compression=None, buffer_size=1 << 20)
                file.write(gzip_member(record_bytes(Record(*(value.as_py() for value in row)))))
                if file.tell() >= FILE_BYTES:
                    file.close()
                    file = None
        if file is not None:
            file.close()
        return WrittenFiles(tuple(names))

    def commit(self, messages):
        store, base = fs.FileSystem.from_uri(self.uri)
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
                if old.type == fs.FileType.File and old.base_name.endswith(".warc.gz"):
                    store.delete_file(old.path)
        store.create_dir(f"{base}/_temporary", recursive=True)
        for message in messages:
            for name in message.names if message else ():
                store.move(f"{base}/_temporary/{name}", f"{base}/{name}")
        store.delete_dir(f"{base}/_temporary")

    def abort(self, messages):
        store, base = fs.FileSystem.from_uri(self.uri)
        store.delete_dir(f"{base}/_temporary")


def register(spark: SparkSession) -> None:
    """Make the format known, and let Spark hand predicates to it."""
    ship_package(spark)
    spark.conf.set(PUSHDOWN_KEY, "true")
    spark.dataSource.register(WarcDataSource)


# ---------------------------------------------------------------- archives of pages


def deduplicated(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """page_id, url, payload, digest, refers_to. Among equal payloads of at least so many bytes
    the one with the smallest page_id is the response; the others refer to it.

    Null html is an empty payload. A page without id never is the one referred to. All rows
    with the smallest id of a group are responses, so that none refers to itself; a group
    without any id has responses only.
    """
    # lazily: the payload is read again after the grouping rather than carried through it
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    groups = (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and least is not null")
        .drop("n")
    )
    refers = F.when(F.col("page_id").eqNullSafe(F.col("least")), None).otherwise(F.col("least"))
    return rows.join(groups, "digest", "left").select("page_id", "url", "payload", "digest", refers.alias("refers_to"))


def write_archive(pages: DataFrame, path: str) -> None:
    register(pages.sparkSession)
    deduplicated(pages).write.format("warc").mode("append").save(qualified(pages.sparkSession, path))


def read_archive(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The named columns of all records."""
    register(spark)
    types = dict(column.split(" ") for column in DDL.split(", "))
    return spark.read.format("warc").schema(", ".join(f"{c} {types[c]}" for c in columns)).load(qualified(spark, path))


def archived_pages(pages: DataFrame) -> DataFrame:
    """Write the pages to an archive in the shared folder and read it back: page_id,
    payload_bytes, payload_digest, record_type, refers_to, digest_agrees.

    The payloads of responses are inflated and measured; of revisits, headers alone are read.
    """
    spark = pages.sparkSession
    path = run_folder(spark, "warc")
    write_archive(pages, path)
    page = F.regexp_extract("record_id", "<urn:page:(-?[0-9]+)>", 1)
    page_id = F.when(page != "", page.cast("long")).alias("page_id")
    named = F.regexp_replace("payload_digest", "^sha256:", "")
    full = F.sha2("payload", 256)
    responses = read_archive(spark, path, "record_type", "record_id", "payload_digest", "payload").where("record_type = 'response'").select(
        page_id,
        F.length("payload").cast("long").alias("payload_bytes"),
        full.alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
        (full == named).alias("digest_agrees"),
    )
    refers = F.regexp_extract("refers_to", "<urn:page:(-?[0-9]+)>", 1).cast("long").alias("refers_to")
    revisits = read_archive(spark, path, "record_type", "record_id", "payload_digest", "refers_to", "http_length").where("record_type = 'revisit'").select(
        page_id, F.col("http_length").alias("payload_bytes"), named.alias("payload_digest"), "record_type", refers, F.lit(True).alias("digest_agrees")
    )
    return responses.union(revisits)
