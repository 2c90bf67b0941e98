"""Web archives (WARC 1.1) as a Spark data source, written and read in Python.

``spark.read.format("warc").load(path)`` plans one partition per archive file.
Predicates on the record type and other headers are pushed down: a record's headers
are parsed first, and the payload of a record that they rule out (or that the schema
does not ask for) is never decoded.  Archives are one gzip member per record, with the
member's length in an extra field ("sl"), so an unwanted record is skipped by a seek;
members without that field are read through, and plain ``.warc`` files seek by length.

``df.write.format("warc").save(path)`` writes a file (or several, of bounded size) per
task under a name of its own, and lists the files of successful attempts in a
manifest when the job commits.  Readers follow the manifest, so files of lost or
repeated attempts are never read.

Paths are URIs of any file system that pyarrow knows, or local paths.

Defined results: a null payload is an empty one; null header values are left out and
read as null; header values are UTF-8 with line breaks percent-encoded; rows come
out as often as they went in; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from tidemark.session import scratch_path

SCHEMA = (
    "record_id string, warc_type string, warc_date string, target_uri string, payload_digest string, "
    "refers_to string, payload_bytes long, payload binary"
)
HEADERS = {
    "record_id": "WARC-Record-ID", "warc_type": "WARC-Type", "warc_date": "WARC-Date", "target_uri": "WARC-Target-URI",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_files"
FILE_BYTES = 256 << 20
BATCH_BYTES = 8 << 20
HEAD_BYTES = 1 << 12


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    if path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.LocalFileSystem(), path


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def member(record: bytes, level: int = 3) -> bytes:
    """A gzip member whose extra field "sl" tells its own length and that of the record."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    size = 12 + 12 + len(body) + 8
    known = size < 1 << 32 and len(record) < 1 << 32
    extra = b"sl" + struct.pack("<HII", 8, size if known else 0, len(record) if known else 0)
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record(row: dict) -> bytes:
    """One response or revisit record; a revisit keeps the HTTP headers without the payload."""
    payload = row["payload"] or b""
    revisit = row["warc_type"] == "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    values = row | {"payload_digest": f"sha1:{digest(payload)}"}
    lines = ["WARC/1.1"]
    for column, header in HEADERS.items():
        value = values.get(column)
        if value is not None:
            lines.append(f"{header}: {value}".replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        lines.append(f"WARC-Profile: {REVISIT_PROFILE}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, base = _open(self.path)
        system.create_dir(base, recursive=True)
        names, out, size = [], None, 0
        try:
            for batch in iterator:
                for at in range(batch.num_rows):
                    row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
                    if out is None or size > FILE_BYTES:
                        if out is not None:
                            out.close()
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = system.open_output_stream(f"{base}/{names[-1]}", compression=None), 0
                    packed = member(record(row))
                    out.write(packed)
                    size += len(packed)
        finally:
            if out is not None:
                out.close()
        return Written(names)

    def commit(self, messages: list[Written | None]) -> None:
        system, base = _open(self.path)
        system.create_dir(base, recursive=True)
        names = [n for m in messages if m is not None for n in m.names]
        old = [] if self.overwrite else _manifest(system, base) or []
        with system.open_output_stream(f"{base}/{MANIFEST}") as out:
            out.write("\n".join([*old, *names]).encode())

    def abort(self, messages: list[Written | None]) -> None:
        system, base = _open(self.path)
        for m in messages:
            for name in m.names if m is not None else []:
                system.delete_file(f"{base}/{name}")


def _manifest(system: fs.FileSystem, base: str) -> list[str] | None:
    if system.get_file_info(f"{base}/{MANIFEST}").type == fs.FileType.NotFound:
        return None
    with system.open_input_stream(f"{base}/{MANIFEST}") as f:
        return f.read().decode().split()


@dataclass
class Archive(InputPartition):
    path: str


class _Gzip:
    """One gzip member at the file's place: its head first, the rest only on demand."""

    def __init__(self, file: BinaryIO, start: int):
        self.file, self.start, self.size = file, start, 0
        file.seek(start)
        fixed = file.read(12)
        flags, extra_bytes = fixed[3], struct.unpack("<H", fixed[10:12])[0]
        if flags & 4:
            extra = file.read(extra_bytes)
            while len(extra) >= 4:
                n = struct.unpack("<H", extra[2:4])[0]
                if extra[:2] == b"sl" and n == 8:
                    self.size = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + n :]
        file.seek(start)
        self.unpacker = zlib.decompressobj(31)

    def read(self, most: int) -> bytes:
        """At most ``most`` more bytes of the record."""
        out = b""
        while len(out) < most and not self.unpacker.eof:
            data = self.unpacker.unconsumed_tail or self.file.read(1 << 14)
            if not data:
                raise EOFError("truncated gzip member")
            out += self.unpacker.decompress(data, most - len(out))
        return out

    def end(self) -> int:
        """Where the next member starts."""
        if self.size:
            return self.start + self.size
        while not self.unpacker.eof:
            self.read(1 << 16)
        return self.file.tell() - len(self.unpacker.unused_data)


class _Plain:
    """A record of an uncompressed archive."""

    def __init__(self, file: BinaryIO, start: int):
        self.file, self.start, self.size = file, start, 0
        file.seek(start)

    def read(self, most: int) -> bytes:
        return self.file.read(most)

    def end(self) -> int:
        return self.start + self.size


def _headers(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        found[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return found


def _head(source, data: bytes) -> tuple[bytes, bytes]:
    """Up to the blank line, and what was read beyond it."""
    while b"\r\n\r\n" not in data:
        more = source.read(HEAD_BYTES)
        if not more:
            raise EOFError("record without end of headers")
        data += more
    head, _, rest = data.partition(b"\r\n\r\n")
    return head, rest


def records(file: BinaryIO, size: int, gzipped: bool, wanted, with_payload: bool, with_length: bool = True) -> Iterator[dict]:
    """Records whose headers ``wanted`` accepts."""
    place = 0
    while place < size:
        source = (_Gzip if gzipped else _Plain)(file, place)
        head, rest = _head(source, source.read(HEAD_BYTES))
        headers = _headers(head)
        length = int(headers.get("content-length", 0))
        if not gzipped:
            source.size = len(head) + 4 + length + 4
        row = {column: headers.get(header.lower()) for column, header in HEADERS.items()}
        if row["payload_digest"] is not None:
            row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
        if wanted(row):
            row["payload"], row["payload_bytes"] = None, None
            http = headers.get("content-type", "").startswith("application/http")
            if with_length or with_payload:
                if http and length:
                    inner, rest = _head(source, rest)
                    row["payload_bytes"] = int(_headers(inner).get("content-length", length - len(inner) - 4))
                    length -= len(inner) + 4
                else:
                    row["payload_bytes"] = length
            if with_payload and row["warc_type"] != "revisit":
                parts, missing = [rest], length - len(rest)
                while missing > 0:
                    parts.append(source.read(min(missing, 1 << 20)))
                    missing -= len(parts[-1])
                row["payload"] = b"".join(parts)[:length]
            yield row
        place = source.end()


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.columns = options["path"].rstrip("/"), schema.names
        self.tests: dict[str, list[set]] = {}
        self.present: set[str] = set()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in HEADERS or not isinstance(f, EqualTo | In | IsNotNull):
                yield f
            elif isinstance(f, IsNotNull):
                self.present.add(column)
            else:
                self.tests.setdefault(column, []).append({f.value} if isinstance(f, EqualTo) else set(f.value))

    def partitions(self) -> list[Archive]:
        system, base = _open(self.path)
        names = _manifest(system, base)
        if names is not None:
            files = [f"{base}/{name}" for name in names]
        elif system.get_file_info(base).type == fs.FileType.File:
            files = [base]
        else:
            infos = system.get_file_info(fs.FileSelector(base, recursive=True))
            files = sorted(i.path for i in infos if i.path.endswith((".warc", ".warc.gz")))
        return [Archive(f) for f in files]

    def _wanted(self, row: dict) -> bool:
        return all(row[c] is not None for c in self.present) and all(
            row[c] in allowed for c, sets in self.tests.items() for allowed in sets
        )

    def read(self, partition: Archive | None) -> Iterator[pa.RecordBatch]:
        if partition is None or not getattr(partition, "path", None):
            return
        system, _ = _open(self.path)
        rows, held = [], 0
        size = system.get_file_info(partition.path).size
        with_length = "payload_bytes" in self.columns
        with system.open_input_file(partition.path) as file:
            for row in records(file, size, partition.path.endswith(".gz"), self._wanted, "payload" in self.columns, with_length):
                rows.append(row)
                held += 200 + len(row["payload"] or b"")
                if held > BATCH_BYTES:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {"payload": pa.binary(), "payload_bytes": pa.int64()}
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in self.columns], names=self.columns
        )


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def as_records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows for the writer: pages (page_id, url, html) with type and reference.

    Of pages with equal payloads of at least ``least_bytes`` bytes, those with the largest
    page_id are responses (a null id is smaller than any), others revisit it.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    long_enough = F.octet_length(F.coalesce("html", F.lit(""))) >= least_bytes
    groups = (
        pages.filter(long_enough).select("page_id", F.sha1(payload).alias("same"))
        .groupBy("same").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        .select("same", "first_id")
    )
    marked = rows.join(groups, F.col("sha1") == F.col("same"), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return marked.select(
        _urn("page_id").alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("warc_type"),
        F.lit("2024-01-01T00:00:00Z").alias("warc_date"),
        F.col("url").alias("target_uri"),
        F.when(revisit, _urn("first_id")).alias("refers_to"),
        "payload",
    )


def _urn(column: str):
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(">"))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and digest of the payloads as they were read."""
    for batch in batches:
        payloads = [p.as_py() or b"" for p in batch.column("payload")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("record_id"), pa.array([len(p) for p in payloads], pa.int64()),
             pa.array([digest(p) for p in payloads], pa.string())],
            names=["record_id", "payload_bytes", "payload_digest"],
        )


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives, read them back, and report each page's record.

    Responses are decoded, and their size and digest are those of the bytes read; of
    revisits, which hold no payload, only the headers are.  Each read pushes its record
    type down, so neither decodes what the other wants.
    """
    spark = pages.sparkSession
    register(spark)
    path = scratch_path(spark, "warc")
    as_records(pages).write.format("warc").mode("append").save(path)

    def back(columns: str, kind: str) -> DataFrame:
        rows = spark.read.format("warc").schema(f"record_id string, warc_type string, {columns}").load(path)
        return rows.filter(F.col("warc_type") == kind)

    responses = back("payload binary", "response").select("record_id", "payload").mapInArrow(
        _measured, "record_id string, payload_bytes long, payload_digest string")
    revisits = back("payload_digest string, refers_to string, payload_bytes long", "revisit")
    found = responses.withColumns({"warc_type": F.lit("response"), "refers_to": F.lit(None).cast("string")}).unionByName(revisits)
    kind = pages.schema["page_id"].dataType

    def number(column: str):
        text = F.regexp_extract(column, "^<urn:page:(.*)>$", 1)
        return F.when(text != "", text).cast(kind)

    return found.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )
