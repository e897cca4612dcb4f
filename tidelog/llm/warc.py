"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

A reader task takes whole files, parses the headers of a record first and decodes its payload only if record
type and headers are wanted; what is not wanted is stepped over, in plain files by its length and in compressed ones by the
skip length in the gzip header, if the writer left one. A writer task writes files of bounded size under names of its own;
only those of tasks that Spark commits come into the list by which the folder is read, so that a task may be lost or run twice.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
    "headers map<string,string>, payload binary"
)
FILE_BYTES = 128 << 20  # a file is closed beyond that
PARTITION_BYTES = 64 << 20  # small files are read together up to that
BATCH_BYTES = 8 << 20
LIST = "_files.json"

# Field names and marks of the format.
VERSION = b"WARC/1.1"
FIELDS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "date": "WARC-Date",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
}
HTTP = "application/http; msgtype=response"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = "<2sBBIBBHHHII"  # with the extra field "sl": lengths of the member and of its content
_GZIP_BYTES = struct.calcsize(_GZIP)
_SKIP = struct.unpack("<H", b"sl")[0]


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _field(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A").strip()


def record_bytes(values: dict) -> bytes:
    """One record. A response holds its payload as an HTTP message, a revisit none, and any other type the payload itself."""
    kind, payload = values["record_type"] or "resource", values["payload"] or b""
    fields = {name: values[column] for column, name in FIELDS.items() if values[column] is not None} | {"WARC-Type": kind}
    if kind == "response":
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        block, fields["Content-Type"] = head.encode() + payload, HTTP
    elif kind == "revisit":
        block, fields["WARC-Profile"] = b"", SAME_PAYLOAD
    else:
        block = payload
    fields |= {k: v for k, v in values["headers"] or [] if v is not None}
    fields["Content-Length"] = str(len(block))
    lines = [VERSION, *(f"{_field(k)}: {_field(v)}".encode() for k, v in fields.items())]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int) -> bytes:
    """The data as a gzip member that says in its header how long it is."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    size = _GZIP_BYTES + len(body) + 8
    head = struct.pack(_GZIP, b"\x1f\x8b", 8, 4, 0, 0, 255, 12, _SKIP, 8, size, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class _Plain:
    """Records of a plain file, one after the other."""

    def __init__(self, file):
        self.file, self.buffer = file, b""

    def _fill(self, n: int) -> None:
        while len(self.buffer) < n and (more := self.file.read(max(1 << 16, n - len(self.buffer)))):
            self.buffer += more

    def head(self) -> bytes | None:
        """The headers of the next record."""
        size = 1 << 12
        while (end := self.buffer.find(b"\r\n\r\n")) < 0:
            before = len(self.buffer)
            self._fill(before + size)
            if len(self.buffer) == before:
                if self.buffer.strip():
                    raise ValueError("the file ends in the headers of a record")
                return None
        head, self.buffer = self.buffer[:end], self.buffer[end + 4 :]
        return head

    def block(self, n: int) -> bytes:
        self._fill(n + 4)
        if len(self.buffer) < n:
            raise ValueError("the file ends in a record")
        out, self.buffer = self.buffer[:n], self.buffer[n + 4 :]
        return out

    def skip(self, n: int) -> None:
        left = n + 4 - len(self.buffer)
        self.buffer = self.buffer[n + 4 :]
        if left > 0:
            self.file.seek(self.file.tell() + left)


class _Gzip:
    """Records of a file with a gzip member for each."""

    def __init__(self, file):
        self.file, self.start, self.raw, self.size = file, 0, b"", file.size()

    def _more(self) -> bool:
        """Inflates some more of the member."""
        if self.inflater.eof:
            return False
        if not self.raw:
            self.raw = self.file.read(1 << 14)
            self.read_to += len(self.raw)
            if not self.raw:
                raise ValueError("the file ends in a record")
        self.text += self.inflater.decompress(self.raw, 1 << 16)
        self.raw = self.inflater.unconsumed_tail or self.inflater.unused_data
        return True

    def head(self) -> bytes | None:
        if self.start >= self.size:
            return None
        self.file.seek(self.start)
        self.raw, self.text, self.inflater = self.file.read(1 << 14), b"", zlib.decompressobj(31)
        self.read_to, self.length = self.start + len(self.raw), None
        if len(self.raw) >= _GZIP_BYTES and self.raw[3] == 4:
            *_, name, _, size, _ = struct.unpack_from(_GZIP, self.raw)
            self.length = size if name == _SKIP else None
        while (end := self.text.find(b"\r\n\r\n")) < 0:
            if not self._more():
                raise ValueError("a record without headers")
        head, self.text = self.text[:end], self.text[end + 4 :]
        return head

    def _end(self) -> None:
        self.start = self.read_to - len(self.raw)

    def block(self, n: int) -> bytes:
        parts = [self.text]
        self.text = b""
        while self._more():
            parts.append(self.text)
            self.text = b""
        out = b"".join(parts)
        if len(out) < n:
            raise ValueError("the file ends in a record")
        self._end()
        return out[:n]

    def skip(self, n: int) -> None:
        if self.length is not None:
            self.start += self.length
            return
        while self._more():
            self.text = b""
        self._end()


def records(file, packed: bool, wanted, with_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of the records of a file whose headers are ``wanted``; null payloads if they are not asked for."""
    source = _Gzip(file) if packed else _Plain(file)
    while (head := source.head()) is not None:
        version, *lines = head.lstrip(b"\r\n").split(b"\r\n")
        if not version.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {version[:40]!r}")
        headers: dict[str, str] = {}
        for line in lines:
            if line[:1] in b" \t" and headers:  # continued
                headers[next(reversed(headers))] += " " + line.strip().decode("utf-8", "replace")
            else:
                name, _, value = line.partition(b":")
                headers[name.strip().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
        size = int(headers.get("Content-Length", 0))
        if not wanted(headers):
            source.skip(size)
            continue
        if not with_payload:
            source.skip(size)
            yield headers, None
            continue
        block = source.block(size)
        if headers.get("Content-Type", "").startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        yield headers, block


@dataclass
class Files(InputPartition):
    paths: list[str]


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, int]]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.options = options["path"], options
        self.with_payload = str(options.get("payload", "true")).lower() == "true"
        # header name -> values wanted
        self.wanted: dict[str, list[str]] = json.loads(options.get("headers", "{}"))
        if options.get("types"):
            self.wanted["WARC-Type"] = options["types"].split(",")

    def partitions(self) -> list[Files]:
        """Files of about PARTITION_BYTES together, largest first; a larger file is a partition of its own."""
        system, top = open_folder(self.path)
        info = system.get_file_info(top)
        if info.type == fs.FileType.File:
            found = [(top, info.size)]
        else:
            names = system.get_file_info(fs.FileSelector(top, recursive=True))
            lists = [n for n in names if n.base_name == LIST]
            if lists:
                found = [(f"{top}/{f}", n) for l in lists for f, n in json.loads(system.open_input_file(l.path).read())]
            else:
                found = [(n.path, n.size) for n in names if n.base_name.endswith((".warc", ".warc.gz"))]
        groups: list[list[str]] = []
        room = 0
        for path, size in sorted(found, key=lambda f: (-f[1], f[0])):
            if not groups or size > room:
                groups.append([])
                room = PARTITION_BYTES
            groups[-1].append(path)
            room -= size
        return [Files(g) for g in groups]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = open_folder(self.path)
        wanted = lambda headers: all(headers.get(k) in v for k, v in self.wanted.items())
        rows: list = []
        size = 0
        for path in partition.paths if partition else []:
            with system.open_input_file(path) as file:
                try:
                    for headers, payload in records(file, path.endswith(".gz"), wanted, self.with_payload):
                        rows.append((headers, payload))
                        size += len(payload or b"") + 1000
                        if size > BATCH_BYTES:
                            yield self._batch(rows)
                            rows, size = [], 0
                except (ValueError, zlib.error) as e:
                    raise ValueError(f"{path}: {e}") from e
        if rows:
            yield self._batch(rows)

    def _batch(self, rows: list) -> pa.RecordBatch:
        columns = [pa.array([h.get(name) for h, _ in rows], pa.string()) for name in FIELDS.values()]
        columns.append(pa.array([list(h.items()) for h, _ in rows], pa.map_(pa.string(), pa.string())))
        columns.append(pa.array([p for _, p in rows], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=[*FIELDS, "headers", "payload"])


class PushingWarcReader(WarcReader):
    def pushFilters(self, filters: list) -> Iterator:
        """Takes over equality and IN on the columns that are headers; the rest is left to Spark."""
        for f in filters:
            name = FIELDS.get(f.attribute[0]) if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if name is None:
                yield f
                continue
            values = [f.value] if isinstance(f, EqualTo) else list(f.value)
            self.wanted[name] = [v for v in self.wanted[name] if v in values] if name in self.wanted else values


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.packed, self.level = options["path"], str(options.get("compression", "gzip")) == "gzip", int(options.get("level", 3))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, top = open_folder(self.path)
        system.create_dir(top, recursive=True)
        done: list[tuple[str, int]] = []
        out, name, size = None, "", 0
        for batch in iterator:
            for values in batch.to_pylist():
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc{'.gz' * self.packed}", 0
                    out = system.open_output_stream(f"{top}/{name}", compression=None)
                data = record_bytes(values)
                data = gzip_member(data, self.level) if self.packed else data
                out.write(data)
                size += len(data)
                if size >= FILE_BYTES:
                    out.close()
                    done.append((name, size))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size))
        return Written(done)

    def commit(self, messages: list) -> None:
        system, top = open_folder(self.path)
        system.create_dir(top, recursive=True)
        with system.open_output_stream(f"{top}/{LIST}") as out:
            out.write(json.dumps(sorted(f for m in messages if m for f in m.files)).encode())

    def abort(self, messages: list) -> None:
        system, top = open_folder(self.path)
        for m in messages:
            for name, _ in m.files if m else []:
                system.delete_file(f"{top}/{name}")


class WarcDataSource(DataSource):
    """Options: path; reading: types (with commas), headers (JSON of lists by name), payload (true or false), pushdown
    (true only where the session has spark.sql.python.filterPushdown.enabled); writing: compression (gzip or none), level."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        kind = PushingWarcReader if self.options.get("pushdown", "false") == "true" else WarcReader
        return kind(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def read_warc(spark: SparkSession, path: str, types: list[str] | None = None, headers: dict[str, list[str]] | None = None, payload: bool = True) -> DataFrame:
    """Records of the archives in ``path`` (columns as SCHEMA) of the given types and with the given header values.

    These bounds hold in the reader without any setting; filters on the frame get there, too, where
    spark.sql.python.filterPushdown.enabled is set.
    """
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").option("payload", str(payload).lower()).option("headers", json.dumps(headers or {}))
    reader = reader.option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    return (reader.option("types", ",".join(types)) if types else reader).load(path)


def write_warc(rows: DataFrame, path: str, compression: str = "gzip") -> None:
    """Writes ``rows`` (columns as SCHEMA, in any order; others are left out) as archives into the new folder ``path``."""
    rows.sparkSession.dataSource.register(WarcDataSource)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    rows.select(names).write.format("warc").option("compression", compression).mode("append").save(path)
