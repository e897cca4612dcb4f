"""Token ids as files of bit or byte planes: ``spark.read.format("planes")`` and ``df.write.format("planes")``.

The ids of all documents of a file, one after the other, are cut into blocks of BLOCK_IDS. A block is transposed into
planes (its first bits, its second bits, ... or its first bytes, ...) and each plane is compressed with zstandard by itself; planes that are
all zero take no room. Behind the blocks stand the documents (keys and lengths, in planes, too) and the chunk index, from
which a reader learns what it has to read for the documents it wants.

Files are written by tasks under names of their own; only those of tasks that Spark commits come into the list by which
the folder is read, so that a task may be lost or run twice. The list also says how many ids come before each file.
"""

from __future__ import annotations

import json
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from tidelog.llm.pretokens import Pieces
from tidelog.llm.texts import map_texts

SCHEMA = "key bigint, start bigint, ids binary"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 26  # a file is closed beyond that
SECTION_DOCS = 1 << 16  # documents listed in one section of the index
PARTITION_BYTES = 16 << 20  # of text that one task writes, about
MOST_PARTITIONS = 1 << 15  # beyond that tasks write more than PARTITION_BYTES each, file after file
BATCH_BYTES = 4 << 20
LIST = "_planes.json"
MAGIC = b"PLANES01"
FOOTER = "<QQ8s"  # place and length of the index, mark
FOOTER_BYTES = struct.calcsize(FOOTER)


def split(values: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of unsigned numbers: of their bytes, or of their bits, lowest first."""
    parts = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    if bits:
        parts = np.unpackbits(parts, axis=1, bitorder="little")
        return [np.packbits(p, bitorder="little").tobytes() for p in parts.T]
    return [p.tobytes() for p in np.ascontiguousarray(parts.T)]


def joined(planes: list[bytes | None], n: int, kind: np.dtype, bits: bool) -> np.ndarray:
    """The ``n`` numbers of which ``split`` made the planes; None is a plane of zeros."""
    size = np.dtype(kind).itemsize
    out = np.zeros((n, size * 8 if bits else size), np.uint8)
    for i, plane in enumerate(planes):
        if plane is not None:
            raw = np.frombuffer(plane, np.uint8)
            out[:, i] = np.unpackbits(raw, count=n, bitorder="little") if bits else raw
    return (np.packbits(out, axis=1, bitorder="little") if bits else out).view(kind).ravel()


class FileWriter:
    """One file: documents in, blocks out as they fill up."""

    def __init__(self, out, bits: bool, level: int):
        self.out, self.bits, self.packer = out, bits, zstandard.ZstdCompressor(level=level)
        self.at, self.ids, self.held, self.waiting = 0, 0, [], 0
        self.blocks: list = []
        self.sections: list = []
        self.keys: list[int | None] = []
        self.lengths: list[int] = []
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _chunk(self, values: np.ndarray) -> list:
        """Writes the planes of the numbers; [place, how many numbers, length of each plane]."""
        place, sizes = self.at, []
        for plane in split(values, self.bits):
            data = self.packer.compress(plane) if plane.count(0) < len(plane) else b""
            sizes.append(len(data))
            self._write(data)
        return [place, len(values), sizes]

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids))
        self.held.append(ids)
        self.waiting += len(ids)
        self.ids += len(ids)
        if self.waiting >= BLOCK_IDS:
            held = np.concatenate(self.held)
            whole = len(held) - len(held) % BLOCK_IDS
            for i in range(0, whole, BLOCK_IDS):
                self.blocks.append(self._chunk(held[i : i + BLOCK_IDS]))
            self.held, self.waiting = [held[whole:].copy()], len(held) - whole
        if len(self.keys) >= SECTION_DOCS:
            self._section()

    def _section(self) -> None:
        keys = np.array([0 if k is None else k for k in self.keys], "<i8")
        null = np.array([k is None for k in self.keys])
        lengths = np.array(self.lengths, "<u8")
        bounds = [int(keys[~null].min()), int(keys[~null].max())] if not null.all() else None
        first = self.ids - int(lengths.sum())
        chunks = [self._chunk(x) for x in (keys.view("<u8"), null.astype("<u1"), lengths)]
        self.sections.append({"first": first, "keys": bounds, "null": bool(null.any()), "chunks": chunks})
        self.keys, self.lengths = [], []

    def close(self) -> dict:
        if self.waiting:
            self.blocks.append(self._chunk(np.concatenate(self.held)))
        if self.keys:
            self._section()
        index = self.packer.compress(json.dumps({"bits": self.bits, "block": BLOCK_IDS, "blocks": self.blocks, "sections": self.sections}).encode())
        place = self.at
        self._write(index)
        self._write(struct.pack(FOOTER, place, len(index), MAGIC))
        self.out.close()
        bounds = [s["keys"] for s in self.sections if s["keys"]]
        return {
            "ids": self.ids,
            "bytes": self.at,
            "keys": [min(b[0] for b in bounds), max(b[1] for b in bounds)] if bounds else None,
            "null": any(s["null"] for s in self.sections),
        }


class FileReader:
    """The documents of one file, in blocks that are read when they are wanted."""

    def __init__(self, file):
        self.file, self.opener = file, zstandard.ZstdDecompressor()
        end = file.size()
        place, size, mark = struct.unpack(FOOTER, self._read(end - FOOTER_BYTES, FOOTER_BYTES)) if end >= FOOTER_BYTES else (0, 0, b"")
        if mark != MAGIC:
            raise ValueError("not a file of planes, or not whole")
        index = json.loads(self.opener.decompress(self._read(place, size)))
        self.bits, self.block, self.blocks, self.sections = (index[k] for k in ("bits", "block", "blocks", "sections"))
        self.known: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _read(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def _chunk(self, chunk: list, kind: str) -> np.ndarray:
        place, n, sizes = chunk
        data, at, planes = self._read(place, sum(sizes)), 0, []
        for size in sizes:
            planes.append(self.opener.decompress(data[at : at + size]) if size else None)
            at += size
        return joined(planes, n, np.dtype(kind), self.bits)

    def _ids(self, first: int, n: int) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        parts = []
        while n:
            i, skip = divmod(first, self.block)
            if self.known[0] != i:
                self.known = (i, self._chunk(self.blocks[i], "<u4"))
            part = self.known[1][skip : skip + n]
            parts.append(part.tobytes())
            first, n = first + len(part), n - len(part)
        return b"".join(parts)

    def documents(self, low: int | None, high: int | None) -> Iterator[tuple[int | None, int, bytes]]:
        """(key, ids before it in the file, its ids) of documents with keys from ``low`` to ``high``; without bounds, of all."""
        for section in self.sections:
            if not wanted(section["keys"], section["null"], low, high):
                continue
            keys, null, lengths = (self._chunk(c, k) for c, k in zip(section["chunks"], ("<u8", "<u1", "<u8")))
            firsts = section["first"] + np.cumsum(lengths.astype(np.int64)) - lengths.astype(np.int64)
            for key, none, first, n in zip(keys.view("<i8").tolist(), null.tolist(), firsts.tolist(), lengths.tolist()):
                if wanted(None if none else [key, key], bool(none), low, high):
                    yield None if none else key, first, self._ids(first, n)


def wanted(keys: list[int] | None, null: bool, low: int | None, high: int | None) -> bool:
    """Can one of the keys between the two ``keys``, or null if there are such, lie within the bounds? Null only does without any."""
    if low is None and high is None:
        return True
    return keys is not None and (low is None or keys[1] >= low) and (high is None or keys[0] <= high)


@dataclass
class Written(WriterCommitMessage):
    partition: int
    files: list[tuple[str, dict]]


class PlanesWriter(DataSourceArrowWriter):
    """Rows (key, ids) in the order they come; the order of the files is that of the partitions."""

    def __init__(self, options: dict):
        self.path, self.bits, self.level = options["path"], options.get("planes", "bytes") == "bits", int(options.get("level", 3))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, top = fs.FileSystem.from_uri(self.path)
        system.create_dir(top, recursive=True)
        done: list[tuple[str, dict]] = []
        out, name = None, ""
        for batch in iterator:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids")):
                if out is None:
                    name = f"{uuid.uuid4().hex}.planes"
                    out = FileWriter(system.open_output_stream(f"{top}/{name}", compression=None), self.bits, self.level)
                data = ids.as_buffer()
                out.add(key, np.frombuffer(data, "<u4") if data is not None and data.size else np.zeros(0, "<u4"))
                if out.ids >= FILE_IDS:
                    done.append((name, out.close()))
                    out = None
        if out is not None:
            done.append((name, out.close()))
        return Written(TaskContext.get().partitionId(), done)

    def commit(self, messages: list) -> None:
        system, top = fs.FileSystem.from_uri(self.path)
        system.create_dir(top, recursive=True)
        files, start = [], 0
        for message in sorted((m for m in messages if m), key=lambda m: m.partition):
            for name, facts in message.files:
                files.append({"name": name, "start": start, **facts})
                start += facts["ids"]
        with system.open_output_stream(f"{top}/{LIST}") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list) -> None:
        system, top = fs.FileSystem.from_uri(self.path)
        for m in messages:
            for name, _ in m.files if m else []:
                system.delete_file(f"{top}/{name}")


@dataclass
class File(InputPartition):
    name: str
    start: int


class PlanesReader(DataSourceReader):
    """A task reads a file; those without a wanted key are left out."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.low, self.high = (int(options[k]) if k in options else None for k in ("low", "high"))

    def partitions(self) -> list[File]:
        system, top = fs.FileSystem.from_uri(self.path)
        with system.open_input_file(f"{top}/{LIST}") as file:
            files = json.loads(file.read())
        return [File(f["name"], f["start"]) for f in files if wanted(f["keys"], f["null"], self.low, self.high)]

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:
            return
        system, top = fs.FileSystem.from_uri(self.path)
        with system.open_input_file(f"{top}/{partition.name}") as file:
            rows, size = [], 0
            for key, first, ids in FileReader(file).documents(self.low, self.high):
                rows.append((key, partition.start + first, ids))
                size += len(ids) + 100
                if size > BATCH_BYTES:
                    yield self._batch(rows)
                    rows, size = [], 0
            if rows:
                yield self._batch(rows)

    def _batch(self, rows: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["key", "start", "ids"])


class PushingPlanesReader(PlanesReader):
    def pushFilters(self, filters: list) -> Iterator:
        """Takes over bounds on the key; the rest is left to Spark."""
        for f in filters:
            if not isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual) or f.attribute != ("key",) or not isinstance(f.value, int):
                yield f
                continue
            if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                low = f.value + isinstance(f, GreaterThan)
                self.low = low if self.low is None else max(self.low, low)
            if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                high = f.value - isinstance(f, LessThan)
                self.high = high if self.high is None else min(self.high, high)


class PlanesDataSource(DataSource):
    """Options: path; writing: planes (bytes or bits), level; reading: low, high (bounds of keys, inclusive), pushdown."""

    @classmethod
    def name(cls) -> str:
        return "planes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PlanesReader:
        return (PushingPlanesReader if self.options.get("pushdown", "false") == "true" else PlanesReader)(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> PlanesWriter:
        return PlanesWriter(self.options)


def write_ids(rows: DataFrame, path: str, planes: str = "bytes", level: int = 3) -> None:
    """Writes ``rows`` (key, ids: little-endian unsigned 32-bit numbers) into the new folder ``path``, partition by
    partition, in the order they have. A key may be null or repeated; ids may be empty."""
    rows.sparkSession.dataSource.register(PlanesDataSource)
    picked = rows.select(F.col("key").cast("bigint").alias("key"), F.lit(0).cast("bigint").alias("start"), F.coalesce("ids", F.lit(b"")).alias("ids"))
    picked.write.format("planes").option("planes", planes).option("level", level).mode("append").save(path)


def read_ids(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """(key, start, ids) of the documents in ``path`` with keys from ``low`` to ``high``: ``start`` ids stand before it in the folder.

    Files, sections and blocks without such keys are not read. Bounds on the frame's key get there, too, where
    spark.sql.python.filterPushdown.enabled is set.
    """
    spark.dataSource.register(PlanesDataSource)
    reader = spark.read.format("planes").option("pushdown", spark.conf.get("spark.sql.python.filterPushdown.enabled", "false"))
    for name, bound in (("low", low), ("high", high)):
        reader = reader if bound is None else reader.option(name, bound)
    return reader.load(path)


def encoded(docs: DataFrame, text: str, key: str, path: str, end: int) -> DataFrame:
    """(key, ids) of all documents in ascending order of ``key`` (whole numbers; null first): the ids the word-level tokenizer at ``path`` makes of
    the text, without special tokens, and then ``end``. Null and empty texts are the end alone.

    Texts are dealt by ranges of the key, so that each task tokenizes and writes one run of documents; rows of one
    key stand in the order of a hash of their texts, and equal rows, too, are dealt to several tasks if they are many.
    """
    worker: dict[str, Pieces] = {}

    def compute(texts: pa.Array) -> list[pa.Array]:
        if path not in worker:
            worker[path] = Pieces(path, words=True)
        return [pa.array([np.r_[ids, np.uint32(end)].astype("<u4").tobytes() for ids in worker[path].ids(texts)], pa.binary())]

    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("key"), F.col(f"`{text}`").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = docs.sparkSession.sparkContext.defaultParallelism
    n = min(max(size // PARTITION_BYTES, least) + 1, MOST_PARTITIONS)
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("row_number", F.monotonically_increasing_id())
    order = ["key", "hash", "row_number"]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return map_texts(rows, "text", ["key"], [StructType.fromDDL("ids binary")["ids"]], compute).select("row.key", "ids")
