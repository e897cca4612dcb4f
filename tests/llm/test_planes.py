"""Files of planes: round trips, ranges of keys, what a reader reads, committed files only, and texts against the library."""

import io
import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from common import documents
from pyspark.sql import functions as F

from tidelog.llm import planes
from tidelog.llm.planes import FileReader, FileWriter, encoded, joined, read_ids, split, write_ids
from tidelog.llm.pretokens import load
from tidelog.llm.queries import QUERIES, TOKENIZERS

WORD = f"{TOKENIZERS}/word_bpe_49k.json"
SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("kind", ["<u1", "<u4", "<u8"])
def test_planes_round_trip(bits, kind):
    draw = np.random.default_rng(1)
    for n in (1, 7, 8, 1000):
        values = draw.integers(0, min(2 ** (8 * np.dtype(kind).itemsize), 1 << 62), n, dtype=np.uint64).astype(kind)
        made = split(values, bits)
        assert len(made) == np.dtype(kind).itemsize * (8 if bits else 1)
        assert (joined(made, n, np.dtype(kind), bits) == values).all()
    assert split(np.array([1, 2, 258], "<u4"), False) == [b"\1\2\2", b"\0\0\1", b"\0\0\0", b"\0\0\0"]
    assert split(np.array([1, 3, 0], "<u1"), True)[:2] == [b"\3", b"\2"]


class Counted(io.BytesIO):
    """A file that knows how much was read of it."""

    taken = 0

    def size(self):
        return len(self.getvalue())

    def read(self, n=-1):
        data = super().read(n)
        self.taken += len(data)
        return data


class Kept(io.BytesIO):
    def close(self):
        self.kept = self.getvalue()


@pytest.mark.parametrize("bits", [False, True])
def test_file(monkeypatch, bits):
    monkeypatch.setattr(planes, "BLOCK_IDS", 100)
    monkeypatch.setattr(planes, "SECTION_DOCS", 10)
    draw = np.random.default_rng(2)
    docs = [(None, [9]), (None, [])] + [(i // 2 - 50, draw.integers(0, 49408, draw.integers(0, 60)).tolist()) for i in range(200)]
    docs.append((100, list(range(1000))))  # longer than several blocks
    out = Kept()
    writer = FileWriter(out, bits, 3)
    for key, ids in docs:
        writer.add(key, np.array(ids, "<u4"))
    facts = writer.close()
    assert facts["ids"] == sum(len(i) for _, i in docs) and facts["keys"] == [-50, 100] and facts["null"] and facts["bytes"] == len(out.kept)
    starts = np.cumsum([0] + [len(i) for _, i in docs])
    want = [(k, s, i) for (k, i), s in zip(docs, starts.tolist())]
    read = lambda low, high, file: [(k, s, np.frombuffer(i, "<u4").tolist()) for k, s, i in FileReader(file).documents(low, high)]
    assert read(None, None, Counted(out.kept)) == want
    for low, high in ((0, 3), (-50, -50), (100, None), (None, -49), (7, 6), (200, 300)):
        some = [w for w in want if w[0] is not None and (low is None or w[0] >= low) and (high is None or w[0] <= high)]
        file = Counted(out.kept)
        assert read(low, high, file) == some
    file = Counted(out.kept)
    read(3, 3, file)
    assert file.taken < len(out.kept) / 3
    with pytest.raises(ValueError):
        FileReader(Counted(out.kept[:-1]))
    with pytest.raises(ValueError):
        FileReader(Counted(b""))


def rows_of(frame):
    return sorted((r.start, r.key, np.frombuffer(r.ids, "<u4").tolist()) for r in frame.collect())


@pytest.mark.parametrize("kind", ["bytes", "bits"])
def test_folder(spark, tmp_path, monkeypatch, kind):
    draw = np.random.default_rng(3)
    docs = [(i, np.array(draw.integers(0, 2**32, draw.integers(0, 30)), "<u4")) for i in range(300)]
    frame = spark.createDataFrame([(k, i.tobytes(), "x", 0) for k, i in docs], "key int, ids binary, extra string, start int")
    write_ids(frame.repartitionByRange(4, "key").sortWithinPartitions("key"), f"{tmp_path}/a", planes=kind)
    starts = np.cumsum([0] + [len(i) for _, i in docs]).tolist()
    want = sorted((s, k, i.tolist()) for (k, i), s in zip(docs, starts))
    assert rows_of(read_ids(spark, f"{tmp_path}/a")) == want
    some = [w for w in want if 20 <= w[1] <= 30]
    assert rows_of(read_ids(spark, f"{tmp_path}/a", 20, 30)) == some
    assert len(planes.PlanesReader({"path": f"{tmp_path}/a", "low": 20, "high": 30}).partitions()) == 1
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        assert rows_of(read_ids(spark, f"{tmp_path}/a").where((F.col("key") >= 20) & (F.col("key") < 31))) == some
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_files_are_closed_and_only_committed_ones_count(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(planes, "FILE_IDS", 50)
    docs = [(i, b"\1\0\0\0" * 20) for i in range(20)]
    names = ["key", "start", "ids"]
    writer = planes.PlanesWriter({"path": f"{tmp_path}/b"})
    monkeypatch.setattr(planes.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": lambda self: 3})()))
    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in docs], pa.int64()), pa.array([0] * 20, pa.int64()), pa.array([i for _, i in docs], pa.binary())], names=names)
    lost, done = writer.write(iter([batch])), writer.write(iter([batch]))
    assert len(done.files) == 7 and {f[0] for f in lost.files}.isdisjoint(f[0] for f in done.files)
    writer.commit([None, done])
    listed = json.load(open(f"{tmp_path}/b/{planes.LIST}"))
    assert [f["start"] for f in listed] == [60 * i for i in range(7)]
    assert len(rows_of(read_ids(spark, f"{tmp_path}/b"))) == 20
    writer.abort([lost])
    assert len(os.listdir(f"{tmp_path}/b")) == 8


def test_empty_table(spark, tmp_path):
    write_ids(spark.createDataFrame([], "key bigint, ids binary"), f"{tmp_path}/none")
    assert read_ids(spark, f"{tmp_path}/none").collect() == []


@pytest.mark.skipif(not os.path.exists(WORD), reason="tokenizers not there")
def test_texts_against_the_library(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(planes, "PARTITION_BYTES", 1000)
    texts = [None, "", "short one", "many words " * 20000, "x <|endoftext|> y", "漢字", "short one", "another"] + ["same"] * 300
    ids = [5, 7, 7, -3, None, 12, 7, 40] + [7] * 300
    library = load(WORD)
    frame = documents(spark, texts, ids, extra="key,ids,hash,row_number,start")
    write_ids(encoded(frame, "text", "doc_id", WORD, 2), f"{tmp_path}/texts")
    got = rows_of(read_ids(spark, f"{tmp_path}/texts"))
    want = [(k, library.encode(t or "", add_special_tokens=False).ids + [2]) for k, t in zip(ids, texts)]
    assert sorted((k is not None, k or 0, i) for _, k, i in got) == sorted((k is not None, k or 0, i) for k, i in want)
    keys = [k for _, k, _ in got]
    assert keys[0] is None and keys[1:] == sorted(keys[1:])
    ends = np.cumsum([0] + [len(i) for _, _, i in got]).tolist()
    assert [s for s, _, _ in got] == ends[:-1]


@pytest.mark.skipif(not os.path.isdir(SF_DIR) or not os.path.exists(WORD), reason="test tables not there")
def test_query(spark):
    library, at, want = load(WORD), 0, []
    for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = QUERIES["op12_token_files"](spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want
