"""Archives: round trips, skipped payloads, predicates, files of others, committed files only."""

import gzip
import io
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.llm import warc
from tidelog.llm.warc import gzip_member, read_warc, record_bytes, records, write_warc

ROW = "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, headers map<string,string>, payload binary, headers2 string"


def rows():
    big = ("é" * 70000).encode()
    return [
        ("response", "<1>", "http://a/x?y=1", "2020-01-01T00:00:00Z", None, "sha256:1", {"X-Page-Id": "1"}, b"<html>\r\n\r\nWARC/1.1\r\n", "x"),
        ("revisit", "<2>", "http://b", "2020-01-02T00:00:00Z", "<1>", "sha256:1", {"X-Page-Id": "2"}, None, None),
        ("response", "<3>", None, None, None, None, {}, b"", None),
        ("response", "<4>", "http://c/\r\nX: y", None, None, None, None, big, None),
        ("resource", "<5>", "http://d", None, None, None, {"a": "b c"}, b"plain\r\n\r\nblock", None),
        (None, "<6>", "http://d", None, None, None, None, None, None),
        ("response", "<3>", None, None, None, None, {}, b"", None),
    ]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, tmp_path, compression, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 100)
    folder = f"{tmp_path}/{compression}"
    write_warc(spark.createDataFrame(rows(), ROW), folder, compression)
    got = sorted((r.record_id, r.record_type, r.target_uri, r.refers_to, bytes(r.payload)) for r in read_warc(spark, folder).collect())
    want = sorted((r[1], r[0] or "resource", (r[2] or "").replace("\r\n", "%0D%0A") or None, r[4], r[7] or b"") for r in rows())
    assert got == want
    one = read_warc(spark, folder).where("record_id = '<1>'").first()
    assert one.headers["X-Page-Id"] == "1" and one.payload_digest == "sha256:1" and one.date == "2020-01-01T00:00:00Z"
    assert {r.record_id for r in read_warc(spark, folder, types=["revisit"]).collect()} == {"<2>"}
    assert {r.record_id for r in read_warc(spark, folder, headers={"X-Page-Id": ["1", "2"], "WARC-Record-ID": ["<2>"]}).collect()} == {"<2>"}
    assert {r.payload for r in read_warc(spark, folder, payload=False).collect()} == {None}
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        some = read_warc(spark, folder).where(F.col("record_type").isin("response", "revisit") & (F.col("target_uri") == "http://b"))
        assert [r.record_id for r in some.collect()] == ["<2>"]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_empty_table(spark, tmp_path):
    write_warc(spark.createDataFrame([], ROW), f"{tmp_path}/none")
    assert read_warc(spark, f"{tmp_path}/none").collect() == []


class Counted(io.BytesIO):
    """A file that knows how much was read of it."""

    taken = 0

    def read(self, n=-1):
        out = super().read(n)
        self.taken += len(out)
        return out

    def size(self):
        return len(self.getbuffer())


def encoded(packed):
    values = [dict(zip([f.split()[0] for f in ROW.split(", ")], r)) for r in rows()]
    for v in values:
        v["headers"] = list((v["headers"] or {}).items())
    values[3]["payload"] = os.urandom(300000)
    data = [record_bytes(v) for v in values]
    return b"".join(gzip_member(d, 3) if packed else d for d in data), data


@pytest.mark.parametrize("packed", [True, False])
def test_unwanted_payloads_are_not_read(packed):
    data, _ = encoded(packed)
    file = Counted(data)
    got = [h["WARC-Record-ID"] for h, _ in records(file, packed, lambda h: h["WARC-Record-ID"] in ("<1>", "<3>", "<5>"), True)]
    assert got == ["<1>", "<3>", "<5>", "<3>"] and file.taken < len(data) - 150000


def test_members_without_skip_lengths_and_with_other_headers():
    _, parts = encoded(True)
    parts.append(b"WARC/1.0\r\nWARC-Type: metadata\r\nX-Long: one\r\n  two\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    data = b"".join(gzip.compress(p) for p in parts)
    for wanted in (lambda h: True, lambda h: h.get("WARC-Type") == "metadata"):
        *_, (headers, payload) = records(Counted(data), True, wanted, True)
        assert headers["X-Long"] == "one two" and payload == b"abc"
    assert len(list(records(Counted(data), True, lambda h: True, True))) == 8
    assert len(list(records(Counted(b"".join(parts)), False, lambda h: True, False))) == 8


def test_members_are_gzip():
    data, parts = encoded(True)
    assert gzip.decompress(data) == b"".join(parts)


@pytest.mark.parametrize("packed", [True, False])
def test_cut_files_are_told(packed):
    data, _ = encoded(packed)
    with pytest.raises(ValueError):
        list(records(Counted(data[:200000]), packed, lambda h: True, True))


def test_files_that_were_not_committed_are_not_read(spark, tmp_path):
    folder = f"{tmp_path}/part"
    write_warc(spark.createDataFrame(rows(), ROW), folder)
    (tmp_path / "part" / "lost.warc").write_bytes(record_bytes({**dict.fromkeys(["date", "refers_to", "payload_digest", "target_uri"]), "record_type": "response", "record_id": "<lost>", "payload": b"", "headers": None}))
    assert "<lost>" not in {r.record_id for r in read_warc(spark, folder).collect()}
    assert [r.record_id for r in read_warc(spark, f"{folder}/lost.warc").collect()] == ["<lost>"]


def test_query_on_equal_pages(spark, tmp_path):
    from tidelog.llm.queries import QUERIES

    same, short = "x" * 100, "x" * 99
    pages = [(5, "u", same), (3, None, same), (9, "v", same), (None, "w", same), (1, "u", short), (2, "u", short), (4, "u", None), (6, "u", ""), (3, None, same), (None, "a", "é" * 60), (None, "b", "é" * 60)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("payload", F.lit(1)).write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op2_warc"](spark, str(tmp_path)).collect()
    found = sorted(((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=str)
    assert found == sorted(
        [(5, 100, "revisit", 3), (3, 100, "response", None), (9, 100, "revisit", 3), (0, 100, "revisit", 3), (1, 99, "response", None), (2, 99, "response", None), (4, 0, "response", None), (6, 0, "response", None), (3, 100, "response", None), (0, 120, "response", None), (0, 120, "response", None)],
        key=str,
    )
    assert pa.array([r.payload_digest for r in got]).null_count == 0
