import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from tidelog.functions.records import message_envelope
from tidelog.session import shared_dir
from tidelog.sources import databases, messages, sinks


def test_messages_from_files_skip_what_cannot_be_read(spark, tmp_path):
    lines = [
        '{"Type":"INSERT","Database":"d","Table":"t","Timestamp":5,"Data":{"a":1,"b":null}}',
        '{"Type":"UPDATE","Database":"d","Table":"t","Timestamp":"6"}',
        ' {"Database":"d"}',
        '{"Type":',
        "[1]",
        "null",
        "plain",
        '{"Type":"X","Timestamp":"soon"}',
    ]
    (tmp_path / "m.txt").write_text("\n".join(lines) + "\n")
    good = messages.read_change_messages(spark, "text", {"path": str(tmp_path)}, stream=False).collect()
    assert [(r.Type, r.Timestamp, r.Data) for r in good] == [
        ("INSERT", 5, {"a": "1", "b": None}), ("UPDATE", 6, None), (None, None, None),
    ]
    raw = messages.read_raw(spark, "text", {"path": str(tmp_path)}, stream=False)
    assert [r.value for r in messages.quarantine(raw).collect()] == lines[3:]
    stream = messages.read_change_messages(spark, "text", {"path": str(tmp_path)})
    query = stream.writeStream.format("memory").queryName("read_messages").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("read_messages").count() == 3


def test_messages_from_a_broker_know_their_place(spark):
    raw = spark.createDataFrame([(b"{}", "t", 3, 77)], "value binary, topic string, partition int, offset bigint")
    row = messages.parse_messages(raw.withColumn("value", F.col("value").cast("string"))).first()
    assert (row.KafkaTopic, row.KafkaOffset) == ("t/3", 77)


def test_jdbc_options():
    options = databases.jdbc_options("jdbc:x", "select 1", session_sql=["set a=1", "set b=2"], user="u")
    assert options == {
        "url": "jdbc:x", "fetchsize": "1000", "queryTimeout": "3600", "query": "select 1",
        "sessionInitStatement": "set a=1; set b=2", "user": "u",
    }
    split = databases.jdbc_options("jdbc:x", "select 1", split=("id", "0", "100", 8))
    assert split["dbtable"] == "(select 1) q" and split["numPartitions"] == "8" and "query" not in split


def test_catalog_of_queries(spark):
    df = spark.sql("select cast(1 as bigint) a, 'x' b, cast(1 as decimal(5,2)) c, array(1) d").limit(0)
    rows = databases.catalog_of(spark, {("d", "t"): df}).orderBy("ordinal").collect()
    assert [(r.column, r.mysql_type) for r in rows] == [("a", "bigint"), ("b", "text"), ("c", "decimal(5,2)"), ("d", "unsupported")]
    assert databases.catalog_of(spark, {}).count() == 0


def orders(spark, *rows):
    return spark.createDataFrame([(i, n, dt.date.fromisoformat(d)) for i, n, d in rows], "cust int, no int, made date")


def times(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_documents_are_upserted_by_id_and_shard(spark, tmp_path):
    path = str(tmp_path / "docs")
    write = sinks.write_documents(path, ["_id", "no", "made"], "_id", "no", "made")
    write(orders(spark, (1, 1, "2020-01-01"), (1, 2, "2020-05-01"), (2, 3, "2020-06-01"), (3, 4, "2021-01-01")), 0)
    untouched = times(f"{path}/shard=2021")
    second = orders(spark, (2, 9, "2020-07-01"), (5, 5, "2020-07-01"), (1, 1, "2020-01-01"))
    for batch_id in (1, 1):  # a repeated batch changes nothing
        write(second, batch_id)
        got = sorted((r._id, r.no, r.shard) for r in spark.read.parquet(path).collect())
        assert got == [(1, 2, 2020), (2, 9, 2020), (3, 4, 2021), (5, 5, 2020)]
    assert untouched == times(f"{path}/shard=2021")


def size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_a_small_batch_writes_little(spark, tmp_path):
    path = str(tmp_path / "runs")
    write = sinks.write_document_runs(path, ["_id", "no", "made"], "_id", "no", "made")
    rows = spark.range(50_000).selectExpr("cast(id as int) as cust", "cast(id as int) as no", "date_add(date'2020-01-01', cast(id % 700 as int)) as made")
    write(rows, 0)
    before = times(f"{path}/runs/0")
    write(orders(spark, (2, 60_000, "2020-07-01"), (70_000, 1, "2021-07-01"), (5, -1, "2020-01-06")), 1)
    assert times(f"{path}/runs/0") == before and size(f"{path}/runs/1") * 100 < size(f"{path}/runs/0")
    got = sinks.read_documents(spark, path, "_id", "no")
    assert got.count() == 50_001
    assert sorted((r._id, r.no) for r in got.where("_id in (2, 5, 70000)").collect()) == [(2, 60_000), (5, 5), (70_000, 1)]


def test_runs_are_merged_as_they_grow(spark, tmp_path):
    path, draw, want = str(tmp_path / "runs"), random.Random(3), {}
    write = sinks.write_document_runs(path, ["_id", "no", "made"], "_id", "no", "made")
    assert sinks.read_documents(spark, path, "_id", "no") is None
    for batch_id in range(9):
        # the date follows from the id, so that a batch has one row per id and shard; numbers tie and go back
        batch = {i: (draw.randrange(6), batch_id) for i in draw.sample(range(60), draw.choice([0, 3, 12]) if batch_id else 40)}
        rows = [(i, n, dt.date(2020 + i % 3, 1, 1)) for i, (n, _) in batch.items()]
        write(spark.createDataFrame(rows, "cust int, no int, made date"), batch_id)
        want.update({i: v for i, v in batch.items() if v >= want.get(i, (-1, -1))})
        got = sinks.read_documents(spark, path, "_id", "no").collect()
        assert sorted((r._id, r.no, r.shard) for r in got) == sorted((i, n, 2020 + i % 3) for i, (n, _) in want.items())
        last = max(int(os.path.basename(f)) for f in glob.glob(f"{path}/versions/*"))
        sizes = [n for _, n in sinks._runs(spark, path, last)]
        assert all(a >= 4 * sum(sizes[k + 1 :]) or k + 1 == len(sizes) for k, a in enumerate(sizes))
        assert len(glob.glob(f"{path}/runs/*")) <= 2 * len(sizes) + 2 and len(glob.glob(f"{path}/versions/*")) <= 2
    files = times(path)
    write(orders(spark, (1, 99, "2021-01-01")), last)  # repeated: it was written already
    assert times(path) == files
    with pytest.raises(ValueError, match="another stream"):
        write(orders(spark, (1, 99, "2021-01-01")), last - 1)


def test_a_batch_cut_short_is_written_anew(spark, tmp_path):
    path = str(tmp_path / "runs")
    write = sinks.write_document_runs(path, ["_id", "no", "made"], "_id", "no", "made")
    write(orders(spark, (1, 1, "2020-01-01"), (2, 2, "2020-01-01")), 0)
    orders(spark, (9, 9, "2020-01-01")).write.parquet(f"{path}/runs/1")  # a run that no list names
    assert sinks.read_documents(spark, path, "_id", "no").count() == 2
    write(orders(spark, (1, 3, "2020-01-01")), 1)
    assert sorted((r._id, r.no) for r in sinks.read_documents(spark, path, "_id", "no").collect()) == [(1, 3), (2, 2)]


def test_lanes(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None), (4, ["b"])], "id int, lanes array<string>")
    path = str(tmp_path / "lanes")
    sinks.write_lanes(df, path, ["a", "b", "c"])
    ids = lambda lane: sorted(r.id for r in spark.read.parquet(f"{path}/lane={lane}").collect())
    assert (ids("a"), ids("b"), ids("c"), ids("default")) == ([1], [1, 4], [], [2, 3])
    sinks.write_lanes(df.filter("id = 2"), str(tmp_path / "single"), ["only"])
    assert spark.read.parquet(str(tmp_path / "single")).first().lane == "only"


def test_message_rows(spark):
    df = spark.createDataFrame(
        [("INSERT", "d", "t", 1, "x"), ("INSERT", "d", "u", 1, None)], "Type string, Database string, Table string, Timestamp bigint, topic string"
    )
    assert [tuple(r) for r in sinks.messages(df).collect()] == [
        ("x", "d.t", '{"Type":"INSERT","Database":"d","Table":"t","Timestamp":1}')
    ]
    assert '"Data"' not in df.select(message_envelope(None)).first()[0]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "a", "b") == f"{named}/a/b"
