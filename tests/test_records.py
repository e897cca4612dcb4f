import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidelog.functions import records as R
from tidelog.operators import records as X
from tidelog.operators import enrich as E

SCHEMA = (
    "pos bigint, event_type string, db string, tbl string, server_id bigint, ts timestamp, binlog_file string, "
    "columns array<string>, included array<int>, included_before array<int>, "
    "rows array<struct<before:array<string>,after:array<string>>>"
)
AT = dt.datetime(2016, 8, 18, 12, 1, 2)


def events(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_multi_row_delete(spark):
    rows = [([str(i)], None) for i in range(10)]
    df = events(spark, (9, "DELETE_ROWS", "test", "foo", 1, AT, "bin.000001", ["bar"], [], [0], rows))
    got = X.to_records(df).orderBy("row_no").collect()
    assert [r.OldData["bar"] for r in got] == [str(i) for i in range(10)]
    assert {r.Type for r in got} == {"DELETE"} and all(r.Data is None for r in got)
    assert {(r.Offset, r.BinLogFilename, r.BinLogPosition) for r in got} == {("bin.000001:9", "bin.000001", 9)}
    notices = X.to_notices(df)
    assert notices.count() == 10 and notices.distinct().count() == 1
    assert notices.columns == list(R.HEADER_FIELDS)


def test_partial_update_keeps_each_bitmap(spark):
    df = events(
        spark,
        (1, "WRITE_ROWS", "test", "foo2", 1, AT, "b.1", ["a", "b", "c"], [0, 1, 2], [], [(None, ["1", "2", "3"])]),
        (2, "UPDATE_ROWS", "test", "foo2", 1, AT, "b.1", ["a", "b", "c"], [0, 2], [0, 1, 2], [(["1", "2", "3"], ["11", "33"])]),
    )
    insert, update = X.to_records(df).orderBy("BinLogPosition").collect()
    assert insert.Data == {"a": "1", "b": "2", "c": "3"} and insert.OldData is None
    assert update.Data == {"a": "11", "c": "33"} and update.OldData == {"a": "1", "b": "2", "c": "3"}
    assert [R.OPERATION_CODES[r.Type] for r in (insert, update)] == [1, 3]


def test_columns_beyond_the_catalog_get_a_name(spark):
    df = spark.createDataFrame([([0, 70], ["a"], ["x", "y"])], "i array<int>, n array<string>, v array<string>")
    assert df.select(R.zip_columns("i", "n", "v")).first()[0] == {"a": "x", "col_70": "y"}


ALL_TYPES = [
    ("_decimal", "decimal", "1", Decimal(1)),
    ("_tinyint", "tinyint(4)", "2", 2),
    ("_smallint", "smallint(6)", "3", 3),
    ("_mediumint", "mediumint(9)", "4", 4),
    ("_float", "float", "5.1", pytest.approx(5.1, rel=1e-6)),
    ("_double", "double", "6.1", 6.1),
    ("_timestamp", "timestamp", "2016-08-18 12:01:02", AT),
    ("_bigint", "bigint(20)", "7", 7),
    ("_int", "int(11)", "8", 8),
    ("_date", "date", "2016-08-18", dt.date(2016, 8, 18)),
    ("_time", "time", "12:01:02", "12:01:02"),
    ("_datetime", "datetime", "2016-08-18 12:01:02", AT),
    ("_year", "year(4)", "2016", 2016),
    ("_varchar", "varchar(10)", "A", "A"),
    ("_enum", "enum('a','b','c')", "1", 1),
    ("_set", "set('1','2','3')", "1", 1),
    ("_tinyblob", "tinyblob", "1", b"1"),
    ("_mediumblob", "mediumblob", "2", b"2"),
    ("_longblob", "longblob", "3", b"3"),
    ("_blob", "blob", "4", b"4"),
    ("_text", "text", "text", "text"),
    ("_tinytext", "tinytext", "text2", "text2"),
    ("_mediumtext", "mediumtext", "text3", "text3"),
    ("_longtext", "longtext", None, None),
    ("_json", "json", "{}", "{}"),
]


def test_all_types(spark):
    names = [t[0] for t in ALL_TYPES]
    df = events(
        spark,
        (1, "WRITE_ROWS", "test", "t", 1, AT, "b.1", names, list(range(len(names))), [], [(None, [t[2] for t in ALL_TYPES])]),
    )
    typed = X.to_records(df).select(R.cast_image("Data", [(n, k) for n, k, _, _ in ALL_TYPES]).alias("v")).first().v
    assert [bytes(v) if isinstance(v, bytearray) else v for v in typed] == [t[3] for t in ALL_TYPES]


def test_missing_metadata_falls_back_to_text_columns(spark):
    log = spark.createDataFrame([("test", "foo", 3), ("test", "bar", 2)], "db string, tbl string, n int")
    catalog = spark.createDataFrame(
        [("test", "bar", 1, "b", "int"), ("test", "bar", 0, "a", "int(10) unsigned")],
        "db string, tbl string, ordinal int, column string, mysql_type string",
    )
    got = {r.tbl: r for r in E.enrich_columns(log, catalog, F.col("n")).collect()}
    assert got["foo"].columns == ["col_0", "col_1", "col_2"] and got["foo"].column_types == ["text"] * 3
    assert got["bar"].columns == ["a", "b"] and got["bar"].has_metadata and not got["foo"].has_metadata


def test_types_by_name(spark):
    names = ["int(10) unsigned", "int unsigned", "JSON", "VARCHAR(9)", "binary", "varbinary(3)", "point", "DECIMAL(5,2)"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(R.normalize_type("n")).collect()] == [
        "int", "unsupported", "unsupported", "varchar", "unsupported", "unsupported", "unsupported", "decimal",
    ]
    assert R.spark_type("decimal(5,2)") == "decimal(5,2)" and R.spark_type("decimal(7)") == "decimal(7,0)"


def test_operation_labels(spark):
    df = spark.createDataFrame([("4",), ("9",), (None,)], "c string")
    assert [r[0] for r in df.select(R.op_label_from_text("c")).collect()] == ["UPSERT", None, None]
    with pytest.raises(Exception, match="numeric"):
        spark.createDataFrame([("x",)], "c string").select(R.op_label_from_text("c")).collect()


def test_gtid_header_wins_over_position(spark):
    df = spark.createDataFrame(
        [("WRITE_ROWS", "d", "t", 7, "g:1-4", "g:5", 2, "b.1", 99)],
        "event_type string, db string, tbl string, server_id bigint, gtid_set string, gtid string, seq_no bigint, binlog_file string, pos bigint",
    )
    row = df.select(*[c.alias(n) for n, c in X.record_header(df).items()]).first()
    assert row.Offset == '{"gtidSet":"g:1-4","incompleteTransactions":{"g:5":2}}'
    assert (row.GTID, row.SeqNo, row.BinLogFilename, row.BinLogPosition, row.ServerId) == ("g:5", 2, None, None, 7)


def test_query_records_in_both_modes(spark):
    df = spark.createDataFrame(
        [("QUERY", "d", "SQL", "drop table x"), ("WRITE_ROWS", "d", "t", None)],
        "event_type string, db string, tbl string, query string",
    )
    full = X.query_records(df).collect()
    assert [(r.Type, r.Data) for r in full] == [("QUERY", {"Sql": "drop table x"})]
    assert [(r.Type, r.Data) for r in X.query_records(df, full=False).collect()] == [("QUERY", None)]


def test_positional_names_must_fit(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert X.project_positional(df, ["_id", "n"]).columns == ["_id", "n"]
    with pytest.raises(ValueError):
        X.project_positional(df, ["_id"])
    assert X.tag_tenant(df, "shop1").first().dbName == "shop1"


def test_result_set_types(spark):
    df = spark.createDataFrame([(1, Decimal("1.5"), None)], "a smallint, b decimal(9,2), c boolean")
    typed = X.type_result_set(df)
    assert dict(typed.dtypes) == {"a": "bigint", "b": "double", "c": "boolean"}
    assert typed.first() == (1, 1.5, None)
    with pytest.raises(ValueError, match="'m'"):
        X.type_result_set(spark.createDataFrame([({"a": 1},)], "m map<string,int>"))


def test_dirty_rows(spark):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, None)], "i int, v string")
    clean, dirty = X.split_dirty(df, {"v": "int"})
    assert [tuple(r) for r in clean.orderBy("i").collect()] == [(1, 5), (3, None)]
    assert [tuple(r) for r in dirty.collect()] == [(2, "x", ["v"])]
    X.check_dirty(dirty, 1)
    with pytest.raises(ValueError):
        X.check_dirty(dirty)


def test_messages_leave_out_absent_data(spark):
    df = spark.createDataFrame(
        [("INSERT", "d", "t", 5, {"a": "1"}), ("DELETE", "d", "t", None, None)],
        "Type string, Database string, Table string, Timestamp bigint, Data map<string,string>",
    )
    out = df.select(R.message_envelope().alias("v"), R.message_key().alias("k"), R.message_time().alias("at")).collect()
    assert out[0].v == '{"Type":"INSERT","Database":"d","Table":"t","Timestamp":5,"Data":{"a":"1"}}'
    assert out[1].v == '{"Type":"DELETE","Database":"d","Table":"t"}'
    assert out[0].k == "d.t" and out[1]["at"] == dt.datetime(1970, 1, 1)


def test_reserved_attributes():
    for call in (R.get_attribute, R.delete_attribute):
        with pytest.raises(ValueError):
            call("m", "_.stagePath")
