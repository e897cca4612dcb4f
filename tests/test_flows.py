import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidelog.plans import flows

START = dt.datetime(2024, 1, 1)
LOG = (
    "server_id int, pos bigint, event_type string, gtid string, table_id bigint, db string, tbl string, query string, ts timestamp, "
    "included array<int>, included_before array<int>, rows array<struct<before:array<string>,after:array<string>>>"
)


@pytest.fixture(scope="module")
def log(spark):
    def event(pos, kind, gtid=None, table=None, db=None, tbl=None, query=None, inc=None, old=None, rows=None, server=1):
        return (server, pos, kind, gtid, table, db, tbl, query, START + dt.timedelta(seconds=pos), inc, old, rows)

    return spark.createDataFrame(
        [
            event(1, "GTID", "u:1"),
            event(2, "TABLE_MAP", table=5, db="db1", tbl="customer"),
            event(3, "WRITE_ROWS", table=5, inc=[0, 1], old=[], rows=[(None, ["1", "ann"]), (None, ["2", "bob"])]),
            event(4, "UPDATE_ROWS", table=5, inc=[1], old=[0, 1], rows=[(["1", "ann"], ["eve"])]),
            event(5, "XID"),
            event(6, "GTID", "u:2"),
            event(7, "TABLE_MAP", table=5, db="sys_info", tbl="x"),
            event(8, "WRITE_ROWS", table=5, inc=[0], old=[], rows=[(None, ["9"])]),
            event(9, "TABLE_MAP", table=5, db="mysql", tbl="user"),
            event(10, "WRITE_ROWS", table=5, inc=[0], old=[], rows=[(None, ["9"])]),
            event(11, "TABLE_MAP", table=5, db="db5", tbl="new"),
            event(12, "DELETE_ROWS", table=5, inc=[], old=[0], rows=[(["7"], None)]),
            event(13, "QUERY", query="COMMIT"),
        ],
        LOG,
    )


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame(
        [("db1", "customer", 0, "id", "int"), ("db1", "customer", 1, "name", "text")],
        "db string, tbl string, ordinal int, column string, mysql_type string",
    )


ROUTES = [("crm", "db1.%"), ("rest", "%.%")]


def test_log_to_messages(log, catalog):
    got = flows.publish(log, catalog, F.lit(2), ROUTES, ignore="sys_info.%", gap_ms=5000, block_bits=2).collect()
    assert sorted((r.topic, r.key) for r in got) == [("crm", "db1.customer"), ("crm", "db1.customer"), ("rest", "db5.new")]
    assert {json.loads(r.value)["Type"] for r in got if r.topic == "crm"} == {"INSERT"}
    unrouted = flows.publish(log, catalog, F.lit(2), ROUTES[:1], ignore="sys_info.%", gap_ms=500, block_bits=2).collect()
    assert [r.key for r in unrouted] == ["db1.customer"] * 3


def test_log_to_full_records(log, catalog):
    records = flows.full_records(log, catalog, F.lit(2), ignore="sys_info.%", block_bits=2)
    got = [(r.Type, r.GTID, r.SeqNo, r.Data, r.OldData) for r in records.orderBy("GTID", "SeqNo", "row_no").collect()]
    assert got == [
        ("INSERT", "u:1", 1, {"id": "1", "name": "ann"}, None),
        ("INSERT", "u:1", 1, {"id": "2", "name": "bob"}, None),
        ("UPDATE", "u:1", 2, {"name": "eve"}, {"id": "1", "name": "ann"}),
        ("DELETE", "u:2", 3, None, {"col_0": "7"}),
    ]
    offset = records.filter("SeqNo = 1").first().Offset
    assert json.loads(offset) == {"gtidSet": "", "incompleteTransactions": {"u:1": 1}}
    resumed = flows.full_records(log, catalog, F.lit(2), ignore="sys_info.%", saved=offset, block_bits=2)
    assert sorted((r.GTID, r.SeqNo) for r in resumed.collect()) == [("u:1", 2), ("u:2", 3)]
