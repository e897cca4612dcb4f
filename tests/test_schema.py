import pytest
from pyspark.sql import functions as F

from tidelog.operators import schema as S

BASE = [("id", "bigint"), ("name", "varchar(20)"), ("at", "datetime")]


@pytest.mark.parametrize(
    "clauses, want",
    [
        ("ADD COLUMN x int(11) unsigned NOT NULL DEFAULT 0", [*BASE, ("x", "int(11) unsigned")]),
        ("add x decimal(10, 2) first, add column `y z` enum('a,b', 'c') after id;", [("x", "decimal(10, 2)"), ("id", "bigint"), ("y z", "enum('a,b', 'c')"), *BASE[1:]]),
        ("add (x int, y text, key by_x (x, y))", [*BASE, ("x", "int"), ("y", "text")]),
        ("drop name, DROP COLUMN AT", [("id", "bigint")]),
        ("rename column name to title, add name text", [("id", "bigint"), ("title", "varchar(20)"), ("at", "datetime"), ("name", "text")]),
        ("change name title text first", [("title", "text"), ("id", "bigint"), ("at", "datetime")]),
        ("change column name title varchar(30)", [("id", "bigint"), ("title", "varchar(30)"), ("at", "datetime")]),
        ("modify column id int after at", [("name", "varchar(20)"), ("at", "datetime"), ("id", "int")]),
        ("add index by_name (name, at), drop primary key, add unique (id), add constraint c foreign key (id) references o (id), engine=innodb, comment 'drop id, add x int'", BASE),
        ("drop column nothing, modify nothing int, rename to other", BASE),
        ("", BASE),
    ],
)
def test_clauses(clauses, want):
    assert S.altered(BASE, clauses) == want


def test_tables_of_statements():
    assert S.tables_of(" ALTER  ignore TABLE `a.b`.`c``d` add x int", "db") == [("a.b", "c`d", "add x int")]
    assert S.tables_of("alter table t\n drop x", "db") == [("db", "t", "drop x")]
    assert S.tables_of("drop table if exists a, other.b , `c` cascade", "db") == [("db", "a", None), ("other", "b", None), ("db", "c", None)]
    assert S.tables_of("insert into t values (1)", "db") == [] and S.tables_of(None, "db") == []


def test_versions_follow_the_log_of_each_server(spark):
    catalog = spark.createDataFrame(
        [("d", "t", 0, "id", "int"), ("d", "t", 1, "v", "text"), ("d", "quiet", 0, "q", "int")], "db string, tbl string, ordinal int, column string, mysql_type string"
    )
    log = spark.createDataFrame(
        [
            (1, 10, "QUERY", "d", "alter table t add w int"), (1, 30, "QUERY", "d", "drop table t"), (1, 40, "QUERY", "d", "alter table t add z int"),
            (2, 20, "QUERY", "x", "alter table d.t drop column v"), (2, 25, "QUERY", "d", "BEGIN"), (2, 26, "QUERY", "d", None), (1, 50, "QUERY", "d", "alter table new add column n int"),
        ],
        "server_id int, pos bigint, event_type string, db string, query string",
    )
    got = {}
    for r in S.schema_versions(catalog, log).collect():
        got.setdefault((r.server_id, r.tbl), []).append((r.valid_from, r.valid_to, r.columns))
    assert {k: sorted(v, key=lambda x: x[0]) for k, v in got.items()} == {
        (1, "t"): [(-1, 10, ["id", "v"]), (10, 30, ["id", "v", "w"]), (30, 40, None), (40, None, ["z"])],
        (2, "t"): [(-1, 20, ["id", "v"]), (20, None, ["id"])],
        (1, "quiet"): [(-1, None, ["q"])],
        (2, "quiet"): [(-1, None, ["q"])],
        (1, "new"): [(-1, 50, None), (50, None, ["n"])],
    }
    events = spark.createDataFrame([(s, p, "d", "t") for s in (1, 2) for p in (5, 10, 15, 35, 60)], "server_id int, pos bigint, db string, tbl string")
    named = S.enrich_columns_from_log(events, catalog, log, F.lit(1))
    assert {(r.server_id, r.pos): (r["columns"], r.has_metadata) for r in named.collect()} == {
        (1, 5): (["id", "v"], True), (1, 10): (["id", "v", "w"], True), (1, 15): (["id", "v", "w"], True), (1, 35): (["col_0"], False), (1, 60): (["z"], True),
        (2, 5): (["id", "v"], True), (2, 10): (["id", "v"], True), (2, 15): (["id", "v"], True), (2, 35): (["id"], True), (2, 60): (["id"], True),
    }
