import random
import time

import pytest
from pyspark.sql import functions as F

from tidelog.functions import patterns as P
from tidelog.operators import matching as M
from tidelog.operators import routing as R

PARTS = ["%", "db1", "DB2 ", "db%", "d%1", "%b2", "shop", "s.op", "sh[ao]p", "(db1|shop)", "", "db", " Db1", "a_b", "x\ny%"]


@pytest.fixture(scope="module")
def events(spark):
    draw = random.Random(2)
    names = ["db1", "DB2", "Shop", " shop", "db12", "d11", "", "s.op", "a_b", "x\nyz", "x\ny\nz", None]
    return spark.createDataFrame([(i, draw.choice(names), draw.choice(names)) for i in range(400)], "id int, Database string, Table string").repartition(3)


def drawn_routes(seed, n):
    draw = random.Random(seed)
    item = lambda: f"{draw.choice(PARTS)}.{draw.choice(PARTS)}"
    return [(f"t{i % 7}", ",".join(item() for _ in range(draw.randint(1, 3))) + draw.choice(["", "", ","])) for i in range(n)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_as_the_column_form_gives_them(events, seed):
    routes = drawn_routes(seed, 9)
    routes += [("all", "")] if seed == 3 else []
    assert rows(M.route_by_names(events, routes)) == rows(events.withColumn("topic", R.route_topic(routes)))
    assert rows(M.fan_out_by_names(events, routes)) == rows(R.fan_out_topics(events, routes))
    include, ignore = ",".join(x for _, x in routes[:3]), ",".join(x for _, x in routes[3:6])
    for i, o in ((include, ignore), (None, ignore), (include, None), ("", ","), (",", ",,")):
        assert rows(M.filter_by_names(events, i, o)) == rows(events.filter(P.table_filter(i, o)))


def test_keys_of_parts():
    assert [M.part_key(p) for p in ("db1", "db%", "%", "d.b", "d%b", "", "a_b%")] == ["=db1", "^db", "^", M.ANY, M.ANY, "=", "^a_b"]
    with pytest.raises(ValueError, match="db.table"):
        M.pattern_rows([("t", "nothing")])


def test_no_routes_and_no_events(events):
    assert rows(M.route_by_names(events, [])) == rows(events.withColumn("topic", F.lit(None)))
    assert M.route_by_names(events.where("false"), drawn_routes(1, 3)).collect() == []


def test_ten_thousand_routes(spark):
    events = spark.range(20_000).selectExpr("id", "concat('db', id % 3000) as Database", "concat('t', id % 7) as Table")
    routes = [(f"topic{i}", f"db{i}.%,x{i}%.t1") for i in range(0, 2990)] + [(f"late{i}", f"db29{i % 100:02d}%.t{i % 9}") for i in range(7000)] + [("rest", "%.[t-z]3"), ("last", "d.*9.t%")]
    began = time.monotonic()
    routed = M.route_by_names(events, routes)
    got = routed.groupBy("topic").count().collect()
    assert time.monotonic() - began < 40
    assert sum(r["count"] for r in got) == 20_000
    known = {r.Database: r.topic for r in routed.select("Database", "topic").distinct().collect()}
    assert known["db5"] == "topic5" and known["db2989"] == "topic2989"
    late = routed.where("Database = 'db2995'").select("Table", "topic").distinct().collect()
    first = {f"t{k}": next((f"late{i}" for i in range(7000) if i % 100 == 95 and i % 9 == k), None) for k in range(7)}
    assert {r.Table: r.topic for r in late} == {t: first[t] or ("rest" if t == "t3" else None) for t in {r.Table for r in late}}
