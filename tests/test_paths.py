import pytest
from pyspark.sql import functions as F

from tidelog.functions import paths
from tidelog.functions import records as R


@pytest.fixture
def df(spark):
    return spark.sql(
        "select named_struct('a', named_struct('b', array(1, 2), 'n', cast(null as string)), 'm', map('x', map('y', 'z', 'q', null))) as v, "
        "map('k', '1', '/k', '2') as flat, parse_json('{\"p\":{\"q\":[5]}}') as j"
    )


def value(df, column):
    return df.select(column).first()[0]


def test_get(df):
    assert value(df, paths.get_path(df, "v", "/a/b[1]")) == 2
    assert value(df, paths.get_path(df, "v", "/a/b[2]")) is None
    assert value(df, paths.get_path(df, "v", "/m/x/y")) == "z"
    assert value(df, paths.get_path(df, "v", "/a/none/at/all")) is None
    assert value(df, paths.get_path(df, "v", "/a[0]")) is None
    assert value(df, paths.get_path(df, "flat", "/k")) == "2"
    assert value(df, paths.get_path(df, "j", "/p/q[0]")) == "5"
    assert value(df, paths.get_path(df, "v", "")).a.b == [1, 2]


def test_has(df):
    cases = {"/a/b[1]": True, "/a/b[2]": False, "/a/n": True, "/m/x/q": True, "/m/x/none": False, "/m/none/y": False, "/z": False, "": True}
    assert {p: value(df, paths.has_path(df, "v", p)) for p in cases} == cases


def test_set(df):
    assert value(df, paths.set_path(df, "v", "/a/b[1]", F.lit(9))).a.b == [1, 9]
    assert value(df, paths.set_path(df, "v", "/a/b[2]", F.lit(9))).a.b == [1, 2, 9]
    assert value(df, paths.set_path(df, "v", "/a/new", F.lit(9))).a.new == 9
    assert value(df, paths.set_path(df, "v", "/m/x/new", F.lit("w"))).m["x"] == {"y": "z", "q": None, "new": "w"}
    assert value(df, paths.set_path(df, "v", "/m/x/y", F.lit("w"))).m["x"]["y"] == "w"
    with pytest.raises(Exception, match="not reachable"):
        value(df, paths.set_path(df, "v", "/a/b[3]", F.lit(9)))
    with pytest.raises(Exception, match="not reachable"):
        value(df, paths.set_path(df, "v", "/m/none/y", F.lit("w")))
    with pytest.raises(ValueError, match="not reachable"):
        paths.set_path(df, "v", "/no/y", F.lit("w"))


def test_delete(df):
    assert value(df, paths.delete_path(df, "v", "/a/b[0]")).a.b == [2]
    assert "n" not in value(df, paths.delete_path(df, "v", "/a/n")).a.asDict()
    assert value(df, paths.delete_path(df, "v", "/m/x/y")).m == {"x": {"q": None}}
    assert value(df, paths.delete_path(df, "v", "/m/none/y")).m["x"]["y"] == "z"
    assert value(df, paths.delete_path(df, "v", "")) is None


def test_list(df, spark):
    assert value(df, paths.list_paths(df, "v")) == [
        "", "/a", "/a/b", "/a/b[0]", "/a/b[1]", "/a/n", "/m", "/m/x", "/m/x/y", "/m/x/q",
    ]
    odd = spark.sql("select map('a/b', 1, 'c[d]', 2) as v")
    assert value(odd, paths.list_paths(odd, "v")) == ["", "/a//b", "/c[[d]]"]


def test_attributes_and_lineage(spark):
    df = spark.sql("select map('a', '1', '_.trackingId', 't') as m, 's' as src, 'one' as path, 's::one' as id")
    assert value(df, R.attribute_values("m")) == {"a": "1"}
    assert value(df, R.set_attribute("m", "a", F.lit("2"))) == {"a": "2", "_.trackingId": "t"}
    row = df.select(*[c.alias(n) for n, c in R.lineage("two", "src", "path", "id").items()]).first()
    assert row.asDict() == {"stage_path": "one:two", "tracking_id": "s::one:two", "previous_tracking_id": "s::one"}
