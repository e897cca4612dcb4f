import pytest

from tidelog.functions import patterns as P


def passes(spark, keep, *pairs):
    df = spark.createDataFrame([(i, d, t) for i, (d, t) in enumerate(pairs)], "i int, Database string, Table string")
    kept = {r.i for r in df.filter(keep()).collect()}
    return [i in kept for i in range(len(pairs))]


def test_pattern_needs_a_dot(spark):
    with pytest.raises(ValueError):
        P.ignore_table("T1")
    with pytest.raises(ValueError):
        P.table_filter("a.b, ,c.d")


def test_ignore_is_case_insensitive_and_trims(spark):
    got = passes(spark, lambda: P.ignore_table("A.T1"), ("a", "t"), ("a", "T1"), ("A", "t1"), ("B", "T1"), (" a", " t1 "))
    assert got == [True, False, False, True, False]


def test_two_ignores(spark):
    keep = lambda: P.all_of(P.ignore_table("A.T1"), P.ignore_table("B.T2"))
    assert passes(spark, keep, ("a", "t"), ("a", "T1"), ("a", "T2"), ("B", "t2")) == [True, False, True, False]


def test_wildcards(spark):
    pairs = [("a", "t"), ("a", "t12"), ("a", "T1"), ("a", "Ta1"), ("a", "Ta2221"), ("ab", "Ta2221")]
    assert passes(spark, lambda: P.ignore_table("A%.T%1"), *pairs) == [True, True, False, False, False, False]
    assert passes(spark, lambda: P.include_table("A%.T%1"), ("a", "t"), ("a", "t21")) == [False, True]


def test_include_or_and_ignore(spark):
    either = lambda: P.any_of(P.include_table("A%.T%1"), P.include_table("B.t2"))
    assert passes(spark, either, ("a", "t21"), ("b", "t2"), ("b", "t3")) == [True, True, False]
    mixed = lambda: P.all_of(
        P.any_of(P.include_table("A%.T1"), P.include_table("B.t2")), P.ignore_table("a.t1")
    )
    assert passes(spark, mixed, ("b", "t2"), ("b", "t3"), ("a", "t1")) == [True, False, False]


def test_lists(spark):
    pairs = [("test", "foo"), ("test", "foo2"), ("x", "y")]
    assert passes(spark, lambda: P.table_filter("test.foo,t%.foo2", "test.foo"), *pairs) == [False, True, False]
    assert passes(spark, lambda: P.table_filter("", None), *pairs) == [True, True, True]
    assert passes(spark, lambda: P.table_filter(",", ","), *pairs) == [True, True, True]
    assert passes(spark, lambda: P.table_filter(",x.y", ""), *pairs) == [False, False, True]


def test_whole_name_must_match_even_with_line_ends(spark):
    assert passes(spark, lambda: P.include_table("a.t"), ("a", "t\n"), ("a", "t\nx"), ("a", "xt")) == [True, False, False]


def test_ignored_databases():
    assert P.ignored_databases("sys_info.%,shop,shop.a.b,DB2.orders,..x.y,") == ["sys_info", "DB2", "x"]
    assert P.ignored_databases(None) == []


def test_statements(spark):
    cases = {
        "  ALTER   TABLE t add c int": True,
        "alter ignore table t": True,
        "\tDrop  table t": True,
        "rename table a to b": False,
        "truncate table t": False,
        "create table t (a int)": False,
        "alter\ttable t": False,
    }
    df = spark.createDataFrame([(s,) for s in cases], "s string")
    assert {r.s: r.x for r in df.select("s", P.is_schema_change("s").alias("x")).collect()} == cases
    commits = spark.createDataFrame(
        [("XID", None), ("QUERY", "COMMIT"), ("QUERY", "commit"), ("QUERY", None), ("GTID", None)],
        "event_type string, query string",
    )
    assert [r[0] for r in commits.select(P.is_commit()).collect()] == [True, True, False, False, False]
