import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelog.operators import enrich as E
from tidelog.operators import incremental as I
from tidelog.plans import flows


def at(seconds):
    return dt.datetime(2020, 1, 1) + dt.timedelta(seconds=seconds)


def test_start_from_progress_or_notice(spark):
    notices = spark.createDataFrame([("a", at(5)), ("b", at(6)), ("c", at(7))], "Database string, ts timestamp")
    progress = spark.createDataFrame([("a", "2019-12-31 23:00:00.250"), ("b", "yesterday")], "dbName string, job_time string")
    got = {r.Database: r.ts_start for r in I.initial_watermark(notices, progress).collect()}
    assert got == {"a": dt.datetime(2019, 12, 31, 23, 0, 0, 250_000), "b": at(6), "c": at(7)}


def releases(spark, *runs):
    return spark.createDataFrame([(db, at(start), at(run)) for db, start, run in runs], "Database string, ts_start timestamp, run_ts timestamp")


def test_windows_are_contiguous(spark):
    df = releases(spark, ("a", 0, 10), ("a", 9, 25), ("a", 20, 40), ("b", 3, 13))
    got = sorted((r.Database, r.ts_start, r.ts_end) for r in I.advance_windows(df).collect())
    assert got == [("a", at(0), at(10)), ("a", at(10), at(25)), ("a", at(25), at(40)), ("b", at(3), at(13))]


def test_a_large_lag_never_reads_twice(spark):
    df = releases(spark, ("a", 8, 10), ("a", 0, 25), ("a", 0, 40))
    got = sorted((r.ts_start, r.ts_end) for r in I.advance_windows(df, lag_ms=20_000).collect())
    assert got == [(at(8), at(8)), (at(8), at(8)), (at(8), at(20))]


def test_rows_on_a_border_belong_to_the_later_window(spark):
    windows = I.advance_windows(releases(spark, ("a", 0, 10), ("a", 0, 100_000)))
    source = spark.createDataFrame(
        [("a", at(0), 1), ("a", at(10), 2), ("a", at(99_999), 3), ("a", at(100_000), 4), ("b", at(5), 5)],
        "Database string, changed timestamp, id int",
    )
    for unit in ("HOUR", "DAY", "MONTH"):
        rows = I.delta_join(windows, source, "changed", unit=unit)
        assert sorted((r.id, r.ts_start) for r in rows.collect()) == [(1, at(0)), (2, at(10)), (3, at(10))]
    assert I.delta_join(windows.filter("false"), source, "changed").count() == 0


def test_open_window_reads_up_to_a_given_time(spark):
    windows = spark.createDataFrame([("a", at(0), None)], "Database string, ts_start timestamp, ts_end timestamp")
    source = spark.createDataFrame([("a", at(5)), ("a", at(50))], "Database string, changed timestamp")
    assert I.delta_join(windows, source, "changed", until=F.lit(at(50))).count() == 1
    assert I.backfill(source, "2020-01-01 00:00:05.000", "changed", F.lit(at(60))).count() == 2


def test_extraction_from_messages(spark):
    millis = lambda s: int(at(s).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    messages = spark.createDataFrame(
        [("a", "t", millis(0), 1), ("a", "u", millis(4), 1), ("a", "t", millis(60), 2), ("sys_info", "x", millis(1), 3)],
        "Database string, Table string, Timestamp bigint, KafkaOffset bigint",
    )
    progress = spark.createDataFrame([], "dbName string, job_time string")
    source = spark.createDataFrame(
        [(1, at(-1), "a"), (2, at(3), "a"), (3, at(30), "a"), (4, at(70), "a"), (5, at(5), "sys_info")],
        "id int, changed timestamp, Database string",
    )
    got = flows.extract(messages, progress, source, "changed", ignore="sys_info.%")
    assert got.columns == ["id", "changed", "dbName"] and dict(got.dtypes)["id"] == "bigint"
    assert sorted((r.id, r.dbName) for r in got.collect()) == [(2, "a"), (3, "a")]


def test_named_queries_have_windows_of_their_own(spark):
    notices = spark.createDataFrame([("a", at(1), at(11)), ("a", at(20), at(30))], "Database string, ts timestamp, run_ts timestamp")
    jobs = I.query_catalog(notices, {"q1": "s1", "q2": "s2"})
    got = sorted((r.task_id, r.ts_start, r.ts_end, r.template) for r in jobs.collect())
    assert got == [(q, s, e, t) for q, t in (("q1", "s1"), ("q2", "s2")) for s, e in ((at(0), at(11)), (at(11), at(30)))]


def test_merge(spark):
    snapshot = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 5)], "id int, v string, version int")
    delta = spark.createDataFrame(
        [(1, "x", 1, "UPDATE"), (1, "y", 2, "UPDATE"), (2, None, 1, "DELETE"), (3, "same", 5, "UPDATE"), (4, "n", 1, "INSERT"), (5, "n", 1, "INSERT"), (5, None, 2, "DELETE")],
        "id int, v string, version int, Type string",
    )
    got = sorted(map(tuple, I.merge_incremental(snapshot, delta, ["id"], "version").collect()))
    assert got == [(1, "y", 2), (3, "same", 5), (4, "n", 1)]


def test_busy_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = I.latest_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_shards(spark):
    df = spark.createDataFrame([("2020-01-31",), ("2020-02-01",), ("2020-12-01",), ("2021-01-01",)], "d string").withColumn("d", F.col("d").cast("date"))
    assert [r[0] for r in df.select(I.shard("d", 12)).collect()] == [2020, 2020, 2020, 2021]
    assert [r[0] for r in df.select(I.shard("d", 1)).collect()] == [24240, 24241, 24251, 24252]


def test_versions_of_a_schema(spark):
    versions = spark.createDataFrame(
        [("d", "t", 0, 0, "a", "int"), ("d", "t", 10, 0, "a", "int"), ("d", "t", 10, 1, "b", "text")],
        "db string, tbl string, valid_from bigint, ordinal int, column string, mysql_type string",
    )
    events = spark.createDataFrame([("d", "t", 9), ("d", "t", 10), ("d", "u", 50)], "db string, tbl string, pos bigint")
    got = E.enrich_columns_versioned(events, versions, F.lit(1)).orderBy("pos").collect()
    assert [r.columns for r in got] == [["a"], ["a", "b"], ["col_0"]]
    assert events.count() == len(got)


def test_lookups(spark):
    events = spark.createDataFrame([(1, 7), (2, 9), (3, None)], "id int, u int")
    source = spark.createDataFrame([(7, "x"), (7, "y")], "key int, name string")
    got = {r.id: sorted(x.name for x in r.Result) for r in E.lookup_enrich(events, source, {"u": "key"}).collect()}
    assert got == {1: ["x", "y"], 2: [], 3: []}
    assert sorted((r.id, r.name or "") for r in E.lookup_rows(events, source, {"u": "key"}).collect()) == [(1, "x"), (1, "y"), (2, ""), (3, "")]


def test_a_source_key_that_owns_many_equal_rows(spark):
    events = spark.createDataFrame([(1, 7), (2, 9), (3, 8)], "id int, u int")
    source = spark.createDataFrame([(7, "x")] * 50 + [(9, "y")], "key int, name string")
    assert {(r.id, len(r.Result)) for r in E.lookup_enrich(events, source, {"u": "key"}).collect()} == {(1, 50), (2, 1), (3, 0)}
    assert E.lookup_rows(events, source, {"u": "key"}).count() == 52


def test_date_columns_include_the_day_a_window_ends_in(spark):
    at = "cast('2024-05-{:02} {}' as timestamp)".format
    windows = spark.range(1).selectExpr("'d' as Database", f"{at(1, '00:00:00')} as ts_start", f"{at(5, '12:00:00')} as ts_end")
    days = spark.range(1, 8).selectExpr("'d' as Database", "id", "date_add(date'2024-04-30', cast(id as int)) as day")
    for kind in ("date", "timestamp", "timestamp_ntz"):
        for unit in ("HOUR", "DAY", "MONTH"):
            found = I.delta_join(windows, days.withColumn("day", F.col("day").cast(kind)), "day", unit=unit)
            assert sorted(r.id for r in found.collect()) == [1, 2, 3, 4, 5]


def test_rows_are_checked_while_they_are_written(spark, tmp_path):
    rows = spark.createDataFrame([(i, "db", "x" if i % 10 == 0 else str(i), None if i % 7 == 0 else "2024-01-01") for i in range(100)], "id int, Database string, code string, due string")
    made = I.extract_checked(rows, {"code": "int", "due": "date"})
    made.rows.write.parquet(f"{tmp_path}/a")
    assert made.check(10) == {"clean": 90, "dirty": 10}
    with pytest.raises(ValueError, match="10 dirty rows, 9 allowed"):
        made.check(9)
    written = spark.read.parquet(f"{tmp_path}/a")
    clean, dirty = made.clean(written), made.dirty(written)
    assert dict(clean.dtypes) == {"id": "bigint", "code": "int", "due": "date", "dbName": "string"}
    assert clean.count() == 90 and clean.agg(F.count("due")).first()[0] == 90 - len([i for i in range(100) if i % 7 == 0 and i % 10])
    assert sorted((r.id, r.code, r.dirty_columns) for r in dirty.collect()) == [(i, "x", ["code"]) for i in range(0, 100, 10)]


def test_a_batch_with_too_many_dirty_rows_leaves_nothing(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    source = spark.createDataFrame([("a", at(i), "x" if i == 5 else str(i)) for i in range(10)], "Database string, changed timestamp, code string")
    notices = spark.createDataFrame([("a", at(0), 1), ("a", at(20), 2)], "Database string, ts timestamp, pos bigint")
    progress = spark.createDataFrame([("a", "2024-01-01 00:00:00.000")], "dbName string, job_time string")

    def run(limit, name):
        return I.incremental_extract_checked(notices, progress, source, "changed", {"code": "int"}, f"{tmp_path}/{name}", limit, interval_ms=1000)

    with pytest.raises(ValueError, match="1 dirty rows"):
        run(0, "none")
    assert not list(tmp_path.glob("none*"))
    clean, dirty = run(1, "some")
    assert sorted(r.code for r in clean.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 9] and [r.code for r in dirty.collect()] == ["x"]
    with pytest.raises(ValueError, match="there already"):
        run(1, "some")


def test_equal_windows_are_joined_once(spark):
    """A row comes once for each of them; the join itself meets different windows only."""
    windows = spark.createDataFrame([("a", at(0), at(10))] * 5 + [("a", at(5), at(10)), ("b", at(0), at(9))], "Database string, ts_start timestamp, ts_end timestamp")
    source = spark.createDataFrame([("a", at(1), 1), ("a", at(6), 2), ("b", at(9), 3)], "Database string, changed timestamp, id int")
    rows = I.delta_join(windows, source, "changed")
    assert sorted((r.id, r.ts_start) for r in rows.collect()) == [(1, at(0))] * 5 + [(2, at(0))] * 5 + [(2, at(5))]
    assert rows.columns == [*source.columns, "ts_start", "ts_end"]
    assert "_times" in rows._jdf.queryExecution().toString()


def test_what_is_picked_is_computed_before_rows_are_repeated(spark):
    windows = spark.createDataFrame([("a", at(0), at(10))] * 5 + [("a", at(5), at(10))], "Database string, ts_start timestamp, ts_end timestamp")
    source = spark.createDataFrame([("a", at(1), 1), ("a", at(6), 2)], "Database string, changed timestamp, id int")
    rows = I.delta_join(windows, source, "changed", pick=["id", F.unix_micros("ts_start").alias("start")])
    zero, five = (int((x - dt.datetime(1970, 1, 1)).total_seconds() * 1e6) for x in (at(0), at(5)))
    assert sorted(map(tuple, rows.collect())) == [(1, zero)] * 5 + [(2, zero)] * 5 + [(2, five)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode(array_repeat") < plan.index("unix_micros(ts_start")


def test_a_source_that_many_windows_read_is_dealt_evenly(spark):
    """Of one file or not; where few windows lie over each other its rows stay where they are."""
    source = spark.range(2000, numPartitions=1).selectExpr("'a' as Database", "timestamp_seconds(id) as changed", "id")
    for n, parts in ((2 * I.DEEP, 4), (I.DEEP // 2, 1)):
        windows = spark.range(n).selectExpr("'a' as Database", "timestamp_seconds(0) as ts_start", "timestamp_seconds(1900 + id) as ts_end")
        rows = I.delta_join(windows, source, "changed")
        counts = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(counts) == sum(1900 + i for i in range(n)) and len(counts) == parts and max(counts) < 1.2 * sum(counts) / parts


def test_many_versions_of_a_table(spark):
    """Events meet the one version that reaches them, also where versions end, and keep their null places and keys."""
    n = 3 * E.FEW_SPANS
    spans = [("d", "t", 10 * i, 10 * i + (5 if i % 7 == 3 else 10), [f"c{i}"], ["int"]) for i in range(n - 1)]
    spans += [("d", "t", 10 * (n - 1), None, ["end"], ["int"]), ("d", "t", 40, 40, ["none"], ["int"]), ("d", "u", -1, None, ["u"], ["int"])]
    frame = spark.createDataFrame(spans, "db string, tbl string, valid_from bigint, valid_to bigint, columns array<string>, column_types array<string>")
    places = [("d", "t", p) for p in range(-5, 10 * n + 20, 3)] + [("d", "t", None), (None, "t", 5), ("d", "u", 7), ("d", "x", 7)]
    events = spark.createDataFrame(places, "db string, tbl string, pos bigint")
    made = E.enrich_as_of(events, frame, F.lit(1))
    got = made.select("db", "tbl", "pos", "valid_from", F.col("columns")[0], "has_metadata").collect()

    def want(db, tbl, pos):
        for d, t, a, b, c, _ in spans:
            if (d, t) == (db, tbl) and pos is not None and a <= pos and (b is None or pos < b):
                return (db, tbl, pos, a, c[0], True)
        return (db, tbl, pos, None, "col_0", False)

    assert sorted(map(str, map(tuple, got))) == sorted(str(want(*p)) for p in places)
    assert "Window" in made._jdf.queryExecution().executedPlan().toString()
