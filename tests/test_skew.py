"""One server and one table own all rows: the work must still be spread."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidelog.operators import coalesce as C
from tidelog.operators import incremental as I
from tidelog.operators import ordering as T
from tidelog.session import tune

N = 20_000


@pytest.fixture
def spread(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def tasks(df):
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        return len(sizes), max(sizes) / sum(sizes)

    yield tasks
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_server(spark, spread):
    log = spark.range(N).select(
        F.lit(1).alias("server_id"),
        (F.col("id") * 100).alias("pos"),
        F.when(F.col("id") == 0, "GTID").otherwise("WRITE_ROWS").alias("event_type"),
        F.when(F.col("id") == 0, "u:1").alias("gtid"),
        F.lit(7).alias("table_id"),
        F.lit("d").alias("db"),
        F.lit("t").alias("tbl"),
    )
    numbered = T.tx_sequence(log, block_bits=14)
    n, share = spread(numbered)
    assert n == 4 and share < 0.5
    # one transaction holds every row event
    assert numbered.agg(F.max("seq_no"), F.sum("seq_no")).first() == (N - 1, N * (N - 1) // 2)
    n, share = spread(T.resolve_table_map(log, block_bits=14))
    assert n == 4 and share < 0.5


def test_one_transaction_keeps_its_offsets_spread(spark, spread):
    log = spark.range(N).select(
        F.lit(1).alias("server_id"),
        (F.col("id") * 100).alias("pos"),
        F.when(F.col("id") == 0, "GTID").otherwise("WRITE_ROWS").alias("event_type"),
        F.when(F.col("id") == 0, "u:5").alias("gtid"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stamped = T.event_offset(log, "u:1-3", block_bits=14)
        n, share = spread(stamped)
        assert n == 4 and share < 0.5
        assert [tuple(r) for r in stamped.groupBy("gtid_set").count().collect()] == [("u:1-3", N - 1)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_table_without_a_pause(spark, spread):
    log = spark.range(N).select(
        F.lit("d").alias("Database"),
        F.lit("t").alias("Table"),
        F.timestamp_millis(F.col("id") * 7).alias("ts"),
        F.col("id").alias("pos"),
    )
    windows = C.anchored_windows(log, ["Database", "Table"], C.micros("ts"), 100_000, "pos", 16)
    n, share = spread(windows)
    # a window opens every 15th change: the first one more than 100 ms after the last opening
    assert n == 4 and share < 0.5
    assert windows.agg(F.count("*"), F.max("pos")).first() == (-(-N // 15), (N - 1) // 15 * 15)


def test_a_long_gap_on_a_dense_table(spark, spread, monkeypatch):
    """All changes lie in a small part of one block of time."""
    monkeypatch.setattr(C, "BLOCK_ROWS", 500)
    log = spark.range(N).select(
        F.lit("d").alias("Database"), F.lit("t").alias("Table"), F.timestamp_millis(F.col("id") * 700).alias("ts"), F.col("id").alias("pos")
    )
    thin = C._blocked(C.combined(log, ["Database", "Table"], C.micros("ts"), "pos", {}), ["Database", "Table"], 3_600_000_000 * 256, 500)
    depths = [r["count"] for r in thin.groupBy("_block").count().collect()]
    assert len(depths) == 64 and max(depths) < 500
    n, share = spread(thin.repartition("Database", "Table", "_block"))
    assert n == 4 and share < 0.5
    windows = C.anchored_windows(log, ["Database", "Table"], C.micros("ts"), 3_600_000_000, "pos", totals={"n": F.lit(1)})
    per = 3_600_000 // 700 + 1
    assert sorted((r.pos, r.n) for r in windows.collect()) == [(at, min(per, N - at)) for at in range(0, N, per)]


def test_steps_of_one_table_are_composed_in_many_tasks(spark, spread, monkeypatch):
    """Evenly spaced changes: no two anchors lead to the same window, so every block has many steps."""
    monkeypatch.setattr(C, "FAN_BITS", 4)
    gap, every, per = 1000, 50, 100  # 100 changes in each of 200 blocks, of five gaps
    made = spark.range(200 * per).select(F.expr(f"id div {per}").alias("_block"), F.expr(f"id % {per}").alias("i"), (F.col("id") * every).alias("t"))
    # a window opens every 21st change, counted from the anchor
    exit_ = F.col("t") + F.expr(f"({per} * {every} * (_block + 1) - 1 - t) div 1050 * 1050")
    steps = made.where(F.col("i") <= 20).select(
        F.lit("t").alias("k"), "_block", F.when(F.col("i") == 0, C._NEVER).otherwise(F.col("t") - every).cast("bigint").alias("_from"), exit_.cast("bigint").alias("_exit")
    )
    found = C._followed(steps, ["k"], gap, 500)
    n, share = spread(found)
    assert n == 4 and share < 0.5
    got = {r["_block"]: r["_open"] for r in found.collect()}
    openings = range(0, 200 * per * every, 1050)
    assert got == {b: max((o for o in openings if o < b * per * every), default=None) for b in range(200)}


def test_equal_times_are_combined_before_the_shuffle(spark):
    log = spark.range(N).select(F.lit("d").alias("k"), F.floor(F.col("id") / 1000).alias("t"), "id")
    plan = C.combined(log, ["k"], F.col("t"), "id", {})._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


def test_one_database_is_split_by_time(spark, spread):
    start = dt.datetime(2020, 1, 1)
    windows = spark.createDataFrame([("a", start, start + dt.timedelta(days=300))], "Database string, ts_start timestamp, ts_end timestamp")
    source = spark.range(N).select(
        F.lit("a").alias("Database"), "id", (F.lit(start).cast("timestamp") + F.make_dt_interval(mins=F.col("id").cast("int") * 20)).alias("changed")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = I.delta_join(windows, source, "changed").hint("merge")
        assert rows.count() == N
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_busy_documents_are_cut_in_every_task(spark):
    df = spark.range(N).select((F.col("id") % 2).alias("k"), "id")
    plan = I.latest_per_key(df, ["k"], [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_partitions_follow_the_data(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        tune(spark, 10 << 40)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(10 * 1024 * 8)
        tune(spark, 1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
