import datetime as dt
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from tidelog.functions import offsets as O
from tidelog.operators import coalesce as C
from tidelog.operators import ordering as T
from tidelog.streaming import batches as B
from tidelog.streaming import coalesce as S
from tidelog.plans import flows
from tidelog.streaming import extract as E
from tidelog.streaming import log as L

START = dt.datetime(2024, 1, 1)
SCHEMA = "Database string, Table string, ts timestamp, pos bigint"


def write(spark, path, n, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/in/part={n}")


def source(spark, path, schema=SCHEMA):
    return S.use_rocksdb(spark).readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def run(stream, path):
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{path}/out")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def shuffled_changes(seed, n=600):
    """Changes of three tables, out of order by up to 2 s, in three parts of time."""
    rng = random.Random(seed)
    rows, ms = [], 0
    for pos in range(n):
        ms += rng.choice([0, 20, 400, 1500, 9000])
        rows.append(("d", rng.choice("aab"), ms, pos))
    arrival = sorted(rows, key=lambda r: r[2] + rng.randint(0, 2000))
    as_rows = [(d, t, START + dt.timedelta(milliseconds=m), p) for d, t, m, p in arrival]
    return [as_rows[i * n // 3 : (i + 1) * n // 3] for i in range(3)]


FAR = [("", "", START + dt.timedelta(days=30), -1)]


def test_stream_merges_like_batch_over_a_restart(spark, tmp_path):
    path, parts = str(tmp_path), shuffled_changes(1)
    merged = lambda: S.coalesce_changes_stream(source(spark, path), gap_ms=3000, watermark="5 seconds")
    write(spark, path, 0, parts[0])
    run(merged(), path)
    for n in (1, 2):
        write(spark, path, n, parts[n])
    write(spark, path, 3, FAR)
    got = run(merged(), path).filter("Table <> ''")
    whole = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    want = C.coalesce_changes(whole, gap_ms=3000).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def follow(times, counts, length, gap):
    """Windows by the steps of each block, one after the other."""
    out, window = [], None
    follower = S.StepFollower([], gap, length, S.T.StructType([]))
    blocks = times // length
    for block in np.unique(blocks):
        here = blocks == block
        steps = S.block_steps(times[here], counts[here], block * length, gap)
        frame = S.pd.DataFrame({"following": steps["following"], "merged": steps["merged"], "last_at": steps["last"], "ahead": steps["ahead"], "before_at": steps["before"]})
        frame["change_at"] = np.r_[times[here][steps["row"][:-1]], np.iinfo(np.int64).max]
        frame["change_first"] = 0
        window = follower._followed(frame, window, out)
    return [(w[0], w[2], w[3]) for w in [*out, window]]


def test_steps_of_blocks_lead_to_the_windows_of_the_whole():
    draw = np.random.default_rng(5)
    cases = [np.unique(draw.integers(0, 5000, draw.integers(1, 400))) for _ in range(60)]
    cases += [np.arange(0, 3000, step) for step in (1, 7, 10, 33, 100, 101)] + [np.array([99, 100, 199, 200, 300, 1000])]
    for times in cases:
        for gap, gaps in ((100, 1), (100, 4), (37, 10)):
            counts = draw.integers(1, 4, len(times))
            starts = C.window_starts(times, gap)
            want = list(zip(times[starts].tolist(), np.add.reduceat(counts, starts).tolist(), times[np.r_[starts[1:], len(times)] - 1].tolist()))
            assert follow(times, counts, gap * gaps, gap) == want


def test_a_busy_block_hands_on_few_of_its_changes():
    draw = np.random.default_rng(6)
    times = np.unique(draw.integers(0, 64 * 1000, 60_000))
    assert len(S.block_steps(times, np.ones(len(times), int), 0, 1000)["row"]) < len(times) / 4


@pytest.mark.parametrize("block_gaps", [1, 16])
def test_a_busy_key_is_held_in_several_tasks(spark, tmp_path, block_gaps):
    """Evenly spaced changes of one key, some of equal time, cut in the middle of a window."""
    path = str(tmp_path)
    at = lambda ms: START + dt.timedelta(milliseconds=ms)
    rows = [("d", "hot", at(50 * (i - i % 3)), i) for i in range(3000)]
    merged = lambda: S.coalesce_changes_stream(source(spark, path), gap_ms=1000, watermark="40 seconds", block_gaps=block_gaps)
    write(spark, path, 0, rows[1400:1700] + rows[:1300])
    run(merged(), path)
    held = spark.read.format("statestore").option("operatorId", 1).option("stateVarName", "held").load(f"{path}/checkpoint")
    parts = [r["count"] for r in held.groupBy("partition_id").count().collect()]
    assert len(parts) > 1 and max(parts) < 0.7 * sum(parts)
    write(spark, path, 1, rows[1300:1400] + rows[1700:])
    write(spark, path, 2, FAR)
    got = run(merged(), path).filter("Table <> ''")
    want = C.coalesce_changes(spark.createDataFrame(rows, SCHEMA), gap_ms=1000).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_the_session_keeps_its_settings(spark, tmp_path):
    write(spark, str(tmp_path), 0, FAR)
    stream = source(spark, str(tmp_path))
    spark.conf.unset(S.PROVIDER)
    with pytest.raises(ValueError, match="stateStore"):
        S.coalesce_changes_stream(stream)
    with pytest.raises(ValueError, match="stateStore"):
        L.log_changes_stream(stream)


def test_late_rows_can_be_told_apart(spark):
    df = spark.createDataFrame([("d", "t", START + dt.timedelta(seconds=s), s) for s in (0, 49, 50, 60)], SCHEMA)
    late = S.late_changes(df, START + dt.timedelta(seconds=60), delay="10 seconds")
    assert sorted(r.pos for r in late.collect()) == [0, 49]


def test_repeats_are_suppressed_while_the_watermark_allows(spark, tmp_path):
    path = str(tmp_path)
    at = lambda s: START + dt.timedelta(seconds=s)
    write(spark, path, 0, [("d", "t", at(0), 1), ("d", "u", at(1), 2)])
    write(spark, path, 1, [("d", "t", at(4), 3)])
    write(spark, path, 2, [("d", "x", at(100), 4)])
    write(spark, path, 3, [("d", "x", at(101), 5)])  # expired keys are cleared with the batch after
    write(spark, path, 4, [("d", "t", at(102), 6)])
    got = run(S.dedup_changes_stream(source(spark, path), watermark="10 seconds"), path)
    assert sorted(r.pos for r in got.collect()) == [1, 2, 4, 6]


def test_batch_bounds():
    assert B.batch_bounds("kafka", 1000, 500) == ({"maxOffsetsPerTrigger": "500"}, {"processingTime": "1000 milliseconds"})
    assert B.batch_bounds("json", 10)[0] == {"maxFilesPerTrigger": "10"}


LOG = "server_id int, pos bigint, event_type string, gtid string, table_id bigint, db string, tbl string, query string"


@pytest.fixture(scope="module")
def log_parts():
    from test_ordering import make_log

    rows = sorted(make_log(11), key=lambda r: r[1])
    third = len(rows) // 3
    return [rows[:third], rows[third : 2 * third], rows[2 * third :]]


def test_log_order_is_carried_over_batches_and_restarts(spark, tmp_path, log_parts):
    path = str(tmp_path)
    # the middle batch lacks one server: its state must survive
    parts = [log_parts[0], [r for r in log_parts[1] if r[0] == 1], [r for r in log_parts[1] if r[0] == 2] + log_parts[2]]
    columns = ["server_id", "pos", "gtid", "seq_no", "db", "tbl"]

    def go():
        carried = B.LogBatches(spark, f"{path}/state", block_bits=4)
        query = (
            source(spark, path, LOG)
            .writeStream.foreachBatch(
                carried.writer(lambda df, n: df.select(*columns).write.mode("overwrite").parquet(f"{path}/rows/b={n}"))
            )
            .option("checkpointLocation", f"{path}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    write(spark, path, 0, parts[0], LOG)
    go()
    write(spark, path, 1, parts[1], LOG)
    write(spark, path, 2, parts[2], LOG)
    go()
    whole = spark.createDataFrame([r for p in parts for r in p], LOG)
    want = T.resolve_table_map(T.tx_sequence(whole, block_bits=4), block_bits=4).select(*columns)
    got = spark.read.parquet(f"{path}/rows").select(*columns)
    order = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert order(got) == order(want)


TIMED_LOG = LOG + ", ts timestamp, rows array<struct<before:array<string>,after:array<string>>>"


def timed(rows):
    """Events a second apart, row events of one to three rows."""
    images = lambda r: [(None, [str(i)]) for i in range(r[1] % 3 + 1)] if "ROWS" in (r[2] or "") else None
    return [(*r, START + dt.timedelta(seconds=r[1]), images(r)) for r in rows]


def far_event(server):
    return (server, 10**9, "GTID", "far:1", None, None, None, None, START + dt.timedelta(days=90), None)


def test_raw_log_is_put_in_order_over_batches_and_restarts(spark, tmp_path, log_parts):
    """Cut in transactions, out of order within and over batches, and some of it delivered twice."""
    path, columns = str(tmp_path), ["server_id", "pos", "gtid", "tx_start", "seq_no", "db", "tbl", "ts", "event_type"]
    rows = timed(sum(log_parts, []))
    rng = random.Random(3)
    arrival = sorted(rows, key=lambda r: r[1] + rng.randint(0, 20))
    cut = len(rows) // 3
    changes = lambda: L.log_changes_stream(source(spark, path, TIMED_LOG).withColumn("n_rows", F.size("rows")), "40 seconds", carry=["n_rows"])
    write(spark, path, 0, arrival[:cut], TIMED_LOG)
    run(changes(), path)
    write(spark, path, 1, arrival[cut - 10 : 2 * cut], TIMED_LOG)
    write(spark, path, 2, arrival[:5] + arrival[2 * cut :], TIMED_LOG)
    write(spark, path, 3, [far_event(0)], TIMED_LOG)
    got = run(changes(), path)
    whole = spark.createDataFrame(rows, TIMED_LOG).withColumn("n_rows", F.size("rows"))
    want = T.resolve_table_map(T.tx_sequence(whole, block_bits=4), block_bits=4)
    order = lambda df: sorted((tuple(r) for r in df.select(*columns, "n_rows").collect()), key=str)
    assert order(got) == order(want)


def test_published_from_a_raw_log_stream_as_from_a_table(spark, tmp_path, log_parts):
    path, rows = str(tmp_path), timed(sum(log_parts, []))
    known = spark.createDataFrame([("db1", "t1", 0, "id", "int")], "db string, tbl string, ordinal int, column string, mysql_type string")
    routes = [("first", "%.t1"), ("rest", "d%.%")]
    settings = dict(ignore="%.t3", gap_ms=7000)
    published = lambda: flows.publish_stream_from_log(source(spark, path, TIMED_LOG), known, F.lit(1), routes, watermark="5 seconds", **settings)
    third = len(rows) // 3
    write(spark, path, 0, rows[:third], TIMED_LOG)
    run(published(), path)
    write(spark, path, 1, rows[third : 2 * third + 1], TIMED_LOG)
    write(spark, path, 2, rows[2 * third + 1 :], TIMED_LOG)
    write(spark, path, 3, [far_event(0)], TIMED_LOG)
    got = sorted((r.topic, r.key, r.value) for r in run(published(), path).collect())
    want = flows.publish(spark.createDataFrame(rows, TIMED_LOG), known, F.lit(1), routes, block_bits=4, **settings)
    assert got == sorted((r.topic, r.key, r.value) for r in want.collect())
    assert len(got) > 50 and len(set(got)) < len(got)  # several rows of an event


def test_progress_survives_a_repeated_batch(spark, tmp_path):
    table = B.ProgressTable(spark, str(tmp_path / "progress"))
    assert table.load() is None
    df = spark.createDataFrame([(1, 5), (1, 9), (2, 3)], "server_id int, pos bigint").withColumn("offset", O.format_position(F.lit("b.1"), "pos"))
    table.save(df, 0)
    table.save(df.filter("pos > 100"), 1)
    for _ in range(2):
        table.save(df.filter("server_id = 2").withColumn("pos", F.col("pos") + 1).withColumn("offset", F.lit("b.1:4")), 2)
        assert sorted((r.server_id, r.offset) for r in table.load().collect()) == [(1, "b.1:9"), (2, "b.1:4")]


def test_many_batches_leave_few_files(spark, tmp_path):
    """Whatever batch a restart repeats, the rows are the same, and old folders go."""
    table, path = B.ProgressTable(spark, str(tmp_path / "progress")), str(tmp_path / "state")
    frame = lambda n: spark.createDataFrame([(n % 3, n, f"b.1:{n}")], "server_id int, pos bigint, offset string")
    for n in range(30):
        for _ in range(1 + (n % 7 == 0)):
            table.save(frame(n), n)
            B.keep_state(frame(n), path, n)
        assert B.kept_batches(spark, path) == [m for m in (n - 1, n) if m >= 0]
        assert {(r.server_id, r.pos) for r in table.load().collect()} == {(m % 3, m) for m in range(max(0, n - 2), n + 1)}
        if n:
            assert B.state_before(spark, path, n).first().pos == n - 1
    assert len(list(tmp_path.rglob("*.parquet"))) <= 8
    (tmp_path / "state" / "31").mkdir()  # begun, not finished
    assert B.kept_batches(spark, path) == [28, 29]
    with pytest.raises(ValueError, match="missing"):
        B.state_before(spark, path, 5)


def test_extraction_goes_on_where_the_batch_before_ended(spark, tmp_path):
    at = lambda s: START + dt.timedelta(seconds=s)
    source = spark.createDataFrame([(i, at(i), "a") for i in range(0, 100, 10)] + [(7, at(7), "b")], "id int, made timestamp, Database string")
    progress = spark.createDataFrame([("a", "2024-01-01 00:00:05.000")], "dbName string, job_time string")
    seen = {}
    extract = E.ExtractBatches(spark, str(tmp_path), lambda: source, "made", progress)
    write = extract.writer(lambda rows, n: seen.__setitem__(n, sorted((r.dbName, r.id) for r in rows.collect())))

    def releases(*runs):
        return spark.createDataFrame([(db, at(t), at(run)) for db, t, run in runs], "Database string, ts timestamp, run_ts timestamp")

    write(releases(("a", 8, 20), ("a", 25, 35)), 0)
    for _ in range(2):  # repeated after a failure
        write(releases(("b", 0, 10)), 1)
    write(releases(("a", 40, 50)), 2)
    assert seen == {0: [("a", 10), ("a", 20), ("a", 30)], 1: [("b", 7)], 2: [("a", 40)]}


def test_first_change_keeps_its_columns_in_a_stream(spark, tmp_path):
    path = str(tmp_path)
    schema = SCHEMA + ", Type string, n int"
    at = lambda s: START + dt.timedelta(seconds=s)
    write(spark, path, 0, [("d", "t", at(1), 2, "UPDATE", None), ("d", "t", at(0), 1, "INSERT", 5), ("d", "t", at(0), 0, None, 7)], schema)
    write(spark, path, 1, [("d", "t", at(9), 3, "DELETE", 8), ("", "", at(3600), 4, "", 0)], schema)
    merged = S.coalesce_changes_stream(source(spark, path, schema), watermark="1 second", carry=["Type", "n"])
    got = run(merged, path)
    assert sorted((r.pos, r.n_merged, r.Type, r.n) for r in got.collect()) == [(0, 3, None, 7), (3, 1, "DELETE", 8)]


def test_held_rows_are_packed(spark):
    """A state element holds many rows, whatever nulls they have."""
    schema = S.held_schema(S.T.StructType([S.T.StructField("n", S.T.LongType()), S.T.StructField("s", S.T.StringType())]))
    import pandas as pd

    rows = S.as_table(pd.DataFrame({"n": [1.0, None] * 50_000, "s": ["a", None] * 50_000}), schema)
    elements = S.packed(rows)
    assert len(elements) == 2 and S.unpacked(iter(elements), schema).equals(rows)
    assert S.unpacked((), schema).num_rows == 0 and S.packed(rows.slice(0, 0)) == []


def test_equal_places_of_two_servers_have_one_first_event(spark):
    """Of events that agree in table, time and order the same one is first, in whatever order they come."""
    rows = [("d", "t", START, 5, kind, n) for kind, n in (("B", 1), ("A", 3), ("A", 2), ("C", 1))]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        frame = spark.createDataFrame(order, "Database string, Table string, ts timestamp, pos bigint, kind string, n int")
        assert [(r.kind, r.n) for r in C.coalesce_changes(frame).collect()] == [("A", 2)]


@pytest.mark.parametrize("n", [10, 2_000_000])
def test_staged_parts_have_equal_files(spark, n):
    """A part of a large log is written by several tasks; a micro-batch is still one part."""
    from checks import streams

    path = streams._staged(spark, spark.range(n).withColumnRenamed("id", "pos"), "test", 2)
    files = streams._files_at_once(path, spark)
    assert files == (4 if n > 1000 else 1)
    for part in (0, 1):
        own = spark.read.parquet(f"{path}/part={part}")
        assert len(own.inputFiles()) == files
        assert own.agg(F.min("pos"), F.max("pos")).first() == (part * n // 2, (part + 1) * n // 2 - 1)


class Kept:
    """A state of any kind, as Python values."""

    def __init__(self):
        self.one, self.many, self.by_key = None, [], {}

    def exists(self):
        return self.one is not None or bool(self.many)

    def get(self):
        return self.one if self.one is not None else iter(list(self.many))

    def update(self, value):
        self.one = value

    def put(self, values):
        self.many = list(values)

    def appendList(self, values):  # noqa: N802
        self.many += values

    def clear(self):
        self.one, self.many = None, []

    def containsKey(self, key):  # noqa: N802
        return key in self.by_key

    def getValue(self, key):  # noqa: N802
        return self.by_key.get(key)

    def updateValue(self, key, value):  # noqa: N802
        self.by_key[key] = value

    def removeKey(self, key):  # noqa: N802
        self.by_key.pop(key)


class Handle:
    def __init__(self):
        self.states, self.timers = {}, []

    def state(self, name, *_):
        return self.states.setdefault(name, Kept())

    getListState = getValueState = getMapState = state  # noqa: N815

    def listTimers(self):  # noqa: N802
        return list(self.timers)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


def ordered_log(monkeypatch, batches, sorted_rows=1 << 14, piece_rows=1 << 8):
    """Frames of a log through its operator, batch by batch as (frames, watermark): rows handed on, most Arrow bytes in use, the state."""
    monkeypatch.setattr(L, "SORTED_ROWS", sorted_rows, raising=False)
    monkeypatch.setattr(L, "PIECE_ROWS", piece_rows, raising=False)
    monkeypatch.setattr(L, "ROWS_AT_ONCE", 1 << 12)
    text, number = T_.StringType(), T_.LongType()
    kept = [("pos", number), ("event_kind", text), ("event_at", number), ("event_type", text), ("gtid", text), ("table_id", number), ("db", text), ("tbl", text)]
    out = [("server_id", number), *(x for x in kept if x[0] in ("pos", "event_at", "event_type")), ("gtid", text), ("tx_start", number), ("seq_no", number), ("db", text), ("tbl", text)]
    schemas = [T_.StructType([T_.StructField(*x) for x in xs] + more) for xs, more in ((kept, []), (out, [T_.StructField(S.RELEASED, T_.TimestampType())]))]
    log, handle, most, rows = L.LogOrder(["server_id"], "pos", *schemas), Handle(), 0, []
    log.init(handle)
    base = pa.total_allocated_bytes()
    for frames, watermark in batches:

        def fed():
            nonlocal most
            for frame in frames:
                yield frame
                most = max(most, pa.total_allocated_bytes() - base)

        handed = log.handleInputRows((1,), fed(), Watermark(watermark)) if frames else log.handleExpiredTimer((1,), Watermark(watermark), None)
        for frame in handed:
            most = max(most, pa.total_allocated_bytes() - base)
            rows += frame[["pos", "gtid", "tx_start", "seq_no", "db", "tbl"]].itertuples(index=False, name=None)
    return rows, most, handle


def log_frames(n, size, shuffled=True):
    """A start, a map and two rows, over and over, in any order, a frame at a time; and what becomes of the rows."""
    pos, k = np.arange(n), np.arange(n) % 4
    kind = np.array(["start", "map", "row", "row"], object)[k]
    gtid = np.where(k == 0, [f"u:{p // 4 + 1}" for p in pos], None)
    db = np.where(k == 1, [f"d{p // 4 % 5}" for p in pos], None)
    frame = pd.DataFrame({"pos": pos, "event_kind": kind, "event_at": pos * 1000, "event_type": kind, "gtid": gtid, "table_id": np.where(k == 0, np.nan, pos // 4 % 3), "db": db, "tbl": db})
    order = np.random.default_rng(1).permutation(n) if shuffled else pos
    wanted = [(p, f"u:{p // 4 + 1}", p - p % 4, p % 4 - 1, f"d{p // 4 % 5}", f"d{p // 4 % 5}") for p in pos.tolist() if p % 4 > 1]
    return [frame.iloc[order[i : i + size]] for i in range(0, n, size)], wanted


@pytest.mark.parametrize("shuffled", [True, False])
def test_a_server_may_write_any_number_of_events_between_two_watermarks(monkeypatch, shuffled):
    """A task has a part of them in memory, as they come in and as they are released."""
    frames, wanted = log_frames(400_000, 10_000, shuffled)
    whole = sum(pa.Table.from_pandas(f).nbytes for f in frames)
    rows, most, handle = ordered_log(monkeypatch, [(frames, 0), ([], 10**9)])
    assert rows == wanted and most < whole / 4
    assert not handle.states["pieces"].by_key and not handle.states["bounds"].many and not handle.timers


def test_a_log_is_released_up_to_the_last_event_that_is_due(monkeypatch):
    """In any pieces: positions and times that do not agree, events that come twice or behind what was released, equal positions."""
    draw = random.Random(8)
    frames, wanted = log_frames(4000, 100)
    frame = pd.concat(frames).sort_values("pos")
    for sizes in ((1 << 14, 1 << 8), (150, 7), (1, 1)):
        parts = [frame.iloc[1000 * i : 1000 * (i + 1)].sample(frac=1, random_state=i) for i in range(4)]
        again = frame.iloc[[5, 400, 999]].assign(event_type="again", event_kind="row")
        parts[1] = pd.concat([parts[1].sample(frac=1, random_state=9), again])  # released before
        parts[2] = pd.concat([parts[2], parts[2].iloc[:50].assign(gtid="later")])  # the first of equal positions counts
        batches = [([p.iloc[i : i + 90] for i in range(0, len(p), 90)], w) for p, w in zip(parts, (1001, 1990, draw.randint(2000, 2900), 3500))]
        rows, _, handle = ordered_log(monkeypatch, [*batches, ([], 5000)], *sizes)
        assert rows == wanted and not handle.states["pieces"].by_key
