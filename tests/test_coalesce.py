import datetime as dt
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.operators import coalesce as C
from tidelog.operators.groups import whole_groups

START = dt.datetime(2024, 1, 1)


def brute(rows, gap):
    """(key, at, order) rows merged one after the other."""
    out = []
    for key in {r[0] for r in rows}:
        anchor = None
        for _, at, order in sorted((r for r in rows if r[0] == key), key=lambda r: r[1:]):
            if anchor is None or at > anchor + gap:
                anchor = at
                out.append([key, at, order, 0, at])
            out[-1][3] += 1
            out[-1][4] = at
    return sorted(map(tuple, out), key=str)


def log(seed, n=300):
    """A busy key with two thirds of all rows and no pauses, a regular one, a sparse one and one without a name."""
    rng = random.Random(seed)
    rows, order = [], 0
    for key, steps, size in (("hot", [0, 1, 1, 2], 4 * n), ("beat", [3], n), ("quiet", [1, 50, 300], n // 3), (None, [0, 7], n)):
        at = -rng.randint(0, 50)
        for _ in range(size):
            at += rng.choice(steps)
            order += 1
            rows.append((key, at, order))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "gap,block_gaps,block_rows,follow_rows,fan", [(1, 1, 0, 0, 10), (4, 2, 0, 1, 3), (7, 3, 2, 10, 2), (10, 64, 7, 5, 4), (40, 256, 3, 1, 6), (300, 4, 1, 0, 5)]
)
def test_windows_across_blocks(spark, monkeypatch, gap, block_gaps, block_rows, follow_rows, fan):
    """Blocks of time and of equal depth, also shorter than a gap; steps followed at once and composed in several rounds."""
    monkeypatch.setattr(C, "FAN_BITS", fan)
    if block_rows:
        monkeypatch.setattr(C, "BLOCK_ROWS", block_rows)
    if follow_rows:
        monkeypatch.setattr(C, "FOLLOW_ROWS", follow_rows)
    rows = log(gap)
    df = spark.createDataFrame(rows, "k string, t bigint, pos bigint").repartition(3)
    counted = C.anchored_windows(df, ["k"], F.col("t"), gap, "pos", block_gaps, {"n": F.lit(1)})
    got = sorted((tuple(r) for r in counted.select("k", "window_start", "pos", "n", "window_last").collect()), key=str)
    assert got == brute(rows, gap)
    bare = C.anchored_windows(df, ["k"], F.col("t"), gap, "pos", block_gaps)
    assert sorted((tuple(r) for r in bare.select("k", "window_start", "pos").collect()), key=str) == [w[:3] for w in brute(rows, gap)]


def opened_by_hand(times, gap, anchor):
    out = []
    for t in times:
        if anchor is None or t > anchor + gap:
            anchor = t
            out.append(t)
    return out


def test_block_steps_lead_to_the_right_exit():
    rng = np.random.default_rng(5)
    for _ in range(100):
        gap = int(rng.integers(1, 12))
        length = gap * int(rng.integers(1, 6))
        numbers = rng.integers(-3, 50, size=4)
        parts = [np.unique(rng.integers(n * length, (n + 1) * length, size=int(rng.integers(1, 40)))) for n in numbers]
        starts = np.cumsum([0, *[len(p) for p in parts[:-1]]])
        blocks = C.Blocks(np.concatenate(parts), starts, gap)
        group, froms, outs, passes = blocks.steps()
        for back in range(1, 3 * gap):
            anchors = numbers * length - back
            opens = blocks.opened(anchors, np.ones(4, dtype=bool))
            for g, part in enumerate(parts):
                want = opened_by_hand(part, gap, anchors[g])
                assert part[opens[blocks.group == g]].tolist() == want
                mine = np.argsort(froms[group == g], kind="stable")
                step = mine[int(np.searchsorted(froms[group == g][mine], anchors[g] + gap, side="right")) - 1]
                exit_ = anchors[g] if passes[group == g][step] else outs[group == g][step]
                assert exit_ == (want[-1] if want else anchors[g])
        opens = blocks.opened(np.zeros(4, dtype=np.int64), np.zeros(4, dtype=bool))
        for g, part in enumerate(parts):
            assert part[opens[blocks.group == g]].tolist() == opened_by_hand(part, gap, None)


def test_composed_steps_are_steps_one_after_the_other():
    rng = np.random.default_rng(7)
    for _ in range(200):
        gap = int(rng.integers(1, 30))
        times = np.unique(rng.integers(0, 200, size=int(rng.integers(3, 60))))
        starts = np.unique(np.r_[0, rng.integers(0, len(times), size=4)])
        group, froms, outs, passes = C.Blocks(times, starts, gap).steps()
        parts = []
        for g in range(len(starts)):
            mine = np.flatnonzero(group == g)
            mine = mine[np.argsort(froms[mine], kind="stable")]
            parts.append(C.Steps.read(froms[mine], pa.array(outs[mine], mask=passes[mine])))
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.then(part, gap)
        assert len(whole.froms) <= len(times) and (whole.froms[1:] > whole.froms[:-1]).all()
        for anchor in [C._NEVER, *range(-gap - 3, 0)]:
            want = np.array([anchor])
            for part in parts:
                want = part.after(want, gap)
            opened = opened_by_hand(times, gap, None if anchor == C._NEVER else anchor)
            assert whole.after(np.array([anchor]), gap)[0] == want[0] == (opened[-1] if opened else anchor)


def test_groups_over_batch_borders():
    rng = np.random.default_rng(1)
    for _ in range(100):
        sizes = rng.integers(1, 9, size=int(rng.integers(1, 9)))
        key = np.repeat(np.arange(len(sizes)), sizes)
        table = pa.table({"a": pa.array([None if k == 0 else f"k{k // 2}" for k in key], pa.string()), "b": key % 2, "i": np.arange(len(key))})
        cuts = np.sort(rng.integers(0, len(key) + 1, size=int(rng.integers(0, 6))))
        edges = [0, *cuts.tolist(), len(key)]
        batches = [b for lo, hi in zip(edges, edges[1:]) for b in table.slice(lo, hi - lo).to_batches()]
        seen, at = [], 0
        for part, starts in whole_groups(iter(batches), ["a", "b"]):
            assert part.column("i").to_pylist() == list(range(at, at + part.num_rows))
            seen += [at + int(s) for s in starts]
            at += part.num_rows
        assert at == len(key) and seen == np.flatnonzero(np.r_[True, key[1:] != key[:-1]]).tolist()


def changes(spark, rows):
    return spark.createDataFrame(
        [(db, tbl, START + dt.timedelta(milliseconds=ms), pos, {"p": str(pos)}) for db, tbl, ms, pos in rows],
        "Database string, Table string, ts timestamp, pos bigint, Data map<string,string>",
    )


def test_first_change_stands_for_a_burst(spark):
    df = changes(spark, [("a", "t", 0, 1), ("a", "t", 2999, 2), ("a", "t", 3000, 3), ("a", "t", 3001, 4), ("a", "u", 10, 5), ("at", "", 20, 6)])
    got = C.coalesce_changes(df).orderBy("pos").collect()
    assert [(r.pos, r.n_merged, r.Data["p"]) for r in got] == [(1, 3, "1"), (4, 1, "4"), (5, 1, "5"), (6, 1, "6")]
    assert [r.ts for r in got][:1] == [START]


def test_the_gap_has_a_floor(spark):
    df = changes(spark, [("a", "t", 0, 1), ("a", "t", 100, 2), ("a", "t", 101, 3)])
    assert [r.pos for r in C.coalesce_changes(df, gap_ms=1, counts=False).orderBy("pos").collect()] == [1, 3]


def test_rows_seen_twice_give_one_window(spark):
    df = changes(spark, [("a", "t", 0, 1), ("a", "t", 0, 1), ("a", "t", 5000, 2)])
    assert [(r.pos, r.n_merged) for r in C.coalesce_changes(df).orderBy("pos").collect()] == [(1, 2), (2, 1)]


def test_one_pending_notice_per_database(spark):
    df = changes(spark, [("a", "t", 0, 1), ("a", "u", 9000, 2), ("b", "t", 1, 3), ("a", "t", 10001, 4)])
    merged = C.coalesce_by_database(df)
    assert sorted((r.Database, r.pos, r.n_merged) for r in merged.collect()) == [("a", 1, 2), ("a", 4, 1), ("b", 3, 1)]
    now = F.lit(START + dt.timedelta(seconds=10, microseconds=1000))
    assert [r.Database for r in C.release_after(merged, now=now).collect()] == ["a"]


def test_batches_never_split_an_event(spark):
    df = spark.createDataFrame([(1, 1, 100), (1, 2, 10)], "server_id int, pos bigint, n_rows int")
    got = C.bounded_batches(df, 50, block_bits=2).orderBy("first_pos").collect()
    assert [(r.first_pos, r.n_events, r.batch_rows) for r in got] == [(1, 1, 100), (2, 1, 10)]


def test_batches_against_filling_one_after_the_other(spark):
    rng = random.Random(2)
    sizes = [(s, p, rng.choice([1, 1, 2, 9, 60])) for s in (1, 2) for p in range(300)]
    df = spark.createDataFrame(sizes, "server_id int, pos bigint, n_rows int").repartition(4)
    want = []
    for server in (1, 2):
        filled = None
        for _, pos, n in sorted(x for x in sizes if x[0] == server):
            if filled is None or filled >= 50:
                filled = 0
                want.append([server, pos, 0, 0])
            filled += n
            want[-1][2] += 1
            want[-1][3] += n
    got = C.bounded_batches(df, 50, block_bits=4, block_gaps=3).select("server_id", "first_pos", "n_events", "batch_rows")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))


def test_speed_of_full_runs(spark):
    sends = [(i, 10, 1000 + 100 * i) for i in range(70)]
    df = spark.createDataFrame(sends, "batch_id bigint, n_rows bigint, at_ms bigint")
    got = sorted(map(tuple, C.throughput(df).select("run", "n_rows", "elapsed_ms", "rows_per_sec").collect()))
    assert got == [(0, 310, 3000, 103), (1, 310, 3100, 100)]


def test_tumbling_form(spark):
    df = changes(spark, [("a", "t", 0, 1), ("a", "t", 59_999, 2), ("a", "t", 60_000, 3)])
    got = C.coalesce_tumbling(df, ["Database", "Table"], "ts", "1 minute").orderBy("pos").collect()
    assert [(r.pos, r.n_merged) for r in got] == [(1, 2), (3, 1)]


def test_changes_without_a_time_are_kept(spark):
    df = spark.createDataFrame(
        [("a", "t", None, 1), ("a", "t", START, 2), (None, "t", START, 3)], "Database string, Table string, ts timestamp, pos bigint"
    )
    assert sorted(r.pos for r in C.coalesce_changes(df).collect()) == [1, 2, 3]
    few = C.coalesce_changes(df, expect_few=True, counts=False)
    assert sorted(r.pos for r in few.collect()) == [1, 2, 3]
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
