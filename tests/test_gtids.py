import random
import time

import pyarrow.parquet as pq
import pytest
from test_ordering import LOG, make_log, set_text, walk

from tidelog.operators import gtids as G
from tidelog.operators.gtids import GtidSet, gtid_deltas, gtid_set_at, merge_intervals


def test_sets_grow_by_intervals():
    draw = random.Random(1)
    for _ in range(100):
        known, seen = GtidSet(), {}
        for _ in range(60):
            uuid, lo = draw.choice("ab"), draw.randint(1, 60)
            hi = lo + draw.choice([0, 0, 0, 2, 9])
            a, b = known.add(uuid, lo, hi)
            seen.setdefault(uuid, set()).update(range(lo, hi + 1))
            assert set(range(a, b + 1)) <= seen[uuid] and not {a - 1, b + 1} & seen[uuid] and a <= lo and hi <= b
            assert known.text() == set_text(seen)
    assert GtidSet(" u:1-3:5,\nv:7 , u:4").text() == "u:1-5,v:7" and GtidSet("").text() == ""


@pytest.mark.parametrize("bits", [3, 30])
def test_sets_at_places_and_changes(spark, bits):
    rows = make_log(9, 300)
    log = spark.createDataFrame(rows, LOG).repartition(3)
    blocks, changes = gtid_deltas(log, "a1:2-4,z:1", block_bits=bits)
    starts = {(r[0], r[1]) for r in rows if r[2] == "GTID"}
    got = changes.collect()
    assert sorted((r.server_id, r.tx_start) for r in got) == sorted(starts)
    base = [("a1", 2, 4), ("z", 1, 1)]
    want = walk(rows)
    for r in got:
        seen = {u: set(v) for u, v in (want[r.server_id, r.tx_start][4] or {}).items()}
        seen.setdefault("a1", set()).update([2, 3, 4])
        numbers = seen.setdefault(r.uuid, set())
        own = next(int(x[3].split(":")[1]) for x in rows if (x[0], x[1]) == (r.server_id, r.tx_start))
        numbers.add(own)
        assert r.lo <= own <= r.hi and set(range(r.lo, r.hi + 1)) <= numbers and not {r.lo - 1, r.hi + 1} & numbers
    places = sorted(starts)[::7] + [(1, 0), (2, 10**9), (3, 5)]
    frame = spark.createDataFrame(places, "server_id int, pos bigint")
    found = {(r.server_id, r.pos): r.gtid_set for r in gtid_set_at(blocks, changes, frame, "a1:2-4,z:1", block_bits=bits).collect()}
    assert len(found) == len(places)
    for server, pos in places:
        before = {}
        for r in rows:
            if r[0] == server and r[1] < pos and r[2] == "GTID":
                u, n = r[3].split(":")
                before.setdefault(u, set()).add(int(n))
        assert found[server, pos] == set_text(before, base)


def test_logs_without_numbers_or_transactions(spark):
    frame = spark.createDataFrame([(1, 5, "GTID", None), (1, 9, "WRITE_ROWS", None)], "server_id int, pos bigint, event_type string, gtid string")
    blocks, changes = gtid_deltas(frame, "u:1-3")
    assert [(r.tx_start, r.uuid, r.lo, r.hi) for r in changes.collect()] == [(5, None, None, None)]
    assert [r.block_set for r in blocks.collect()] == ["u:1-3"]
    blocks, changes = gtid_deltas(frame.where("pos > 5"))
    assert blocks.collect() == [] and changes.collect() == []


def test_many_gaps_are_linear(spark):
    """Every other number is missing and commits come out of order: no set is written out but those before blocks."""

    def run(n):
        log = spark.range(n).selectExpr(
            "1 as server_id", "id * 100 as pos", "'GTID' as event_type",
            "concat('u:', 2 * (16 * (id div 16) + (5 * (id % 16)) % 16) + 1) as gtid",
        )
        began = time.monotonic()
        blocks, changes = gtid_deltas(log, block_bits=20)
        assert changes.where("lo = hi").count() == n
        return time.monotonic() - began, sum(len(r.block_set) for r in blocks.collect())

    run(1000)
    (short, _), (long, written) = run(25_000), run(100_000)
    assert long < 6 * short + 3, (short, long)
    assert written < 10 * 100_000 * 8  # ten blocks


def test_intervals_over_buckets(spark):
    draw = random.Random(4)
    intervals, seen = [], {}
    for _ in range(500):
        uuid, lo = draw.choice("ab"), draw.randint(-50, 900)
        hi = lo + draw.choice([0, 1, 3, 200 if uuid == "b" else 2])
        intervals.append((uuid, lo, hi))
        seen.setdefault(uuid, set()).update(range(lo, hi + 1))
    frame = spark.createDataFrame(intervals, "uuid string, lo bigint, hi bigint")
    want = [(u, *map(int, (a, b))) for u in sorted(seen) for a, b in runs(sorted(seen[u]))]
    for bucket in (1, 10, 10**6):
        assert sorted(map(tuple, merge_intervals(frame, bucket).collect())) == want


def runs(numbers):
    out = []
    for n in numbers:
        if out and out[-1][1] + 1 == n:
            out[-1][1] = n
        else:
            out.append([n, n])
    return out


def test_module_is_found_under_its_old_name():
    from tidelog.operators import ordering

    assert ordering.merge_intervals is G.merge_intervals and ordering.gtid_sets is G.gtid_sets


def test_whole_sets_are_written_now_and_then(spark):
    """Small blocks of a log with many gaps: all sets together stay in proportion to the log, and every place finds its own."""

    def run(n):
        log = spark.range(n).selectExpr("1 as server_id", "id * 100 as pos", "'GTID' as event_type", "concat('u:', 2 * id + 1) as gtid")
        blocks, changes = gtid_deltas(log, block_bits=10)
        assert changes.where("lo = hi").count() == n
        return log, blocks, changes, sum(len(r.block_set or "") + len(r.near_set) for r in blocks.collect())

    (*_, short), (log, blocks, changes, long) = run(2000), run(8000)
    assert long < 6 * short
    places = log.where("pos % 50000 = 0").select("server_id", "pos")
    for r in gtid_set_at(blocks, changes, places, block_bits=10).collect():
        assert r.gtid_set == (":".join(["u", *(str(2 * i + 1) for i in range(r.pos // 100))]) if r.pos else "")


def test_sets_are_text_again_after_every_change(monkeypatch):
    """A part of the text is kept; what joins intervals in it, at its end or behind it is seen."""
    monkeypatch.setattr(G, "TAIL", 2)
    draw = random.Random(4)
    for spread in (3, 40, 400):
        known, seen = GtidSet("a:1-3"), {"a": {1, 2, 3}}
        for i in range(400):
            uuid, lo = draw.choice("ab"), max(1, 5 * i + draw.randint(-spread, spread))
            known.add(uuid, lo, lo)
            seen.setdefault(uuid, set()).add(lo)
            assert known.text() == set_text(seen)


def test_long_sets_are_written_in_pages_of_bounded_size(spark, tmp_path):
    """However many long texts a file has, its writer holds a row group of them: not a hundred rows, of megabytes each in a long log."""
    log = spark.range(16000).selectExpr("1 as server_id", "id * 100 as pos", "'GTID' as event_type", "concat('u:', 2 * id + 1) as gtid")
    blocks, changes = gtid_deltas(log, block_bits=14)
    places = log.where("pos % 8000 = 0 and pos > 1200000").select("server_id", "pos")
    found = gtid_set_at(blocks, changes, places, block_bits=14)
    found.coalesce(1).write.option("parquet.block.size", 1 << 20).option("parquet.enable.dictionary", "false").parquet(f"{tmp_path}/sets")
    (file,) = tmp_path.glob("sets/*.parquet")
    groups = pq.ParquetFile(file).metadata
    sizes = [groups.row_group(i).column(2) for i in range(groups.num_row_groups)]
    assert groups.num_rows == 49 and all(c.num_values <= 24 for c in sizes)
