import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import ordering as T
from tidelog.operators.scan import fill_forward, number_transactions, running_sum

LOG = "server_id int, pos bigint, event_type string, gtid string, table_id bigint, db string, tbl string, query string"


def make_log(seed: int, n: int = 400, skip_gtid_until: int = 0):
    """Two servers; transactions of every length, also empty ones and ones longer than a block, ids with gaps."""
    rng = random.Random(seed)
    rows, txn = [], {(s, u): 0 for s in (1, 2) for u in "ab"}
    for server in (1, 2):
        pos = 0
        for i in range(n):
            pos += rng.choice([1, 1, 2, 40])
            kind = rng.choice(["GTID", "TABLE_MAP", "ROW", "ROW", "ROW", "ROW", "XID", "QUERY"])
            gtid = table = db = tbl = query = None
            if kind == "GTID":
                if i < skip_gtid_until:
                    kind = "XID"
                else:
                    u = rng.choice("aaab")
                    txn[server, u] += rng.choice([1, 1, 1, 3])
                    gtid = f"{u}{server}:{txn[server, u]}"
            elif kind in ("TABLE_MAP", "ROW"):
                table = rng.choice([1, 2, 3])
                if kind == "TABLE_MAP":
                    db, tbl = f"d{rng.randint(1, 2)}", f"t{rng.randint(1, 5)}"
                else:
                    kind = rng.choice(["WRITE_ROWS", "EXT_DELETE_ROWS"])
            elif kind == "QUERY":
                query = rng.choice(["COMMIT", "BEGIN"])
            rows.append((server, pos, kind, gtid, table, db, tbl, query))
    rng.shuffle(rows)
    return rows


def walk(rows):
    """The log read one event after the other."""
    out = {}
    for server in (1, 2):
        gtid, seq, start, maps, seen = None, 0, None, {}, {}
        known = None
        for r in sorted(x for x in rows if x[0] == server):
            _, pos, kind, g, table, db, tbl, _ = r
            if kind == "GTID":
                known = {u: sorted(v) for u, v in seen.items()}
                gtid, seq, start = g, 0, pos
                u, n = g.split(":")
                seen.setdefault(u, set()).add(int(n))
            elif kind == "TABLE_MAP":
                maps[table] = (db, tbl)
            row = kind.endswith("ROWS")
            seq += row
            out[server, pos] = (gtid, start, seq if row else None, maps.get(table, (None, None)) if row else None, known)
    return out


def set_text(known, base=()):
    seen = {u: set(v) for u, v in (known or {}).items()}
    for u, lo, hi in base:
        seen.setdefault(u, set()).update(range(lo, hi + 1))
    parts = []
    for u in sorted(seen):
        runs, numbers = [], sorted(seen[u])
        for n in numbers:
            if runs and runs[-1][1] + 1 == n:
                runs[-1][1] = n
            else:
                runs.append([n, n])
        if runs:
            parts.append(u + ":" + ":".join(str(a) if a == b else f"{a}-{b}" for a, b in runs))
    return ",".join(parts)


@pytest.mark.parametrize("bits", [2, 5, 30])
def test_log_operators_against_reading_in_order(spark, bits):
    rows = make_log(bits, skip_gtid_until=20)
    log = spark.createDataFrame(rows, LOG).repartition(5)
    want = walk(rows)
    got = {(r.server_id, r.pos): (r.gtid, r.tx_start, r.seq_no) for r in T.tx_sequence(log, block_bits=bits).collect()}
    assert got == {k: v[:3] for k, v in want.items()}
    got = {(r.server_id, r.pos): r.gtid for r in T.assign_transaction(log, block_bits=bits).collect()}
    assert got == {k: v[0] for k, v in want.items()}
    got = {(r.server_id, r.pos): (r.db, r.tbl) for r in T.resolve_table_map(log, block_bits=bits).collect()}
    assert got == {k: v[3] for k, v in want.items() if v[3] is not None}


@pytest.mark.parametrize("bits", [4, 30])
def test_event_offsets_with_gaps_and_two_sources(spark, bits):
    rows = make_log(7, 250)
    log = spark.createDataFrame(rows, LOG)
    want = walk(rows)
    got = {(r.server_id, r.pos): (r.gtid_set, r.incomplete) for r in T.event_offset(log, "a1:2-4,z:1", block_bits=bits).collect()}
    base = [("a1", 2, 4), ("z", 1, 1)]
    expected = {
        k: (set_text(v[4], base), {v[0]: v[2]}) if v[0] else (None, None) for k, v in want.items() if v[2] is not None
    }
    assert got == expected


def test_running_values_and_strictness(spark):
    rows = [(1 + i % 2, i, i * 3 % 7) for i in range(200)]
    df = spark.createDataFrame(rows, "server_id int, pos bigint, v int")
    got = running_sum(running_sum(df, "upto", F.col("v"), block_bits=3), "before", F.col("v"), block_bits=3, strict=True)
    for r in got.collect():
        upto = sum(v for s, p, v in rows if s == r.server_id and p <= r.pos)
        assert (r.upto, r.before) == (upto, upto - r.v)
    filled = fill_forward(df, "last", F.col("v"), F.col("v") == 0, block_bits=2, strict=True).withColumn("p", F.lit(1))
    for r in filled.collect():
        assert r["last"] == (0 if any(s == r.server_id and p < r.pos and v == 0 for s, p, v in rows) else None)


def test_log_without_servers(spark):
    df = spark.createDataFrame([(1, "GTID", "u:1"), (2, "WRITE_ROWS", None), (9, "WRITE_ROWS", None)], "pos bigint, event_type string, gtid string")
    got = [(r.pos, r.gtid, r.seq_no) for r in T.tx_sequence(df, keys=(), block_bits=2).orderBy("pos").collect()]
    assert got == [(1, "u:1", None), (2, "u:1", 1), (9, "u:1", 2)]
    offsets = T.event_offset(df, keys=(), block_bits=2).orderBy("pos").collect()
    assert [(r.gtid_set, r.incomplete) for r in offsets] == [("", {"u:1": 1}), ("", {"u:1": 2})]


def test_continuing_an_open_transaction(spark):
    rows = make_log(3)
    cut = 300
    log = spark.createDataFrame(rows, LOG)
    whole = T.tx_sequence(log, block_bits=4)
    tail = whole.filter(F.col("pos") <= cut).groupBy("server_id").agg(
        F.max_by(F.struct("gtid", F.col("tx_start").alias("start")), "pos").alias("tx"),
        F.max(F.struct("tx_start", F.coalesce("seq_no", F.lit(0)).alias("n"))).alias("last"),
    )
    before = tail.select("server_id", "tx", F.col("last.n").cast("bigint").alias("seq_no"))
    rest = T.tx_sequence(log.filter(F.col("pos") > cut), block_bits=4, open_before=before)
    columns = ["server_id", "pos", "gtid", "tx_start", "seq_no"]
    got = sorted(rest.select(*columns).collect(), key=lambda r: r[:2])
    assert got == sorted(whole.filter(F.col("pos") > cut).select(*columns).collect(), key=lambda r: r[:2])


TWO_TX = [
    (1, 1, "GTID", "u:4", None, None, None, None),
    (1, 2, "TABLE_MAP", None, 7, "test", "foo", None),
    (1, 3, "WRITE_ROWS", None, 7, None, None, None),
    (1, 4, "WRITE_ROWS", None, 7, None, None, None),
    (1, 5, "GTID", "u:5", None, None, None, None),
    (1, 6, "WRITE_ROWS", None, 7, None, None, None),
    (1, 7, "XID", None, None, None, None, None),
]


def test_open_transaction_and_resume_in_the_middle(spark):
    log = spark.createDataFrame(TWO_TX, LOG)
    first, second, third = T.event_offset(log, "u:1-3").orderBy("pos").collect()
    assert (first.gtid_set, first.incomplete) == ("u:1-3", {"u:4": 1})
    assert (second.gtid_set, second.incomplete) == ("u:1-3", {"u:4": 2})
    assert (third.gtid_set, third.incomplete) == ("u:1-4", {"u:5": 1})
    numbered = T.tx_sequence(log).filter("event_type = 'WRITE_ROWS'")
    saved = '{"gtidSet":"u:1-3","incompleteTransactions":{"u:4":1}}'
    assert [(r.gtid, r.seq_no) for r in T.start_position(numbered, saved=saved).orderBy("pos").collect()] == [("u:4", 2), ("u:5", 1)]
    state = {r.gtid: (r.seq_no, r.complete) for r in T.transaction_state(T.tx_sequence(log)).collect()}
    assert state == {"u:4": (2, False), "u:5": (1, True)}


def test_where_reading_starts(spark):
    numbered = T.tx_sequence(spark.createDataFrame(TWO_TX, LOG)).filter("event_type = 'WRITE_ROWS'")

    def positions(**how):
        return sorted(r.pos for r in T.start_position(numbered, **how).collect())

    assert positions(saved="u:1-4", initial="u:1-5") == [6]
    assert positions(initial="u:1-5", from_beginning=True) == []
    assert positions(from_beginning=True, purged="u:1-4") == [6]
    assert positions(from_beginning=True, purged="u:1-4", gtid_mode=False) == [3, 4, 6]
    assert positions(executed="u:1-3") == [3, 4, 6]
    assert positions(saved="bin.000000:3", gtid_mode=False) == [4, 6]
    assert positions(executed="bin.000001:0", gtid_mode=False) == []


def test_filtered_events_move_the_offset(spark):
    log = spark.createDataFrame([(1, "a:1"), (2, "a:2"), (3, "a:3")], "pos bigint, o string")
    assert T.high_water_offset(log, "o").first().offset == "a:3"


def test_system_rows_without_metadata_keep_their_numbers(spark):
    rows = [(1, 1, "GTID", "u:1", None, None, None, None)] + [
        (1, 2 + i, "WRITE_ROWS", None, 1, db, "t", None) for i, db in enumerate(["mysql", "test", "mysql", "test"])
    ]
    kept = T.drop_system_without_metadata(T.tx_sequence(spark.createDataFrame(rows, LOG)), F.lit(False))
    assert [r.seq_no for r in kept.filter("seq_no is not null").orderBy("pos").collect()] == [2, 4]


def test_number_transactions_without_rows_in_a_block(spark):
    df = spark.createDataFrame([(1, 0, "g:1", True, False), (1, 1000, None, False, True)], "server_id int, pos bigint, gtid string, s boolean, c boolean")
    got = number_transactions(df, F.col("s"), F.col("c"), block_bits=1).orderBy("pos").collect()
    assert [(r.tx.gtid, r.seq_no) for r in got] == [("g:1", 0), ("g:1", 1)]


def test_now_without_gtids_needs_a_position(spark):
    numbered = spark.createDataFrame([(5, "WRITE_ROWS", None, 1)], "pos bigint, event_type string, gtid string, seq_no bigint")
    with pytest.raises(ValueError, match="executed"):
        T.start_position(numbered, gtid_mode=False)
    assert T.start_position(numbered, gtid_mode=False, executed="bin.000000:4").count() == 1
