from pyspark.sql import functions as F

from tidelog.functions import offsets as O
from tidelog.operators.ordering import merge_intervals, parse_gtid_text


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_open_and_finished_transactions(spark):
    empty = O.parse_gtid_offset(F.lit("uuid:1-10"))
    opened = O.open_transaction(empty["incompleteTransactions"], F.lit("g1"), F.lit(300))
    offset = F.struct(empty["gtidSet"].alias("gtidSet"), opened.alias("incompleteTransactions"))
    closed = F.struct(O.finish_transaction(opened, F.lit("g1")).alias("incompleteTransactions"))
    contains = [O.contains_event(offset, F.lit(g), F.lit(n)) for g, n in (("g1", 100), ("g1", 300), ("g1", 301), ("g2", 100))]
    got = one(spark, O.contains_event(empty, F.lit("g1"), F.lit(100)), *contains, O.contains_event(closed, F.lit("g1"), F.lit(100)))
    assert list(got) == [False, True, True, False, False, False]


def test_round_trip(spark):
    text = '{"gtidSet":"uuid:1-10","incompleteTransactions":{"g1":300,"g2":500}}'
    parsed = O.parse_gtid_offset(F.lit(text))
    row = one(spark, parsed.alias("p"), O.format_gtid_offset(parsed["gtidSet"], parsed["incompleteTransactions"]).alias("t"))
    assert row.p.gtidSet == "uuid:1-10" and row.p.incompleteTransactions == {"g1": 300, "g2": 500} and row.t == text
    plain = one(spark, O.parse_gtid_offset(F.lit("uuid:1-10")).alias("p")).p
    assert plain.gtidSet == "uuid:1-10" and plain.incompleteTransactions == {}


def test_positions_sort_by_file_number(spark):
    df = spark.createDataFrame([("bin.9", 500), ("bin.10", 4), ("bin.000002", 7)], "f string, p bigint")
    assert [r.f for r in df.orderBy(O.log_order("f", "p")).collect()] == ["bin.000002", "bin.9", "bin.10"]
    parsed = one(spark, O.parse_position(F.lit("bin.10:4")).alias("p")).p
    assert (parsed.file, parsed.pos) == ("bin.10", 4)


def test_gtid_sets(spark):
    text = "u1:1-3:5,\n u2:9"
    assert parse_gtid_text(text) == [("u1", 1, 3), ("u1", 5, 5), ("u2", 9, 9)] and parse_gtid_text("") == []
    rows = spark.range(1).select(F.inline(O.parse_gtid_set(F.lit(text)))).collect()
    assert [tuple(r) for r in rows] == parse_gtid_text(text)


def test_union_of_intervals_over_bucket_borders(spark):
    parts = [("u", 1, 3), ("u", 4, 4), ("u", 10, 2500), ("u", 11, 12), ("u", 999, 1001), ("u", 2502, 2502), ("v", 2, 2), ("v", 2, 2)]
    df = spark.createDataFrame(parts, "uuid string, lo bigint, hi bigint")
    got = sorted(map(tuple, merge_intervals(df, bucket=7).collect()))
    assert got == [("u", 1, 4), ("u", 10, 2500), ("u", 2502, 2502), ("v", 2, 2)]


def test_ranges_in_one_list(spark):
    ranges = F.array(*[F.struct(F.lit(a).cast("bigint").alias("lo"), F.lit(b).cast("bigint").alias("hi")) for a, b in ((7, 9), (1, 2), (3, 3), (8, 12), (20, 20))])
    assert one(spark, O.format_ranges(O.merge_ranges(ranges)))[0] == "1-3:7-12:20"
