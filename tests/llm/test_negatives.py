"""Hard negatives: against brute force over several shards, ties, copies, odd rows; what the scan leaves."""

import numpy as np
import pytest

from tidelog.llm import negatives
from tidelog.llm.negatives import Shard, among_first, hard_negatives, window, within

SCHEMA = "vec_id bigint, label int, vector array<bigint>, id string, v int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 0, None) for r in rows], SCHEMA)


def brute(rows, anchors, positives=5, many=10, least=30, most=90):
    out = []
    different = list({(i, l, tuple(v)): None for i, l, v in rows})
    for anchor, label, vector in list({(i, l, tuple(v)): None for i, l, v in anchors}):
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i, l) for i, l, v in different if len(v) == len(vector))
        for p, i, _ in [(-s, i, l) for s, i, l in scored if l == label and i != anchor][:positives]:
            found = [(i2, -s) for s, i2, l in scored if l != label and least * p <= 100 * -s <= most * p][:many]
            out += [(anchor, i, rank, i2, p, n) for rank, (i2, n) in enumerate(found, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def drawn(seed, n, dims=12, labels=4, spread=60):
    draw = np.random.default_rng(seed)
    centres = draw.integers(-spread, spread, (5, dims))
    return [(i, int(draw.integers(labels)), (centres[draw.integers(5)] + draw.integers(-20, 20, dims)).tolist()) for i in range(n)]


def test_shards_and_blocks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD_ROWS", 90)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 5)
    rows = drawn(1, 500) + [(1000 + i, i % 2, [30] * 12) for i in range(200)]  # a crowd of equal vectors
    df = frame(spark, rows)
    want = brute(rows, [r for r in rows if r[0] % 50 == 0])
    assert len(want) > 500
    assert got(hard_negatives(df, df.where("vec_id % 50 = 0"))) == want


def test_other_numbers(spark):
    rows = drawn(2, 150, dims=3, labels=2)
    df = frame(spark, rows)
    asked = [r for r in rows if r[0] % 10 == 0]
    assert got(hard_negatives(df, df.where("vec_id % 10 = 0"), positives=2, negatives=3, least=10, most=100)) == brute(rows, asked, 2, 3, 10, 100)


def test_odd_rows(spark):
    rows = [(0, 1, [5, 0]), (0, 1, [5, 0]), (0, 1, [4, 0]), (1, 1, [4, 1]), (2, 2, [3, 9]), (3, 2, [3, 9]), (5, 1, [-1, 0]), (6, 2, [0, 0]), (7, 1, [1, 2, 3]), (8, 2, [2, 0, 0])]
    odd = [(None, 1, [5, 0]), (9, None, [5, 0]), (10, 2, None), (11, 2, [None, 3]), (12, 2, [])]
    df = frame(spark, rows + odd)
    assert got(hard_negatives(df, df.where("vec_id in (0, 7) or vec_id is null or label is null"))) == brute(rows, [r for r in rows if r[0] in (0, 7)])
    assert got(hard_negatives(df.where("false"), df.where("false"))) == []
    assert got(hard_negatives(df, df.where("false"))) == []
    big = frame(spark, [(0, 1, [1 << 40]), (1, 1, [1 << 40])])
    with pytest.raises(Exception, match="beyond 64 bits"):
        hard_negatives(big, big).collect()


def test_wide_numbers_are_exact(spark):
    rows = [(i, i % 2, [(1 << 29) + i * i, -(1 << 28) + 7 * i]) for i in range(40)]
    df = frame(spark, rows)
    assert got(hard_negatives(df, df.where("vec_id % 10 = 0"), least=1, most=100)) == brute(rows, [r for r in rows if r[0] % 10 == 0], least=1, most=100)


def test_windows_are_exact():
    for p in range(-250, 250):
        low, high = window(p, 30, 90)
        assert [n for n in range(-400, 400) if 30 * p <= 100 * n <= 90 * p] == list(range(low, high + 1))


def test_bounds_drop_rows_early_and_none_that_count():
    draw = np.random.default_rng(3)
    vectors = draw.integers(-50, 50, (2000, 64)) + 200 * np.eye(64, dtype=int)[draw.integers(64, size=2000)]
    anchor = np.round(200 * 0.7 ** np.arange(64)).astype(np.int64)[draw.permutation(64)]
    shard = Shard(np.arange(2000), np.zeros(2000), vectors, anchor[None])
    exact = vectors @ anchor
    read = []

    def counted(stay):
        def look(low, high):
            kept = stay(low, high)
            read.append(int(kept.sum()))
            return kept

        return look

    rows, scores = shard.scan(anchor, np.arange(2000), counted(among_first(5)))
    assert (exact[rows] == scores).all() and sorted(exact)[-5:] == sorted(scores)[-5:]
    assert read[0] < 1000 and read[2] < 100
    low, high = int(np.quantile(exact, 0.5)), int(np.quantile(exact, 0.6))
    rows, scores = shard.scan(anchor, np.arange(2000), within([(low, high)], 10))
    best = sorted(s for s in exact if low <= s <= high)[-10:]
    assert sorted(s for s in scores if low <= s <= high)[-10:] == best
