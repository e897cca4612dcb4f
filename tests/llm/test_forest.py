"""Neighbours: recall against brute force, ties, odd vectors, and the levels of a forest."""

import os

import numpy as np
import pytest

from tidelog.llm import forest
from tidelog.llm.forest import BITS, Forest, hash_strings, neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank int, score double"
SF_DIR = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, None, None) for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    out = {}
    for q, v in queries:
        found = sorted((-float((np.array(v, float) * np.array(x, float)).sum()), i) for i, x in rows if i != q)
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


def test_candidates_are_those_of_the_longest_prefix_with_enough():
    draw = np.random.default_rng(1)
    points, queries = draw.standard_normal((300, 8)), draw.standard_normal((20, 8))
    queries[0] = points[5]
    bits = lambda x: [[f"{int(s):064b}" for s in t] for t in hash_strings(x)]
    ours, theirs = bits(points), bits(queries)
    for wanted in (1, 40, 300, 10**6):
        got = Forest(points).candidates(queries, wanted)
        for q in range(20):
            for length in range(BITS, -1, -1):
                match = [[i for i in range(300) if t[i].startswith(u[q][:length])] for t, u in zip(ours, theirs)]
                if len(set(sum(match, []))) >= wanted or length == 0:
                    break
            assert got[q].tolist() == sorted(set(sum(match, [])))


def test_ties_odd_vectors_and_few_rows(spark):
    rows = [(i, [1.0, 0.0]) for i in (9, 3, 7, 20)] + [(40, [0.5, 0.5]), (5, [2.0, 0.0]), (60, [0.0, 0.0]), (80, None), (11, [None, 1.0]), (100, [float("nan"), 1.0]), (13, [float("inf"), 1.0]), (None, [1.0, 1.0]), (3, [1.0, 0.0])]
    rows.append((120, [1.0, 2.0, 3.0]))
    df = frame(spark, rows)
    got = [tuple(r) for r in neighbours(df, df.where("vec_id % 20 = 0"), k=3).orderBy("query_id", "rank").collect()]
    assert got == [(20, 1, 5, 2.0), (20, 2, 3, 1.0), (20, 3, 7, 1.0), (40, 1, 5, 1.0), (40, 2, 3, 0.5), (40, 3, 7, 0.5)]
    assert len(neighbours(df, df.where("vec_id = 40"), k=20).collect()) == 5
    assert neighbours(df.where("false"), df.where("false")).collect() == []


def test_shards_and_blocks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(forest, "SHARD_ROWS", 100)
    monkeypatch.setattr(forest, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(forest, "CANDIDATES", 1e9)  # all: then the result is exact
    draw = np.random.default_rng(2)
    rows = [(i, draw.standard_normal(6).astype(np.float32).tolist()) for i in range(400)] + [(1000 + i, [1.0] * 6) for i in range(200)]
    df = frame(spark, rows)
    got = {}
    for r in neighbours(df, df.where("vec_id % 20 = 0"), k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute(rows, [(i, v) for i, v in rows if i % 20 == 0], 10)
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")
def test_recall(spark):
    from tidelog.llm.queries import QUERIES

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows, [(i, v) for i, v in rows if i % 20 == 0], 20)
    got = {}
    for r in QUERIES["op4_neighbours"](spark, SF_DIR).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = np.mean([len(got[q] & {i for i, _ in x}) / len(x) for q, x in want.items()])
    assert recall >= 0.9, recall
