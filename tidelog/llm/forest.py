"""Approximate nearest neighbours by a hash-prefix forest: sorted arrays of long hash strings, searched by longest prefix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import settle

TREES = 32
BITS = 64  # of a hash string
SHARD_ROWS = 4096  # indexed by a forest, about
BLOCK_QUERIES = 1024  # searched in one shard together, about
#: The part of a shard's rows wanted as candidates. As shards do not grow, recall does not fall with the number of
#: rows. Lower it for vectors with close neighbours; those tested have none nearer than 65 degrees.
CANDIDATES = 0.5


def hash_strings(vectors: np.ndarray) -> np.ndarray:
    """For each tree and vector BITS bits: on which side of as many random planes is it?"""
    planes = np.random.default_rng(20).standard_normal((TREES * BITS, vectors.shape[1]))
    bits = (vectors @ planes.T > 0).reshape(len(vectors), TREES, BITS)
    return np.packbits(bits, axis=2).view(">u8").astype(np.uint64)[:, :, 0].T


class Forest:
    """The hash strings of some vectors, sorted in each tree."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        strings = hash_strings(vectors)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, axis=1)

    def _spans(self, strings: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In each tree, where the entries stand that share ``length`` leading bits with the string of each query."""
        rest = np.where(length > 0, np.uint64(0xFFFFFFFFFFFFFFFF) >> np.minimum(length, 63).astype(np.uint64), np.uint64(0xFFFFFFFFFFFFFFFF))
        rest = np.where(length == BITS, np.uint64(0), rest)
        low, high = strings & ~rest, strings | rest
        starts = np.stack([np.searchsorted(s, x, "left") for s, x in zip(self.strings, low)])
        ends = np.stack([np.searchsorted(s, x, "right") for s, x in zip(self.strings, high)])
        return starts, ends

    def candidates(self, queries: np.ndarray, wanted: int) -> list[np.ndarray]:
        """For each query, the rows of the longest prefix at which all trees together have ``wanted`` different ones.

        Each tree is descended to the longest match; then all ascend together, a bit at a time, until there
        are enough. The levels at which even repeated entries are too few are passed over by halving.
        """
        strings = hash_strings(queries)
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), BITS, np.int64)
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            starts, ends = self._spans(strings, middle)
            enough = (ends - starts).sum(axis=0) >= wanted
            low = np.where(open_ & enough, middle, low)
            high = np.where(open_ & ~enough, middle - 1, high)
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        left = np.arange(len(queries))
        while len(left):
            starts, ends = self._spans(strings[:, left], low[left])
            few = []
            for i, q in enumerate(left):
                seen = np.zeros(len(self.vectors), bool)
                for order, a, b in zip(self.order, starts[:, i], ends[:, i]):
                    seen[order[a:b]] = True
                out[q] = np.flatnonzero(seen)
                if len(out[q]) < wanted and low[q] > 0:
                    few.append(q)
            left = np.array(few, np.int64)
            low[left] -= 1
        return out


def scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal vectors get equal ones, wherever they stand."""
    return (vectors * query).sum(axis=1)


def nearest(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query id, id, score) of the best ``k`` candidates of each query, its own id left out."""
    forest = Forest(vectors)
    own = int(np.unique(ids, return_counts=True)[1].max())  # rows that a query's id may have
    wanted = max(k + own, int(CANDIDATES * len(vectors)))
    out_q, out_i, out_s = [], [], []
    for query_id, query, rows in zip(query_ids, queries, forest.candidates(queries, wanted)):
        rows = rows[ids[rows] != query_id]
        found = scores(vectors[rows], query)
        if len(rows) > k:
            some = found >= -np.partition(-found, k - 1)[k - 1]
            rows, found = rows[some], found[some]
        best = np.lexsort((ids[rows], -found))[:k]
        out_q.append(np.full(len(best), query_id))
        out_i.append(ids[rows[best]])
        out_s.append(found[best])
    return np.concatenate(out_q), np.concatenate(out_i), np.concatenate(out_s)


def neighbours(vectors: DataFrame, queries: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` rows with the largest inner product that were found.

    Rows take no part, on either side, whose id or vector is null, whose vector is zero or has a null or
    non-finite component; vectors of different lengths do not meet. Equal rows count once, and
    rows with the query's id are not its neighbours. Equal scores go by the smaller id. With fewer than ``k`` candidates, all.

    Rows are dealt into shards of about SHARD_ROWS, each with a forest of its own, and queries into blocks; a task
    searches a block in a shard, and the best of all shards are the result. Recall therefore depends on the
    size of a shard, not on that of the table, and no task holds more than one shard and one block.
    """
    usable = (
        F.col("v").isNotNull()
        & F.col("id").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )

    def taken(df: DataFrame) -> DataFrame:
        picked = df.select(F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("v"))
        return picked.where(F.coalesce(usable, F.lit(False))).dropDuplicates().withColumn("size", F.size("v"))

    rows, asked = settle(taken(vectors)), settle(taken(queries))
    shards, blocks = rows.count() // SHARD_ROWS + 1, asked.count() // BLOCK_QUERIES + 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).withColumn("block", every(blocks))
    right = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))

    def search(key: tuple, points: pa.Table, wanted: pa.Table) -> pa.Table:
        if not points.num_rows or not wanted.num_rows:
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        else:
            size = key[2].as_py()
            x, y = (t["v"].combine_chunks().flatten().to_numpy().reshape(-1, size) for t in (points, wanted))
            found = nearest(points["id"].to_numpy(), x, wanted["id"].to_numpy(), y, k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found)))

    by = ["shard", "block", "size"]
    made = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(search, "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return made.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
