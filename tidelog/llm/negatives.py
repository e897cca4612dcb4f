"""Hard negatives by vertical scans: an anchor reads a shard dimension by dimension, its largest ones first, and what the
dimensions not yet read can add at least and at most leaves ever fewer rows, until scores are exact."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.tables import stored

SHARD_ROWS = 8192  # read together as columns, about
BLOCK_ANCHORS = 1024  # that meet one shard in one task, about
STEP = 8  # dimensions read between two looks at the bounds

Bounds = Callable[[np.ndarray, np.ndarray], np.ndarray]  # lowest and highest scores there can be -> which rows stay


class Shard:
    """Some vectors as columns, with the least and the largest number of each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, anchors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.least, self.most = vectors.min(axis=0), vectors.max(axis=0)
        widest = [max(int(b), -int(a)) for a, b in zip(self.least, self.most)]
        anchored = [max(int(b), -int(a)) for a, b in zip(anchors.min(axis=0), anchors.max(axis=0))]
        reach = sum(x * y for x, y in zip(widest, anchored))
        if reach >= 1 << 62:
            raise OverflowError("inner products beyond 64 bits")
        # whole numbers below 2^53 are exact as doubles, and those are faster
        self.kind = np.float64 if reach < 1 << 52 else np.int64
        self.columns = np.ascontiguousarray(vectors.T, dtype=self.kind)
        self.least, self.most = self.least.astype(self.kind), self.most.astype(self.kind)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, stay: Bounds) -> tuple[np.ndarray, np.ndarray]:
        """The rows left of ``rows`` after all dimensions, and their exact scores."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        a = anchor[order].astype(self.kind)
        ends = np.stack([a * self.least[order], a * self.most[order]])
        low = np.r_[np.cumsum(ends.min(axis=0)[::-1])[::-1], 0]
        high = np.r_[np.cumsum(ends.max(axis=0)[::-1])[::-1], 0]
        scores = np.zeros(len(rows), self.kind)
        for at in range(0, len(order), STEP):
            some = order[at : at + STEP]
            read = self.columns[some] if len(rows) == self.columns.shape[1] else self.columns[some[:, None], rows]
            scores += a[at : at + STEP] @ read
            end = min(at + STEP, len(order))
            kept = stay(scores + low[end], scores + high[end])
            if not kept.all():
                rows, scores = rows[kept], scores[kept]
            if not len(rows):
                break
        return rows, scores.astype(np.int64)

    def first(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the first ``k``: higher scores, then smaller ids."""
        if len(rows) > k:
            some = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            rows, scores = rows[some], scores[some]
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]


def among_first(k: int) -> Bounds:
    """Rows that can still be among the ``k`` highest scores; ties stay."""

    def stay(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(low) <= k:
            return np.ones(len(low), bool)
        return high >= np.partition(low, len(low) - k)[len(low) - k]

    return stay


def within(windows: list[tuple[int, int]], k: int) -> Bounds:
    """Rows that can still be among the ``k`` highest scores inside one of the windows."""

    def stay(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        kept = np.zeros(len(low), bool)
        for least, most in windows:
            sure = low[(low >= least) & (high <= most)]
            floor = np.partition(sure, len(sure) - k)[len(sure) - k] if len(sure) >= k else least
            kept |= (high >= floor) & (low <= most)
        return kept

    return stay


def window(positive: int, least: int, most: int) -> tuple[int, int]:
    """The whole numbers n with least * positive <= 100 * n <= most * positive."""
    return -(-least * positive // 100), most * positive // 100


def _matrix(table: pa.Table, size: int) -> np.ndarray:
    return table["v"].combine_chunks().flatten().to_numpy().reshape(-1, size)


def hard_negatives(
    rows: DataFrame,
    anchors: DataFrame,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "vector",
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Vectors are arrays of whole numbers, scores their inner products; higher scores come first, ties by smaller id. The
    positives of an anchor are its first ``positives`` rows of another id and the same label; the negatives of a positive the
    first ``negatives`` rows of other labels whose score is between ``least`` and ``most`` per cent of the positive's
    (all, if fewer; for scores below 0 there is none).

    Rows take no part, on either side, whose id, label or vector is null or holds a null. Equal rows count once; of different rows
    with one id each counts, and each that is an anchor is asked for by itself. Vectors of different lengths do not meet. Scores beyond 64 bits are refused.

    Rows are dealt by a hash into shards of about SHARD_ROWS, anchors into blocks of about BLOCK_ANCHORS; a task holds one of
    each. A row is sent once for each block, an anchor once for each shard and pass. The positives, known over all
    shards, give the windows of the second pass.
    """

    def taken(df: DataFrame) -> DataFrame:
        picked = df.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{vector}`").cast("array<bigint>").alias("v"))
        there = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull()) & (F.size("v") > 0)
        return stored(picked.where(there).dropDuplicates().withColumn("size", F.size("v")).withColumn("own", F.xxhash64("id", "label", "v")))

    points, asked = taken(rows), taken(anchors)
    shards, blocks = points.count() // SHARD_ROWS + 1, asked.count() // BLOCK_ANCHORS + 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    by = ["shard", "block", "size"]
    left = points.withColumn("shard", F.pmod("own", F.lit(shards)).cast("int")).withColumn("block", every(blocks)).groupBy(*by)

    def scanned(wanted: DataFrame, find: Callable, schema: str) -> DataFrame:
        """``find(shard, anchor, row of wanted)`` gives (values for each result, ids, scores) of an anchor in a shard."""

        def search(key: tuple, here: pa.Table, there: pa.Table) -> pa.Table:
            names = [f.split()[0] for f in schema.split(", ")]
            out: list[list] = [[] for _ in names]
            if here.num_rows and there.num_rows:
                size = key[2].as_py()
                vectors = _matrix(there, size)
                shard = Shard(here["id"].to_numpy(), here["label"].to_numpy(), _matrix(here, size), vectors)
                for anchor, row in zip(vectors, there.drop_columns(["v"]).to_pylist()):
                    for found in find(shard, anchor, row):
                        for column, values in zip(out, found):
                            column.extend(values)
            return pa.table({n: pa.array(v, pa.int64()) for n, v in zip(names, out)})

        dealt = wanted.withColumn("block", F.pmod("own", F.lit(blocks)).cast("int")).withColumn("shard", every(shards))
        return left.cogroup(dealt.groupBy(*by)).applyInArrow(search, schema)

    def same_label(shard: Shard, anchor: np.ndarray, row: dict):
        rows = np.flatnonzero((shard.labels == row["label"]) & (shard.ids != row["id"]))
        ids, scores = shard.first(*shard.scan(anchor, rows, among_first(positives)), positives)
        yield [row["id"]] * len(ids), [row["own"]] * len(ids), ids.tolist(), scores.tolist()

    near = scanned(asked, same_label, "id bigint, own bigint, positive_id bigint, positive_score bigint")
    order = F.row_number().over(Window.partitionBy("id", "own").orderBy(F.desc("positive_score"), "positive_id"))
    near = near.withColumn("place", order).where(F.col("place") <= positives)
    listed = near.groupBy("id", "own").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))

    def other_labels(shard: Shard, anchor: np.ndarray, row: dict):
        windows = [window(p["positive_score"], least, most) for p in row["positives"]]
        rows = np.flatnonzero(shard.labels != row["label"])
        rows, scores = shard.scan(anchor, rows, within(list(dict.fromkeys(windows)), negatives))
        for p, (low, high) in zip(row["positives"], windows):
            some = (scores >= low) & (scores <= high)
            ids, found = shard.first(rows[some], scores[some], negatives)
            yield (*([x] * len(ids) for x in (row["id"], row["own"], p["place"], p["positive_id"], p["positive_score"])), ids.tolist(), found.tolist())

    schema = "anchor_id bigint, own bigint, place bigint, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    made = scanned(asked.join(stored(listed), ["id", "own"]), other_labels, schema)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "own", "place").orderBy(F.desc("negative_score"), "negative_id"))
    made = made.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return made.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
