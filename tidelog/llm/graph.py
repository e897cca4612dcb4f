"""Connected components of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import settle


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as stars: each node tied to the smallest one it reaches by them."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            one, two = root(a), root(b)
            parent[max(one, two)] = min(one, two)
    tied = [(x, r) for x in parent if (r := root(x)) != x]
    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in tied], pa.int64()), pa.array([r for _, r in tied], pa.int64())], names=["a", "b"])


LINKS_AT_ONCE = 500_000  # contracted in one partition, about


def _contract(links: DataFrame) -> tuple[DataFrame, bool]:
    """Links after each partition has contracted its own, in partitions sized by their number; and was it only one?"""
    links = settle(links.distinct())
    parts = links.count() // LINKS_AT_ONCE + 1
    return settle(links.coalesce(parts).mapInArrow(_contracted, "a bigint, b bigint")), parts == 1


def _is_stars(links: DataFrame) -> bool:
    """Does every node have one link upwards at most, and none that has one a link from below?"""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(links.select("b", F.lit(0), F.lit(1)))
    met = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return met.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Columns ``node`` and ``component``, the smallest node reachable, for every node of ``links`` (a, b).

    Every partition first contracts its own links; few links are one partition, and done. Else rounds follow until only
    stars are left: the larger neighbours of a node are tied to its smallest one, and then a node
    and its smaller neighbours to the smallest of them. A node with many links is only
    ever joined with one row, its smallest neighbour, so that Spark can split it.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    links, whole = _contract(links)
    while not whole and not _is_stars(links):
        both = links.select("a", "b").union(links.select("b", "a"))
        low = settle(both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low")))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = settle(large.where("a > b").distinct())
        low = settle(links.groupBy("a").agg(F.min("b").alias("low")))
        small = links.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b")
        links, whole = _contract(small.union(low.select("a", F.col("low").alias("b"))))
    named = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return settle(named.union(links.select("b", "b").distinct()))
