"""Near-duplicates by MinHash: a multi-index Hamming join over short signatures, confirmed on whole sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from tidelog.llm.graph import components
from tidelog.llm.texts import WHITE_SPACE, blocks, fold_table, map_texts, mix, shingles, word_hashes
from tidelog.operators.groups import whole_groups
from tidelog.session import settle, small_side

# A signature is VALUES numbers of 16 bits, cut into CHUNKS chunks. Two signatures that differ
# in at most CHUNKS * (ERRORS + 1) - 1 numbers have a chunk with at most ERRORS differing ones.
VALUES = 32
CHUNKS = 8
ERRORS = 1
WIDTH = VALUES // CHUNKS
DISTANCE = CHUNKS * (ERRORS + 1) - 1

ITEMS_AT_ONCE = 100_000  # a set beyond that is worked on at once

_FACTORS = mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)) | np.uint64(1)


def word_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes."""
    table = fold_table(WHITE_SPACE)
    for _, data, offsets in blocks(texts):
        hashes, cuts, _ = word_hashes(data, offsets, table)
        for i in range(len(offsets) - 1):
            yield np.unique(shingles(hashes[cuts[i] : cuts[i + 1]], n))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """For each set (none empty) the low 16 bits of VALUES smallest hashes."""
    ends = np.cumsum([len(s) for s in sets])
    flat, starts = np.concatenate(sets), np.r_[0, ends[:-1]]
    out = np.zeros((len(sets), VALUES), np.uint64)
    for i, factor in enumerate(_FACTORS):
        hashed = flat * factor
        hashed ^= hashed >> np.uint64(32)
        out[:, i] = np.minimum.reduceat(hashed, starts)
    return mix(out) & np.uint64(0xFFFF)


def chunk_keys(values: np.ndarray) -> np.ndarray:
    """The keys of each signature: every chunk without each of its numbers.

    With one error allowed to a chunk, two chunks match if they agree on all numbers but
    one. A key holds the three numbers that are left (48 bits), and which ones they are.
    """
    keys = []
    for chunk in range(CHUNKS):
        for skipped in range(WIDTH):
            key = np.full(len(values), chunk * WIDTH + skipped, np.uint64)
            for i in range(WIDTH):
                if i != skipped:
                    key = key << np.uint64(16) | values[:, chunk * WIDTH + i]
            keys.append(key)
    return np.stack(keys, axis=1).astype(np.int64)


def _features(texts: pa.Array, n: int) -> list[pa.Array]:
    """Size, digest and signature of each text's set, for a few sets at a time."""
    sizes = np.zeros(len(texts), np.int64)
    signs = np.zeros((len(texts), VALUES), np.uint16)
    digests = np.zeros((len(texts), 2), np.uint64)
    some: dict[int, np.ndarray] = {}
    for i, items in enumerate(word_sets(texts, n)):
        sizes[i] = len(items)
        if len(items):
            some[i] = items
            digests[i] = mix(items).sum(), mix(items ^ np.uint64(0x6A09E667F3BCC909)).sum()
        if some and (len(some) >= 256 or len(items) > ITEMS_AT_ONCE):
            signs[list(some)] = signatures(list(some.values()))
            some = {}
    if some:
        signs[list(some)] = signatures(list(some.values()))
    return [
        pa.array(sizes),
        pa.array([r.tobytes() for r in digests], pa.binary()),
        pa.array(list(signs.view(np.int64)), pa.list_(pa.int64())),
    ]


def _with_keys(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                signs = batch.column(1).flatten().to_numpy().view(np.uint16).reshape(-1, VALUES)
                keys = chunk_keys(signs.astype(np.uint64))
                node = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], names=["key", "node"])

    return nodes.select("node", "sign").mapInArrow(run, "key bigint, node bigint")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets have at least ``percent`` of their union in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, two = (np.frombuffer(z.as_py(), np.uint64) for z in (x, y))
                both = len(np.intersect1d(one, two, assume_unique=True))
                good.append(100 * both >= percent * (len(one) + len(two) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], names=["a", "b"])

    first = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    return (
        first.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
        .select("a", "b", "x", "y")
        .mapInArrow(run, "a bigint, b bigint")
    )


def _sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame, n: int) -> DataFrame:
    """The whole sets of the ``wanted`` nodes, written once: (node, items)."""

    def compute(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([s.tobytes() for s in word_sets(texts, n)], pa.binary())]

    some = docs.select(F.col(doc_id).alias("node"), F.col(text).alias("text")).join(small_side(wanted), "node", "left_semi")
    made = map_texts(some, "text", ["node"], [StructField("items", BinaryType())], compute)
    return settle(made.select(F.col("row.node").cast("bigint").alias("node"), "items"))


def _first_shared(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For all pairs of two lists of signatures: number of the first key they share (VALUES: none), and values that differ."""
    first = np.full((len(one), len(two)), VALUES)
    apart = np.zeros((len(one), len(two)), np.int64)
    for chunk in reversed(range(CHUNKS)):
        wrong = [one[:, None, i] != two[None, :, i] for i in range(chunk * WIDTH, (chunk + 1) * WIDTH)]
        count = np.sum(wrong, axis=0)
        apart += count
        for skipped in reversed(range(WIDTH)):
            first[count - wrong[skipped] == 0] = chunk * WIDTH + skipped
    return first, apart


def _links_of_unit(key: int, own: bool, sides: list[dict], percent: int) -> list[tuple[int, int]]:
    """Links between nodes of different components, one for each two components that a link joins.

    ``sides`` are two lists of nodes, or twice the same one (``own``). A pair is looked at under the first key it shares only.
    """
    one, two = sides
    first, _ = _first_shared(one["sign"], two["sign"])
    sizes = np.minimum.outer(one["size"], two["size"]), np.maximum.outer(one["size"], two["size"])
    common = np.minimum.outer(one["common"], two["common"]), np.maximum.outer(one["common"], two["common"])
    lone = np.add.outer(one["size"] - one["common"], two["size"] - two["common"])
    wanted = (first == key >> 48) & (one["component"][:, None] != two["component"][None, :])
    # what only one set has is in no intersection, but in the union
    wanted &= (100 * sizes[0] >= percent * sizes[1]) & (100 * common[0] >= percent * (lone + common[1]))
    if own:
        wanted &= np.arange(len(one["node"]))[:, None] < np.arange(len(two["node"]))[None, :]
    if not wanted.any():
        return []
    known, ids = np.unique(np.concatenate([*one["items"], *two["items"]]), return_inverse=True)
    cut = sum(map(len, one["items"]))
    mine, theirs = np.split(ids[:cut], np.cumsum([len(x) for x in one["items"]])[:-1]), ids[cut:]
    starts = np.cumsum([0, *(len(x) for x in two["items"])])[:-1]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            x = up
        return x

    links = []
    flags = np.zeros(len(known), bool)
    for i in np.flatnonzero(wanted.any(axis=1)):
        flags[mine[i]] = True
        both = np.add.reduceat(flags[theirs].astype(np.int64), starts)
        flags[mine[i]] = False
        good = wanted[i] & (100 * both >= percent * (one["size"][i] + two["size"] - both))
        for j in np.flatnonzero(good):
            x, y = root(int(one["component"][i])), root(int(two["component"][j]))
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((int(one["node"][i]), int(two["node"][j])))
    return links


def _links_between(apart: DataFrame, able: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among members of a bucket, ``apart`` (key, node, component), that are in different components.

    Buckets are cut into blocks of about ITEMS_AT_ONCE shingles, and each two blocks are compared in one task: however many
    members a bucket has, a task holds two blocks, and only links leave it. The sets come with ``able`` (node, n_shingles, common,
    sign, items) and join the rows last.
    """
    thin = settle(apart.join(able.select("node", "n_shingles"), "node"))
    sized = thin.groupBy("key").agg(
        (F.sum("n_shingles") / ITEMS_AT_ONCE).cast("bigint").alias("blocks"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    rows = thin.join(settle(sized.where("x < y").select("key", "blocks")), "key")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks") + 1))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks"))))
    rows = rows.select("key", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"), "block", "node", "component")
    rows = rows.join(able.select("node", "common", "sign", "items"), "node")
    rows = rows.select("key", "low", "high", "block", "node", "component", "common", "sign", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["key", "low", "high"]):
            keys, low, high, block, node, component, common = (table[i].to_numpy() for i in range(7))
            signs, items = table["sign"].combine_chunks(), table["items"].combine_chunks()
            links = []
            for a, b in zip(starts, [*starts[1:], table.num_rows]):
                if b - a < 2 or (component[a:b] == component[a]).all():
                    continue
                sides = []
                for side in (low[a], high[a]):
                    at = a + np.flatnonzero(block[a:b] == side)
                    sets = [np.frombuffer(items[int(i)].as_py(), np.uint64) for i in at]
                    sides.append(
                        {
                            "node": node[at], "component": component[at], "common": common[at], "items": sets,
                            "size": np.array([len(x) for x in sets], np.int64),
                            "sign": np.array([signs[int(i)].as_py() for i in at], np.int64).reshape(-1, VALUES // 4).view(np.uint16),
                        }
                    )
                if all(len(s["node"]) for s in sides):
                    links += _links_of_unit(int(keys[a]), low[a] == high[a], sides, percent)
            yield pa.RecordBatch.from_arrays([pa.array([min(x) for x in links], pa.int64()), pa.array([max(x) for x in links], pa.int64())], names=["a", "b"])

    by = ["key", "low", "high"]
    return rows.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "a bigint, b bigint")


def _near_links(docs: DataFrame, doc_id: str, text: str, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) that join all nodes whose sets are near, though not a link for every pair.

    In each bucket the member with the most company in all its buckets meets the others first. Members that
    this leaves in different components are then compared in blocks, unless what they can have in common is too
    little: a set has in common with another one at most those of its shingles that occur twice at all
    among the sets that are still apart.
    """
    sizes = nodes.select("node", "n_shingles", "sign")

    def confirmed(pairs: DataFrame) -> DataFrame:
        wanted = settle(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        return settle(_confirmed(pairs, _sets(docs, doc_id, text, wanted, n), percent))

    members = _with_keys(nodes)
    buckets = settle(members.groupBy("key").agg(F.count("*").alias("company")).where("company > 1"))
    members = settle(members.join(buckets, "key"))
    company = settle(members.groupBy("node").agg(F.sum("company").alias("company")))
    centres = members.select("key", "node").join(company, "node").groupBy("key")
    centres = settle(centres.agg(F.max(F.struct("company", (-F.col("node")).alias("minus"))).alias("c")).select("key", (-F.col("c.minus")).alias("centre")))
    pairs = members.select("key", "node").join(centres, "key").where("node <> centre")
    pairs = settle(pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    for side in ("a", "b"):
        pairs = pairs.join(sizes.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}")), side)
    # no bound on the differing numbers of a signature: it would lose pairs whose sets are near
    near = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"
    links = confirmed(settle(pairs.where(near).select("a", "b")))

    found = components(links)
    apart = settle(members.select("key", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node")))
    mixed = apart.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    apart = settle(apart.join(settle(mixed), "key"))
    if apart.isEmpty():
        return links
    sets = _sets(docs, doc_id, text, settle(apart.select("node").distinct()), n)
    # a node that stands for several texts is not bounded
    plain = sets.join(settle(sets.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")), "node", "left_anti")
    single = _items(sets).groupBy("item").agg(F.min("node").alias("node"), F.count("*").alias("n")).where("n = 1")
    alone = settle(single.join(plain.select("node"), "node", "left_semi").groupBy("node").agg(F.count("*").alias("alone")))
    able = sizes.join(alone, "node", "left").withColumn("common", F.col("n_shingles") - F.coalesce("alone", F.lit(0)))
    # common / size >= percent / 100, as the union is no smaller than the set itself
    able = able.where(f"100 * common >= {percent} * n_shingles").select("node", "n_shingles", "common", "sign")
    able = settle(able.join(sets, "node"))
    return links.union(settle(_links_between(apart, able, percent)))


def _items(sets: DataFrame) -> DataFrame:
    """(node, item) for every shingle of every set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(x.as_py(), np.int64) for x in batch.column(1)]
            for i in range(0, len(lists), 256):
                part = lists[i : i + 256]
                nodes = np.repeat(batch.column(0).slice(i, 256).to_numpy(), [len(x) for x in part])
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(np.concatenate(part))], names=["node", "item"])

    return sets.mapInArrow(run, "node bigint, item bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of ``n``-word shingles share ``percent`` per cent of
    their union; a component is named by its smallest doc_id, which alone is kept.
    Texts without words, null ones included, have empty sets and are linked with nothing.
    Rows without a doc_id are linked with nothing, have no component and are kept. Rows with
    the same doc_id are one document and all have its component.

    Equal sets are one node, so that thousands of copies cost no pairs. Candidates are nodes
    with a common chunk key, which all have that differ in at most DISTANCE numbers; each is confirmed
    on the whole sets. Links that only join what others have joined already are not looked for, all others are.
    """
    features = map_texts(
        docs, text, [doc_id], [StructField("n_shingles", LongType()), StructField("digest", BinaryType()), StructField("sign", ArrayType(LongType()))],
        lambda texts: _features(texts, n),
    ).select(F.col(f"row.{doc_id}").cast("bigint").alias("doc_id"), "n_shingles", "digest", "sign")
    features = settle(features)
    linked = features.where("doc_id is not null and n_shingles > 0")
    # the smallest document of equal sets stands for all
    nodes = settle(linked.groupBy("n_shingles", "digest").agg(F.min("doc_id").alias("node")))
    placed = features.join(nodes, ["n_shingles", "digest"], "left")
    placed = settle(placed.withColumn("node", F.when(F.col("doc_id").isNotNull(), F.col("node"))))
    nodes = placed.where("doc_id = node").select("node", "n_shingles", "sign")
    # a doc_id that has several texts links them
    several = settle(placed.where("node is not null").groupBy("doc_id").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high"))
    own = placed.join(several, "doc_id").select(F.col("node").alias("a"), F.col("low").alias("b")).where("a > b")
    found = components(_near_links(docs, doc_id, text, nodes, n, percent).union(own))
    out = placed.join(found, "node", "left").withColumn("component_id", F.coalesce("component", "node", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
