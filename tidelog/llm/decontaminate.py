"""Benchmark decontamination by greedy string tiling: which documents hold which test items, in any order of passages."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tidelog.llm.texts import blocks, fold_table, map_texts, shingles, word_hashes
from tidelog.session import settle, small_side

MIN_WORDS = 5  # of a tile, and of a seed
COVERAGE = 0.5  # of an item's words that make a document contaminated
SEEDS_AT_ONCE = 1 << 20  # benchmark seeds sent to the executors together: 16 MB

# ASCII characters that are no letter or digit part words.
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())

_BASE = np.uint64(0x5851F42D4C957F2D)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def token_lists(texts: pa.Array) -> Iterator[np.ndarray]:
    """Each text as hashes of its words, without case and punctuation."""
    table = fold_table(SEPARATORS)
    for _, data, offsets in blocks(pc.utf8_lower(texts)):
        hashes, cuts, _ = word_hashes(data, offsets, table)
        for i in range(len(offsets) - 1):
            yield hashes[cuts[i] : cuts[i + 1]]


def _sums(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the rolling (Karp-Rabin) hashes of all windows of any size are made from."""
    powers, back = (np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(tokens), x)]) for x in (_BASE, _BACK))
    return np.r_[np.uint64(0), np.cumsum(tokens * powers[:-1])], back


def _windows(sums: np.ndarray, back: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all runs of ``size`` unmarked tokens, and their hashes."""
    if len(free) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    taken = np.r_[0, np.cumsum(~free)]
    starts = np.flatnonzero(taken[size:] == taken[:-size])
    return starts, (sums[starts + size] - sums[starts]) * back[starts]


def tiles(doc: np.ndarray, item: np.ndarray, least: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """Greedy string tiling by running Karp-Rabin: (start in doc, start in item, length) of each tile.

    Tiles are common runs of at least ``least`` tokens; none overlaps another on either
    side. The longest free run is always marked first; of equal ones the first in the item, then in the
    document. The longest size that still has a common window is found by halving, as every shorter size has one,
    too; its windows are compared token by token and marked, and the search goes on below that size. Pairs of
    equal windows are never listed, so that the time does not grow with their number in repetitive texts.
    """
    found: list[tuple[int, int, int]] = []
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    sums_doc, sums_item = _sums(doc), _sums(item)

    def shared(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Free windows of the item, and those of the document that the item has, by their hashes."""
        starts, hashes = _windows(*sums_item, free_item, size)
        at, theirs = _windows(*sums_doc, free_doc, size)
        if not len(starts):
            return starts, hashes, at[:0], theirs[:0]
        known = np.sort(hashes)
        hit = known[np.minimum(np.searchsorted(known, theirs), len(known) - 1)] == theirs
        return starts, hashes, at[hit], theirs[hit]

    above = min(len(doc), len(item)) + 1  # no common run of this size is left
    while above > least and len(shared(least)[2]):
        size = least
        while above - size > 1:
            middle = (size + above) // 2
            if len(shared(middle)[2]):
                size = middle
            else:
                above = middle
        starts, hashes, at, theirs = shared(size)
        order = np.argsort(theirs, kind="stable")
        at, theirs = at[order], theirs[order]
        low, high = (np.searchsorted(theirs, hashes, side).tolist() for side in ("left", "right"))
        passed: dict[int, int] = {}  # for each hash, up to where the document's windows are taken
        for j, a, b in zip(starts.tolist(), low, high):
            if a == b or not free_item[j : j + size].all():
                continue
            k = passed.get(a, a)
            while k < b and not free_doc[at[k] : at[k] + size].all():
                k += 1
            passed[a] = k
            for i in map(int, at[k:b]):
                if free_doc[i : i + size].all() and np.array_equal(doc[i : i + size], item[j : j + size]):
                    free_doc[i : i + size] = free_item[j : j + size] = False
                    found.append((i, j, size))
                    break
        above = size
    return found


def _near_seeds(at: np.ndarray, size: int, reach: int) -> np.ndarray:
    """Positions of the ``reach`` tokens of all seeds: all that a tile can cover."""
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, at, 1)
    np.add.at(steps, np.minimum(at + reach, size), -1)
    return np.flatnonzero(np.cumsum(steps[:-1]) > 0)


def covered(doc: np.ndarray, item: np.ndarray, least: int = MIN_WORDS) -> int:
    """How many tokens of the item the tiles cover. Only those parts of the document that hold seeds are tiled."""
    seeds = shingles(item, least)
    at = np.flatnonzero(np.isin(shingles(doc, least), seeds))
    if not len(at):
        return 0
    keep = _near_seeds(at, len(doc), least)
    gaps = np.flatnonzero(np.diff(keep) > 1) + 1
    # a token that occurs nowhere stands between parts that do not touch
    parts = [x for part in np.split(doc[keep], gaps) for x in (part, np.zeros(1, np.uint64))]
    return sum(length for _, _, length in tiles(np.concatenate(parts[:-1]), item, least))


def _text_key(text: str) -> Column:
    """What tells an item's text from all others."""
    return F.sha2(text, 256)


def _parts(items: DataFrame, text: str, least: int) -> Iterator:
    """The different texts of the items in broadcast parts: SEEDS_AT_ONCE seeds, and what the last text has beyond."""

    def counted(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([max(len(t) - least + 1, 0) for t in token_lists(texts)], pa.int64())]

    texts = items.select(F.col(text).alias("text")).where("text is not null").withColumn("key", _text_key("text"))
    texts = texts.dropDuplicates(["key"])
    seeds = map_texts(texts, "text", ["key", "text"], [StructField("seeds", LongType())], counted).where("seeds > 0")
    # a running sum over a few hundred blocks of the key; that of each block starts where the ones before it end
    seeds = settle(seeds.select("row.key", "row.text", "seeds", F.substring("row.key", 1, 2).alias("block")))
    sizes = {r["block"]: r["n"] for r in seeds.groupBy("block").agg(F.sum("seeds").alias("n")).collect()}
    if not sizes:
        yield items.sparkSession.sparkContext.broadcast(([], [], np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        return
    ends = dict(zip(sorted(sizes), np.cumsum([sizes[b] for b in sorted(sizes)]).tolist()))
    start = F.element_at(F.create_map(*(F.lit(x) for b, end in ends.items() for x in (b, end - sizes[b]))), F.col("block"))
    before = F.sum("seeds").over(Window.partitionBy("block").orderBy("key")) - F.col("seeds")
    dealt = settle(seeds.select("key", "text", F.floor((start + before) / SEEDS_AT_ONCE).alias("part")))
    for part in sorted(r["part"] for r in dealt.select("part").distinct().collect()):
        own = dealt.where(F.col("part") == part).select("key", "text").toArrow()
        lists = list(token_lists(own["text"].combine_chunks()))
        flat = [np.unique(shingles(t, least)) for t in lists]
        which = np.repeat(np.arange(len(flat)), [len(f) for f in flat])
        values = np.concatenate(flat)
        order = np.argsort(values, kind="stable")
        yield items.sparkSession.sparkContext.broadcast((own["key"].to_pylist(), lists, values[order], which[order]))


def _hits(docs: DataFrame, text: str, keep: list[str], part, least: int) -> DataFrame:
    """Columns ``row`` (of ``keep``) and ``hits``, one for each item text of the part that has words in the text covered."""
    one = StructType([StructField("key", StringType()), StructField("item_words", LongType()), StructField("covered", LongType())])
    kind = pa.list_(pa.struct([("key", pa.string()), ("item_words", pa.int64()), ("covered", pa.int64())]))

    def compute(texts: pa.Array) -> list[pa.Array]:
        keys, lists, values, which = part.value
        rows: list[list[dict]] = [[] for _ in range(len(texts))]
        table = fold_table(SEPARATORS)
        for first, data, offsets in blocks(pc.utf8_lower(texts)):
            words, cuts, _ = word_hashes(data, offsets, table)
            if len(words) < least or not len(values):
                continue
            # the seeds of all texts at once; those that reach into the next text are none
            seeds = shingles(words, least)
            at = np.minimum(np.searchsorted(values, seeds), len(values) - 1)
            hit = np.flatnonzero(values[at] == seeds)
            owner = np.searchsorted(cuts, hit, "right") - 1
            inside = hit + least <= cuts[owner + 1]
            hit, owner = hit[inside], owner[inside]
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
            for i, mine in zip(owner[starts].tolist(), np.split(hit, starts[1:])):
                own = np.unique(seeds[mine])
                low, high = (np.searchsorted(values, own, side) for side in ("left", "right"))
                for j in sorted({int(x) for a, b in zip(low, high) for x in which[a:b]}):
                    if n := covered(words[cuts[i] : cuts[i + 1]], lists[j], least):
                        rows[first + i].append({"key": keys[j], "item_words": len(lists[j]), "covered": n})
        return [pa.array(rows, kind)]

    return map_texts(docs, text, keep, [StructField("hits", ArrayType(one))], compute)


def overlaps(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """For every row of ``docs`` and item that share ``least`` words in a row: (doc_id, item_id, item_words, covered).

    ``covered`` counts the item's words that greedy string tiling covers. Null and empty texts and those of fewer
    words share nothing. Rows are taken one by one: equal items give a row each, as equal documents do.

    The different texts of the items go to the executors in parts of bounded size; every part meets all documents, so
    that memory is bounded whatever the size of the benchmark, and the documents, which are the large side, are never
    moved. A text is looked for once, however many items have it; their ids are joined to what was found.
    """
    made = [
        _hits(docs, text, [doc_id], part, least).select(F.col(f"row.{doc_id}").alias("doc_id"), F.inline("hits"))
        for part in _parts(items, item_text, least)
    ]
    ids = items.select(F.col(item_id).alias("item_id"), _text_key(item_text).alias("key"))
    return reduce(DataFrame.union, made).join(small_side(ids), "key").select("doc_id", "item_id", "item_words", "covered")


def uncontaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", coverage: float = COVERAGE, least: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` that cover less than ``coverage`` of the words of every item."""
    columns = docs.columns
    for part in _parts(items, item_text, least):
        made = _hits(docs, text, columns, part, least)
        clean = made.where(~F.exists("hits", lambda h: h.covered >= coverage * h.item_words))
        docs = clean.select(*(F.col("row").getField(c).alias(c) for c in columns))
    return docs
