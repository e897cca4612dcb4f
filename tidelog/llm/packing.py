"""Packing token sequences: bin completion over the counts of lengths, and the places of all pieces by rank."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from tidelog.llm.pretokens import Pieces
from tidelog.llm.texts import map_texts
from tidelog.session import settle

NODES = 100_000  # sizes that the search looks at, at most; then the best packing so far stands
RANKED_AT_ONCE = 4000  # pieces numbered in one group, about

Bins = list[tuple[tuple[int, ...], int]]  # the lengths in a bin, and the number of such bins


def best_fit(counts: Counter, capacity: int) -> Bins:
    """Best-fit decreasing: each length goes to the fullest bin that has room. Bins with equal contents are counted, not listed."""
    by_room: dict[int, Counter] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        rooms = sorted(by_room)
        at = bisect_right(rooms, length - 1)
        while left and at < len(rooms):
            room = rooms[at]
            at += 1
            for content in sorted(by_room[room]):
                if not left:
                    break
                # once in, the bin is the fullest with room for the next one as long as it has any
                fits = room // length
                bins = min(by_room[room][content], left // fits)
                takes = [(bins, fits)] if bins else []
                if bins < by_room[room][content] and left - bins * fits:
                    takes.append((1, left - bins * fits))
                for n, each in takes:
                    each = min(each, fits)
                    by_room[room][content] -= n
                    by_room.setdefault(room - each * length, Counter())[content + (length,) * each] += n
                    left -= n * each
            by_room[room] += Counter()  # drops what is used up
            if not by_room[room]:
                del by_room[room]
        if left:
            fits = capacity // length
            for n, each in ((left // fits, fits), (1 if left % fits else 0, left % fits)):
                if n:
                    by_room.setdefault(capacity - each * length, Counter())[(length,) * each] += n
    return [(content, n) for contents in by_room.values() for content, n in sorted(contents.items())]


def simple_bound(counts: Counter, capacity: int) -> int:
    """No packing has fewer bins: by the sum of all lengths, or by those of which no two share a bin."""
    total = sum(l * n for l, n in counts.items())
    return max(-(-total // capacity), sum(n for l, n in counts.items() if 2 * l > capacity))


def lower_bound(counts: Counter, capacity: int) -> int:
    """No packing has fewer bins, by dual feasible functions: whatever fits one bin has at most value 1 under each.

    One kind counts a length by how many (k + 1)-ths of the capacity it is at least, in k-ths, which sees bins of k items; the other
    rounds long ones up to 1 and very short ones down to 0.
    """
    lengths = np.array([l for l, n in counts.items() if n > 0], np.int64)
    if not len(lengths):
        return 0
    n = np.array([int(counts[int(l)]) for l in lengths])
    if int(n.sum()) * capacity * capacity >= 1 << 62:
        n = n.astype(object)  # exact, however many there are
    best = simple_bound(counts, capacity)

    def value(parts: np.ndarray, of: int) -> int:
        return -(-int((parts * n).sum()) // of)

    for short in np.unique(lengths[2 * lengths <= capacity]):
        best = max(best, value(np.where(lengths > capacity - short, capacity, np.where(lengths < short, 0, lengths)), capacity))
    for k in range(1, capacity // int(lengths.min()) + 1):
        whole = (k + 1) * lengths % capacity == 0
        best = max(best, value(np.where(whole, k * lengths, (k + 1) * lengths // capacity * capacity), k * capacity))
    return best


class Budget:
    """The work a search may still do, counted in sizes looked at."""

    def __init__(self, left: int):
        self.left = left


def _reach(sizes: list[int], room: int) -> list[int]:
    """For each number of the smallest sizes, as bits, the sums they can make if there are any number of each."""
    bits, mask, out = 1, (1 << (room + 1)) - 1, [1]
    for size in sizes:
        while size <= room:
            bits |= bits << size & mask
            size *= 2
        out.append(bits)
    return out


def _of_sum(total: int, sizes: list[int], counts: Counter, reach: list[int], budget: Budget) -> Iterator[tuple[int, ...]]:
    """The ways to make exactly ``total``, larger lengths first. A prefix that cannot be completed is not entered."""
    content: list[int] = []
    used: Counter = Counter()
    tries = [len(sizes) - 1]  # for each place, the next size to try
    rest = total
    while tries and budget.left > 0:
        i = min(tries[-1], bisect_right(sizes, rest) - 1)
        budget.left -= 1
        while i >= 0:
            if not reach[i + 1] >> rest & 1:
                i = -1
            elif used[sizes[i]] < counts[sizes[i]] and reach[i + 1] >> (rest - sizes[i]) & 1:
                break
            i -= 1
            budget.left -= 1
        if i < 0:
            tries.pop()
            if content:
                used[content[-1]] -= 1
                rest += content.pop()
            continue
        tries[-1] = i - 1
        size = sizes[i]
        if rest == size:
            yield (*content, size)
            continue
        content.append(size)
        used[size] += 1
        rest -= size
        tries.append(i)


def _dominated(content: tuple[int, ...], waste: int, sizes: list[int], counts: Counter) -> bool:
    """Is there a filling at least as good that puts a length into the waste, a longer one into the place of one, or one into the place of two?"""
    held = Counter(content)
    for size in (0, *held):
        i = bisect_right(sizes, size)
        while i < len(sizes) and sizes[i] <= size + waste:
            if counts[sizes[i]] > held[sizes[i]]:
                return True
            i += 1
    several = sorted(held)
    for i, a in enumerate(several):
        for b in several[i:]:
            if (a != b or held[a] > 1) and counts[a + b] > held[a + b]:
                return True
    return False


def fillings(room: int, sizes: list[int], counts: Counter, waste: int, budget: Budget) -> Iterator[tuple[int, ...]]:
    """Undominated ways to fill ``room`` that waste at most ``waste``, least waste first, one at a time.

    ``sizes`` are the lengths there are, ascending. A length that fills the room alone dominates all others.
    """
    sizes = sizes[: bisect_right(sizes, room)]
    if sizes and sizes[-1] == room:
        yield (room,)
        return
    if not sizes:
        if room <= waste:
            yield ()
        return
    reach = _reach(sizes, room)
    budget.left -= len(sizes)
    for total in range(room, max(room - waste, 1) - 1, -1):
        if reach[-1] >> total & 1:
            for content in _of_sum(total, sizes, counts, reach, budget):
                budget.left -= len(content)
                if not _dominated(content, room - total, sizes, counts):
                    yield content


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = NODES) -> Bins:
    """As few bins as found: branch and bound over the counts of lengths (at most ``capacity`` of them).

    The largest length left is completed in all undominated ways that waste no more than a better packing
    could, least waste first; each way is taken for as many bins as there are lengths for it, or half as many, and so on
    down to one. Best-fit decreasing is the first incumbent, and best fit of what is left after each step the next ones. Branches are
    taken in the order of how often they leave the first choice, so that early choices are changed as soon as late ones.

    The search ends at the lower bound, when nothing is left to try, or when it has looked at ``nodes`` sizes,
    whether they led to a filling or not; then the best packing so far stands, and ``lower_bound`` says how far from it the fewest can be.
    """
    left = Counter({l: n for l, n in counts.items() if n > 0})
    if not left:
        return []
    total = sum(l * n for l, n in left.items())
    best = best_fit(left, capacity)
    fewest, least = sum(n for _, n in best), lower_bound(left, capacity)
    budget = Budget(nodes)
    done: Bins = []
    bins = waste = 0

    def ways() -> Iterator[tuple[tuple[int, ...], int]]:
        largest = max(left)
        others = left - Counter([largest])
        allowed = (fewest - 1) * capacity - total - waste
        for filling in fillings(capacity - largest, sorted(others), others, allowed, budget):
            content = (largest, *filling)
            n = min(left[l] // c for l, c in Counter(content).items())
            while n:
                yield content, n
                n //= 2

    def put(content: tuple[int, ...], n: int) -> None:
        nonlocal bins, waste, left
        for length, c in Counter(content).items():
            left[length] += -n * c
            if not left[length]:
                del left[length]
        done.append((content, n))
        bins += n
        waste += n * (capacity - sum(content))

    def take_back() -> None:
        nonlocal bins, waste
        content, n = done.pop()
        for length in content:
            left[length] += n
        bins -= n
        waste -= n * (capacity - sum(content))

    changes, more = 0, True
    while more and fewest > least and budget.left > 0:
        more = False
        trail = [[ways(), changes, 0]]  # ways still to try, changes of the first choice allowed from here on, ways tried
        while trail and fewest > least and budget.left > 0:
            untried, allowed, tried = trail[-1]
            choice = next(untried, None) if tried <= allowed else None
            if choice is None:
                more |= tried > allowed
                trail.pop()
                if done:
                    take_back()
                continue
            trail[-1][2] += 1
            put(*choice)
            if waste > (fewest - 1) * capacity - total or left and bins + simple_bound(left, capacity) >= fewest:
                take_back()
                continue
            rest = best_fit(left, capacity)
            budget.left -= 1 + len(left)
            if bins + sum(n for _, n in rest) < fewest:
                best = done + rest
                fewest = sum(n for _, n in best)
            if left:
                trail.append([ways(), allowed - tried, 0])
            else:
                take_back()
        while done:
            take_back()
        changes += 1
    return best


def _slots(bins: Bins) -> dict[int, np.ndarray]:
    """For each length, by the rank of its pieces: rows (first rank, first bin, pieces in a bin, place of the first one)."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    first = 0
    for content, n in bins:
        place = 0
        for length, each in sorted(Counter(content).items(), reverse=True):
            rows.setdefault(length, []).append((ranks[length], first, each, place))
            ranks[length] += n * each
            place += length * each
        first += n
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def pack(pieces: DataFrame, length: str, by: list[str], capacity: int) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: each piece whole in one sequence, from 0 without gaps.

    Columns of these two names that ``pieces`` has are replaced. Lengths are from 1 to ``capacity``; pieces of length null, 0 or above it are refused. ``by``
    orders pieces of equal length; what is equal there may swap places.

    The driver only sees how many pieces of each length there are, at most ``capacity`` numbers. A piece finds
    its place by its rank among those of its length, which is counted in groups of a hash of ``by``, so that
    a length that many pieces have is spread.
    """
    spark = pieces.sparkSession
    columns = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    rows = pieces.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.col(f"`{length}`").cast("bigint").alias("length"))
    rows = settle(rows.withColumn("hash", F.xxhash64(*(F.col("row").getField(c) for c in by))))
    n, bad = rows.agg(F.count("*"), F.count_if(F.coalesce(~F.col("length").between(1, capacity), F.lit(True)))).first()
    if bad:
        raise ValueError(f"{bad} pieces are not between 1 and {capacity} long")
    grouped = rows.withColumn("part", F.pmod("hash", F.lit(n // RANKED_AT_ONCE + 1)))
    sizes = settle(grouped.groupBy("length", "part").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = settle(sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")))
    own = Window.partitionBy("length", "part").orderBy("hash", *(F.col("row").getField(c) for c in by))
    ranked = grouped.withColumn("own", F.row_number().over(own)).join(ahead, ["length", "part"])
    ranked = ranked.select("row", "length", (F.col("ahead") + F.col("own") - 1).alias("rank"))
    slots = spark.sparkContext.broadcast(_slots(bin_completion(counts, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(i).to_numpy() for i in (1, 2))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for one in np.unique(lengths):
                here = np.flatnonzero(lengths == one)
                table = slots.value[int(one)]
                line = table[np.searchsorted(table[:, 0], ranks[here], "right") - 1]
                bin_, within = np.divmod(ranks[here] - line[:, 0], line[:, 2])
                sequence[here] = line[:, 1] + bin_
                offset[here] = line[:, 3] + within * one
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence), pa.array(offset)], names=["row", "sequence_id", "offset"])

    out = StructType([rows.schema["row"], StructField("sequence_id", LongType()), StructField("offset", LongType())])
    placed = ranked.mapInArrow(place, out)
    return placed.select(*(F.col("row").getField(c).alias(c) for c in columns), "sequence_id", "offset")


def token_pieces(docs: DataFrame, text: str, keep: list[str], path: str, capacity: int, end: int = 0) -> DataFrame:
    """The documents as token ids, cut where they exceed ``capacity``: (row, piece, start, ids).

    A document is the ids of its text by the word-level tokenizer at ``path``, without added
    special tokens, and then ``end``. Null and empty texts are the end alone. ``ids`` are little-endian unsigned 32-bit numbers.
    """
    worker: dict[str, Pieces] = {}
    kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("ids", pa.binary())]))

    def compute(texts: pa.Array) -> list[pa.Array]:
        if path not in worker:
            worker[path] = Pieces(path, words=True)
        out = []
        for ids in worker[path].ids(texts):
            data = np.r_[ids, np.uint32(end)].astype("<u4").tobytes()
            step = 4 * capacity
            out.append([{"piece": i, "start": i * capacity, "ids": data[i * step : (i + 1) * step]} for i in range(-(-len(data) // step))])
        return [pa.array(out, kind)]

    one = StructType([StructField("piece", IntegerType()), StructField("start", LongType()), StructField("ids", BinaryType())])
    made = map_texts(docs, text, keep, [StructField("pieces", ArrayType(one))], compute)
    return made.select("row", F.inline("pieces"))
