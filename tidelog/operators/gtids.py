"""Sets of transactions along a log, kept as what changes.

The set of all transactions before an event has as many intervals as the log has gaps and sources, so writing it out for
every transaction is a square. Here a log is cut into blocks; every block has what its own transactions touch of the set at its
beginning, some blocks (as many as the set's growth pays for) the whole set, and every transaction only the interval that it makes by joining the set. Both together are as long as the log. Sets are put
together from them where somebody wants to read one.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import offsets as O
from tidelog.operators.groups import whole_groups
from tidelog.operators.scan import BLOCK_BITS
from tidelog.session import bound_pages, settle, small_side

SERVER = ("server_id",)
TAIL = 128  # intervals at the end of a set that are made into text anew each time
HEAD_SHARE = 16  # a whole set is written down again when it has grown by a part in so many


def parse_gtid_text(gtid_set: str) -> list[tuple[str, int, int]]:
    """Intervals of a set given to the driver as text."""
    intervals = []
    for member in "".join((gtid_set or "").split()).split(","):
        uuid, *ranges = member.split(":")
        for r in ranges:
            lo, _, hi = r.partition("-")
            intervals.append((uuid, int(lo), int(hi or lo)))
    return intervals


class GtidSet:
    """Closed intervals per source, sorted and apart; grows by intervals."""

    def __init__(self, text: str = ""):
        self.lows: dict[str, list[int]] = {}
        self.highs: dict[str, list[int]] = {}
        self.texts: dict[str, str] = {}
        self.fronts: dict[str, tuple[int, str]] = {}  # of a source, so many first intervals as text: a log grows at its end
        for interval in parse_gtid_text(text):
            self.add(*interval)

    def add(self, uuid: str, lo: int, hi: int) -> tuple[int, int]:
        """The interval that now holds these numbers."""
        lows, highs = self.lows.setdefault(uuid, []), self.highs.setdefault(uuid, [])
        first = bisect_right(highs, lo - 2)  # the first that touches
        last = bisect_right(lows, hi + 1)  # behind the last that touches
        if first < last:
            lo, hi = min(lo, lows[first]), max(hi, highs[last - 1])
        lows[first:last], highs[first:last] = [lo], [hi]
        self.texts.pop(uuid, None)
        if uuid in self.fronts and first < self.fronts[uuid][0]:
            del self.fronts[uuid]
        return lo, hi

    def touching(self, uuid: str, lo: int, hi: int) -> list[tuple[str, int, int]]:
        """The intervals that these numbers would join."""
        lows, highs = self.lows.get(uuid, []), self.highs.get(uuid, [])
        first, last = bisect_right(highs, lo - 2), bisect_right(lows, hi + 1)
        return [(uuid, a, b) for a, b in zip(lows[first:last], highs[first:last])]

    def size(self) -> int:
        return sum(map(len, self.lows.values()))

    def _upto(self, uuid: str, n: int, end: int, front: str) -> str:
        ranges = (str(a) if a == b else f"{a}-{b}" for a, b in zip(self.lows[uuid][n:end], self.highs[uuid][n:end]))
        return ":".join((front, *ranges))

    def text(self) -> str:
        for uuid, lows in self.lows.items():
            if uuid not in self.texts:
                n, front = self.fronts.get(uuid, (0, uuid))
                if len(lows) - n > 2 * TAIL:
                    front, n = self._upto(uuid, n, len(lows) - TAIL, front), len(lows) - TAIL
                    self.fronts[uuid] = n, front
                self.texts[uuid] = self._upto(uuid, n, len(lows), front)
        return ",".join(sorted(self.texts.values()))


def _starts(events: DataFrame, order: str, keys: Sequence[str], block_bits: int) -> DataFrame:
    return events.filter(F.col("event_type") == "GTID").select(
        *keys,
        F.shiftright(order, block_bits).alias("_block"),
        F.col(order).cast("bigint").alias("tx_start"),
        O.gtid_uuid("gtid").alias("uuid"),
        O.gtid_txn("gtid").alias("txn"),
    )


def _islands(groups: np.ndarray, sources: np.ndarray, txns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of successive numbers start and end, in the order (group, source, number) that is also returned."""
    order = np.lexsort((txns, sources, groups))
    g, s, t = groups[order], sources[order], txns[order]
    new = np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1]) | (t[1:] > t[:-1] + 1)]
    first = np.flatnonzero(new)
    return order[first], order[np.r_[first[1:], len(t)] - 1]


def block_sets(
    events: DataFrame, base_set: str = "", order: str = "pos", keys: Sequence[str] = SERVER, block_bits: int = BLOCK_BITS, whole: bool = True
) -> DataFrame:
    """For every block of a log in which transactions start: the set before it, ``block_set``, and ``next_block``.

    ``near_set`` is what the block's own transactions touch of that set. Unless ``whole``, ``block_set`` is null but for heads, blocks far enough
    apart that all sets together are as long as the log; ``head_block`` is the last of them.
    ``next_block`` is that of the next start, or of the end of the log. The intervals of each block are
    made first; only these, and one row per block, are followed along the log.
    """
    keys, group = list(keys), [*keys, "_block"]
    starts = _starts(events, order, keys, block_bits)
    key_fields = [starts.schema[k] for k in group]
    numbers = [T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType())]
    own_schema = T.StructType([*key_fields, T.StructField("uuid", T.StringType()), *numbers])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, firsts in whole_groups(batches, group):
            txns = table.column("txn")
            some = np.flatnonzero(txns.is_valid().to_numpy())
            which = np.searchsorted(firsts, np.arange(table.num_rows), side="right") - 1
            sources = table.column("uuid").combine_chunks().dictionary_encode().indices
            a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
            values = txns.fill_null(0).to_numpy()
            if len(some):
                a, b = _islands(which[some], sources.fill_null(-1).to_numpy()[some], values[some])
                a, b = some[a], some[b]
            # a block always has a row, also if its transactions have no numbers
            rows = np.r_[a, firsts]
            columns = {name: table.column(name).take(pa.array(rows)) for name in group}
            columns["uuid"] = pa.concat_arrays([table.column("uuid").combine_chunks().take(pa.array(a)), pa.nulls(len(firsts), pa.string())])
            nothing = np.r_[np.zeros(len(a), bool), np.ones(len(firsts), bool)]
            columns["lo"] = pa.array(np.r_[values[a], np.zeros(len(firsts), np.int64)], mask=nothing)
            columns["hi"] = pa.array(np.r_[values[b], np.zeros(len(firsts), np.int64)], mask=nothing)
            yield from pa.table(columns).to_batches()

    out_schema = T.StructType([*key_fields, T.StructField("next_block", T.LongType()), T.StructField("block_set", T.StringType()), T.StructField("near_set", T.StringType()), T.StructField("head_block", T.LongType())])
    from_keys = {k: i for i, k in enumerate(keys)}

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sets are handed on as they are finished, so that a task holds one of them at a time."""
        known, server, head, since = GtidSet(base_set), None, None, 0
        at, own = None, []
        waiting: list[tuple] = []
        size = 0
        kinds = None

        def flush() -> pa.RecordBatch:
            nonlocal waiting, size
            columns = [pa.array(c, t) for c, t in zip(zip(*waiting), kinds)]
            waiting, size = [], 0
            return pa.RecordBatch.from_arrays(columns, names=out_schema.names)

        def closed(following: int) -> None:
            """The block that was read goes out, and its intervals join the set."""
            nonlocal head, since, own, size
            first = head is None
            full = known.text() if whole or first or since * HEAD_SHARE >= known.size() else None
            if full is not None:
                head, since = at, 0
            near = ",".join(f"{u}:{a}-{b}" for u, a, b in sorted({t for i in own for t in known.touching(*i)}))
            for interval in own:
                known.add(*interval)
            waiting.append((*server, at, following, full, near, head))
            size += len(full or "") + len(near)
            since += len(own)
            own = []

        for batch in batches:
            kinds = [*(batch.schema.field(n).type for n in group), pa.int64(), pa.string(), pa.string(), pa.int64()]
            for row in zip(*(batch.column(c).to_pylist() for c in [*group, "uuid", "lo", "hi"])):
                key, block, interval = row[: len(keys)], row[len(keys)], row[len(keys) + 1 :]
                if at is not None and (key != server or block != at):
                    closed(block if key == server else at)
                if key != server or at is None:
                    known, server, head, since = GtidSet(base_set), key, None, 0
                at = block
                if interval[0] is not None:
                    own.append(interval)
                if size > 4 << 20 or len(waiting) > 10_000:
                    yield flush()
        if at is not None:
            closed(at)
        if waiting:
            yield flush()

    intervals = starts.repartition(*group).sortWithinPartitions(*group).mapInArrow(own, own_schema)
    spread = intervals.repartition(*keys) if keys else intervals.coalesce(1)
    found = spread.sortWithinPartitions(*group).mapInArrow(prefix, out_schema)
    ends = events.groupBy(*keys).agg(F.shiftright(F.max(order), block_bits).alias("_end"))
    last = F.col("next_block") == F.col("_block")
    joined = found.join(ends, keys) if from_keys else found.crossJoin(ends)
    return joined.withColumn("next_block", F.when(last, F.col("_end")).otherwise(F.col("next_block"))).drop("_end")


def _folded(starts: DataFrame, blocks: DataFrame, keys: list[str], texts: bool) -> DataFrame:
    """Per transaction the interval it makes and, with ``texts``, the set before it. A block is read in order, its set in hand."""
    group = [*keys, "_block"]
    rows = starts.withColumn("block_set", F.lit(None).cast("string")).withColumn("next_block", F.lit(None).cast("bigint"))
    heads = blocks.select(*group, *(F.lit(None).cast(starts.schema[c].dataType).alias(c) for c in ("tx_start", "uuid", "txn")), "block_set", "next_block")
    number, text = T.LongType(), T.StringType()
    made = [T.StructField("tx_start", number), T.StructField("uuid", text), T.StructField("lo", number), T.StructField("hi", number), T.StructField("_to", number), T.StructField("gtid_set", text)]
    out = T.StructType([*(starts.schema[k] for k in group), *made])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, until, size = GtidSet(), None, 0
        done: list[tuple] = []
        kinds = None

        def flush() -> pa.RecordBatch:
            nonlocal done, size
            columns = [pa.array(c, t) for c, t in zip(zip(*done), kinds)]
            done, size = [], 0
            return pa.RecordBatch.from_arrays(columns, names=out.names)

        held: tuple | None = None  # a transaction lasts to the next one's block, which the next row tells
        for batch in batches:
            kinds = [*(batch.schema.field(n).type for n in group), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            for *where, at, uuid, txn, block_set, next_block in zip(*(batch.column(c).to_pylist() for c in [*group, "tx_start", "uuid", "txn", "block_set", "next_block"])):
                if held is not None:
                    held[-2] = until if at is None else held[len(keys)]
                    done.append(tuple(held))
                    held = None
                if at is None:
                    known, until = GtidSet(block_set), next_block
                    continue
                before = known.text() if texts else None
                lo, hi = known.add(uuid, txn, txn) if txn is not None else (None, None)
                held = [*where, at, uuid, lo, hi, None, before]
                size += len(before or "")
                if size > 4 << 20 or len(done) >= 10_000:
                    if done:
                        yield flush()
        if held is not None:
            held[-2] = until
            done.append(tuple(held))
        if done:
            yield flush()

    return rows.unionByName(heads).repartition(*group).sortWithinPartitions(*group, F.col("tx_start").asc_nulls_first()).mapInArrow(fold, out)


def gtid_deltas(
    events: DataFrame, base_set: str = "", order: str = "pos", keys: Sequence[str] = SERVER, block_bits: int = BLOCK_BITS
) -> tuple[DataFrame, DataFrame]:
    """(blocks, changes): the set before each block, and per transaction the interval (``uuid, lo, hi``) it makes.

    ``blocks`` has ``_block``, ``next_block``, ``block_set`` (null but for heads, of which the first block of a server is one) and ``head_block``; ``changes`` has ``_block``, ``tx_start`` and the interval, which
    swallows those it touches. Read in order after its block's set, they give the set at any place (``gtid_set_at``).
    """
    keys = list(keys)
    blocks = settle(block_sets(events, base_set, order, keys, block_bits, whole=False))
    near = blocks.withColumn("block_set", F.col("near_set"))
    changes = _folded(_starts(events, order, keys, block_bits), near, keys, texts=False)
    return blocks, changes.select(*keys, "_block", "tx_start", "uuid", "lo", "hi")


def gtid_set_at(blocks: DataFrame, changes: DataFrame, places: DataFrame, base_set: str = "", order: str = "pos", keys: Sequence[str] = SERVER, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``places`` (keys, ``order``) with ``gtid_set``: all that started before them.

    From one head to the next a task reads the head's set once, then changes and places in order, and writes the set at each place.
    A set may be megabytes of text, so what is written as Parquet later has its pages bounded (``session.bound_pages``).
    """
    keys = list(keys)
    bound_pages(places.sparkSession)
    server = W.partitionBy(*keys).orderBy("_block")
    sets = blocks.filter(F.col("block_set").isNotNull())
    spans = sets.select(*keys, "_block", F.coalesce(F.lead("_block").over(server), F.lit(1 << 62)).alias("_after"))
    p = places.select(F.struct("*").alias("_row"), *keys, F.col(order).cast("bigint").alias("_at")).alias("p")
    s, at = small_side(spans).alias("s"), F.shiftright("p._at", block_bits)
    inside = [F.col(f"p.{k}") == F.col(f"s.{k}") for k in keys] + [at >= F.col("s._block"), at < F.col("s._after")]
    asked = p.join(s, inside, "left").select("p.*", F.col("s._block").alias("_head"), F.lit(0).alias("_kind"))
    heads = sets.select(*keys, F.col("_block").alias("_head"), F.lit(-1 << 62).alias("_at"), F.lit(-1).alias("_kind"), "block_set")
    grown = changes.join(blocks.select(*keys, "_block", "head_block"), [*keys, "_block"]).select(
        *keys, F.col("head_block").alias("_head"), F.col("tx_start").alias("_at"), F.lit(1).alias("_kind"), "uuid", "lo", "hi"
    )
    log = asked.unionByName(heads, allowMissingColumns=True).unionByName(grown, allowMissingColumns=True)
    columns, group = places.columns, [*keys, "_head"]
    schema = T.StructType([*places.schema.fields, T.StructField("gtid_set", T.StringType())])

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, here = GtidSet(base_set), None
        for batch in batches:
            rows, texts, size = [], [], 0
            own = batch.column("_row")

            def flush() -> pa.RecordBatch:
                row = own.take(pa.array(rows, pa.int64()))
                return pa.RecordBatch.from_arrays([*(row.field(i) for i in range(len(columns))), pa.array(texts, pa.string())], names=[*columns, "gtid_set"])

            for i, (*where, kind, block_set, uuid, lo, hi) in enumerate(zip(*(batch.column(n).to_pylist() for n in [*group, "_kind", "block_set", "uuid", "lo", "hi"]))):
                if where != here:
                    known, here = GtidSet(base_set if block_set is None else block_set), where
                if kind == 0:
                    rows.append(i)
                    texts.append(known.text())
                    size += len(texts[-1])
                elif kind == 1 and lo is not None:
                    known.add(uuid, lo, hi)
                if size > 4 << 20:
                    yield flush()
                    rows, texts, size = [], [], 0
            if rows:
                yield flush()

    names = ["_row", *group, "_kind", "block_set", "uuid", "lo", "hi"]
    # a number of its own: what comes out is far more than what goes in, by which small partitions would be put together
    dealt = log.repartition(int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")), *group)
    return dealt.sortWithinPartitions(*group, F.col("_at").asc_nulls_last(), "_kind").select(*names).mapInArrow(put_together, schema)


def gtid_sets(
    events: DataFrame, base_set: str = "", order: str = "pos", keys: Sequence[str] = SERVER, block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Per transaction (``tx_start``: its start event's order) the set of ``base_set`` and all that started before it, as text.

    One row for each block of the log that a transaction reaches into (``_block``), so that the events of a
    large one find it block by block. Made from the start events alone. The texts are as long as the sets; ``gtid_deltas``
    gives the same without writing each out.
    """
    keys = list(keys)
    blocks = settle(block_sets(events, base_set, order, keys, block_bits))
    folded = _folded(_starts(events, order, keys, block_bits), blocks, keys, texts=True)
    reached = F.explode(F.sequence("_block", F.greatest("_to", "_block")))
    return folded.select(*keys, reached.alias("_block"), "tx_start", "gtid_set")


def merge_intervals(intervals: DataFrame, bucket: int = 1_000_000) -> DataFrame:
    """Union of (uuid, lo, hi) intervals: touching and overlapping ones become one.

    Windows run inside buckets of ``lo``; one row per bucket carries how far the buckets before it reach and where the
    interval that is open there began, so that one busy uuid is spread however many intervals are left of it.
    """
    by_lo = W.partitionBy("uuid", "_slice").orderBy("lo", "hi")
    ahead = by_lo.rowsBetween(W.unboundedPreceding, -1)
    upto = by_lo.rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("uuid").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    slices = intervals.select("uuid", F.expr(f"(lo - pmod(lo, {bucket})) div {bucket}").alias("_slice"), "lo", "hi").distinct()
    local = (
        slices.withColumn("_new", F.when(F.col("lo") <= F.max("hi").over(ahead) + 1, 0).otherwise(1))
        .withColumn("_island", F.sum("_new").over(upto))
        .groupBy("uuid", "_slice", "_island")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .drop("_island")
    )
    local = settle(local)
    reach = local.groupBy("uuid", "_slice").agg(F.max("hi").alias("_hi")).select("uuid", "_slice", F.max("_hi").over(earlier).alias("_reach"))
    opened = local.join(reach, ["uuid", "_slice"]).withColumn("_start", F.when(F.coalesce(F.col("lo") > F.greatest("_reach", F.max("hi").over(ahead)) + 1, F.lit(True)), F.col("lo")))
    carried = opened.groupBy("uuid", "_slice").agg(F.max("_start").alias("_tail")).select("uuid", "_slice", F.max("_tail").over(earlier).alias("_carry"))
    begun = opened.withColumn("_own", F.max("_start").over(upto)).join(carried, ["uuid", "_slice"])
    return begun.groupBy("uuid", F.coalesce("_own", "_carry").alias("lo")).agg(F.max("hi").alias("hi")).select("uuid", "lo", "hi")
