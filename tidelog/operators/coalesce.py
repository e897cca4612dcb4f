"""Merging bursts of changes.

The first change of a key opens a window anchored at it; changes up to ``gap``
later are merged into it, the next one opens a new window. Every window depends on
the one before, so the log of a key is cut into blocks of time:

1. equal (key, time) rows are combined before anything else is shuffled, and written down,
2. blocks in which a key has very many of them are cut further, so that a block is never more than a task's work,
3. each (key, block) finds, for every change that could open its first window,
   which window is open at the block's end; those runs meet quickly, so only a few
   rows per block are left,
4. these step functions are followed block by block for each key; where a key has too many for one task, those of
   neighbouring blocks are first composed to one, in as many rounds as it takes, and what is
   open is handed down the same rounds,
5. each (key, block), now knowing what is open when it begins, emits its windows.

All steps take up many small groups of a partition at once, so that thousands of
quiet tables cost no more than one busy table with as many rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.groups import whole_groups
from tidelog.operators.scan import BLOCK_BITS, running_sum
from tidelog.session import settle, small_side

GAP_FLOOR_MS = 100
GAP_DEFAULT_MS = 3000
DATABASE_GAP_MS = 10_000
COMMIT_GAP_MS = 60_000
BLOCK_GAPS = 256
BLOCK_ROWS = 200_000  # different times of a key in a block, beyond which the block is cut
FOLLOW_ROWS = 1_000_000  # steps of a key that are followed in one task
FAN_BITS = 10  # blocks, as a power of two, whose steps are composed to one, and parts a block is cut into at most
CHUNK = 32  # cuts of a block that are looked through at once

_NEVER = np.iinfo(np.int64).min


def window_starts(times: np.ndarray, gap: int) -> np.ndarray:
    """Indexes of the sorted times that open a window, the first one included."""
    opened, i = [], 0
    while i < len(times):
        opened.append(i)
        i = int(np.searchsorted(times, times[i] + gap, side="right"))
    return np.asarray(opened, dtype=np.int64)


class Blocks:
    """Sorted times of several (key, block) groups laid end to end.

    Every group gets a stretch of its own on one line, wide enough that a gap never
    reaches from one group into the next; so one search serves all groups.
    """

    def __init__(self, times: np.ndarray, starts: np.ndarray, gap: int):
        n = len(times)
        self.times, self.starts, self.gap = times, starts, gap
        self.begins = times[starts]  # every anchor from before is earlier
        self.ends = np.r_[starts[1:], n]
        self.group = np.repeat(np.arange(len(starts)), self.ends - starts)
        self.base = np.cumsum(np.r_[0, times[self.ends - 1] - self.begins + gap + 1])[:-1]
        self.line = times - self.begins[self.group] + self.base[self.group]
        following = np.searchsorted(self.line, self.line + gap, side="right")
        self.following = np.where(following < self.ends[self.group], following, -1)

    def steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """How the window open before a block decides the one open after it.

        Returns (group, from, exit, passes): an anchor ``a`` takes the last step of the
        group with ``from <= a + gap``; where ``passes``, ``a`` itself stays open.
        """
        n = len(self.times)
        here = np.arange(n)
        jump = np.where(self.following >= 0, self.following, here)
        while True:
            further = jump[jump]
            if np.array_equal(further, jump):
                break
            jump = further
        exits = self.times[jump]
        # the first row above the highest time an earlier anchor can reach is the last that may open first
        last = np.searchsorted(self.line, self.base + self.gap - 1, side="right")
        is_first = np.zeros(n, dtype=bool)
        is_first[self.starts] = True
        differs = np.r_[True, exits[1:] != exits[:-1]]
        rows = np.flatnonzero((here <= last[self.group]) & (is_first | differs))
        passing = np.flatnonzero(last >= self.ends)
        group = np.r_[self.group[rows], passing]
        before = np.where(is_first[rows], _NEVER, self.times[np.maximum(rows - 1, 0)])
        froms = np.r_[before, self.times[self.ends[passing] - 1]]
        outs = np.r_[exits[rows], np.zeros(len(passing), dtype=np.int64)]
        return group, froms, outs, np.r_[np.zeros(len(rows), dtype=bool), np.ones(len(passing), dtype=bool)]

    def opened(self, anchors: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Which rows open a window, given each group's anchor from before (where ``known``)."""
        reach = np.maximum(np.where(known, anchors - self.begins + self.gap, -1), -1)
        at = np.searchsorted(self.line, reach + self.base, side="right")
        at = at[at < self.ends]
        opens = np.zeros(len(self.times), dtype=bool)
        while len(at):
            opens[at] = True
            at = self.following[at]
            at = at[at >= 0]
        return opens


class Steps:
    """How the window open before a stretch of a key decides the one open after it: an anchor takes the last step with
    ``froms <= anchor + gap``; beyond ``passes`` (if not None) it stays open itself. No anchor takes the first step."""

    def __init__(self, froms: np.ndarray, outs: np.ndarray, passes: int | None):
        self.froms, self.outs, self.passes = froms, outs, passes

    @classmethod
    def read(cls, froms: np.ndarray, exits: pa.Array) -> Steps:
        known = exits.is_valid().to_numpy(zero_copy_only=False)
        passing = froms[~known]
        return cls(froms[known], exits.drop_null().to_numpy(), int(passing[0]) if len(passing) else None)

    def after(self, anchors: np.ndarray, gap: int) -> np.ndarray:
        """The anchors after the stretch; _NEVER stands for none before it."""
        reach = np.where(anchors == _NEVER, _NEVER, anchors + gap)
        out = self.outs[np.searchsorted(self.froms, reach, side="right") - 1]
        return out if self.passes is None else np.where(reach >= self.passes, anchors, out)

    def then(self, other: Steps, gap: int) -> Steps:
        """Both, one after the other. Steps that lead to the same window become one."""
        froms, outs, passes = self.froms, other.after(self.outs, gap), None
        if self.passes is not None:  # an anchor that stays open meets the other's own steps
            later = np.searchsorted(other.froms, self.passes, side="right") - 1
            froms = np.r_[froms, np.maximum(other.froms[later:], self.passes)]
            outs = np.r_[outs, other.outs[later:]]
            if other.passes is not None:
                passes = max(self.passes, other.passes)
                some = froms < passes
                froms, outs = froms[some], outs[some]
        differs = np.r_[True, outs[1:] != outs[:-1]]
        return Steps(froms[differs], outs[differs], passes)


def anchored_windows(
    df: DataFrame,
    keys: Sequence[str],
    at: Column,
    gap: int,
    order: str,
    block_gaps: int = BLOCK_GAPS,
    totals: dict[str, Column] | None = None,
    block_rows: int | None = None,
    follow_rows: int | None = None,
) -> DataFrame:
    """Windows per key: ``window_start``, the ``order`` of the first row, ``window_last`` and ``totals`` summed.

    ``at`` is a bigint column; a window holds the rows with ``at`` up to ``gap``
    above its first one. Of rows with equal key and ``at`` the lowest ``order``
    counts as first. Only keys, times, orders and totals are moved, and ``df`` is read once. Without totals
    only the openings are looked for, which saves the last aggregation.
    """
    keys, totals = list(keys), totals or {}
    counts = bool(totals)
    sums = [f"_sum{i}" for i in range(len(totals))]
    group = [*keys, "_block"]
    length = max(gap, 1) * block_gaps
    thin = settle(combined(df, keys, at, order, dict(zip(sums, totals.values()))))
    thin = _blocked(thin, keys, length, block_rows or BLOCK_ROWS)
    key_fields = [f for f in thin.schema.fields if f.name in group]

    step_schema = T.StructType(
        [*key_fields, T.StructField("_from", T.LongType()), T.StructField("_exit", T.LongType())]
    )

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, group):
            which, froms, outs, passes = Blocks(table.column("_at").to_numpy(), starts, gap).steps()
            columns = {name: table.column(name).take(pa.array(starts[which])) for name in group}
            columns["_from"] = pa.array(froms, pa.int64())
            columns["_exit"] = pa.array(outs, pa.int64(), mask=passes)
            yield from pa.table(columns).to_batches()

    ready = thin.repartition(*group).sortWithinPartitions(*group, "_at")
    carried = _followed(settle(ready.mapInArrow(steps, step_schema)), keys, gap, follow_rows or FOLLOW_ROWS)

    out_schema = T.StructType(
        [
            *[f for f in key_fields if f.name != "_block"],
            T.StructField("window_start", T.LongType()),
            T.StructField(order, thin.schema["_first"].dataType),
            *[T.StructField(name, T.LongType()) for name in sums],
            T.StructField("window_last", T.LongType()),
        ]
    )

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mixed, heads in whole_groups(batches, group):
            # the state row, which has no time, is the first of each group
            anchors = mixed.column("_open").take(pa.array(heads))
            known = anchors.is_valid().to_numpy()
            anchors = anchors.fill_null(0).to_numpy()
            is_row = np.ones(mixed.num_rows, dtype=bool)
            is_row[heads] = False
            table, starts = mixed.filter(pa.array(is_row)).combine_chunks(), heads - np.arange(len(heads))
            blocks = Blocks(table.column("_at").to_numpy(), starts, gap)
            opens = blocks.opened(anchors, known)
            edges = opens.copy()
            edges[starts] = True  # rows ahead of a block's first opening belong to the window it began with
            rows = np.flatnonzero(edges)
            ends = np.r_[rows[1:], len(opens)]
            columns = {name: table.column(name).take(pa.array(rows)) for name in keys}
            begun = np.where(opens[rows], blocks.times[rows], anchors[blocks.group[rows]])
            columns["window_start"] = pa.array(begun, pa.int64())
            picked = pa.array(rows, pa.int64(), mask=~opens[rows])
            columns[order] = table.column("_first").take(picked)
            for name in sums:
                columns[name] = pa.array(np.add.reduceat(table.column(name).to_numpy(), rows), pa.int64())
            columns["window_last"] = pa.array(blocks.times[ends - 1], pa.int64())
            made = pa.table(columns)
            yield from (made if counts else made.filter(pa.array(opens[rows]))).to_batches()

    opened = (
        thin.unionByName(carried, allowMissingColumns=True)
        .repartition(*group)
        .sortWithinPartitions(*group, F.col("_at").asc_nulls_first())
        .mapInArrow(windows, out_schema)
    )
    if not counts:
        return opened.drop("window_last")
    return opened.groupBy(*keys, "window_start").agg(
        F.min(order).alias(order),
        *[F.sum(name).alias(name_) for name, name_ in zip(sums, totals)],
        F.max("window_last").alias("window_last"),
    )


def combined(df: DataFrame, keys: list[str], at: Column, order: str, totals: dict[str, Column]) -> DataFrame:
    """One row per key and ``_at``: the lowest order as ``_first``, and the totals. Every task combines its own rows first."""
    picked = df.select(*keys, at.alias("_at"), F.col(order).alias("_first"), *[total.cast("bigint").alias(name) for name, total in totals.items()])
    return picked.groupBy(*keys, "_at").agg(F.min("_first").alias("_first"), *[F.sum(name).alias(name) for name in totals])


def _blocked(thin: DataFrame, keys: list[str], length: int, most: int) -> DataFrame:
    """``thin`` with ``_block``: spans of time, and parts of equal depth of those in which a key has more than ``most`` rows.

    Where to cut such a span is told by a sketch of its times. Only these spans are listed, so the list is as short as
    they are long.
    """
    span = thin.withColumn("_span", F.expr(f"(_at - pmod(_at, {length})) div {length}"))
    place = F.struct(*keys, "_span")  # equal even where a key is null
    span = span.withColumn("_place", place)
    full = span.groupBy("_place").count().where(F.col("count") > most)
    bits = F.least(F.ceil(F.log2(F.col("count") / most)), F.lit(FAN_BITS)).cast("int")
    full = settle(full.select("_place", bits.alias("_bits")))
    if full.isEmpty():
        return span.withColumn("_block", F.shiftleft("_span", FAN_BITS)).drop("_span", "_place")
    parts = 1 << FAN_BITS
    some = span.join(small_side(full), "_place")
    sketch = F.percentile_approx("_at", [i / parts for i in range(1, parts)], 10 * parts)
    bounds = F.transform(F.sequence(F.lit(1), F.expr("shiftleft(1, _bits) - 1")), lambda i: F.get("_times", i * F.expr(f"{parts} div shiftleft(1, _bits)") - 1))
    cuts = some.groupBy("_place", "_bits").agg(sketch.alias("_times")).select("_place", bounds.alias("_bounds"))
    # looked up in two steps
    chunks = F.transform(F.sequence(F.lit(0), F.expr(f"(size(_bounds) - 1) div {CHUNK}")), lambda i: F.slice("_bounds", i * CHUNK + 1, F.lit(CHUNK)))
    cuts = cuts.select("_place", chunks.alias("_chunks"))
    cut = span.join(small_side(settle(cuts)), "_place", "left")
    chunk = F.size(F.filter("_chunks", lambda c: F.get(c, F.lit(0)) <= F.col("_at"))) - 1
    inside = F.size(F.filter(F.get("_chunks", chunk), lambda b: b <= F.col("_at")))
    part = F.when(F.col("_chunks").isNotNull() & (chunk >= 0), chunk * CHUNK + inside).otherwise(0)
    return cut.withColumn("_block", F.shiftleft("_span", FAN_BITS) + part).drop("_span", "_place", "_chunks")


def _followed(steps: DataFrame, keys: list[str], gap: int, most: int, rounds: int = 6) -> DataFrame:
    """(keys, _block, _open): the anchor open before each block, from the steps (keys, _block, _from, _exit)."""
    busiest = steps.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("_block").alias("blocks")).agg(F.max(F.when(F.col("blocks") > 1, F.col("n")))).first()[0] or 0
    schema = steps.schema
    group, above = [*keys, "_block"], [*keys, "_above"]
    open_schema = T.StructType([*(schema[k] for k in group), T.StructField("_open", T.LongType())])

    def reader(table: pa.Table):
        """The blocks of a stretch of rows: where each starts, and its steps."""
        numbers, froms = (table.column(c).fill_null(0).to_numpy() for c in ("_block", "_from"))
        exits = table.column("_exit").combine_chunks()

        def blocks_of(start: int, end: int) -> Iterator[tuple[int, Steps]]:
            firsts = start + np.flatnonzero(np.r_[True, numbers[start + 1 : end] != numbers[start : end - 1]])
            for lo, hi in zip(firsts.tolist(), [*firsts[1:].tolist(), end]):
                yield lo, Steps.read(froms[lo:hi], exits.slice(lo, hi - lo))

        return blocks_of

    def follow(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
        """Blocks in order. With ``names`` of stretches, a row without a block says what is open before each."""
        for table, starts in whole_groups(batches, names):
            given = table.column("_open").to_pylist() if names != keys else None
            blocks_of, rows, opened = reader(table), [], []
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
                anchor = np.array([_NEVER])
                if given is not None:
                    anchor = anchor if given[start] is None else np.array([given[start]])
                    start += 1
                for row, one in blocks_of(start, end):
                    rows.append(row)
                    opened.append(int(anchor[0]))
                    anchor = one.after(anchor, gap)
            columns = {name: table.column(name).take(pa.array(rows, pa.int64())) for name in group}
            columns["_open"] = pa.array([None if a == _NEVER else a for a in opened], pa.int64())
            yield from pa.table(columns).to_batches()

    if busiest <= most or not rounds:
        ordered = (steps.repartition(*keys) if keys else steps.coalesce(1)).sortWithinPartitions(*group, "_from")
        return ordered.mapInArrow(lambda batches: follow(batches, keys), open_schema)

    stretches = steps.withColumn("_above", F.shiftright("_block", FAN_BITS))

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, above):
            blocks_of, rows, froms, outs = reader(table), [], [], []
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows]):
                whole: Steps | None = None
                for _, one in blocks_of(start, end):
                    whole = one if whole is None else whole.then(one, gap)
                froms += [*whole.froms.tolist(), *([] if whole.passes is None else [whole.passes])]
                outs += [*whole.outs.tolist(), *([] if whole.passes is None else [None])]
                rows += [start] * (len(froms) - len(rows))
            columns = {name: table.column(name).take(pa.array(rows, pa.int64())) for name in keys}
            columns |= {"_block": table.column("_above").take(pa.array(rows, pa.int64())), "_from": pa.array(froms, pa.int64()), "_exit": pa.array(outs, pa.int64())}
            yield from pa.table(columns).to_batches()

    composed = stretches.repartition(*above).sortWithinPartitions(*above, "_block", "_from").mapInArrow(compose, schema)
    before = _followed(settle(composed), keys, gap, most, rounds - 1).withColumnRenamed("_block", "_above")
    known = stretches.unionByName(before, allowMissingColumns=True).repartition(*above)
    known = known.sortWithinPartitions(*above, F.col("_block").asc_nulls_first(), "_from")
    return known.mapInArrow(lambda batches: follow(batches, above), open_schema)


def with_first_rows(df: DataFrame, windows: DataFrame, keys: Sequence[str], at: Column, order: str) -> DataFrame:
    """Windows with all columns of their first row.

    Rows that agree in key, time and order count as one: that with the lowest values of its other columns, one after the other.
    """
    place = F.struct(*keys, "_at", order).alias("_place")  # equal even where a key is null
    rows = df.withColumn("_at", at).select("*", place).alias("r")
    extra = [c for c in windows.columns if c not in (*keys, order, "window_start")]
    w = windows.withColumnRenamed("window_start", "_at").select(*extra, place).alias("w")
    names = [c for c in df.columns if c not in (*keys, order)]
    told = F.struct(*(f"`{c}`" for c in names if isinstance(df.schema[c].dataType, T.AtomicType)), F.lit(0).alias("_end"))
    found = rows.join(w, F.col("r._place") == F.col("w._place")).select("r.*", *[F.col(f"w.{c}") for c in extra])
    return (
        found.groupBy("_place")
        .agg(F.min_by(F.struct(*(f"`{c}`" for c in found.columns if c != "_place")), told).alias("_row"))
        .select("_row.*")
        .withColumnRenamed("_at", "window_start")
    )


def micros(ts: str) -> Column:
    """Microseconds of a timestamp column (of either kind, read as UTC); a change without a time counts as 1970."""
    return F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(0).cast("bigint"))


def coalesce_changes(
    df: DataFrame,
    keys: Sequence[str] = ("Database", "Table"),
    ts: str = "ts",
    gap_ms: int = GAP_DEFAULT_MS,
    order: str = "pos",
    block_gaps: int = BLOCK_GAPS,
    counts: bool = True,
    expect_few: bool = False,
) -> DataFrame:
    """First change of every burst per key: at most one per ``gap_ms`` (never below 100 ms).

    With ``expect_few`` the windows are written down and measured first; if they are
    small, the wide rows are looked up by broadcast and none of them is shuffled.
    """
    gap = max(gap_ms, GAP_FLOOR_MS) * 1000
    windows = anchored_windows(df, keys, micros(ts), gap, order, block_gaps, _merged() if counts else None)
    if expect_few:
        windows = small_side(settle(windows))
    return with_first_rows(df, windows, keys, micros(ts), order)


def _merged() -> dict[str, Column]:
    return {"n_merged": F.lit(1)}


def coalesce_by_database(
    df: DataFrame,
    ts: str = "ts",
    interval_ms: int = DATABASE_GAP_MS,
    order: str = "pos",
    database: str = "Database",
    block_gaps: int = BLOCK_GAPS,
) -> DataFrame:
    """One pending notice per database: the first, standing for all that arrive within the interval.

    ``window_start`` is its time in microseconds.
    """
    return anchored_windows(df, [database], micros(ts), interval_ms * 1000, order, block_gaps, _merged())


def release_after(notices: DataFrame, interval_ms: int = DATABASE_GAP_MS, now: Column | None = None) -> DataFrame:
    """Coalesced notices with the time they are handed on; with ``now``, only those that have aged enough.

    Sort by ``release_at`` to process them oldest first.
    """
    released = notices.withColumn("release_at", F.col("window_start") + F.lit(interval_ms * 1000))
    return released if now is None else released.filter(F.col("release_at") < F.unix_micros(now))


def coalesce_tumbling(
    df: DataFrame, keys: Sequence[str], ts: str, gap: str, order: str = "pos", watermark: str | None = None
) -> DataFrame:
    """First change per key and fixed window: cheaper, and the same in a stream, for users who accept fixed windows."""
    if watermark is not None:
        df = df.withWatermark(ts, watermark)
    return (
        df.groupBy(F.window(ts, gap), *keys)
        .agg(F.min(ts).alias("first_ts"), F.min(order).alias(order), F.count("*").alias("n_merged"))
        .select(*keys, F.col("window.start").alias("window_start"), "first_ts", order, "n_merged")
    )


def bounded_batches(
    events: DataFrame,
    max_records: int,
    n_rows: str = "n_rows",
    order: str = "pos",
    key: str = "server_id",
    block_bits: int = BLOCK_BITS,
    block_gaps: int = BLOCK_GAPS,
) -> DataFrame:
    """Batches of whole events: a batch closes once it holds ``max_records`` rows, so its last event may exceed it.

    One row per batch: the first event's order, ``batch_start`` (rows before it),
    events and rows. It is the anchored merge over running row counts.
    """
    counted = running_sum(
        events.select(key, order, n_rows), "_before", F.col(n_rows), order, [key], block_bits, strict=True
    )
    batches = anchored_windows(
        counted,
        [key],
        F.col("_before"),
        max_records - 1,
        order,
        block_gaps,
        {"n_events": F.lit(1), "batch_rows": F.col(n_rows)},
    )
    return batches.select(
        key,
        F.col(order).alias("first_pos"),
        F.col("window_start").alias("batch_start"),
        "n_events",
        "batch_rows",
    )


def commit_points(messages: DataFrame, ts: str = "ts", interval_ms: int = COMMIT_GAP_MS) -> DataFrame:
    """Offsets committed per topic partition when at most one commit per interval is made."""
    points = anchored_windows(messages, ["KafkaTopic"], micros(ts), interval_ms * 1000, "KafkaOffset")
    return points.select(
        "KafkaTopic",
        F.timestamp_micros("window_start").alias("commit_ts"),
        (F.col("KafkaOffset") + 1).alias("committed_offset"),
    )


def throughput(sends: DataFrame, batch: str = "batch_id", rows: str = "n_rows", ms: str = "at_ms") -> DataFrame:
    """Rows per second over each full run of 31 sends.

    ``batch`` counts sends from 0, ``ms`` is when each one ended. A run is timed
    from the end of the run before it, so a run's last send takes part in two runs.
    """
    n = F.col(batch)
    last = n % 31 == 30
    run = F.floor(n / 31)
    begins = F.struct((run + 1).alias("run"), F.lit(False).alias("sent"))
    sent = F.struct(run.alias("run"), F.lit(True).alias("sent"))
    parts = F.when(last, F.array(sent, begins)).otherwise(F.array(sent))
    return (
        sends.select(F.explode(parts).alias("part"), F.col(rows).alias("_rows"), F.col(ms).alias("_ms"))
        .groupBy("part.run")
        .agg(
            F.count_if("part.sent").alias("n_sends"),
            F.sum(F.when(F.col("part.sent"), F.col("_rows"))).alias("n_rows"),
            (F.max("_ms") - F.min("_ms")).alias("elapsed_ms"),
        )
        .filter(F.col("n_sends") == 31)
        .withColumn("rows_per_sec", F.expr("n_rows * 1000 div nullif(elapsed_ms, 0)"))
    )
