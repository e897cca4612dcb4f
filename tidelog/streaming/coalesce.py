"""Merging bursts on a stream.

A window depends on the one before it, but the changes a watermark has not passed yet need not be held together: their
state is one list per (key, block of time), so that those of a busy key lie in many tasks and a batch touches
only the blocks it has changes for. When the watermark is past a block's end, the block is closed: it hands on
its step function, that is, for every change that may be the first to open a window there, the windows that follow.
These meet quickly, so that a busy block hands on few of its changes. A second operator follows the steps of the
closed blocks of a key in order; all it remembers is the window that is open.

A window ends for good when the block with its last possible change is closed, so the windows are those of the batch
operator over all rows that were not late.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.coalesce import GAP_DEFAULT_MS, GAP_FLOOR_MS, micros

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
BLOCK_GAPS = 4  # of a stream: a window waits at most for so many gaps, and a key's state is cut as often


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """The stateful operators need a state store with timers; whoever owns the session calls this."""
    spark.conf.set(PROVIDER, ROCKSDB)
    return spark


def needs_rocksdb(spark: SparkSession) -> None:
    if "RocksDB" not in spark.conf.get(PROVIDER, ""):
        raise ValueError(f"this operator keeps state with timers: set {PROVIDER} (use_rocksdb(spark) does)")


HELD_ROWS = 1 << 16  # of one element of a packed state, at most
LEAST_ROWS = 32  # of one of a block's, and at least an eighth of what comes in: their number tells where a state is large
PACKED = T.StructType([T.StructField("rows", T.BinaryType())])


def held_schema(schema: T.StructType) -> pa.Schema:
    """Arrow schema of rows held in a state; times are kept as pandas has them, without a zone."""
    fields = to_arrow_schema(schema)
    return pa.schema([f.with_type(pa.timestamp("us")) if pa.types.is_timestamp(f.type) else f for f in fields])


def as_table(pdf: pd.DataFrame, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pandas(pdf[schema.names], schema=schema, preserve_index=False)


def packed(table: pa.Table, size: int = HELD_ROWS) -> list[tuple[bytes]]:
    """Elements of a list state, many rows in each: a state that held row by row costs more than all work on the rows."""
    elements = []
    for start in range(0, table.num_rows, size):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table.slice(start, size))
        elements.append((sink.getvalue().to_pybytes(),))
    return elements


def unpacked(elements: Iterator[tuple], schema: pa.Schema) -> pa.Table:
    tables = [pa.ipc.open_stream(bytes(e[0])).read_all() for e in elements]
    return pa.concat_tables([schema.empty_table(), *tables])


def plain_values(values: pd.Series, kind: T.DataType) -> list:
    """Python values of a column; pandas turns whole numbers next to nulls into floats."""
    whole = isinstance(kind, T.IntegralType)
    return [None if v is None or v is pd.NaT or v != v else int(v) if whole else v for v in values.tolist()]


def block_steps(times: np.ndarray, counts: np.ndarray, begin: int, gap: int) -> dict[str, np.ndarray]:
    """The changes of a block that can open a window there, and the windows they open.

    ``times`` are sorted and different. ``row`` is the change's index, ``following`` the place in this table of the change
    that opens the next window (-1 if none does in the block), ``merged`` and ``last`` what its own window
    holds of the block, ``ahead`` and ``before`` how many changes stand before it and the time of the last one. The last entry stands for the
    end of the block.
    """
    n = len(times)
    after = np.searchsorted(times, times + gap, side="right")
    reached = np.zeros(n + 1, dtype=bool)
    # an anchor from an earlier block reaches less than a gap into this one
    reached[: min(int(np.searchsorted(times, begin + gap, side="left")) + 1, n)] = True
    level = np.flatnonzero(reached)
    while len(level):
        level = np.unique(after[level])
        level = level[(level < n) & ~reached[np.minimum(level, n)]]
        reached[level] = True
    rows = np.flatnonzero(reached[:n])
    place = np.full(n + 1, -1, dtype=np.int64)
    place[rows] = np.arange(len(rows))
    sums = np.r_[0, np.cumsum(counts)]
    ends = np.r_[rows, n]
    return {
        "row": ends,
        "following": np.r_[place[after[rows]], -1],
        "merged": np.r_[sums[after[rows]] - sums[rows], 0],
        "last": np.r_[times[after[rows] - 1], 0],
        "ahead": sums[ends],
        "before": np.where(ends > 0, times[np.maximum(ends - 1, 0)], 0),
    }


STEP_FIELDS = ("step_no", "change_at", "change_first", "following", "merged", "last_at", "ahead", "before_at")
BLOCK = "change_block"
RELEASED = "released_at"


def released(watermark_ms: int) -> pd.Timestamp:
    """An event time for what a watermark released: not late for the operators behind."""
    return pd.Timestamp(watermark_ms + 1, unit="ms", tz="UTC")


class BlockBuffer(StatefulProcessor):
    """Holds the open changes (time, lowest order, count, carried columns) of one key and block; hands on the steps when it is closed."""

    def __init__(self, keys: list[str], gap: int, length: int, carried: T.StructType):
        self.keys, self.gap, self.length, self.carried = keys, gap, length, carried
        numbers = [T.StructField(c, T.LongType()) for c in ("change_at", "change_first", "change_n")]
        self.held_schema = T.StructType([*numbers, *carried.fields])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", PACKED)
        self.arrow = held_schema(self.held_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new, n = [], 0
        for pdf in rows:
            new.append(as_table(pdf, self.arrow))
            n += new[-1].num_rows
            if n >= HELD_ROWS:
                self._hold(new, n)
                new, n = [], 0
        if new:
            self._hold(new, n)
        self.handle.registerTimer(-(-(int(key[-1]) + 1) * self.length // 1000))
        return iter(())

    def _hold(self, new: list[pa.Table], n: int) -> None:
        self.held.appendList(packed(pa.concat_tables(new), max(LEAST_ROWS, -(-n // 8))))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = unpacked(self.held.get(), self.arrow)
        self.held.clear()
        # changes that agree in time and order are told apart by what is carried, whatever order they came in
        names = ["change_at", "change_first", *self.carried.names]
        held = held.take(pc.sort_indices(held, sort_keys=[(c, "ascending") for c in names], null_placement="at_start"))
        times = held["change_at"].to_numpy()
        first = np.flatnonzero(np.r_[True, times[1:] != times[:-1]])
        counts = np.add.reduceat(held["change_n"].to_numpy(), first)
        changes = held.take(first).to_pandas(integer_object_nulls=True)
        block = int(key[-1])
        steps = block_steps(changes["change_at"].to_numpy(), counts, block * self.length, self.gap)
        picked = changes.iloc[steps["row"][:-1]]
        n = len(steps["row"])
        out = {name: [part] * n for name, part in zip([*self.keys, BLOCK], key)}
        out["step_no"] = np.arange(n)
        out["change_at"] = np.r_[picked["change_at"].to_numpy(), np.iinfo(np.int64).max]
        out["change_first"] = np.r_[picked["change_first"].to_numpy(), 0]
        for name, column in (("following", "following"), ("merged", "merged"), ("last_at", "last"), ("ahead", "ahead"), ("before_at", "before")):
            out[name] = steps[column]
        out[RELEASED] = released(timerValues.getCurrentWatermarkInMs())
        for f in self.carried.fields:
            out[f.name] = pd.Series([*plain_values(picked[f.name], f.dataType), None], dtype=object)
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass


class StepFollower(StatefulProcessor):
    """Follows the steps of a key's closed blocks in order. The only state is the window that is open."""

    def __init__(self, keys: list[str], gap: int, length: int, carried: T.StructType):
        self.keys, self.gap, self.length, self.carried = keys, gap, length, carried
        numbers = [T.StructField(c, T.LongType()) for c in ("window_start", "change_first", "n_merged", "window_last")]
        self.window_schema = T.StructType([*numbers, *carried.fields])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", self.window_schema)

    def _ends_ms(self, start: int) -> int:
        """The watermark at which no change can be in the window any more: the end of the block of its last instant."""
        return -(-((start + self.gap) // self.length + 1) * self.length // 1000)

    def _followed(self, block: pd.DataFrame, window: list | None, done: list[list]) -> list:
        """The window open after a block, given that open before it; those that end there are added to ``done``."""
        times = block["change_at"].to_numpy()
        following, merged, last, first = (block[c].tolist() for c in ("following", "merged", "last_at", "change_first"))
        carried = [plain_values(block[f.name], f.dataType) for f in self.carried.fields]
        at = 0
        if window is not None:
            at = int(np.searchsorted(times, window[0] + self.gap, side="right"))
            if ahead := int(block["ahead"].iloc[at]):
                window[2] += ahead
                window[3] = int(block["before_at"].iloc[at])
        end = len(times) - 1  # its time is later than any
        while 0 <= at < end:
            if window is not None:
                done.append(window)
            window = [int(times[at]), first[at], merged[at], last[at], *(c[at] for c in carried)]
            at = following[at]
        return window

    def _rows(self, key: tuple, windows: list[list]) -> Iterator[pd.DataFrame]:
        if windows:
            out = {name: [part] * len(windows) for name, part in zip(self.keys, key)}
            for f, column in zip(self.window_schema.fields, zip(*windows)):
                out[f.name] = pd.Series(list(column), dtype=object if f in self.carried.fields else "int64")
            yield pd.DataFrame(out)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        steps = pd.concat(list(rows)).sort_values([BLOCK, "step_no"], kind="stable")
        window = list(self.open.get()) if self.open.exists() else None
        done: list[list] = []
        for _, block in steps.groupby(BLOCK, sort=True):
            window = self._followed(block, window, done)
        for expiry in list(self.handle.listTimers()):
            self.handle.deleteTimer(expiry)
        if self._ends_ms(window[0]) <= timerValues.getCurrentWatermarkInMs():
            done.append(window)
            self.open.clear()
        else:
            self.open.update(tuple(window))
            self.handle.registerTimer(self._ends_ms(window[0]))
        yield from self._rows(key, done)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        window = list(self.open.get())
        self.open.clear()
        yield from self._rows(key, [window])

    def close(self) -> None:
        pass


def coalesce_changes_stream(
    df: DataFrame,
    keys: Sequence[str] = ("Database", "Table"),
    ts: str = "ts",
    gap_ms: int = GAP_DEFAULT_MS,
    watermark: str | None = "10 seconds",
    order: str = "pos",
    carry: Sequence[str] = (),
    block_gaps: int = BLOCK_GAPS,
) -> DataFrame:
    """Windows of ``coalesce_changes`` on a stream: keys, ``window_start``, order of the first change, count, last.

    ``carry`` names columns of the first change to keep. Changes with equal key and
    time are combined in each task before they are shuffled to their block's state. A stream that another stateful operator made, with what
    it released marked in RELEASED (``log_changes_stream``), comes without a ``watermark`` of its own.
    """
    keys, carry = list(keys), list(carry)
    gap = max(gap_ms, GAP_FLOOR_MS) * 1000
    length = gap * block_gaps
    needs_rocksdb(df.sparkSession)
    slim = df.select(
        *keys,
        micros(ts).alias("change_at"),
        F.col(order).cast("bigint").alias("change_first"),
        F.lit(1).cast("bigint").alias("change_n"),
        *carry,
        *([RELEASED] if watermark is None else []),
    )
    carried = T.StructType([slim.schema[c] for c in carry])

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_nulls = pc.ScalarAggregateOptions(skip_nulls=False)
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by("change_first")
            rest = [("change_first", "first"), ("change_n", "sum"), *[(c, "first", with_nulls) for c in carry]]
            merged = table.group_by([*keys, "change_at"], use_threads=False).aggregate(rest)
            names = {f"{c}_{how}": c for c, how, *_ in rest}
            merged = merged.rename_columns([names.get(c, c) for c in merged.column_names])
            yield from merged.select(table.column_names).to_batches()

    if watermark is not None:
        slim = slim.mapInArrow(thin, slim.schema).withColumn(RELEASED, F.timestamp_micros("change_at")).withWatermark(RELEASED, watermark)
    timed = slim.withColumn(BLOCK, F.expr(f"(change_at - pmod(change_at, {length})) div {length}"))
    key_fields = [slim.schema[k] for k in keys]
    numbers = [T.StructField(c, T.LongType()) for c in (BLOCK, *STEP_FIELDS)]
    steps = T.StructType([*key_fields, *numbers, T.StructField(RELEASED, T.TimestampType()), *carried.fields])
    windows = T.StructType([*key_fields, *StepFollower(keys, gap, length, carried).window_schema.fields])
    return (
        timed.groupBy(*keys, BLOCK)
        .transformWithStateInPandas(BlockBuffer(keys, gap, length, carried), steps, "Append", "EventTime", eventTimeColumnName=RELEASED)
        .groupBy(*keys)
        .transformWithStateInPandas(StepFollower(keys, gap, length, carried), windows, "Append", "EventTime")
        .withColumnRenamed("change_first", order)
    )


def dedup_changes_stream(
    df: DataFrame, keys: Sequence[str] = ("Database", "Table"), ts: str = "ts", watermark: str = "10 seconds"
) -> DataFrame:
    """First change per key at once; repeats within the watermark's delay are suppressed.

    Each task drops the repeats it sees itself, so that a busy key sends few rows to its state.
    """
    keys = list(keys)
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))

    def earliest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            order = pc.sort_indices(table, sort_keys=[(ts, "ascending")])
            ranked = table.select(keys).take(order).append_column("row_no", order)
            first = ranked.group_by(keys, use_threads=False).aggregate([("row_no", "first")])
            yield from table.take(first.column("row_no_first")).to_batches()

    thinned = timed.mapInArrow(earliest, timed.schema)
    return thinned.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def late_changes(df: DataFrame, high_water, ts: str = "ts", delay: str = "10 seconds") -> DataFrame:
    """Rows of a micro-batch that are older than ``high_water`` less the delay: what a watermark would drop."""
    return df.filter(F.col(ts).cast("timestamp") < F.lit(high_water).cast("timestamp") - F.expr(f"INTERVAL {delay}"))
