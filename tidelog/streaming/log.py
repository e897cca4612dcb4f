"""A raw log as one stateful stream: events in the order of the log, in their transactions, with their tables.

A server writes one log, so its events are ordered, numbered and resolved in one state, as the server itself
wrote them one after the other; what comes behind (filters, names, merging) is spread by table and time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.functions import patterns as P
from tidelog.operators.ordering import SERVER
from tidelog.streaming.coalesce import PACKED, RELEASED, as_table, held_schema, needs_rocksdb, packed, released, unpacked

ROWS_AT_ONCE = 1 << 17  # of a frame handed on
SORTED_ROWS = 1 << 19  # that came in are sorted together
PIECE_ROWS = 1 << 13  # of a sorted piece in the state


class Piece(NamedTuple):
    """Bounds of a piece: its number, its first and last position, and the earliest and latest time in it."""

    no: int
    first: int
    last: int
    early: int
    late: int


BOUNDS = pa.schema([(c, pa.int64()) for c in Piece._fields])


class LogOrder(StatefulProcessor):
    """Per server: events that the watermark has not reached, the open transaction, and the last map of each table id.

    Events are held as sorted pieces with their bounds beside them. What is released is merged piece by piece, so that a task has
    a few pieces in memory however many events a server writes between two watermarks.
    """

    def __init__(self, keys: list[str], order: str, held: T.StructType, out: T.StructType):
        self.keys, self.order, self.held_schema, self.out_schema = keys, order, held, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        text, number = T.StringType(), T.LongType()
        self.handle = handle
        self.pieces = handle.getMapState("pieces", T.StructType([T.StructField("no", number)]), PACKED)
        self.bounds = handle.getListState("bounds", PACKED)
        self.arrow = held_schema(self.held_schema)
        self.open = handle.getValueState("open", T.StructType([T.StructField("gtid", text), T.StructField("start", number), T.StructField("seq_no", number)]))
        self.maps = handle.getMapState("maps", T.StructType([T.StructField("table_id", number)]), T.StructType([T.StructField("db", text), T.StructField("tbl", text)]))
        self.done = handle.getValueState("done", T.StructType([T.StructField("at", number)]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        done = self.done.get()[0] if self.done.exists() else None
        held, new, n = self._held(), [], 0
        for pdf in rows:
            events = as_table(pdf, self.arrow)
            if done is not None:  # delivered again, or too late to be put in its place
                events = events.filter(pc.greater(events[self.order], done))
            new.append(events)
            n += events.num_rows
            if n >= SORTED_ROWS:
                self._hold(held, new)
                new, n = [], 0
        self._hold(held, new)
        yield from self._advance(key, held, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._advance(key, self._held(), timerValues.getCurrentWatermarkInMs())

    def _held(self) -> list[Piece]:
        known = unpacked(self.bounds.get() if self.bounds.exists() else (), BOUNDS)
        return [Piece(*x) for x in zip(*(c.to_pylist() for c in known.columns))]

    def _piece(self, no: int, events: pa.Table) -> Piece:
        """Sorted events put into the state under a number."""
        self.pieces.updateValue((no,), packed(events)[0])
        places, at = events[self.order].to_numpy(), events["event_at"].to_numpy()
        return Piece(no, int(places[0]), int(places[-1]), int(at.min()), int(at.max()))

    def _events(self, piece: Piece) -> pa.Table:
        return unpacked([self.pieces.getValue((piece.no,))], self.arrow)

    def _hold(self, held: list[Piece], new: list[pa.Table]) -> None:
        events = pa.concat_tables([self.arrow.empty_table(), *new])
        events = events.take(np.argsort(events[self.order].to_numpy(), kind="stable"))
        for start in range(0, events.num_rows, PIECE_ROWS):
            held.append(self._piece(held[-1].no + 1 if held else 0, events.slice(start, PIECE_ROWS)))

    def _upto(self, held: list[Piece], watermark: int) -> int | None:
        """The last position with an event older than the watermark. Nothing older comes any more, so all up to it is complete."""
        upto = max((p.last for p in held if p.late < watermark), default=None)
        for piece in held:
            if piece.early < watermark <= piece.late and (upto is None or piece.last > upto):
                events = self._events(piece)
                due = events[self.order].to_numpy()[events["event_at"].to_numpy() < watermark].max()
                upto = int(due) if upto is None else max(upto, int(due))
        return upto

    def _advance(self, key: tuple, held: list[Piece], watermark_ms: int) -> Iterator[pd.DataFrame]:
        upto = self._upto(held, watermark_ms * 1000)
        for expiry in list(self.handle.listTimers()):
            self.handle.deleteTimer(expiry)
        if upto is not None:
            self.done.update((upto,))
            for events in self._released(held, upto):
                yield from self._resolved(key, events, watermark_ms)
        if held:
            self.bounds.put(packed(pa.table([pa.array(c, pa.int64()) for c in zip(*held)], schema=BOUNDS)))
            self.handle.registerTimer(min(p.early for p in held) // 1000 + 1)
        else:
            self.bounds.clear()

    def _released(self, held: list[Piece], upto: int) -> Iterator[pa.Table]:
        """All events up to a position, in runs none of which reaches into the next; what is behind it stays held."""
        due = sorted((p for p in held if p.first <= upto), key=lambda p: p.first)
        kept = [p for p in held if p.first > upto]
        merged: list[tuple[int, pa.Table]] = []
        for i, piece in enumerate(due):
            events = self._events(piece)
            if piece.last > upto:
                cut = int(np.searchsorted(events[self.order].to_numpy(), upto, "right"))
                kept.append(self._piece(piece.no, events.slice(cut)))
                events = events.slice(0, cut)
            else:
                self.pieces.removeKey((piece.no,))
            merged = sorted([*merged, (piece.no, events)], key=lambda x: x[0])  # of equal positions that which came first counts
            if i + 1 < len(due) and sum(t.num_rows for _, t in merged) < ROWS_AT_ONCE:
                continue
            until = due[i + 1].first - 1 if i + 1 < len(due) else upto
            cuts = [int(np.searchsorted(t[self.order].to_numpy(), until, "right")) for _, t in merged]
            if any(cuts):
                yield pa.concat_tables([t.slice(0, n) for (_, t), n in zip(merged, cuts)])
            merged = [(no, t.slice(n)) for (no, t), n in zip(merged, cuts) if n < t.num_rows]
        held[:] = sorted(kept)

    def _resolved(self, key: tuple, events: pa.Table, watermark_ms: int) -> Iterator[pd.DataFrame]:
        """The row events among ``events``, which are complete up to their last one."""
        order = np.argsort(events[self.order].to_numpy(), kind="stable")
        positions = events[self.order].to_numpy()[order]
        new = np.r_[True, positions[1:] != positions[:-1]]
        events, positions = events.take(order[new]).combine_chunks(), positions[new]
        starts, maps, rows = (pc.equal(events["event_kind"], k).to_numpy() for k in ("start", "map", "row"))
        gtid, start, seq_no = self.open.get() if self.open.exists() else (None, None, 0)
        # transactions: the run of events since each start, the first of them going on with what was open
        run = np.cumsum(starts)
        counted = np.cumsum(rows)
        heads = np.flatnonzero(starts)
        numbers = counted - np.r_[-seq_no, counted[heads]][run]
        gtids = pa.array([gtid, *events["gtid"].take(heads).to_pylist()], pa.string())
        begun = pa.array([start, *positions[heads].tolist()], pa.int64())
        self.open.update((gtids[-1].as_py(), begun[-1].as_py(), int(numbers[-1])))
        sources, db, tbl = self._tables(events, maps, rows)
        at = np.flatnonzero(rows)
        for part in np.split(at, range(ROWS_AT_ONCE, len(at), ROWS_AT_ONCE)):
            if not len(part):
                continue
            columns = {f.name: events[f.name].take(part) for f in self.out_schema.fields if f.name in self.arrow.names}
            columns |= {"gtid": gtids.take(run[part]), "tx_start": begun.take(run[part]), "seq_no": pa.array(numbers[part])}
            columns |= {"db": db.take(sources[part]), "tbl": tbl.take(sources[part])}
            out = pa.table(columns).to_pandas(integer_object_nulls=True)
            for name, value in (*zip(self.keys, key), (RELEASED, released(watermark_ms))):
                out[name] = [value] * len(part)
            yield out[self.out_schema.names]

    def _tables(self, events: pa.Table, maps: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Where each row event's table stands in the names returned: that of the last map before it, here or in the state."""
        ids = pc.dictionary_encode(events["table_id"], null_encoding="encode").combine_chunks()
        codes, known = ids.indices.to_numpy(), ids.dictionary.to_pylist()
        used = np.flatnonzero(maps | rows)
        used = used[np.argsort(codes[used], kind="stable")]
        place, of = np.arange(len(used)), codes[used]
        new = np.ones(len(used), bool)
        new[1:] = of[1:] != of[:-1]
        first = np.maximum.accumulate(np.where(new, place, 0))
        last = np.maximum.accumulate(np.where(maps[used], place, -1))
        found = last >= first
        sources = np.full(events.num_rows, -1)
        sources[used[found]] = used[last[found]]
        names: list[tuple] = []  # of the ids that have no map here
        for code in np.unique(of[~found]).tolist():
            table_id = known[code]
            there = table_id is not None and self.maps.containsKey((table_id,))
            sources[used[~found & (of == code)]] = events.num_rows + len(names)
            names.append(tuple(self.maps.getValue((table_id,))) if there else (None, None))
        for end in np.flatnonzero(found & np.r_[new[1:], np.ones(min(len(used), 1), bool)]).tolist():
            if (table_id := known[of[end]]) is not None:
                at = int(used[last[end]])
                self.maps.updateValue((table_id,), (events["db"][at].as_py(), events["tbl"][at].as_py()))
        both = (pa.chunked_array([*events[c].chunks, pa.array([n[i] for n in names], pa.string())]) for i, c in enumerate(("db", "tbl")))
        return sources, *(c.combine_chunks() for c in both)

    def close(self) -> None:
        pass


def log_changes_stream(
    events: DataFrame,
    watermark: str = "10 seconds",
    order: str = "pos",
    ts: str = "ts",
    keys: Sequence[str] = SERVER,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Row events of a raw log stream with ``gtid``, ``tx_start``, ``seq_no``, ``db`` and ``tbl``, as the batch operators give them.

    Micro-batches may be cut anywhere and hold events in any order: an event is held until the watermark is past its time, and is then
    put in its place. An event that comes after one behind it was released, or again, is left out. ``carry`` names columns of plain
    types to keep (give ``n_rows`` instead of rows, images as JSON). The result is marked with what released it, so other stateful operators can follow.
    """
    keys, carry = list(keys), list(carry)
    needs_rocksdb(events.sparkSession)
    kind = F.when(F.col("event_type") == "GTID", "start").when(F.col("event_type") == "TABLE_MAP", "map").when(P.is_row_event(), "row")
    picked = events.select(
        *keys,
        F.col(order).cast("bigint").alias(order),
        F.coalesce(kind, F.lit("other")).alias("event_kind"),
        F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(0).cast("bigint")).alias("event_at"),
        "event_type",
        "gtid",
        F.col("table_id").cast("bigint").alias("table_id"),
        "db",
        "tbl",
        *carry,
    ).filter(F.col("event_kind") != "other")
    timed = picked.withColumn(RELEASED, F.timestamp_micros("event_at")).withWatermark(RELEASED, watermark)
    kept = [picked.schema[c] for c in (order, "event_kind", "event_at", "event_type", "gtid", "table_id", "db", "tbl", *carry)]
    key_fields = [picked.schema[k] for k in keys]
    numbers = [T.StructField(c, T.LongType()) for c in ("tx_start", "seq_no")]
    texts = [T.StructField(c, T.StringType()) for c in ("gtid", "db", "tbl")]
    out = T.StructType([*key_fields, picked.schema[order], picked.schema["event_at"], picked.schema["event_type"], *texts, *numbers, *[picked.schema[c] for c in carry], T.StructField(RELEASED, T.TimestampType())])
    resolved = timed.groupBy(*keys).transformWithStateInPandas(
        LogOrder(keys, order, T.StructType(kept), out), out, "Append", "EventTime", eventTimeColumnName=RELEASED
    )
    return resolved.withColumn(ts, F.timestamp_micros("event_at")).drop("event_at")
