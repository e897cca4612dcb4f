"""Transactions, table maps, offsets and resuming."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import offsets as O
from tidelog.functions import patterns as P
from tidelog.operators.gtids import SERVER, gtid_sets, merge_intervals, parse_gtid_text  # noqa: F401  also found here
from tidelog.operators.scan import BLOCK_BITS, fill_forward, number_transactions
from tidelog.session import settle, small_side


def resolve_table_map(
    events: DataFrame,
    order: str = "pos",
    keys: Sequence[str] = SERVER,
    block_bits: int = BLOCK_BITS,
    keep_all: bool = False,
) -> DataFrame:
    """Row events with the (db, tbl) that the latest earlier table map gave to their table id.

    ``keep_all`` leaves the other events in, as they are, for operators that need them later.
    """
    is_map = F.col("event_type") == "TABLE_MAP"
    log = events if keep_all else events.filter(is_map | P.is_row_event())
    named = fill_forward(log, "_table", F.struct("db", "tbl"), is_map, order, [*keys, "table_id"], block_bits)
    if not keep_all:
        named = named.filter(P.is_row_event())
    return named.withColumns(
        {c: F.when(P.is_row_event(), F.col(f"_table.{c}")).otherwise(F.col(c)) for c in ("db", "tbl")}
    ).drop("_table")


def tx_sequence(
    events: DataFrame,
    order: str = "pos",
    keys: Sequence[str] = SERVER,
    block_bits: int = BLOCK_BITS,
    open_before: DataFrame | None = None,
) -> DataFrame:
    """Every event with its transaction: ``gtid``, position ``tx_start`` and the 1-based ``seq_no`` of row events.

    Run it before any filter: dropped events count as well.
    """
    numbered = number_transactions(
        events, F.col("event_type") == "GTID", P.is_row_event(), order, keys, block_bits, open_before
    )
    return (
        numbered.withColumn("gtid", F.col("tx.gtid"))
        .withColumn("tx_start", F.col("tx.start"))
        .withColumn("seq_no", F.when(P.is_row_event(), F.col("seq_no")))
        .drop("tx")
    )


def assign_transaction(
    events: DataFrame, order: str = "pos", keys: Sequence[str] = SERVER, block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Every event with the gtid of the last transaction start at or before it; null while gtids are off."""
    return (
        fill_forward(
            events, "_tx", F.struct("gtid"), F.col("event_type") == "GTID", order, keys, block_bits
        )
        .withColumn("gtid", F.col("_tx.gtid"))
        .drop("_tx")
    )


def transaction_state(numbered: DataFrame, order: str = "pos", keys: Sequence[str] = SERVER) -> DataFrame:
    """One row per transaction of a ``tx_sequence`` result: last sequence number, whether it ended, its extent."""
    return (
        numbered.filter(F.col("gtid").isNotNull())
        .groupBy(*keys, "gtid")
        .agg(
            F.max("seq_no").alias("seq_no"),
            F.bool_or(P.is_commit()).alias("complete"),
            F.min(order).alias("first_pos"),
            F.max(order).alias("last_pos"),
        )
    )


def drop_system_without_metadata(
    numbered: DataFrame, has_metadata: Column, database: str = "db", system: str = "mysql"
) -> DataFrame:
    """Row events of the system database without a catalog entry go; their numbers stay used."""
    return numbered.filter(~(P.is_row_event() & (F.col(database) == system) & ~has_metadata))


def merged_ranges(intervals: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Intervals of one offset's text, sorted, touching ones joined."""
    out: list[tuple[str, int, int]] = []
    for uuid, lo, hi in sorted(intervals):
        if out and out[-1][0] == uuid and lo <= out[-1][2] + 1:
            out[-1] = (uuid, out[-1][1], max(hi, out[-1][2]))
        else:
            out.append((uuid, lo, hi))
    return out


def skip_gtid_set(events: DataFrame, gtid_set: str, gtid: str = "gtid") -> DataFrame:
    """Events of transactions outside the set; events without a gtid stay.

    The set is an offset's text; its intervals are written into the plan, where the
    optimizer sees how few they are.
    """
    intervals = [_interval(*i) for i in merged_ranges(parse_gtid_text(gtid_set))]
    if not intervals:
        return events
    done = events.sparkSession.range(1).select(F.inline(F.array(*intervals))).alias("done")
    uuid, txn = O.gtid_uuid(F.col(gtid)), O.gtid_txn(F.col(gtid))
    return events.join(
        done,
        (uuid == F.col("done.uuid")) & (txn >= F.col("done.lo")) & (txn <= F.col("done.hi")),
        "left_anti",
    )


def resume_filter(numbered: DataFrame, offset: str) -> DataFrame:
    """Row events an offset has not covered yet inside the transactions it left open."""
    saved = F.lit(offset)
    return numbered.filter(
        ~(P.is_row_event() & F.col("gtid").isNotNull() & O.contains_event(O.parse_gtid_offset(saved), "gtid", "seq_no"))
    )


def start_position(
    events: DataFrame,
    saved: str | None = None,
    initial: str | None = None,
    from_beginning: bool = False,
    gtid_mode: bool = True,
    purged: str = "",
    executed: str = "",
    order: str = "pos",
) -> DataFrame:
    """Events from where reading starts: saved offset, else configured offset, else beginning, else now.

    ``events`` are numbered (``tx_sequence``). ``purged`` and ``executed`` are the
    server's gtid sets, or with gtids off ``executed`` is its current ``file:pos``.
    """
    offset = saved or initial
    if offset is None or offset == "":
        if from_beginning:
            return skip_gtid_set(events, purged) if gtid_mode else events
        if not executed and not gtid_mode:
            raise ValueError("to start from now without gtids, give the server's current file:pos as executed")
        offset = executed
    if not gtid_mode:
        file, _, pos = offset.rpartition(":")
        at = (int(file.rpartition(".")[2]) << 40) + int(pos) if file else int(pos)
        return events.filter(F.col(order) > at)
    gtid_set = json.loads(offset)["gtidSet"] if offset.strip().startswith("{") else offset
    return resume_filter(skip_gtid_set(events, gtid_set), offset)


def stamp_offset(
    numbered: DataFrame, sets: DataFrame, keys: Sequence[str] = SERVER, order: str = "pos", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Numbered row events with ``gtid_set`` and ``incomplete``: their own gtid and sequence number.

    ``sets`` are those of ``gtid_sets`` with the same blocks: an event finds its transaction's set in its own block of
    log, so that the events of one large transaction stay spread.
    """
    events = numbered.filter(P.is_row_event()).withColumn("_block", F.shiftright(order, block_bits))
    return (
        events.join(small_side(settle(sets)), [*keys, "_block", "tx_start"], "left")
        .withColumn("incomplete", F.when(F.col("gtid").isNotNull(), F.create_map("gtid", "seq_no")))
        .drop("_block")
    )


def event_offset(
    events: DataFrame,
    base_set: str = "",
    order: str = "pos",
    keys: Sequence[str] = SERVER,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Row events of a raw log, numbered and with the offset stamped on them."""
    if not keys:
        single = events.withColumn("_server", F.lit(0))
        return event_offset(single, base_set, order, ("_server",), block_bits).drop("_server")
    sets = gtid_sets(events, base_set, order, keys, block_bits)
    return stamp_offset(tx_sequence(events, order, keys, block_bits), sets, keys, order, block_bits)


def _interval(uuid: str, lo: int, hi: int) -> Column:
    return F.struct(
        F.lit(uuid).alias("uuid"), F.lit(lo).cast("bigint").alias("lo"), F.lit(hi).cast("bigint").alias("hi")
    )


def compare_position(events: DataFrame, file: str = "binlog_file", pos: str = "pos") -> DataFrame:
    """Events in log order; the order column compares file numbers, not file names."""
    return events.withColumn("log_order", O.log_order(file, pos)).orderBy("log_order")


def high_water_offset(events: DataFrame, offset: str, order: str = "pos", keys: Sequence[str] = ()) -> DataFrame:
    """Offset of the last event. Give it the unfiltered log: filtered events move the offset too."""
    return events.groupBy(*keys).agg(F.max(order).alias(order), F.max_by(offset, order).alias("offset"))


def consumer_progress(messages: DataFrame) -> DataFrame:
    """Next offset to read per topic and partition."""
    where = F.split("KafkaTopic", "/")
    return (
        messages.select(
            F.get(where, F.lit(0)).alias("topic"),
            F.get(where, F.lit(1)).cast("int").alias("partition"),
            "KafkaOffset",
        )
        .groupBy("topic", "partition")
        .agg((F.max("KafkaOffset") + 1).alias("next_offset"))
    )
