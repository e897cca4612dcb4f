"""The three ways through the library: publish notices, extract deltas, apply rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import patterns as P
from tidelog.functions.patterns import all_of
from tidelog.operators.coalesce import GAP_DEFAULT_MS, coalesce_changes
from tidelog.operators.enrich import enrich_columns
from tidelog.operators.incremental import incremental_extract
from tidelog.operators.ordering import (
    SERVER,
    drop_system_without_metadata,
    gtid_sets,
    resolve_table_map,
    stamp_offset,
    start_position,
    tx_sequence,
)
from tidelog.operators.records import to_notices, to_records
from tidelog.operators.routing import Lookup, Routes, Rule, apply_rules, drop_unrouted, route_topic
from tidelog.operators.scan import BLOCK_BITS
from tidelog.operators.schema import enrich_columns_from_log
from tidelog.sources.sinks import messages
from tidelog.streaming.coalesce import BLOCK_GAPS, coalesce_changes_stream
from tidelog.streaming.log import log_changes_stream


def known_events(
    log: DataFrame,
    catalog: DataFrame,
    n_columns: Column,
    include: str | None = None,
    ignore: str | None = None,
    keys: Sequence[str] = SERVER,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Wanted row events with their table and columns; system tables without metadata are left out."""
    resolved = resolve_table_map(log, keys=keys, block_bits=block_bits)
    wanted = resolved.filter(P.table_filter(include, ignore, "db", "tbl"))
    return drop_system_without_metadata(enrich_columns(wanted, catalog, n_columns), F.col("has_metadata"))


def publish(
    log: DataFrame,
    catalog: DataFrame,
    n_columns: Column,
    routes: Routes,
    include: str | None = None,
    ignore: str | None = None,
    gap_ms: int = GAP_DEFAULT_MS,
    keys: Sequence[str] = SERVER,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Raw log to (topic, key, value) messages, one set of notices per burst of changes of a table.

    A notice has no transaction in it, so the log need not be numbered here.
    """
    known = known_events(log, catalog, n_columns, include, ignore, keys, block_bits)
    # as on a stream: of events of several servers that agree in time and order, these columns tell which is the first
    counted = known.select("db", "tbl", "ts", "pos", "event_type", F.size("rows").alias("n_rows"))
    merged = coalesce_changes(counted, ["db", "tbl"], "ts", gap_ms, counts=False)
    return publish_notices(to_notices(merged), routes)


def publish_stream(
    changes: DataFrame,
    routes: Routes,
    include: str | None = None,
    ignore: str | None = None,
    gap_ms: int = GAP_DEFAULT_MS,
    watermark: str = "10 seconds",
    block_gaps: int = BLOCK_GAPS,
) -> DataFrame:
    """Stream of resolved changes (Type, Database, Table, ts, pos) to a stream of (topic, key, value).

    A change is one notice here; ``publish_stream_from_log`` starts from a raw log and gives one for each row.
    """
    wanted = changes.filter(P.table_filter(include, ignore)).filter(route_topic(routes).isNotNull())
    merged = coalesce_changes_stream(wanted, gap_ms=gap_ms, watermark=watermark, carry=["Type"], block_gaps=block_gaps)
    return publish_notices(merged.withColumn("Timestamp", F.floor(F.col("window_start") / 1000).cast("bigint")), routes)


def publish_stream_from_log(
    log: DataFrame,
    catalog: DataFrame,
    n_columns: Column,
    routes: Routes,
    include: str | None = None,
    ignore: str | None = None,
    gap_ms: int = GAP_DEFAULT_MS,
    watermark: str = "10 seconds",
    keys: Sequence[str] = SERVER,
    block_gaps: int = BLOCK_GAPS,
) -> DataFrame:
    """``publish`` as one streaming query: stream of raw log events to a stream of (topic, key, value).

    Three operators follow one another: events are put in order and resolved by server, their bursts merged by table
    and block of time, and the windows followed by table. ``n_columns`` may use columns of the resolved events.
    """
    counted = log.withColumn("n_rows", F.size("rows"))
    changes = log_changes_stream(counted, watermark, keys=keys, carry=["n_rows"])
    wanted = changes.filter(P.table_filter(include, ignore, "db", "tbl"))
    known = drop_system_without_metadata(enrich_columns(wanted, catalog, n_columns), F.col("has_metadata"))
    merged = coalesce_changes_stream(known, ["db", "tbl"], "ts", gap_ms, None, carry=["event_type", "n_rows"], block_gaps=block_gaps)
    return publish_notices(to_notices(merged.withColumn("ts", F.timestamp_micros("window_start"))), routes)


def full_records(
    log: DataFrame,
    catalog: DataFrame,
    n_columns: Column,
    include: str | None = None,
    ignore: str | None = None,
    saved: str | None = None,
    base_set: str = "",
    keys: Sequence[str] = SERVER,
    block_bits: int = BLOCK_BITS,
    versions: bool = False,
) -> DataFrame:
    """Raw log to full change records with images and offsets, continuing after a ``saved`` gtid offset.

    With ``versions`` the catalog holds where the log begins, and a row is read with the columns that the log's own
    statements had made of it by then. Transactions are numbered and tables found on the whole log, before anything is left out.
    """
    resolved = resolve_table_map(log, keys=keys, block_bits=block_bits, keep_all=True)
    numbered = tx_sequence(resolved, keys=keys, block_bits=block_bits)
    events = stamp_offset(numbered, gtid_sets(log, base_set, keys=keys, block_bits=block_bits), keys, block_bits=block_bits)
    if saved:
        events = start_position(events, saved)
    wanted = events.filter(P.table_filter(include, ignore, "db", "tbl"))
    named = enrich_columns_from_log(wanted, catalog, log, n_columns, keys=keys) if versions else enrich_columns(wanted, catalog, n_columns)
    return to_records(drop_system_without_metadata(named, F.col("has_metadata")))


def publish_notices(notices: DataFrame, routes: Routes) -> DataFrame:
    return messages(drop_unrouted(notices.withColumn("topic", route_topic(routes))))


def extract(
    messages: DataFrame,
    progress: DataFrame,
    source: DataFrame,
    source_ts: str,
    ignore: str | None = None,
    **settings,
) -> DataFrame:
    """Consumed messages to the typed rows changed since each database was last read."""
    notices = messages.withColumn("ts", F.timestamp_millis("Timestamp"))
    return incremental_extract(notices, progress, source, source_ts, ignore, order="KafkaOffset", **settings)


def apply_rule_set(events: DataFrame, rules: Sequence[Rule], lookups: dict[int, Lookup] | None = None) -> DataFrame:
    """Full-mode events through all rules; ``lookups`` gives, per rule number, the source of its ``resultset`` query.

    One row per event, query it asked and row found, with ``rule_no``, ``AskedSql`` and the row as JSON in
    ``ResultRow``; an event that asked nothing, or a query that found nothing, has one row without it. Queries are asked only where
    their transform ran, with the data as they were then. Each look-up is one join over all events, in which only those
    that asked carry a key, and however many rows a key owns, none is ever gathered in a list.
    """
    done = apply_rules(events, rules)
    asked = done.withColumn("_asked", F.explode_outer("Asked")).withColumns(
        {"rule_no": F.col("_asked.rule_no"), "AskedSql": F.col("_asked.sql"), "ResultRow": F.lit(None).cast("string")}
    )
    # rows that ask for nothing have a longer key than any source row; its number spreads them over tasks
    plain = [F.col(c) for c, kind in events.dtypes if "map<" not in kind and "variant" not in kind]
    spread = F.xxhash64(*plain).cast("string")
    for number, lookup in (lookups or {}).items():
        values = [F.col("_asked.data")[name] for name in lookup.on]
        mine = F.coalesce(all_of(F.col("rule_no") == number, *[v.isNotNull() for v in values]), F.lit(False))
        keyed = asked.withColumn("_key", F.when(mine, F.array(*values)).otherwise(F.array(*[spread] * (len(values) + 1))))
        columns = [F.col(c).cast("string") for c in lookup.on.values()]
        rows = lookup.source.where(all_of(*[c.isNotNull() for c in columns])).select(
            F.array(*columns).alias("_key"), F.to_json(F.struct(*lookup.source.columns)).alias("_found")
        )
        found = keyed.join(rows, "_key", "left")
        asked = found.withColumn("ResultRow", F.coalesce("_found", "ResultRow")).drop("_found", "_key")
    return asked.drop("_asked", "Asked")
