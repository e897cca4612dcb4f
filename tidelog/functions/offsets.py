"""Offsets and transaction-id sets as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.patterns import BLANKS, _as_column

INTERVALS = "array<struct<uuid:string,lo:bigint,hi:bigint>>"
GTID_OFFSET = "struct<gtidSet:string,incompleteTransactions:map<string,bigint>>"


def file_number(file: Column | str) -> Column:
    return F.substring_index(_as_column(file), ".", -1).cast("bigint")


def log_order(file: Column | str, pos: Column | str) -> Column:
    """One bigint that sorts like (file number, position); names never sort as text.

    40 bits hold positions up to a terabyte per file, the rest counts files.
    """
    return F.shiftleft(file_number(file), 40) + _as_column(pos)


def format_position(file: Column | str, pos: Column | str) -> Column:
    return F.concat_ws(":", _as_column(file), _as_column(pos).cast("string"))


def parse_position(offset: Column | str) -> Column:
    parts = F.split(_as_column(offset), ":")
    return F.struct(F.get(parts, F.lit(0)).alias("file"), F.get(parts, F.lit(1)).cast("bigint").alias("pos"))


def format_gtid_offset(gtid_set: Column | str, incomplete: Column | str) -> Column:
    return F.to_json(
        F.struct(_as_column(gtid_set).alias("gtidSet"), _as_column(incomplete).alias("incompleteTransactions"))
    )


def parse_gtid_offset(offset: Column | str) -> Column:
    """JSON form, or a plain set that has no open transactions."""
    text = _as_column(offset)
    no_open = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    plain = F.struct(text.alias("gtidSet"), no_open.alias("incompleteTransactions"))
    return F.when(
        F.btrim(text, F.lit(BLANKS)).startswith("{"), F.from_json(text, GTID_OFFSET, {"mode": "FAILFAST"})
    ).otherwise(plain.cast(GTID_OFFSET))


def contains_event(offset: Column, gtid: Column | str, seq_no: Column | str) -> Column:
    """True where the offset already covers event ``seq_no`` of an open transaction."""
    seen = offset["incompleteTransactions"][_as_column(gtid)]
    return F.coalesce(seen >= _as_column(seq_no), F.lit(False))


def open_transaction(incomplete: Column, gtid: Column | str, seq_no: Column | str) -> Column:
    return F.map_concat(
        finish_transaction(incomplete, gtid),
        F.create_map(_as_column(gtid), _as_column(seq_no).cast("bigint")),
    )


def finish_transaction(incomplete: Column, gtid: Column | str) -> Column:
    return F.map_filter(incomplete, lambda k, _: k != _as_column(gtid))


def gtid_uuid(gtid: Column | str) -> Column:
    return F.substring_index(_as_column(gtid), ":", 1)


def gtid_txn(gtid: Column | str) -> Column:
    return F.substring_index(_as_column(gtid), ":", -1).cast("bigint")


def parse_gtid_set(gtid_set: Column | str) -> Column:
    """``uuid:1-3:5,uuid2:9`` as an array of closed intervals (uuid, lo, hi)."""
    members = F.filter(F.split(F.regexp_replace(_as_column(gtid_set), r"\s", ""), ","), lambda m: m != "")

    def intervals(member: Column) -> Column:
        parts = F.split(member, ":")
        return F.transform(
            F.slice(parts, F.lit(2), F.size(parts) - 1),
            lambda r: F.struct(
                F.get(parts, F.lit(0)).alias("uuid"),
                F.substring_index(r, "-", 1).cast("bigint").alias("lo"),
                F.substring_index(r, "-", -1).cast("bigint").alias("hi"),
            ),
        )

    return F.flatten(F.transform(members, intervals))


def merge_ranges(ranges: Column) -> Column:
    """Array of (lo, hi) sorted and joined where they touch or overlap.

    The array is the interval list of one source inside one offset, which is as
    long as the offset's own text.
    """
    empty = F.array().cast("array<struct<lo:bigint,hi:bigint>>")

    def step(acc: Column, r: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        joined = F.concat(
            F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))),
            F.array(F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], r["hi"]).alias("hi"))),
        )
        return F.when((F.size(acc) > 0) & (r["lo"] <= last["hi"] + 1), joined).otherwise(
            F.concat(acc, F.array(F.struct(r["lo"].alias("lo"), r["hi"].alias("hi"))))
        )

    return F.aggregate(F.array_sort(ranges), empty, step)


def format_ranges(ranges: Column) -> Column:
    """``1-3:5`` for an array of (lo, hi)."""
    return F.array_join(
        F.transform(
            ranges,
            lambda r: F.when(r["lo"] == r["hi"], r["lo"].cast("string")).otherwise(
                F.concat_ws("-", r["lo"].cast("string"), r["hi"].cast("string"))
            ),
        ),
        ":",
    )
