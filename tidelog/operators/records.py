"""Row events to change records, typed rows and dirty rows.

A row event has ``event_type, db, tbl, server_id, ts, columns array<string>`` (see
``enrich_columns``), ``included`` and ``included_before`` (ordinals of the bitmaps) and
``rows array<struct<before array<string>, after array<string>>>``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import offsets as O
from tidelog.functions import records as R


def explode_rows(events: DataFrame, rows: str = "rows") -> DataFrame:
    """One record per row of an event, numbered by ``row_no`` from 0; the other columns repeat."""
    others = [c for c in events.columns if c != rows]
    return events.select(*others, F.posexplode(rows).alias("row_no", "row"))


def record_header(events: DataFrame) -> dict[str, Column]:
    """The header fields of a record that the event's columns can give.

    Events with ``gtid`` and ``gtid_set`` fill GTID and SeqNo, events with
    ``binlog_file`` and ``pos`` the file and position; the offset follows.
    """
    have, null_text, null_long = set(events.columns), F.lit(None).cast("string"), F.lit(None).cast("bigint")
    by_gtid = F.col("gtid").isNotNull() if {"gtid", "gtid_set"} <= have else F.lit(False)
    by_pos = ~by_gtid if {"binlog_file", "pos"} <= have else F.lit(False)
    fields = {
        "Type": R.classify_op("event_type", "query" if "query" in have else None),
        "Database": F.col("db"),
        "Table": F.col("tbl"),
        "ServerId": F.col("server_id") if "server_id" in have else null_long,
        "Timestamp": F.unix_millis(F.col("ts").cast("timestamp")) if "ts" in have else null_long,
    }
    gtid_offset = position_offset = null_text
    if {"gtid", "gtid_set"} <= have:
        gtid_offset = O.format_gtid_offset("gtid_set", F.create_map("gtid", "seq_no"))
        fields["GTID"] = F.when(by_gtid, F.col("gtid"))
        fields["SeqNo"] = F.when(by_gtid, F.col("seq_no"))
    if {"binlog_file", "pos"} <= have:
        position_offset = O.format_position("binlog_file", "pos")
        fields["BinLogFilename"] = F.when(by_pos, F.col("binlog_file"))
        fields["BinLogPosition"] = F.when(by_pos, F.col("pos"))
    fields["Offset"] = F.when(by_gtid, gtid_offset).when(by_pos, position_offset)
    absent = {"GTID": null_text, "SeqNo": null_long, "BinLogFilename": null_text, "BinLogPosition": null_long}
    return {name: fields.get(name, absent.get(name)) for name in R.HEADER_FIELDS}


def _headed(events: DataFrame) -> DataFrame:
    others = [c for c in events.columns]
    return events.select(*others, *[c.alias(f"_{n}") for n, c in record_header(events).items()])


def to_records(events: DataFrame) -> DataFrame:
    """Full change records: header, ``row_no``, ``Data`` and ``OldData``."""
    rows = explode_rows(_headed(events))
    data, old = R.before_after("_Type", "columns", "included_before", "row.before", "included", "row.after")
    return rows.select(
        *[F.col(f"_{n}").alias(n) for n in R.HEADER_FIELDS], "row_no", data.alias("Data"), old.alias("OldData")
    )


def to_notices(events: DataFrame) -> DataFrame:
    """Header-only records, one per row: of the images only their number is read (``n_rows`` may stand for ``rows``)."""
    headed = _headed(events)
    n_rows = F.col("n_rows") if "n_rows" in events.columns else F.size("rows")
    repeated = F.explode(F.array_repeat(F.lit(True), n_rows)).alias("_row")
    return headed.select(*[F.col(f"_{n}").alias(n) for n in R.HEADER_FIELDS], repeated).drop("_row")


def query_records(events: DataFrame, full: bool = True) -> DataFrame:
    """Statement events as records of type QUERY; ``full`` carries the text in ``Data``."""
    statements = events.filter(F.col("query").isNotNull())
    data = F.create_map(F.lit("Sql"), F.col("query")) if full else F.lit(None).cast("map<string,string>")
    return statements.select(*[c.alias(n) for n, c in record_header(statements).items()], data.alias("Data"))


def project_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns renamed by position; every column needs a name."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns but {len(names)} names")
    return df.toDF(*names)


def tag_tenant(df: DataFrame, database: Column | str, name: str = "dbName") -> DataFrame:
    """The database name as last column; text is a name, a Column says where to find it."""
    value = F.lit(database) if isinstance(database, str) else database
    others = [c for c in df.columns if c != name]
    return df.select(*others, value.alias(name))


def _row_type(field: T.StructField) -> str | None:
    kind = field.dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(kind, (T.DecimalType, T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(kind, (T.StringType, T.NullType)):
        return "string"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType, T.BooleanType)):
        return kind.simpleString()
    return None


def type_result_set(df: DataFrame) -> DataFrame:
    """Query result widened to the row types: integers, doubles, text, times, bytes, booleans. Nulls stay null."""
    kinds = {f.name: _row_type(f) for f in df.schema.fields}
    for f in df.schema.fields:
        if kinds[f.name] is None:
            raise ValueError(f"column {f.name!r} has the unsupported type {f.dataType.simpleString()}")
    return df.select(*[F.col(f"`{n}`").cast(t).alias(n) for n, t in kinds.items()])


def flag_dirty(df: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Columns cast; ``dirty_columns`` names those whose value did not fit."""
    bad = [
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in casts.items()
    ]
    columns = [F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns]
    return df.select(
        *columns,
        F.array_compact(F.array(*bad)).alias("dirty_columns"),
        F.struct(*[F.col(c) for c in casts]).alias("_raw"),
    )


def split_dirty(df: DataFrame, casts: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(clean, dirty): typed rows without faults, and faulty rows as they came with ``dirty_columns``."""
    flagged = flag_dirty(df, casts)
    is_dirty = F.size("dirty_columns") > 0
    dirty = flagged.filter(is_dirty).select(
        *[F.col(f"_raw.{c}").alias(c) if c in casts else F.col(c) for c in df.columns], "dirty_columns"
    )
    return flagged.filter(~is_dirty).drop("dirty_columns", "_raw"), dirty


def check_dirty(dirty: DataFrame, error_limit: int = 0) -> None:
    """Fail when more rows are dirty than the limit allows; reads no more than one row above it."""
    if dirty.limit(error_limit + 1).count() > error_limit:
        raise ValueError(f"more than {error_limit} dirty rows")
