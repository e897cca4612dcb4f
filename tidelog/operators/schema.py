"""Schema versions out of the log: the columns a table had when a row event was written.

A catalog says what tables look like where the log begins; every statement that changes a table's columns makes a
new version, valid from its place in the log on. Tables change seldom, so all statements of a table are followed in one
row, and the versions are joined to the events by place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.patterns import is_schema_change
from tidelog.operators.enrich import TABLE, enrich_as_of, table_columns

FIRST_PLACE = -1  # before every event

# The forms of statements and clauses that change columns, and words after ADD or DROP that name no column.
_STATEMENT = re.compile(r"\s*(alter\s+(?:ignore\s+)?table|drop\s+table)\s+(?:if\s+exists\s+)?(.*)", re.I | re.S)
_NAME = r"(?:`(?:[^`]|``)+`|[\w$]+)"
_TABLE = re.compile(rf"\s*({_NAME})(?:\s*\.\s*({_NAME}))?\s*", re.S)
_CLAUSES = re.compile(r"(?:[^,('\"]|\((?:[^()']|'[^']*'|\([^()]*\))*\)|'(?:[^']|'')*'|\"[^\"]*\")+")
_KIND = re.compile(r"[a-z]+(?:\s*\((?:[^()']|'[^']*')*\))?(?:\s+unsigned)?", re.I)
_NO_COLUMN = ("index", "key", "constraint", "primary", "unique", "fulltext", "spatial", "foreign", "check", "partition")

Columns = list[tuple[str, str]]


def _plain(name: str) -> str:
    return name[1:-1].replace("``", "`") if name.startswith("`") else name


def tables_of(statement: str, database: str | None) -> list[tuple[str | None, str, str | None]]:
    """(database, table, clauses) of each table a statement changes; without clauses it is dropped."""
    found = _STATEMENT.match(statement or "")
    if not found:
        return []
    drops, rest, out = found[1].lower().startswith("drop"), found[2], []
    while name := _TABLE.match(rest):
        db, table = (_plain(name[1]), _plain(name[2])) if name[2] else (database, _plain(name[1]))
        rest = rest[name.end() :]
        out.append((db, table, None if drops else rest))
        if not drops or not rest.startswith(","):
            break
        rest = rest[1:]
    return out


def altered(columns: Columns, clauses: str) -> Columns:
    """The columns after the clauses of one statement, in order. Clauses about anything else change nothing."""
    columns = list(columns)

    def at(name: str) -> int:
        return next((i for i, (c, _) in enumerate(columns) if c.lower() == _plain(name).lower()), -1)

    def put(name: str, definition: str, default: int) -> None:
        kind = _KIND.match(definition.strip())
        where = re.search(rf"\b(first|after\s+({_NAME}))\s*$", definition, re.I)
        place = default
        if where:
            place = 0 if where[1].lower() == "first" else at(where[2]) + 1
        columns.insert(place, (_plain(name), re.sub(r"\s+", " ", kind[0]).lower() if kind else "text"))

    for clause in _CLAUSES.findall(clauses.strip().rstrip(";")):
        words = clause.strip()
        if m := re.match(rf"rename\s+column\s+({_NAME})\s+to\s+({_NAME})", words, re.I):
            if (i := at(m[1])) >= 0:
                columns[i] = (_plain(m[2]), columns[i][1])
        elif m := re.match(rf"change\s+(?:column\s+)?({_NAME})\s+({_NAME})\s+(.*)", words, re.I | re.S):
            if (i := at(m[1])) >= 0:
                del columns[i]
                put(m[2], m[3], i)
        elif m := re.match(rf"modify\s+(?:column\s+)?({_NAME})\s+(.*)", words, re.I | re.S):
            if (i := at(m[1])) >= 0:
                name, _ = columns.pop(i)
                put(f"`{name.replace('`', '``')}`", m[2], i)
        elif m := re.match(r"add\s+(?:column\s+)?(?:if\s+not\s+exists\s+)?\((.*)\)\s*$", words, re.I | re.S):
            for one in _CLAUSES.findall(m[1]):
                if n := re.match(rf"\s*({_NAME})\s+(.*)", one, re.S):
                    if n[1].lower() not in _NO_COLUMN:
                        put(n[1], n[2], len(columns))
        elif m := re.match(rf"add\s+(column\s+)?(?:if\s+not\s+exists\s+)?({_NAME})\s+(.*)", words, re.I | re.S):
            if m[1] or m[2].lower() not in _NO_COLUMN:
                put(m[2], m[3], len(columns))
        elif m := re.match(rf"drop\s+(column\s+)?(?:if\s+exists\s+)?({_NAME})", words, re.I):
            if (m[1] or m[2].lower() not in _NO_COLUMN) and (i := at(m[2])) >= 0:
                del columns[i]
    return columns


def schema_versions(
    catalog: DataFrame, log: DataFrame, order: str = "pos", keys: Sequence[str] = ("server_id",), database: str = "db", query: str = "query"
) -> DataFrame:
    """Versions of all tables: ``keys``, db, tbl, ``valid_from``, ``valid_to``, ``columns`` and ``column_types``.

    ``catalog`` (db, tbl, ordinal, column, mysql_type) holds where the log begins, on every server, and may have the ``keys``, too. A dropped
    table has a version without columns (null), so what is written to a later one of that name is taken for unknown; so is
    a table that is altered without being in the catalog, but for the columns that were added.
    """
    keys, place = list(keys), [*keys, *TABLE]
    statements = log.filter((F.col("event_type") == "QUERY") & F.coalesce(is_schema_change(query), F.lit(False)))
    picked = statements.select(*keys, F.col(database).alias("db"), F.col(query).alias("query"), F.col(order).cast("bigint").alias("at"))
    key_fields = [picked.schema[k] for k in keys]
    text, number = T.StringType(), T.LongType()
    changes_schema = T.StructType([*key_fields, T.StructField("db", text), T.StructField("tbl", text), T.StructField("at", number), T.StructField("clauses", text)])

    def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                (i, db, tbl, clauses)
                for i, (base, said) in enumerate(zip(batch.column("db").to_pylist(), batch.column("query").to_pylist()))
                for db, tbl, clauses in tables_of(said, base)
            ]
            rows = pa.array([f[0] for f in found], pa.int64())
            columns = [batch.column(k).take(rows) for k in keys]
            columns += [pa.array([f[i] for f in found], pa.string()) for i in (1, 2)]
            columns += [batch.column("at").take(rows), pa.array([f[3] for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=changes_schema.names)

    made = picked.mapInArrow(changes, changes_schema)
    listed = made.groupBy(*place).agg(F.sort_array(F.collect_list(F.struct("at", "clauses"))).alias("changes"))
    known = table_columns(catalog, [*(k for k in keys if k in catalog.columns), *TABLE])
    if missing := [k for k in keys if k not in known.columns]:
        known = known.crossJoin(F.broadcast(log.select(*missing).distinct()))  # a row for each server, in a list that all its tables are in
    both = known.join(listed, place, "full").select(*place, "columns", "column_types", "changes")
    names = T.ArrayType(text)
    out = T.StructType([*(both.schema[k] for k in place), T.StructField("valid_from", number), T.StructField("columns", names), T.StructField("column_types", names)])

    def versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, columns = [], [], []
            for i, (first, kinds, listed) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("columns", "column_types", "changes")))):
                current: Columns | None = None if first is None else list(zip(first, kinds))
                history = [(FIRST_PLACE, current)]
                for change in listed or []:
                    current = None if change["clauses"] is None else altered(current or [], change["clauses"]) or None
                    history.append((change["at"], current))
                for start, state in history:
                    rows.append(i)
                    starts.append(start)
                    columns.append(state)
            taken = [batch.column(k).take(pa.array(rows, pa.int64())) for k in place]
            parts = [pa.array([None if c is None else [x[j] for x in c] for c in columns], pa.list_(pa.string())) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(starts, pa.int64()), *parts], names=out.names)

    later = F.lead("valid_from").over(W.partitionBy(*place).orderBy("valid_from"))
    return both.mapInArrow(versions, out).withColumn("valid_to", later)


def enrich_columns_from_log(
    events: DataFrame, catalog: DataFrame, log: DataFrame, n_columns: Column, order: str = "pos", keys: Sequence[str] = ("server_id",)
) -> DataFrame:
    """As ``enrich_columns``, with the columns that the statements in ``log`` had made of the catalog when an event was written."""
    return enrich_as_of(events, schema_versions(catalog, log, order, keys), n_columns, order, [*keys, *TABLE])
