"""Predicates over database and table names, statements and event types."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters cut from both ends of a name (U+0000 to U+0020).
BLANKS = "".join(chr(c) for c in range(0x21))


def pass_all() -> Column:
    return F.lit(True)


def discard_all() -> Column:
    return F.lit(False)


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _name_matches(name: Column | str, pattern: str) -> Column:
    regex = pattern.strip(BLANKS).lower().replace("%", ".*")
    return F.btrim(F.lower(_as_column(name)), F.lit(BLANKS)).rlike(f"^(?:{regex})\\z")


def include_table(pattern: str, database: Column | str = "Database", table: Column | str = "Table") -> Column:
    """True where ``db.table`` matches as a whole; ``%`` is any text, the rest is a regular expression."""
    db_pattern, dot, table_pattern = pattern.partition(".")
    if not dot:
        raise ValueError(f"table pattern {pattern!r} must have the form 'db.table'")
    return _name_matches(database, db_pattern) & _name_matches(table, table_pattern)


def ignore_table(pattern: str, database: Column | str = "Database", table: Column | str = "Table") -> Column:
    return ~include_table(pattern, database, table)


def all_of(*filters: Column) -> Column:
    return reduce(lambda a, b: a & b, filters, pass_all())


def any_of(*filters: Column) -> Column:
    return reduce(lambda a, b: a | b, filters, discard_all())


def _items(patterns: str | None) -> list[str]:
    """Comma items; trailing empty items do not count, so ``","`` names nothing."""
    return (patterns or "").rstrip(",").split(",") if (patterns or "").rstrip(",") else []


def include_list(patterns: str | None, database: Column | str = "Database", table: Column | str = "Table") -> Column:
    items = _items(patterns)
    if not items:
        return pass_all()
    return any_of(*[include_table(p, database, table) for p in items if p])


def ignore_list(patterns: str | None, database: Column | str = "Database", table: Column | str = "Table") -> Column:
    return all_of(*[ignore_table(p, database, table) for p in _items(patterns) if p])


def table_filter(
    include: str | None = None,
    ignore: str | None = None,
    database: Column | str = "Database",
    table: Column | str = "Table",
) -> Column:
    """Include list (empty: everything) and ignore list in one predicate; ignore wins."""
    return include_list(include, database, table) & ignore_list(ignore, database, table)


def ignored_databases(patterns: str | None) -> list[str]:
    """Databases named by items with exactly two dot parts; the table part plays no role."""
    names = []
    for item in (patterns or "").split(","):
        parts = [p for p in item.split(".") if p]
        if len(parts) == 2 and parts[0] not in names:
            names.append(parts[0])
    return names


# Statement heads that change a table's columns.
SCHEMA_CHANGE_HEADS = ("alter table", "alter ignore table", "drop table")


def is_schema_change(sql: Column | str) -> Column:
    text = F.regexp_replace(F.btrim(F.lower(_as_column(sql)), F.lit(BLANKS)), " {2,}", " ")
    return any_of(*[text.startswith(head) for head in SCHEMA_CHANGE_HEADS])


def is_commit(event_type: Column | str = "event_type", query: Column | str = "query") -> Column:
    kind, text = _as_column(event_type), _as_column(query)
    return F.coalesce((kind == "XID") | ((kind == "QUERY") & (text == "COMMIT")), discard_all())


# Row events by the operation they carry.
ROW_EVENTS = {
    "INSERT": ("PRE_GA_WRITE_ROWS", "WRITE_ROWS", "EXT_WRITE_ROWS"),
    "UPDATE": ("PRE_GA_UPDATE_ROWS", "UPDATE_ROWS", "EXT_UPDATE_ROWS"),
    "DELETE": ("PRE_GA_DELETE_ROWS", "DELETE_ROWS", "EXT_DELETE_ROWS"),
}

# Other events that are looked at.
CONTROL_EVENTS = ("TABLE_MAP", "QUERY", "XID", "GTID")


def is_row_event(event_type: Column | str = "event_type") -> Column:
    return _as_column(event_type).isin(*[e for events in ROW_EVENTS.values() for e in events])


def keep_row_events(event_type: Column | str = "event_type") -> Column:
    """True for the events that take part at all: row events and control events."""
    return is_row_event(event_type) | _as_column(event_type).isin(*CONTROL_EVENTS)


def names_in(name: Column | str, names: Sequence[str]) -> Column:
    return _as_column(name).isin(*names) if names else discard_all()
