"""Thousands of ``db.table`` patterns: matched by joins against the names that occur, instead of one expression each per row.

A pattern part without special characters can only match one name, one that ends in ``%`` only names with that beginning;
only the others have to be tried on every name. So each part has a key, a name has the keys of all patterns that could
match it, and an equi-join gives the candidates, which are then matched in full. Names are the few different ones of all
rows; the rows meet them once more, by broadcast while they are few.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.patterns import BLANKS, _items
from tidelog.session import settle, small_side

_SPECIAL = re.compile(r"[.^$*+?{}\[\]\\|()%]")
PATTERN_SCHEMA = "no int, value string, db_key string, tbl_key string, db_regex string, tbl_regex string"
ANY = "*"  # key of parts that have to be tried on every name


def part_key(part: str) -> str:
    """``=name`` for a plain name, ``^beginning`` for one followed by ``%``, else ANY."""
    if not _SPECIAL.search(part):
        return f"={part}"
    return f"^{part[:-1]}" if part.endswith("%") and not _SPECIAL.search(part[:-1]) else ANY


def pattern_rows(patterns: Sequence[tuple[str, str]]) -> list[tuple]:
    """Rows of PATTERN_SCHEMA: ``(value, list of patterns)`` each, numbered in order; an empty list matches everything."""
    out = []
    for no, (value, listed) in enumerate(patterns):
        items = _items(listed)
        if not items:
            out.append((no, value, "^", "^", "(?s).*", "(?s).*"))
        for item in filter(None, items):
            db, dot, table = item.partition(".")
            if not dot:
                raise ValueError(f"table pattern {item!r} must have the form 'db.table'")
            parts = [p.strip(BLANKS).lower() for p in (db, table)]
            out.append((no, value, *map(part_key, parts), *(f"^(?:{p.replace('%', '.*')})\\z" for p in parts)))
    return out


def _keys(name: Column, keys: set[str]) -> Column:
    """The keys, of those there are, of parts that could match the name."""
    lengths = sorted({len(k) - 1 for k in keys if k.startswith("^")})
    found = [F.concat(F.lit("="), name)] if any(k.startswith("=") for k in keys) else []
    found += [F.when(F.length(name) >= n, F.concat(F.lit("^"), F.substring(name, 1, n))) for n in lengths]
    found += [F.lit(ANY)] if ANY in keys else []
    return F.array_compact(F.array(*found))


def matched_names(names: DataFrame, rows: list[tuple], database: str, table: str, null_matches: bool = False) -> DataFrame:
    """(database, table, no, value) of all patterns that match each of the different ``names``.

    A null name matches nothing, or with ``null_matches`` every pattern whose other part does.
    """
    spark: SparkSession = names.sparkSession
    patterns = F.broadcast(spark.createDataFrame(rows, PATTERN_SCHEMA))
    db, tbl = (F.btrim(F.lower(F.col(c)), F.lit(BLANKS)) for c in (database, table))
    there = names.filter(F.col(database).isNotNull() & F.col(table).isNotNull()).withColumns({"_db": db, "_tbl": tbl})
    keyed = there.withColumn("db_key", F.explode(_keys(F.col("_db"), {r[2] for r in rows})))
    keyed = keyed.withColumn("tbl_key", F.explode(_keys(F.col("_tbl"), {r[3] for r in rows})))
    fits = F.regexp_like("_db", "db_regex") & F.regexp_like("_tbl", "tbl_regex")
    found = keyed.join(patterns, ["db_key", "tbl_key"]).filter(fits).select(database, table, "no", "value")
    if not null_matches:
        return found
    absent = names.filter(F.col(database).isNull() | F.col(table).isNull()).withColumns({"_db": db, "_tbl": tbl})
    either = [F.col(c).isNull() | F.regexp_like(c, r) for c, r in (("_db", "db_regex"), ("_tbl", "tbl_regex"))]
    return found.unionByName(absent.join(patterns, either[0] & either[1]).select(database, table, "no", "value"))


def _met(events: DataFrame, named: DataFrame, database: str, table: str, how: str = "left") -> DataFrame:
    """Events with what is known of their names; each name has one row."""
    e, n = events.alias("e"), small_side(settle(named)).alias("n")
    same = F.col(f"e.{database}").eqNullSafe(F.col(f"n.{database}")) & F.col(f"e.{table}").eqNullSafe(F.col(f"n.{table}"))
    joined = e.join(n, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.select("e.*", *(f"n.{c}" for c in named.columns if c not in (database, table)))


def route_by_names(events: DataFrame, routes: Sequence[tuple[str, str]], database: str = "Database", table: str = "Table") -> DataFrame:
    """Events with ``topic``: of the first route whose include list passes, as ``route_topic`` gives it."""
    rows = pattern_rows(routes)
    if not rows:
        return events.withColumn("topic", F.lit(None).cast("string"))
    open_ = [no for no, (_, listed) in enumerate(routes) if not _items(listed)]  # passes nulls, too
    names = events.select(database, table).distinct()
    first = matched_names(names, rows, database, table).groupBy(database, table).agg(F.min_by("value", "no").alias("topic"))
    found = _met(events, first, database, table)
    return found if not open_ else found.withColumn("topic", F.coalesce("topic", F.lit(routes[open_[0]][0])))


def fan_out_by_names(events: DataFrame, routes: Sequence[tuple[str, str]], database: str = "Database", table: str = "Table") -> DataFrame:
    """One row per topic whose include list passes, as ``fan_out_topics`` gives them."""
    names = events.select(database, table).distinct()
    matches = matched_names(names, pattern_rows(routes), database, table).dropDuplicates([database, table, "no"])
    lists = matches.groupBy(database, table).agg(F.transform(F.array_sort(F.collect_list(F.struct("no", "value"))), lambda m: m["value"]).alias("_topics"))
    always = F.array(*(F.lit(topic) for topic, listed in routes if not _items(listed))).cast("array<string>")
    found = _met(events, lists, database, table)
    return found.withColumn("topic", F.explode(F.coalesce("_topics", always))).drop("_topics")


def filter_by_names(events: DataFrame, include: str | None = None, ignore: str | None = None, database: str = "Database", table: str = "Table") -> DataFrame:
    """Events that ``table_filter`` would keep."""
    out = events
    if _items(include):
        names = out.select(database, table).distinct()
        rows = pattern_rows([("in", include)])
        found = matched_names(names, rows, database, table).select(database, table).distinct() if rows else names.limit(0)
        out = _met(out, found, database, table, "left_semi")
    rows = pattern_rows([("out", ignore)]) if _items(ignore) else []
    if rows:
        names = out.select(database, table).distinct()
        found = matched_names(names, rows, database, table, null_matches=True).select(database, table).distinct()
        out = _met(out, found, database, table, "left_anti")
    return out
