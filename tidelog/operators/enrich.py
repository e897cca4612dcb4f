"""Look-ups as joins: column names, schema versions and bound queries.

Catalogs are written down and measured first; below a bound they are broadcast, so
that events of a busy table stay where they are. Look-up sources are left to the
optimizer, which knows the size of files and splits skewed keys of shuffled joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.operators.scan import fill_forward
from tidelog.session import settle, small_side

TABLE = ("db", "tbl")
FEW_SPANS = 50  # of a key, which its events may all meet


def table_columns(catalog: DataFrame, keys: Sequence[str] = TABLE) -> DataFrame:
    """One row per table with its columns in order; a table has at most a few thousand."""
    column = F.struct("ordinal", "column", "mysql_type")
    return (
        catalog.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(column)).alias("_columns"))
        .select(
            *keys,
            F.transform("_columns", lambda c: c["column"]).alias("columns"),
            F.transform("_columns", lambda c: c["mysql_type"]).alias("column_types"),
        )
    )


def _with_fallback(joined: DataFrame, n_columns: Column) -> DataFrame:
    """Events whose table is unknown get ``col_<i>`` columns of type text."""
    ordinals = F.when(n_columns > 0, F.sequence(F.lit(0), n_columns - 1)).otherwise(F.array().cast("array<int>"))
    return (
        joined.withColumn("has_metadata", F.col("columns").isNotNull())
        .withColumn(
            "columns",
            F.coalesce("columns", F.transform(ordinals, lambda i: F.concat(F.lit("col_"), i.cast("string")))),
        )
        .withColumn("column_types", F.coalesce("column_types", F.transform(ordinals, lambda i: F.lit("text"))))
    )


def enrich_columns(events: DataFrame, catalog: DataFrame, n_columns: Column, keys: Sequence[str] = TABLE) -> DataFrame:
    """Events with the ``columns`` and ``column_types`` of their table and ``has_metadata``."""
    columns = small_side(settle(table_columns(catalog, keys)))
    return _with_fallback(events.join(columns, list(keys), "left"), n_columns)


def enrich_columns_versioned(
    events: DataFrame, versions: DataFrame, n_columns: Column, order: str = "pos", keys: Sequence[str] = TABLE
) -> DataFrame:
    """As ``enrich_columns``, with the schema that was valid when the event was written.

    ``versions`` is a catalog with ``valid_from``, the log position of the
    statement that made the version; a version lasts until the next one.
    """
    spans = table_columns(versions, [*keys, "valid_from"]).withColumn(
        "valid_to", F.lead("valid_from").over(W.partitionBy(*keys).orderBy("valid_from"))
    )
    return enrich_as_of(events, spans, n_columns, order, keys)


def enrich_as_of(events: DataFrame, spans: DataFrame, n_columns: Column, order: str = "pos", keys: Sequence[str] = TABLE) -> DataFrame:
    """Events with the columns of the span (``valid_from`` up to ``valid_to``, open if null) that their place lies in.

    Spans of a key do not overlap. Where a key has more than FEW_SPANS, events do not meet all of them: the last one that begins at or before
    an event is carried along the log (``scan.fill_forward``), whose blocks are cut by the places of the spans.
    """
    keys = list(keys)
    spans = settle(spans.filter(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to"))))
    most, first, last = (
        spans.filter(F.col("valid_to").isNotNull())
        .groupBy(*keys)
        .agg(F.count("*").alias("n"), F.min("valid_to").alias("first"), F.max("valid_to").alias("last"))
        .agg(F.max("n"), F.min("first"), F.max("last"))
        .first()
    )
    if (most or 0) > FEW_SPANS:
        return _with_fallback(_carried(events, spans, order, keys, max(0, int(last - first).bit_length() - 9)), n_columns)
    e, s = events.alias("e"), small_side(spans).alias("s")
    valid = [F.col(f"e.{k}") == F.col(f"s.{k}") for k in keys]
    valid += [
        F.col(f"e.{order}") >= F.col("s.valid_from"),
        F.col("s.valid_to").isNull() | (F.col(f"e.{order}") < F.col("s.valid_to")),
    ]
    joined = e.join(s, valid, "left").select("e.*", "s.valid_from", "s.columns", "s.column_types")
    return _with_fallback(joined, n_columns)


def _carried(events: DataFrame, spans: DataFrame, order: str, keys: list[str], block_bits: int) -> DataFrame:
    """Events with the last span that begins at or before them, if it reaches them."""
    names = ["valid_from", "valid_to", "columns", "column_types"]
    # twice the place, so that a span comes before the events of its own place
    begins = spans.dropna(subset=keys).select(*keys, (F.col("valid_from") * 2).alias("_place"), F.struct(*names).alias("_span"))
    places = events.select(*keys, (F.col(order).cast("bigint") * 2 + 1).alias("_place"), F.struct("*").alias("_row"))
    log = places.unionByName(begins, allowMissingColumns=True)
    filled = fill_forward(log, "_known", F.col("_span"), F.col("_span").isNotNull(), "_place", keys, block_bits)
    reached = F.col("_known.valid_to").isNull() | (F.col(f"_row.`{order}`") < F.col("_known.valid_to"))
    return filled.filter(F.col("_row").isNotNull()).select(
        "_row.*", *[F.when(reached, F.col(f"_known.{c}")).alias(c) for c in names if c != "valid_to"]
    )


def lookup_rows(events: DataFrame, source: DataFrame, on: dict[str, str]) -> DataFrame:
    """Events joined to the source rows a bound query would return, one output row per pair; others stay, with nulls."""
    e, s = events.alias("e"), source.alias("s")
    return e.join(s, [F.col(f"e.{a}") == F.col(f"s.{b}") for a, b in on.items()], "left").select("e.*", "s.*")


def lookup_enrich(events: DataFrame, source: DataFrame, on: dict[str, str], result: str = "Result") -> DataFrame:
    """Events with the list of source rows whose columns equal the event's, for sources whose keys own few rows.

    The lists are made once per source key, not per event. Where a key may own more rows than
    one record should hold, ``lookup_rows`` gives the same pairs as rows.
    """
    keys = list(on.values())
    lists = source.groupBy(*keys).agg(F.collect_list(F.struct(*source.columns)).alias(result))
    e, s = events.alias("e"), lists.alias("s")
    none = F.array().cast(lists.schema[result].dataType)
    joined = e.join(s, [F.col(f"e.{a}") == F.col(f"s.{b}") for a, b in on.items()], "left")
    return joined.select("e.*", F.coalesce(F.col(f"s.{result}"), none).alias(result))
