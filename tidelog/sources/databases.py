"""Rows and schemas out of databases over Spark's JDBC source."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.templates import check_query_template

FETCH_SIZE = 1000
TIMEOUT_SECONDS = 3600

COLUMNS_SQL = (
    "select table_schema as db, table_name as tbl, ordinal_position - 1 as ordinal, "
    "column_name as `column`, column_type as mysql_type from information_schema.columns"
)


def jdbc_options(
    url: str,
    sql: str,
    fetch_size: int = FETCH_SIZE,
    timeout: int = TIMEOUT_SECONDS,
    session_sql: Sequence[str] = (),
    split: tuple[str, str, str, int] | None = None,
    **connection: str,
) -> dict[str, str]:
    """Options of a read of any SQL text.

    More than one session statement needs a driver that takes several at once.
    ``split`` = (column, lower, upper, partitions) reads ranges of a column in
    parallel; without it one task reads the result.
    """
    options = {"url": url, "fetchsize": str(fetch_size), "queryTimeout": str(timeout), **connection}
    if session_sql:
        options["sessionInitStatement"] = "; ".join(session_sql)
    if split is None:
        return {**options, "query": sql}
    column, lower, upper, partitions = split
    return {
        **options,
        "dbtable": f"({sql}) q",
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def jdbc_query_scan(spark: SparkSession, url: str, sql: str, **settings) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, sql, **settings)).load()


def jdbc_extract(
    spark: SparkSession, url: str, template: str, windows: Iterable[tuple[str, str, str]], **settings
) -> DataFrame:
    """Union of the delta queries of (database, ts_start, ts_end) windows, the database as last column.

    Each window is a JDBC read of its own, planned here and run by executors.
    """
    check_query_template(template)
    parts = []
    for database, start, end in windows:
        sql = template.replace("$database", database).replace("$ts_start", start).replace("$ts_end", end)
        parts.append(jdbc_query_scan(spark, url, sql, **settings).withColumn("dbName", F.lit(database)))
    return reduce(DataFrame.unionByName, parts)


def scan_schema_catalog(spark: SparkSession, url: str, databases: Sequence[str] = (), **connection: str) -> DataFrame:
    """(db, tbl, ordinal, column, mysql_type) of a server; a table that is not there has no rows."""
    sql = COLUMNS_SQL
    if databases:
        names = ", ".join("'" + d.replace("'", "''") + "'" for d in databases)
        sql += f" where table_schema in ({names})"
    return jdbc_query_scan(spark, url, sql, **connection)


# Column type a Spark type is listed under.
LISTED_TYPES = {
    T.ByteType: "tinyint",
    T.ShortType: "smallint",
    T.IntegerType: "int",
    T.LongType: "bigint",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.StringType: "text",
    T.BinaryType: "blob",
    T.BooleanType: "bit",
    T.DateType: "date",
    T.TimestampType: "timestamp",
    T.TimestampNTZType: "datetime",
}


def listed_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"decimal({dtype.precision},{dtype.scale})"
    return LISTED_TYPES.get(type(dtype), "unsupported")


def columns_of(df: DataFrame) -> list[tuple[int, str, str]]:
    """Ordered (ordinal, column, type) of any query; only its plan is looked at."""
    return [(i, f.name, listed_type(f.dataType)) for i, f in enumerate(df.schema.fields)]


def catalog_of(spark: SparkSession, tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Catalog of DataFrames given as {(db, tbl): df}."""
    rows = [(db, tbl, *column) for (db, tbl), df in tables.items() for column in columns_of(df)]
    return spark.createDataFrame(rows, "db string, tbl string, ordinal int, column string, mysql_type string")
