"""Registration of checks, and the views they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidelog.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def over(spark: SparkSession, sf_dir: str, sql: str, *tables: str) -> DataFrame:
    """``sql`` with ``{name}`` for each given table; other braces are text."""
    sql = sql.replace("{", "{{").replace("}", "}}")
    for t in tables:
        sql = sql.replace("{{" + t + "}}", "{" + t + "}")
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in tables})


# The texts below run unchanged in Spark and in the checking engine; only the table's name differs.

CHANGELOG = """
select event_id as pos, ts,
  case event_id % 3 when 0 then 'INSERT' when 1 then 'UPDATE' else 'DELETE' end as type,
  case user_id % 4 when 0 then 'db1' when 1 then 'DB2' when 2 then 'sys_info' else 'shop' end as db,
  event_type as tbl,
  concat('u1:', cast(floor(event_id / 5.0) as bigint) + 1) as gtid,
  event_id % 5 + 1 as seq_no, user_id, value, props
from {events}"""

# One server in three transactions out of three is the second one; gtids of each count from 1 without gaps.
RAW_LOG = """
select t.*, case when tx % 3 = 0 then 2 else 1 end as server_id from (
select cast(floor(event_id / 5.0) as bigint) * 20 as pos, 'GTID' as event_type,
       case when cast(floor(event_id / 5.0) as bigint) % 3 = 0
            then concat('s2:', cast(floor(event_id / 15.0) as bigint) + 1)
            else concat('s1:', cast(floor(event_id / 5.0) as bigint) - cast(floor(event_id / 15.0) as bigint)) end as gtid,
       cast(null as bigint) as table_id, cast(null as varchar(20)) as db, cast(null as varchar(20)) as tbl,
       cast(null as varchar(20)) as query, cast(null as bigint) as event_id, ts,
       cast(floor(event_id / 5.0) as bigint) as tx
from {events} where event_id % 5 = 0
union all
select cast(floor(event_id / 5.0) as bigint) * 20 + 1 + 3 * (event_id % 5), 'TABLE_MAP', null, event_id % 3,
       case user_id % 4 when 0 then 'db1' when 1 then 'DB2' when 2 then 'mysql' else 'shop' end, event_type, null, null, ts,
       cast(floor(event_id / 5.0) as bigint)
from {events}
union all
select cast(floor(event_id / 5.0) as bigint) * 20 + 2 + 3 * (event_id % 5),
       case event_id % 4 when 0 then 'WRITE_ROWS' when 1 then 'EXT_UPDATE_ROWS' when 2 then 'PRE_GA_DELETE_ROWS' else 'EXT_WRITE_ROWS' end,
       null, event_id % 3, null, null, null, event_id, ts, cast(floor(event_id / 5.0) as bigint)
from {events}
union all
select cast(floor(event_id / 5.0) as bigint) * 20 + 19,
       case when cast(floor(event_id / 5.0) as bigint) % 2 = 0 then 'XID' else 'QUERY' end, null, null, null, null,
       case when cast(floor(event_id / 5.0) as bigint) % 2 = 0 then null else 'COMMIT' end, null, ts,
       cast(floor(event_id / 5.0) as bigint)
from {events} where event_id % 5 = 4 and cast(floor(event_id / 5.0) as bigint) % 7 <> 3) t"""

# Statements of many spellings, one per event.
STATEMENTS = """
select event_id as pos, 'QUERY' as event_type, concat('db', user_id % 3) as db, event_type as tbl, ts,
  case event_id % 9 when 0 then concat('ALTER TABLE t', user_id, ' add c int') when 1 then ' alter  ignore    table x'
    when 2 then 'Drop   Table y' when 3 then 'TRUNCATE TABLE z' when 4 then 'COMMIT' when 5 then 'commit'
    when 6 then 'rename table a to b' when 7 then concat('insert into t values (', user_id, ')') else 'BEGIN' end as query
from {events}"""


def named(sql: str, *ctes: tuple[str, str]) -> str:
    """SQL with the shared views in front, for the checking engine."""
    heads = [f"{name} as ({text.replace('{events}', 'events')})" for name, text in ctes]
    return f"with {', '.join(heads)} {sql}" if heads else sql


def with_changelog(sql: str) -> str:
    return named(sql, ("changelog", CHANGELOG))


def with_raw_log(sql: str) -> str:
    return named(sql, ("raw_log", RAW_LOG))


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over(spark, sf_dir, CHANGELOG, "events")


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over(spark, sf_dir, RAW_LOG, "events")


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over(spark, sf_dir, STATEMENTS, "events")


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog under the field names of change records."""
    return changelog(spark, sf_dir).selectExpr(
        "type as Type", "db as Database", "tbl as Table", "pos", "ts", "gtid", "seq_no", "user_id", "value", "props"
    )


def anchored(base: str, keys: list[str], at: str, gap: str, order: str, ctes: str = "") -> str:
    """SQL that follows the anchors of every key one by one: CTEs ``base`` and ``w`` (keys, a)."""
    k = ", ".join(keys)
    wk = ", ".join(f"w.{x}" for x in keys)
    same = " and ".join(f"b.{x} = w.{x}" for x in keys)
    return f"""with recursive {ctes} base as ({base.replace('{events}', 'events')}),
w as (select {k}, min({at}) as a from base group by {k}
  union all
  select {wk}, min(b.{at}) from w join base b on {same} and b.{at} > w.a + {gap} group by {wk}),
spans as (select {k}, a, lead(a) over (partition by {k} order by a) as z from w),
merged as (select {', '.join(f's.{x}' for x in keys)}, s.a, min(case when b.{at} = s.a then b.{order} end) as first_pos,
    count(*) as n_merged, max(b.{at}) as last_at
  from spans s join base b on {same.replace('w.', 's.')} and b.{at} >= s.a and (s.z is null or b.{at} < s.z)
  group by {', '.join(f's.{x}' for x in keys)}, s.a)"""
