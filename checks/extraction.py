"""High-water-mark windows and the rows they pull."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.registry import CHANGELOG, anchored, changelog, check, over, table, with_changelog
from tidelog.operators import incremental as I
from tidelog.session import shared_dir

# Databases of the changelog stand for the three order statuses; sys_info has no orders.
DATABASE_SQL = "case db when 'db1' then 'F' when 'DB2' then 'O' when 'shop' then 'P' else 'sys_info' end"

# Times are moved so that the month of events covers the years of orders: one second is a minute and some.
NOTICES = (
    f"select pos, {DATABASE_SQL} as \"Database\", timestamp '1995-01-01 00:00:00' + interval 1 minute * "
    "cast(floor((epoch_us(ts) - epoch_us(min(ts) over ())) / 1000000 * 1.2) as bigint) as ts from changelog"
)


def order_notices(spark, d):
    """Notices per order status, with their times stretched from the month of events to the years of orders."""
    log = changelog(spark, d)
    first = log.agg(F.unix_micros(F.min("ts").cast("timestamp"))).scalar()
    minutes = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - first) / 1000000 * 1.2).cast("bigint")
    start = F.lit("1995-01-01 00:00:00").cast("timestamp")
    return log.select(
        "pos",
        F.when(F.col("db") == "db1", "F").when(F.col("db") == "DB2", "O").when(F.col("db") == "shop", "P").otherwise("sys_info").alias("Database"),
        F.timestamp_micros(F.unix_micros(start) + minutes * 60_000_000).alias("ts"),
    )


def progress(spark):
    return spark.createDataFrame(
        [("F", "1996-06-01 00:00:00.000"), ("O", "last night")], "dbName string, job_time string"
    )


PROGRESS_SQL = "(values ('F', timestamp '1996-06-01 00:00:00'), ('O', null)) p(db, stored)"


def plain(c):
    return F.col(c).cast("timestamp_ntz").alias(c)


@check(
    "i1_initial_watermark",
    with_changelog(
        f"select n.pos, n.\"Database\", coalesce(p.stored, n.ts) as ts_start from ({NOTICES}) n left join {PROGRESS_SQL} on p.db = n.\"Database\""
    ),
)
def initial_watermark(spark, d):
    started = I.initial_watermark(order_notices(spark, d), progress(spark))
    return started.select("pos", "Database", plain("ts_start"))


INTERVAL_MIN = 20_000

# (Database, a = notice time, run_ts, start0) of the coalesced notices, then contiguous windows with a lag of 3 hours.
WINDOWS_SQL = (
    anchored(
        NOTICES.replace("from changelog", f"from ({CHANGELOG}) changelog"),
        ['"Database"'],
        "ts",
        f"interval {INTERVAL_MIN} minute",
        "pos",
    )
    + ", runs as (select m.\"Database\" as db, m.a, m.a + interval " + str(INTERVAL_MIN) + " minute as run_ts, "
    "coalesce(p.stored, m.a) as start0 from merged m left join " + PROGRESS_SQL + " on p.db = m.\"Database\"), "
    "ends as (select *, first_value(start0) over (partition by db order by run_ts) as s0, "
    "max(run_ts - interval 3 hour) over (partition by db order by run_ts) as e from runs), "
    "clamped as (select *, greatest(s0, e) as ts_end from ends), "
    "windows as (select db, run_ts, coalesce(lag(ts_end) over (partition by db order by run_ts), s0) as ts_start, ts_end from clamped)"
)

SETTINGS = {"interval_ms": INTERVAL_MIN * 60_000, "lag_ms": 3 * 3_600_000}


@check("i2_advance_windows", f"{WINDOWS_SQL} select db as \"Database\", run_ts, ts_start, ts_end from windows where db <> 'sys_info'")
def advance_windows(spark, d):
    windows = I.extraction_windows(order_notices(spark, d), progress(spark), "sys_info.%", **SETTINGS)
    return windows.select("Database", plain("run_ts"), plain("ts_start"), plain("ts_end"))


@check(
    "i3_render_query",
    f"{WINDOWS_SQL}, t as (select db, run_ts, strftime(ts_start, '%Y-%m-%d %H:%M:%S.0') as s, strftime(ts_end, '%Y-%m-%d %H:%M:%S.0') as e from windows) "
    "select run_ts, concat('select * from ', db, '.orders where ts >= ''', s, ''' and ts < ''', e, ''' -- ', db) as query_text from t",
)
def render_query(spark, d):
    windows = I.extraction_windows(order_notices(spark, d), progress(spark), **SETTINGS)
    template = "select * from $database.orders where ts >= '$ts_start' and ts < '$ts_end' -- $database"
    return I.extraction_queries(windows, template).select(plain("run_ts"), F.col("sql").alias("query_text"))


PART_WINDOWS = (
    "select p_partkey, case p_partkey % 3 when 0 then 'F' when 1 then 'O' else 'P' end as db, p_size as hours, p_partkey % 2400 as day from {part}"
)


@check(
    "e5_delta_join",
    f"with w as ({PART_WINDOWS.replace('{part}', 'part')}), b as (select db, timestamp '1995-01-01 00:00:00' + to_days(cast(day as int)) as s, hours from w) "
    "select o.o_orderkey, b.s as ts_start, b.s + to_hours(hours) as ts_end from b join orders o on o.o_orderstatus = b.db "
    "and o.o_orderdate >= b.s and o.o_orderdate < b.s + to_hours(hours)",
)
def delta_join(spark, d):
    windows = over(spark, d, PART_WINDOWS, "part").selectExpr(
        "db as Database",
        "timestamp '1995-01-01 00:00:00' + make_dt_interval(cast(day as int)) as ts_start",
        "timestamp '1995-01-01 00:00:00' + make_dt_interval(cast(day as int), hours) as ts_end",
    )
    source = table(spark, d, "orders").withColumnRenamed("o_orderstatus", "Database")
    return I.delta_join(windows, source, "o_orderdate", pick=["o_orderkey", plain("ts_start"), plain("ts_end")])


# the outer bounds lie among the orders and cut a day
LATE_WINDOWS = (
    "select p_partkey, case p_partkey % 3 when 0 then 'F' when 1 then 'O' else 'P' end as db, p_partkey * 7 % 24 as hour, p_size as hours, "
    "p_partkey * 3 % 900 as day from {part}"
)


@check(
    "e5_delta_join_dates",
    f"with w as ({LATE_WINDOWS.replace('{part}', 'part')}), b as (select db, timestamp '1995-01-01 00:00:00' + to_days(cast(day as int)) + to_hours(hour) as s, hours from w) "
    "select o.o_orderkey, b.s as ts_start, b.s + to_hours(hours) as ts_end from b join orders o on o.o_orderstatus = b.db "
    "and cast(cast(o.o_orderdate as date) as timestamp) >= b.s and cast(cast(o.o_orderdate as date) as timestamp) < b.s + to_hours(hours)",
)
def delta_join_dates(spark, d):
    """The change column is a date, and windows begin and end within a day."""
    windows = over(spark, d, LATE_WINDOWS, "part").selectExpr(
        "db as Database",
        "timestamp '1995-01-01 00:00:00' + make_dt_interval(cast(day as int), hour) as ts_start",
        "timestamp '1995-01-01 00:00:00' + make_dt_interval(cast(day as int), hour + hours) as ts_end",
    )
    source = table(spark, d, "orders").withColumnRenamed("o_orderstatus", "Database").withColumn("changed", F.to_date("o_orderdate"))
    return I.delta_join(windows, source, "changed", pick=["o_orderkey", plain("ts_start"), plain("ts_end")])


EXTRACT_SQL = (
    f"{WINDOWS_SQL} select o.o_orderkey, o.o_totalprice, o.o_orderdate, o.o_orderstatus as \"dbName\" from windows w join orders o "
    "on o.o_orderstatus = w.db and o.o_orderdate >= w.ts_start and o.o_orderdate < w.ts_end"
)


@check("i4_incremental_extract", EXTRACT_SQL)
def incremental_extract(spark, d):
    source = table(spark, d, "orders").selectExpr("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus as Database")
    return I.incremental_extract(
        order_notices(spark, d), progress(spark), source, "o_orderdate", "sys_info.%", **SETTINGS
    )


# texts of which some are no numbers and no dates
CODES = (
    "case when o_orderkey % 7 = 0 then concat('#', o_orderkey) when o_orderkey % 13 = 0 then null else concat('', o_orderkey) end as code",
    "case when o_orderkey % 11 = 0 then 'soon' else '1997-03-01' end as due",
)


@check(
    "i4_extract_checked",
    f"{WINDOWS_SQL}, r as (select o.o_orderkey, o.o_orderstatus as \"dbName\", {", ".join(CODES)} from windows w join orders o "
    "on o.o_orderstatus = w.db and o.o_orderdate >= w.ts_start and o.o_orderdate < w.ts_end), "
    "f as (select *, case when code like '#%' then 'code,' else '' end || case when due = 'soon' then 'due,' else '' end as misfits from r) "
    "select o_orderkey, \"dbName\", code, due, misfits, count(*) over (partition by misfits <> '') as rows_alike from f",
)
def extract_checked(spark, d):
    """Clean and dirty rows of one pass, and the numbers that were observed while they were written."""
    source = table(spark, d, "orders").selectExpr("o_orderkey", "o_orderdate", "o_orderstatus as Database", *CODES)
    path = shared_dir(spark, "checks", f"checked-{uuid.uuid4().hex}")
    casts = {"code": "bigint", "due": "date"}
    clean, dirty = I.incremental_extract_checked(
        order_notices(spark, d), progress(spark), source, "o_orderdate", casts, path, 10**9, "sys_info.%", **SETTINGS
    )
    names = ["o_orderkey", "dbName", F.col("code").cast("string").alias("code"), F.col("due").cast("string").alias("due")]
    misfits = F.concat(*[F.when(F.array_contains("dirty_columns", c), f"{c},").otherwise("") for c in casts])
    both = clean.select(*names, F.lit("").alias("misfits")), dirty.select(*names, misfits.alias("misfits"))
    counted = [df.withColumn("rows_alike", F.lit(df.count()).cast("bigint")) for df in both]
    return counted[0].unionByName(counted[1])


@check(
    "i5_query_catalog",
    f"{WINDOWS_SQL}, r as (select db, a, run_ts from runs), j as (select r.*, t.task_id, "
    "first_value(a - interval 1 second) over (partition by db, task_id order by run_ts) as s0 from r, (values ('orders'), ('parts')) t(task_id)) "
    "select db as \"Database\", task_id, coalesce(lag(run_ts) over (partition by db, task_id order by run_ts), s0) as ts_start, "
    "run_ts as ts_end from j",
)
def query_catalog(spark, d):
    from tidelog.operators.coalesce import coalesce_by_database

    merged = coalesce_by_database(order_notices(spark, d), "ts", INTERVAL_MIN * 60_000)
    runs = merged.withColumns(
        {
            "ts": F.timestamp_micros("window_start"),
            "run_ts": F.timestamp_micros(F.col("window_start") + F.lit(INTERVAL_MIN * 60_000_000)),
        }
    )
    jobs = I.query_catalog(runs, {"orders": "select 1", "parts": "select 2"})
    return jobs.select("Database", "task_id", plain("ts_start"), plain("ts_end"))


@check(
    "i6_backfill",
    "select o_orderkey, o_orderdate from orders where o_orderdate >= timestamp '1998-03-01 00:00:01' and o_orderdate < timestamp '2001-01-01 00:00:00'",
)
def backfill(spark, d):
    rows = I.backfill(
        table(spark, d, "orders"), "1998-03-01 00:00:01.000", "o_orderdate", F.lit("2001-01-01 00:00:00").cast("timestamp")
    )
    return rows.select("o_orderkey", "o_orderdate")


SNAPSHOT = (
    "select o_orderkey, o_totalprice, o_orderpriority, cast(0 as bigint) as version from {orders} where o_orderkey % 5 <> 0"
)
DELTA = (
    "select o_orderkey, o_totalprice + v as o_totalprice, concat('v', v) as o_orderpriority, cast(v as bigint) as version, "
    "case when (o_orderkey + v) % 4 = 0 then 'DELETE' when o_orderkey % 5 = 0 then 'INSERT' else 'UPDATE' end as Type from ("
    "select *, 1 as v from {orders} where o_orderkey % 2 = 0 union all select *, 2 as v from {orders} where o_orderkey % 3 = 0) x"
)


@check(
    "i7_merge_incremental",
    f"with s as ({SNAPSHOT.replace('{orders}', 'orders')}), d as ({DELTA.replace('{orders}', 'orders')}), "
    "u as (select *, 'SNAPSHOT' as Type from s union all by name select * from d), "
    "r as (select *, row_number() over (partition by o_orderkey order by version desc) as n from u) "
    "select o_orderkey, o_totalprice, o_orderpriority, version from r where n = 1 and Type <> 'DELETE'",
)
def merge_incremental(spark, d):
    return I.merge_incremental(over(spark, d, SNAPSHOT, "orders"), over(spark, d, DELTA, "orders"), ["o_orderkey"], "version")
