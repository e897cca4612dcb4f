"""Predicates, routing of tables and merging of bursts over the changelog."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import CHANGELOG, anchored, changelog, check, notices, over, raw_log, statements, with_changelog
from checks.registry import STATEMENTS, named, with_raw_log
from tidelog.functions import patterns as P
from tidelog.operators import coalesce as C
from tidelog.operators import incremental as I
from tidelog.operators import matching
from tidelog.operators import ordering as T
from tidelog.operators import routing
from tidelog.plans import flows

HOUR_MS = 3_600_000

ROUTES = [
    ("visits", "db1.c%,db%.view,db3.%"),
    ("orders", "shop.%,sto_e.%"),
    ("errors", "%.err.r"),
]


def _matches(db: str, tbl: str) -> str:
    """Two whole-name patterns in the checking engine's words."""
    return f"(regexp_full_match(lower(trim(db)), '{db}') and regexp_full_match(lower(trim(tbl)), '{tbl}'))"


@check("f1_include_table", with_changelog(f"select pos, db, tbl from changelog where {_matches('db.*', '.*i.*')}"))
def include_table(spark, d):
    return changelog(spark, d).filter(P.include_table(" Db% . %I% ", "db", "tbl")).select("pos", "db", "tbl")


@check("f2_ignore_table", with_changelog(f"select pos, db, tbl from changelog where not {_matches('db1', 'cl[a-z]ck')}"))
def ignore_table(spark, d):
    return changelog(spark, d).filter(P.ignore_table("DB1.cl[a-z]ck", "db", "tbl")).select("pos", "db", "tbl")


@check(
    "f3_filter_algebra",
    with_changelog(
        f"select pos from changelog where ({_matches('db1', '.*')} or {_matches('shop', 'view')}) "
        f"and not {_matches('.*', 'error')}"
    ),
)
def filter_algebra(spark, d):
    either = P.any_of(P.include_table("db1.%", "db", "tbl"), P.include_table("shop.view", "db", "tbl"))
    keep = P.all_of(P.pass_all(), either, P.ignore_table("%.error", "db", "tbl"))
    return changelog(spark, d).filter(P.any_of(P.discard_all(), keep)).select("pos")


TABLE_FILTER_SQL = with_changelog(
    f"select pos, db, tbl from changelog where ({_matches('db.*', '.*')} or {_matches('shop', 's.*p')}) "
    f"and not {_matches('db2', 'v.*')} and not {_matches('.*', 'error')}"
)


@check("f4_filter_by_names", TABLE_FILTER_SQL)
def filter_by_names(spark, d):
    """The same lists among thousands of patterns of other names."""
    others = ",".join(f"none{i}.%,%.none{i}" for i in range(3000))
    kept = matching.filter_by_names(changelog(spark, d), f"db%.%,,shop.s%p,{others}", f"{others},db2.v%,%.error", "db", "tbl")
    return kept.select("pos", "db", "tbl")


@check("f4_table_filter", TABLE_FILTER_SQL)
def table_filter(spark, d):
    keep = P.table_filter("db%.%,,shop.s%p", "db2.v%,%.error", "db", "tbl")
    return changelog(spark, d).filter(keep).select("pos", "db", "tbl")


@check("f5_ignored_databases", with_changelog("select pos, db from changelog where db not in ('sys_info', 'DB2')"))
def ignored_databases(spark, d):
    kept = I.drop_ignored_databases(changelog(spark, d), "sys_info.%,shop,shop.a.b,DB2.orders,db1", "db")
    return kept.select("pos", "db")


@check(
    "f6_schema_change",
    named(
        "select pos, regexp_matches(regexp_replace(trim(lower(query)), ' {2,}', ' ', 'g'), "
        "'^(alter table|alter ignore table|drop table)') as is_ddl from st",
        ("st", STATEMENTS),
    ),
)
def schema_change(spark, d):
    return statements(spark, d).select("pos", P.is_schema_change("query").alias("is_ddl"))


@check(
    "f7_commit",
    with_raw_log(
        "select pos, event_type, coalesce(event_type = 'XID' or (event_type = 'QUERY' and query = 'COMMIT'), false) "
        "as is_commit from raw_log"
    ),
)
def commit(spark, d):
    return raw_log(spark, d).select("pos", "event_type", P.is_commit().alias("is_commit"))


@check(
    "f9_row_and_control_events",
    "with l as (select event_id as pos, case event_id % 6 when 0 then 'ROTATE' when 1 then 'XID' when 2 then 'WRITE_ROWS' "
    "when 3 then 'FORMAT_DESCRIPTION' when 4 then 'PRE_GA_UPDATE_ROWS' else 'HEARTBEAT' end as event_type from events) "
    "select pos, event_type from l where event_type in ('XID', 'WRITE_ROWS', 'PRE_GA_UPDATE_ROWS')",
)
def row_and_control_events(spark, d):
    log = over(
        spark,
        d,
        "select event_id as pos, case event_id % 6 when 0 then 'ROTATE' when 1 then 'XID' when 2 then 'WRITE_ROWS' "
        "when 3 then 'FORMAT_DESCRIPTION' when 4 then 'PRE_GA_UPDATE_ROWS' else 'HEARTBEAT' end as event_type from {events}",
        "events",
    )
    return log.filter(P.keep_row_events()).select("pos", "event_type")


TOPIC_SQL = (
    f"case when {_matches('db1', 'c.*')} or {_matches('db.*', 'view')} or {_matches('db3', '.*')} then 'visits' "
    f"when {_matches('shop', '.*')} or {_matches('sto.e', '.*')} then 'orders' "
    f"when {_matches('.*', 'err.r')} then 'errors' end"
)


@check("r1_first_matching_topic", with_changelog(f"select pos, {TOPIC_SQL} as topic from changelog"))
def first_matching_topic(spark, d):
    return notices(spark, d).select("pos", routing.route_topic(ROUTES).alias("topic"))


# ten thousand routes ahead of those that match, of names that look like theirs
MANY_ROUTES = [(f"other{i}", f"db{i + 4}.%,shop{i}%.view,%.c{i}") for i in range(10_000)] + ROUTES


@check("r1_topics_by_names", with_changelog(f"select pos, {TOPIC_SQL} as topic from changelog"))
def topics_by_names(spark, d):
    return matching.route_by_names(notices(spark, d), MANY_ROUTES).select("pos", "topic")


@check("f10_drop_unrouted", with_changelog(f"select pos, {TOPIC_SQL} as topic from changelog where {TOPIC_SQL} is not null"))
def unrouted(spark, d):
    return routing.drop_unrouted(notices(spark, d).select("pos", routing.route_topic(ROUTES).alias("topic")))


ALL_TOPICS_SQL = with_changelog(
    f"select pos, 'visits' as topic from changelog where {_matches('db1', 'c.*')} or {_matches('db.*', 'view')} "
    f"union all select pos, 'orders' from changelog where {_matches('shop', '.*')} "
    f"union all select pos, 'errors' from changelog where {_matches('.*', 'err.r')}"
)


@check("r2_all_topics_by_names", ALL_TOPICS_SQL)
def all_topics_by_names(spark, d):
    return matching.fan_out_by_names(notices(spark, d), MANY_ROUTES).select("pos", "topic")


@check("r2_all_matching_topics", ALL_TOPICS_SQL)
def all_matching_topics(spark, d):
    return routing.fan_out_topics(notices(spark, d), ROUTES).select("pos", "topic")


ANCHORED_TABLES = anchored(CHANGELOG, ["db", "tbl"], "ts", "interval 1 hour", "pos")


@check(
    "c1_coalesce_changes",
    f"{ANCHORED_TABLES} select m.db, m.tbl, m.first_pos, m.n_merged, m.a as first_ts, e.seq_no, "
    "m.last_at as last_ts from merged m join base e on e.pos = m.first_pos",
)
def coalesce_changes(spark, d):
    merged = C.coalesce_changes(changelog(spark, d), ["db", "tbl"], "ts", HOUR_MS)
    return merged.select(
        "db",
        "tbl",
        F.col("pos").alias("first_pos"),
        "n_merged",
        F.col("ts").alias("first_ts"),
        "seq_no",
        F.timestamp_micros("window_last").cast("timestamp_ntz").alias("last_ts"),
    )


@check(
    "c3_coalesce_by_database",
    f"{anchored(CHANGELOG, ['db'], 'ts', 'interval 30 minute', 'pos')} select db, first_pos, n_merged, a as first_ts from merged",
)
def coalesce_by_database(spark, d):
    merged = C.coalesce_by_database(notices(spark, d).select("Database", "ts", "pos"), "ts", HOUR_MS // 2, block_gaps=64)
    return merged.select(
        F.col("Database").alias("db"),
        F.col("pos").alias("first_pos"),
        "n_merged",
        F.timestamp_micros("window_start").cast("timestamp_ntz").alias("first_ts"),
    )


@check(
    "c4_release_after",
    f"{anchored(CHANGELOG, ['db'], 'ts', 'interval 10 minute', 'pos')}, newest as (select max(ts) as t from base) "
    "select db, first_pos, a + interval 10 minute as release_ts from merged, newest where a + interval 10 minute < t",
)
def release_after(spark, d):
    log = notices(spark, d).select("Database", "ts", "pos")
    newest = log.agg(F.max("ts").cast("timestamp").alias("t")).scalar()
    pending = C.coalesce_by_database(log, "ts", 600_000)
    released = C.release_after(pending, 600_000, newest).orderBy("release_at")
    return released.select(
        F.col("Database").alias("db"),
        F.col("pos").alias("first_pos"),
        F.timestamp_micros("release_at").cast("timestamp_ntz").alias("release_ts"),
    )


@check(
    "c5_coalesce_tumbling",
    with_changelog(
        "select db, tbl, time_bucket(interval 1 hour, ts) as window_start, min(ts) as first_ts, min(pos) as pos, "
        "count(*) as n_merged from changelog group by all"
    ),
)
def coalesce_tumbling(spark, d):
    return C.coalesce_tumbling(changelog(spark, d), ["db", "tbl"], "ts", "1 hour").withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


ORDER_EVENTS = (
    "select o_orderkey as pos, 1 as server_id, cast(o_orderkey % 7 as bigint) + 1 as n_rows from {orders}"
)


@check(
    "c7_bounded_batches",
    "with recursive e as (" + ORDER_EVENTS.replace("{orders}", "orders") + "), "
    "c as (select pos, n_rows, sum(n_rows) over (order by pos) - n_rows as before_rows from e), "
    "w as (select min(before_rows) as a from c union all "
    "select min(c.before_rows) from w join c on c.before_rows >= w.a + 500 having min(c.before_rows) is not null), "
    "spans as (select a, lead(a) over (order by a) as z from w) "
    "select cast(min(c.pos) as bigint) as first_pos, cast(s.a as bigint) as batch_start, count(*) as n_events, "
    "cast(sum(c.n_rows) as bigint) as batch_rows "
    "from spans s join c on c.before_rows >= s.a and (s.z is null or c.before_rows < s.z) group by s.a",
)
def bounded_batches(spark, d):
    events = over(spark, d, ORDER_EVENTS, "orders")
    return C.bounded_batches(events, 500, block_bits=12, block_gaps=64).drop("server_id")


@check(
    "c8_throughput",
    "with s as (select event_id as batch_id, user_id % 50 + 1 as n_rows, epoch_us(ts) // 1000 as at_ms from events), "
    "r as (select batch_id // 31 as run, sum(n_rows) as n_rows, count(*) as n, max(at_ms) as z, min(at_ms) as b from s group by 1), "
    "t as (select *, coalesce(lag(z) over (order by run), b) as b0 from r) "
    "select cast(run as bigint) as run, cast(n_rows as bigint) as n_rows, z - b0 as elapsed_ms, "
    "cast(n_rows * 1000 // nullif(z - b0, 0) as bigint) as rows_per_sec from t where n = 31",
)
def throughput(spark, d):
    sends = over(
        spark,
        d,
        "select event_id as batch_id, user_id % 50 + 1 as n_rows, unix_millis(cast(ts as timestamp)) as at_ms from {events}",
        "events",
    )
    return C.throughput(sends).select(F.col("run").cast("bigint").alias("run"), "n_rows", "elapsed_ms", "rows_per_sec")


MESSAGE_LOG = (
    "select concat('t', user_id % 3, '/', event_id % 4) as KafkaTopic, event_id as KafkaOffset, ts from {events}"
)


@check(
    "o8_consumer_progress",
    "select concat('t', user_id % 3) as topic, cast(event_id % 4 as int) as partition, max(event_id) + 1 as next_offset "
    "from events group by 1, 2",
)
def consumer_progress(spark, d):
    return T.consumer_progress(over(spark, d, MESSAGE_LOG, "events"))


@check(
    "o8_commit_points",
    f"{anchored(MESSAGE_LOG, ['KafkaTopic'], 'ts', 'interval 6 hour', 'KafkaOffset')} "
    "select KafkaTopic, a as commit_ts, first_pos + 1 as committed_offset from merged",
)
def commit_points(spark, d):
    points = C.commit_points(over(spark, d, MESSAGE_LOG, "events"), "ts", 6 * HOUR_MS)
    return points.withColumn("commit_ts", F.col("commit_ts").cast("timestamp_ntz"))


PUBLISH_SQL = (
    f"{anchored(CHANGELOG + ' where event_type <> ' + chr(39) + 'error' + chr(39), ['db', 'tbl'], 'ts', 'interval 1 hour', 'pos')}, "
    f"firsts as (select e.* from merged m join base e on e.pos = m.first_pos where e.db <> 'sys_info'), "
    f"routed as (select *, {TOPIC_SQL} as topic from firsts) "
    "select topic, concat(db, '.', tbl) as key, concat('{\"Type\":\"', type, '\",\"Database\":\"', db, '\",\"Table\":\"', tbl, "
    "'\",\"Timestamp\":', epoch_us(ts) // 1000, '}') as value from routed where topic is not null"
)


@check("publish_notices", PUBLISH_SQL)
def publish_notices(spark, d):
    """Which table-change notices go to which topic: filter, merge, route, envelope."""
    log = notices(spark, d).filter(P.table_filter("%.%", "sys_info.%,%.error"))
    merged = C.coalesce_changes(log.drop("value", "props", "user_id"), gap_ms=HOUR_MS, counts=False)
    stamped = merged.withColumn("Timestamp", F.unix_millis(F.col("ts").cast("timestamp")))
    return flows.publish_notices(stamped, ROUTES)
