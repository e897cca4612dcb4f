"""Log order, transactions, offsets and metadata over the raw log."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import RAW_LOG, changelog, check, over, raw_log, with_changelog, with_raw_log
from tidelog.functions import offsets as O
from tidelog.functions import patterns as P
from tidelog.operators import enrich as E
from tidelog.operators import gtids as G
from tidelog.operators import ordering as T
from tidelog.plans import flows

BITS = 12

ROW_EVENT_SQL = "event_type like '%ROWS'"

NUMBERED = (
    "n0 as (select *, last_value(gtid ignore nulls) over (partition by server_id order by pos) as g, "
    "last_value(case when event_type = 'GTID' then pos end ignore nulls) over (partition by server_id order by pos) as tx_pos, "
    f"{ROW_EVENT_SQL} as is_row from raw_log), "
    "numbered as (select *, case when is_row then sum(case when is_row then 1 else 0 end) "
    "over (partition by server_id, tx_pos order by pos) end as seq_no from n0), "
    "maps as (select *, last_value(case when event_type = 'TABLE_MAP' then {'d': db, 't': tbl} end ignore nulls) "
    "over (partition by server_id, table_id order by pos) as m from numbered), "
    "resolved as (select * exclude (db, tbl), m.d as db, m.t as tbl from maps where is_row)"
)


def numbered_sql(sql: str) -> str:
    return f"with raw_log as ({RAW_LOG.replace('{events}', 'events')}), {NUMBERED} {sql}"


@check("e1_resolve_table_map", numbered_sql("select pos, server_id, db, tbl from resolved"))
def resolve_table_map(spark, d):
    return T.resolve_table_map(raw_log(spark, d), block_bits=BITS).select("pos", "server_id", "db", "tbl")


@check("t1_assign_transaction", numbered_sql("select pos, g as gtid from numbered"))
def assign_transaction(spark, d):
    return T.assign_transaction(raw_log(spark, d), block_bits=BITS).select("pos", "gtid")


@check(
    "t2_tx_sequence",
    numbered_sql("select pos, g as gtid, tx_pos as tx_start, cast(seq_no as bigint) as seq_no from numbered"),
)
def tx_sequence(spark, d):
    return T.tx_sequence(raw_log(spark, d), block_bits=BITS).select("pos", "gtid", "tx_start", "seq_no")


@check(
    "t3_transaction_state",
    numbered_sql(
        "select server_id, g as gtid, cast(max(seq_no) as bigint) as seq_no, bool_or(event_type = 'XID' or "
        "coalesce(query = 'COMMIT', false)) as complete, min(pos) as first_pos, max(pos) as last_pos "
        "from numbered where g is not null group by server_id, g"
    ),
)
def transaction_state(spark, d):
    return T.transaction_state(T.tx_sequence(raw_log(spark, d), block_bits=BITS))


@check(
    "t4_event_offset",
    numbered_sql(
        "select pos, server_id, concat('s0:1-9', case when n = 1 then '' else concat(',s', server_id, ':1', "
        "case when n = 2 then '' else concat('-', n - 1) end) end) as gtid_set, g as open_gtid, "
        "cast(seq_no as bigint) as open_seq from (select *, cast(split_part(g, ':', 2) as bigint) as n from numbered where is_row)"
    ),
)
def event_offset(spark, d):
    stamped = T.event_offset(raw_log(spark, d), "s0:1-9", block_bits=BITS)
    return stamped.select(
        "pos",
        "server_id",
        "gtid_set",
        F.map_keys("incomplete")[0].alias("open_gtid"),
        F.map_values("incomplete")[0].alias("open_seq"),
    )


# Two servers that commit out of order, eight transactions at a time, and leave numbers out.
GAP_LOG = (
    "select pos, event_type, server_id, concat('g', server_id, ':', 8 * cast(floor(j / 8.0) as bigint) + (3 * (j % 8)) % 8 + 1) as gtid from ("
    "select event_id * 4 as pos, 'GTID' as event_type, cast(floor(event_id / 5.0) as bigint) % 2 + 1 as server_id, "
    "cast(floor(event_id / 10.0) as bigint) as j from {events} where event_id % 5 = 0) k where j % 11 <> 5"
)

GAPS_SQL = (
    f"with g as (select server_id, pos, cast(split_part(gtid, ':', 2) as bigint) as n from ({GAP_LOG.replace('{events}', 'events')})), "
    "numbers as (select server_id, unnest(range(0, max(n) + 2)) as n from g group by server_id), "
    "places as (select m.server_id, m.n, g.pos from numbers m left join g using (server_id, n)) "
)


def gap_log(spark, d):
    return over(spark, d, GAP_LOG, "events")


@check(
    "t4_gtid_changes",
    GAPS_SQL + "select t.server_id, t.pos as tx_start, concat('g', t.server_id) as uuid, "
    "max(case when m.n < t.n then m.n end) + 1 as lo, min(case when m.n > t.n then m.n end) - 1 as hi "
    "from g t join places m on m.server_id = t.server_id and (m.pos is null or m.pos > t.pos) group by t.server_id, t.pos, t.n",
)
def gtid_changes(spark, d):
    """What each transaction makes of the set: the interval that it lies in from then on."""
    _, changes = G.gtid_deltas(gap_log(spark, d), block_bits=BITS)
    return changes.drop("_block")


@check(
    "t4_gtid_set_at",
    GAPS_SQL + "select server_id, pos, string_agg(r, ':' order by lo) as gtid_set from ("
    "select server_id, pos, min(n) as lo, case when count(*) = 1 then concat('', min(n)) else concat(min(n), '-', max(n)) end as r from ("
    "select p.server_id, p.pos, g.n, g.n - row_number() over (partition by p.server_id, p.pos order by g.n) as k "
    "from (select server_id, pos from g where pos % 1000 = 0) p join g on g.server_id = p.server_id and g.pos < p.pos) group by server_id, pos, k) "
    "group by server_id, pos",
)
def gtid_set_at(spark, d):
    """The whole set, put together from a block's set and the changes after it, at every fiftieth transaction that has one."""
    log = gap_log(spark, d)
    blocks, changes = G.gtid_deltas(log, block_bits=BITS)
    places = log.where("pos % 1000 = 0").select("server_id", "pos")
    found = G.gtid_set_at(blocks, changes, places, block_bits=BITS).where("gtid_set <> ''")
    return found.withColumn("gtid_set", F.expr("substring_index(gtid_set, concat('g', server_id, ':'), -1)"))


@check(
    "f8_system_rows_without_metadata",
    numbered_sql(
        "select pos, g as gtid, cast(seq_no as bigint) as seq_no, db, tbl from resolved "
        "where not (db = 'mysql' and tbl not in ('click', 'error'))"
    ),
)
def system_rows_without_metadata(spark, d):
    log = T.resolve_table_map(T.tx_sequence(raw_log(spark, d), block_bits=BITS), block_bits=BITS)
    known = F.col("tbl").isin("click", "error")
    return T.drop_system_without_metadata(log, known).select("pos", "gtid", "seq_no", "db", "tbl")


SAVED = '{"gtidSet":"s1:1-40,s2:1-30:35","incompleteTransactions":{"s1:41":2,"s1:45":4,"s2:33":1}}'

RESUME_SQL = (
    "not (g = 's1:41' and seq_no <= 2) and not (g = 's1:45' and seq_no <= 4) and not (g = 's2:33' and seq_no <= 1)"
)


@check("e8_resume_filter", numbered_sql(f"select pos, g as gtid from numbered where not is_row or ({RESUME_SQL})"))
def resume_filter(spark, d):
    return T.resume_filter(T.tx_sequence(raw_log(spark, d), block_bits=BITS), SAVED).select("pos", "gtid")


@check(
    "s2_start_position",
    numbered_sql(
        f"select 'saved' as start, pos from numbered where is_row and {RESUME_SQL} and not (split_part(g, ':', 1) = 's1' and "
        "cast(split_part(g, ':', 2) as int) <= 40) and not (split_part(g, ':', 1) = 's2' and "
        "(cast(split_part(g, ':', 2) as int) <= 30 or cast(split_part(g, ':', 2) as int) = 35)) "
        "union all select 'initial', pos from numbered where is_row and not (split_part(g, ':', 1) = 's1' and "
        "cast(split_part(g, ':', 2) as int) <= 99) "
        "union all select 'beginning', pos from numbered where is_row and not (split_part(g, ':', 1) = 's2' and "
        "cast(split_part(g, ':', 2) as int) <= 7) "
        "union all select 'current', pos from numbered where is_row and not (split_part(g, ':', 1) = 's1' and "
        "cast(split_part(g, ':', 2) as int) <= 100) and not (split_part(g, ':', 1) = 's2' and cast(split_part(g, ':', 2) as int) <= 9) "
        "union all select 'position', pos from numbered where is_row and pos > 3000"
    ),
)
def start_position(spark, d):
    log = T.tx_sequence(raw_log(spark, d), block_bits=BITS).filter(P.is_row_event())
    starts = {
        "saved": T.start_position(log, saved=SAVED, initial="s1:1-2", from_beginning=True),
        "initial": T.start_position(log, saved="", initial="s1:1-99", from_beginning=True),
        "beginning": T.start_position(log, from_beginning=True, purged="s2:1-7"),
        "current": T.start_position(log, executed="s1:1-100,s2:1-9"),
        "position": T.start_position(log, saved="bin.000000:3000", gtid_mode=False),
    }
    parts = [df.select(F.lit(name).alias("start"), "pos") for name, df in starts.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@check(
    "o1_position_offset",
    "select event_id, concat('bin.', event_id % 300, ':', event_id * 97) as text, concat('bin.', event_id % 300) as file, "
    "event_id * 97 as pos from events",
)
def position_offset(spark, d):
    log = over(spark, d, "select event_id, concat('bin.', event_id % 300) as f, event_id * 97 as p from {events}", "events")
    text = log.select("event_id", O.format_position("f", "p").alias("text"))
    return text.select("event_id", "text", O.parse_position("text")["file"].alias("file"), O.parse_position("text")["pos"].alias("pos"))


OFFSET_TEXTS = (
    "select event_id, case when event_id % 2 = 0 then concat(' {\"gtidSet\":\"u1:1-', event_id + 1, "
    "'\",\"incompleteTransactions\":{\"u1:', event_id + 2, '\":', user_id, '}}') else concat('u', user_id % 4, ':1-', event_id) end "
    "as offset_text, user_id from {events}"
)


@check(
    "o2_gtid_offset",
    "select event_id, case when event_id % 2 = 0 then concat('u1:1-', event_id + 1) else concat('u', user_id % 4, ':1-', event_id) end "
    "as gtid_set, case when event_id % 2 = 0 then 1 else 0 end as n_open, "
    "case when event_id % 2 = 0 then concat('{\"gtidSet\":\"u1:1-', event_id + 1, '\",\"incompleteTransactions\":{\"u1:', "
    "event_id + 2, '\":', user_id, '}}') else concat('{\"gtidSet\":\"u', user_id % 4, ':1-', event_id, "
    "'\",\"incompleteTransactions\":{}}') end as round_trip from events",
)
def gtid_offset(spark, d):
    parsed = over(spark, d, OFFSET_TEXTS, "events").withColumn("o", O.parse_gtid_offset("offset_text"))
    return parsed.select(
        "event_id",
        F.col("o.gtidSet").alias("gtid_set"),
        F.size("o.incompleteTransactions").alias("n_open"),
        O.format_gtid_offset("o.gtidSet", "o.incompleteTransactions").alias("round_trip"),
    )


@check(
    "o3_compare_position",
    "with l as (select event_id, event_id % 12 as f, event_id // 12 as p from events) select event_id, f * 1099511627776 + p as log_order, "
    "row_number() over (partition by p order by f) as nth_file from l",
)
def compare_position(spark, d):
    from pyspark.sql import Window as W

    log = over(
        spark, d, "select event_id, concat('mysql-bin.', event_id % 12) as binlog_file, event_id div 12 as pos from {events}", "events"
    )
    ordered = T.compare_position(log)
    return ordered.select(
        "event_id", "log_order", F.row_number().over(W.partitionBy("pos").orderBy("log_order")).cast("bigint").alias("nth_file")
    )


INTERVAL_TEXTS = (
    "select event_id, concat('u', user_id % 3, ':', event_id * 2, '-', event_id * 2 + event_id % 5, ':', event_id * 2 + 9, "
    "',u9:', event_id % 400 * 3) as gtid_set from {events}"
)


@check(
    "o4_gtid_set_union",
    "with i as (select concat('u', user_id % 3) as uuid, event_id * 2 as lo, event_id * 2 + event_id % 5 as hi from events "
    "union select concat('u', user_id % 3), event_id * 2 + 9, event_id * 2 + 9 from events "
    "union select 'u9', event_id % 400 * 3, event_id % 400 * 3 from events), "
    "m as (select *, max(hi) over (partition by uuid order by lo, hi rows between unbounded preceding and 1 preceding) as reach from i), "
    "g as (select *, sum(case when reach is null or lo > reach + 1 then 1 else 0 end) over (partition by uuid order by lo, hi "
    "rows between unbounded preceding and current row) as k from m) "
    "select uuid, min(lo) as lo, max(hi) as hi from g group by uuid, k",
)
def gtid_set_union(spark, d):
    texts = over(spark, d, INTERVAL_TEXTS, "events")
    intervals = texts.select(F.inline(O.parse_gtid_set("gtid_set")))
    return T.merge_intervals(intervals, bucket=1000)


@check(
    "o5_skip_gtid_set",
    with_changelog(
        "select pos, gtid from (select *, cast(split_part(gtid, ':', 2) as int) as n from changelog) "
        "where not (n between 1 and 100 or n between 150 and 200 or n = 222)"
    ),
)
def skip_gtid_set(spark, d):
    return T.skip_gtid_set(changelog(spark, d), "u1:1-100:150-200:180-190:222, u7:1-100000").select("pos", "gtid")


@check(
    "o6_high_water_offset",
    with_raw_log(
        "select server_id, max(pos) as pos, concat('bin.000001:', max(pos)) as offset_text from raw_log group by server_id"
    ),
)
def high_water_offset(spark, d):
    log = raw_log(spark, d).withColumn("o", O.format_position(F.lit("bin.000001"), "pos"))
    return T.high_water_offset(log, "o", keys=["server_id"]).withColumnRenamed("offset", "offset_text")




def _catalog(spark, d):
    """Three columns for each table that changed, but none for the tables named error."""
    columns = F.array(
        *[
            F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.lit(t).alias("mysql_type"))
            for i, c, t in ((2, "value", "double"), (0, "id", "bigint"), (1, "user_id", "int(11)"))
        ]
    )
    tables = changelog(spark, d).select("db", "tbl").distinct().filter("tbl <> 'error'")
    return tables.select("db", "tbl", F.inline(columns))


@check(
    "e2_enrich_columns",
    with_changelog(
        "select pos, db, tbl, case when tbl = 'error' then case when pos % 3 = 0 then 'col_0' when pos % 3 = 1 then 'col_0,col_1' "
        "else 'col_0,col_1,col_2' end else 'id,user_id,value' end as columns, case when tbl = 'error' then case when pos % 3 = 0 "
        "then 'text' when pos % 3 = 1 then 'text,text' else 'text,text,text' end else 'bigint,int(11),double' end as types, "
        "tbl <> 'error' as has_metadata from changelog"
    ),
)
def enrich_columns(spark, d):
    log = changelog(spark, d)
    named_events = E.enrich_columns(log, _catalog(spark, d), (F.col("pos") % 3 + 1).cast("int"))
    return named_events.select(
        "pos",
        "db",
        "tbl",
        F.array_join("columns", ",").alias("columns"),
        F.array_join("column_types", ",").alias("types"),
        "has_metadata",
    )


VERSIONS = (
    "select db, tbl, pos as valid_from, 'id' as c0, concat('c', pos) as c1 from changelog where pos % 97 = 5"
)


@check(
    "e3_enrich_columns_versioned",
    with_changelog(
        f"select l.pos, l.db, l.tbl, v.valid_from, coalesce(v.c0 || ',' || v.c1, 'col_0,col_1') as columns from changelog l "
        f"asof left join ({VERSIONS}) v on l.db = v.db and l.tbl = v.tbl and l.pos >= v.valid_from"
    ),
)
def enrich_columns_versioned(spark, d):
    log = changelog(spark, d)
    ddl = log.filter("pos % 97 = 5").select("db", "tbl", F.col("pos").alias("valid_from"))
    columns = F.array(
        F.struct(F.lit(0).alias("ordinal"), F.lit("id").alias("column"), F.lit("bigint").alias("mysql_type")),
        F.struct(
            F.lit(1).alias("ordinal"),
            F.concat(F.lit("c"), F.col("valid_from").cast("string")).alias("column"),
            F.lit("text").alias("mysql_type"),
        ),
    )
    versions = ddl.select("db", "tbl", "valid_from", F.inline(columns))
    decoded = E.enrich_columns_versioned(log, versions, F.lit(2))
    return decoded.select("pos", "db", "tbl", "valid_from", F.array_join("columns", ",").alias("columns"))


@check(
    "e4_lookup_enrich",
    "select e.event_id, case when c.c_custkey is null then 0 else 1 end as n_found, c.c_name, c.c_nationkey "
    "from events e left join customer c on c.c_custkey = e.user_id",
)
def lookup_enrich(spark, d):
    customers = over(spark, d, "select c_custkey, c_name, c_nationkey from {customer}", "customer")
    events = over(spark, d, "select event_id, user_id from {events}", "events")
    found = E.lookup_enrich(events, customers, {"user_id": "c_custkey"})
    return found.select(
        "event_id",
        F.size("Result").alias("n_found"),
        F.get("Result", F.lit(0))["c_name"].alias("c_name"),
        F.get("Result", F.lit(0))["c_nationkey"].alias("c_nationkey"),
    )


@check(
    "e4_lookup_rows",
    "select e.event_id, c.c_custkey, c.c_mktsegment from events e left join customer c on c.c_custkey = e.user_id",
)
def lookup_rows(spark, d):
    customers = over(spark, d, "select c_custkey, c_mktsegment from {customer}", "customer")
    events = over(spark, d, "select event_id, user_id from {events}", "events")
    found = E.lookup_rows(events, customers, {"user_id": "c_custkey"})
    return found.select("event_id", "c_custkey", "c_mktsegment")


# A catalog for half of the tables, and one or two rows in each row event: (id, user) after or before the change.
KNOWN = "tbl in ('click', 'view', 'error')"

N_ROWS = "event_id % 2 + 1"


def image_log(spark, d):
    """The raw log with the row images that its row events carry."""
    images = (
        "transform(sequence(0, cast(event_id % 2 as int)), i -> named_struct("
        "'before', case when event_id % 4 in (1, 2) then array(cast(event_id * 10 + i as string), concat('o', i)) end, "
        "'after', case when event_id % 4 <> 2 then array(cast(event_id * 10 + i as string)) end))"
    )
    return raw_log(spark, d).withColumns(
        {
            "rows": F.when(P.is_row_event(), F.expr(images)),
            "included": F.expr("case when event_id % 4 <> 2 then array(0) else cast(array() as array<int>) end"),
            "included_before": F.expr("case when event_id % 4 in (1, 2) then array(0, 1) else cast(array() as array<int>) end"),
        }
    )


def half_catalog(spark, d):
    columns = F.array(
        F.struct(F.lit(0).alias("ordinal"), F.lit("id").alias("column"), F.lit("bigint").alias("mysql_type")),
        F.struct(F.lit(1).alias("ordinal"), F.lit("user").alias("column"), F.lit("text").alias("mysql_type")),
    )
    tables = over(
        spark,
        d,
        "select distinct case user_id % 4 when 0 then 'db1' when 1 then 'DB2' when 2 then 'mysql' else 'shop' end as db, "
        "event_type as tbl from {events}",
        "events",
    )
    return tables.filter(KNOWN).select("db", "tbl", F.inline(columns))


WANTED_SQL = f"db <> 'shop' and not (db = 'mysql' and not ({KNOWN}))"

TYPE_SQL = "case when event_type like '%WRITE%' then 'INSERT' when event_type like '%UPDATE%' then 'UPDATE' else 'DELETE' end"


@check(
    "full_records_from_log",
    numbered_sql(
        f"select r.server_id as \"ServerId\", r.g as \"GTID\", cast(r.seq_no as bigint) as \"SeqNo\", cast(i as int) as row_no, "
        f"{TYPE_SQL} as \"Type\", db as \"Database\", tbl as \"Table\", "
        f"case when event_id % 4 <> 2 then cast(event_id * 10 + i as varchar) end as new_id, "
        f"case when event_id % 4 in (1, 2) then cast(event_id * 10 + i as varchar) end as old_id, "
        f"case when event_id % 4 in (1, 2) then concat('o', i) end as old_user, {KNOWN} as known, "
        "concat('{\"gtidSet\":\"', case when n = 1 then '' else concat('s', server_id, ':1', case when n = 2 then '' else concat('-', n - 1) end) end, "
        "'\",\"incompleteTransactions\":{\"', g, '\":', cast(seq_no as bigint), '}}') as \"Offset\" "
        f"from (select *, cast(split_part(g, ':', 2) as bigint) as n, unnest(range(0, {N_ROWS})) as i from resolved where {WANTED_SQL}) r"
    ),
)
def full_records_from_log(spark, d):
    """Raw log to full change records: numbered, stamped, resolved, filtered, named, split into rows."""
    records = flows.full_records(
        image_log(spark, d), half_catalog(spark, d), F.lit(2), "%.%", "shop.%", block_bits=BITS
    )
    data, old = F.col("Data"), F.col("OldData")
    return records.select(
        "ServerId",
        "GTID",
        "SeqNo",
        "row_no",
        "Type",
        "Database",
        "Table",
        F.coalesce(data["id"], data["col_0"]).alias("new_id"),
        F.coalesce(old["id"], old["col_0"]).alias("old_id"),
        F.coalesce(old["user"], old["col_1"]).alias("old_user"),
        F.coalesce(F.map_contains_key(data, "id"), F.map_contains_key(old, "id")).alias("known"),
        "Offset",
    )


# both servers alter a table, and drop and alter another one, in the middle of their logs
ALTERED = [
    (2, 60, "ALTER TABLE db1.`click` RENAME COLUMN id TO key_id, ADD COLUMN extra decimal(10,2) NOT NULL"),
    (1, 61, "alter  table click rename column id to key_id, add extra decimal(10,2) after user, add index by_user (user, id)"),
    (2, 120, "alter table db1.click drop column user"),
    (1, 121, "Alter Table db1.click Drop user, modify key_id bigint"),
    (2, 90, "drop table if exists other, DB2.`click`"),
]


def altered_log(spark, d):
    log = image_log(spark, d)
    statements = spark.createDataFrame(ALTERED, "server_id int, k bigint, query string").selectExpr(
        "server_id", "k * 20 + 17 as pos", "'QUERY' as event_type", "'db1' as db", "query"
    )
    return log.unionByName(statements, allowMissingColumns=True)


@check(
    "full_records_with_versions",
    numbered_sql(
        f"select server_id as \"ServerId\", g as \"GTID\", cast(seq_no as bigint) as \"SeqNo\", cast(i as int) as row_no, "
        f"case when not ({KNOWN}) or (db = 'DB2' and tbl = 'click' and server_id = 2 and pos > 1817) then 'col_0' "
        "when db = 'db1' and tbl = 'click' and pos > case server_id when 2 then 1217 else 1237 end then 'key_id' else 'id' end as id_name, "
        "case when event_id % 4 not in (1, 2) then null "
        f"when not ({KNOWN}) or (db = 'DB2' and tbl = 'click' and server_id = 2 and pos > 1817) then 'col_1' "
        "when db = 'db1' and tbl = 'click' and pos > case server_id when 2 then 2417 else 2437 end then 'extra' else 'user' end as user_name "
        f"from (select *, unnest(range(0, {N_ROWS})) as i from resolved where {WANTED_SQL})"
    ),
)
def full_records_with_versions(spark, d):
    """Rows on both sides of statements that rename, add and drop columns, read with the columns of their time."""
    records = flows.full_records(
        altered_log(spark, d), half_catalog(spark, d), F.lit(2), "%.%", "shop.%", block_bits=BITS, versions=True
    )
    name = lambda c, i: F.get(F.map_keys(c), F.lit(i))
    return records.select(
        "ServerId", "GTID", "SeqNo", "row_no", F.coalesce(name("Data", 0), name("OldData", 0)).alias("id_name"), name("OldData", 1).alias("user_name")
    )


PUBLISH_LOG_SQL = (
    "with recursive raw_log as (" + RAW_LOG.replace("{events}", "events") + f"), {NUMBERED}, "
    f"wanted as (select pos, db, tbl, ts, event_id, {TYPE_SQL} as type from resolved where {WANTED_SQL}), "
    "w as (select db, tbl, min(ts) as a from wanted group by db, tbl union all "
    "select w.db, w.tbl, min(b.ts) from w join wanted b on b.db = w.db and b.tbl = w.tbl and b.ts > w.a + interval 2 hour group by w.db, w.tbl), "
    "firsts as (select b.*, row_number() over (partition by b.db, b.tbl, b.ts order by b.pos) as r from w join wanted b on b.db = w.db and b.tbl = w.tbl and b.ts = w.a) "
    "select case when db = 'db1' then 'first' else 'rest' end as topic, concat(db, '.', tbl) as key, concat('{\"Type\":\"', type, "
    "'\",\"Database\":\"', db, '\",\"Table\":\"', tbl, '\",\"Timestamp\":', epoch_us(ts) // 1000, '}') as value "
    f"from (select *, unnest(range(0, {N_ROWS})) as i from firsts where r = 1)"
)


@check("publish_from_log", PUBLISH_LOG_SQL)
def publish_from_log(spark, d):
    """Raw log to messages: resolved, filtered, named, merged by table, routed; one notice per row of the first event."""
    return flows.publish(
        image_log(spark, d),
        half_catalog(spark, d),
        F.lit(2),
        [("first", "db1.%"), ("rest", "%.%")],
        ignore="shop.%",
        gap_ms=7_200_000,
        block_bits=BITS,
    )
