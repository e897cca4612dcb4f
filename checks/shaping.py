"""Change records, messages, typed rows and nested values."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import STATEMENTS, check, named, notices, over, raw_log, statements, table, with_changelog, with_raw_log
from tidelog.functions import paths
from tidelog.functions import records as R
from tidelog.operators import records as X
from tidelog.sources import databases, messages, sinks

# Row events with one to three rows each; updates name two of their three columns, deletes only the key before.
ROW_EVENTS = """
select event_id as pos, concat('bin.', lpad(cast(event_id % 7 as string), 6, '0')) as binlog_file, 5 as server_id, ts,
  case event_id % 3 when 0 then 'WRITE_ROWS' when 1 then 'EXT_UPDATE_ROWS' else 'PRE_GA_DELETE_ROWS' end as event_type,
  concat('db', user_id % 3) as db, event_type as tbl, event_id % 5 + 1 as seq_no,
  case when event_id % 2 = 0 then concat('u1:', event_id div 10 + 2) end as gtid, concat('u1:1-', event_id div 10 + 1) as gtid_set,
  array('id', 'user', 'note') as columns,
  case event_id % 3 when 0 then array(0, 1, 2) when 1 then array(0, 2) else cast(array() as array<int>) end as included,
  case event_id % 3 when 0 then cast(array() as array<int>) when 1 then array(0, 1, 2) else array(0) end as included_before,
  transform(sequence(0, cast(event_id % 4 as int)), i -> named_struct(
    'before', case event_id % 3 when 1 then array(cast(event_id * 10 + i as string), cast(user_id as string), 'old')
              when 2 then array(cast(event_id * 10 + i as string)) end,
    'after', case event_id % 3 when 0 then array(cast(event_id * 10 + i as string), cast(user_id as string), props)
             when 1 then array(cast(event_id * 10 + i as string), 'new') end)) as rows
from {events}"""

ROWS_SQL = (
    "rows0 as (select *, event_id % 3 as k, unnest(range(0, event_id % 4 + 1)) as row_no from events)"
)

TYPE_SQL = "case event_id % 3 when 0 then 'INSERT' when 1 then 'UPDATE' else 'DELETE' end"


def row_events(spark, d):
    return over(spark, d, ROW_EVENTS, "events")


@check(
    "p1_classify_op",
    with_raw_log(
        "select pos, case when event_type like '%WRITE_ROWS' then 'INSERT' when event_type like '%UPDATE_ROWS' then 'UPDATE' "
        "when event_type like '%DELETE_ROWS' then 'DELETE' when query is not null then 'QUERY' end as op from raw_log"
    ),
)
def classify_op(spark, d):
    return raw_log(spark, d).select("pos", R.classify_op("event_type", "query").alias("op"))


@check("p2_explode_rows", f"with {ROWS_SQL} select event_id as pos, cast(row_no as int) as row_no, event_id * 10 + row_no as id from rows0")
def explode_rows(spark, d):
    rows = X.explode_rows(row_events(spark, d))
    return rows.select("pos", "row_no", F.coalesce("row.after", "row.before")[0].cast("bigint").alias("id"))


@check(
    "p3_zip_columns",
    "select o_orderkey, case when o_orderkey & 1 = 1 then cast(o_custkey as varchar) end as cust, "
    "case when o_orderkey & 2 = 2 then o_orderstatus end as status, case when o_orderkey & 4 = 4 then o_orderpriority end as priority, "
    "cast(o_orderkey & 1 as int) + cast((o_orderkey & 2) // 2 as int) + cast((o_orderkey & 4) // 4 as int) as n from orders",
)
def zip_columns(spark, d):
    dense = over(
        spark,
        d,
        "select o_orderkey, o_orderkey & 7 as mask, array_compact(array(case when o_orderkey & 1 = 1 then cast(o_custkey as string) end, "
        "case when o_orderkey & 2 = 2 then o_orderstatus end, case when o_orderkey & 4 = 4 then o_orderpriority end)) as vals "
        "from {orders}",
        "orders",
    )
    names = F.array(F.lit("cust"), F.lit("status"), F.lit("priority"))
    zipped = dense.select("o_orderkey", R.zip_columns(R.ordinals_of_mask("mask", 3), names, "vals").alias("m"))
    return zipped.select("o_orderkey", *[F.col("m")[c].alias(c) for c in ("cust", "status", "priority")], F.size("m").alias("n"))


@check(
    "p4_before_after",
    f"with {ROWS_SQL} select event_id as pos, cast(row_no as int) as row_no, {TYPE_SQL} as type, "
    "case when k <> 2 then cast(event_id * 10 + row_no as varchar) end as id, case when k = 0 then cast(user_id as varchar) end as usr, "
    "case k when 0 then props when 1 then 'new' end as note, case when k <> 0 then cast(event_id * 10 + row_no as varchar) end as old_id, "
    "case when k = 1 then cast(user_id as varchar) end as old_usr, case when k = 1 then 'old' end as old_note, "
    "k <> 2 as has_data, k <> 0 as has_old from rows0",
)
def before_after(spark, d):
    records = X.to_records(row_events(spark, d).drop("gtid", "gtid_set").withColumn("id", F.col("pos")))
    return records.select(
        F.col("BinLogPosition").alias("pos"),
        "row_no",
        F.col("Type").alias("type"),
        *[F.col("Data")[c].alias(a) for c, a in (("id", "id"), ("user", "usr"), ("note", "note"))],
        *[F.col("OldData")[c].alias(f"old_{a}") for c, a in (("id", "id"), ("user", "usr"), ("note", "note"))],
        F.col("Data").isNotNull().alias("has_data"),
        F.col("OldData").isNotNull().alias("has_old"),
    )


HEADER_SQL = (
    f"select {TYPE_SQL} as Type, concat('db', user_id % 3) as Database, event_type as \"Table\", "
    "case when event_id % 2 = 0 then concat('{\"gtidSet\":\"u1:1-', event_id // 10 + 1, '\",\"incompleteTransactions\":{\"u1:', "
    "event_id // 10 + 2, '\":', event_id % 5 + 1, '}}') else concat('bin.', lpad(cast(event_id % 7 as varchar), 6, '0'), ':', event_id) end "
    "as \"Offset\", 5 as ServerId, epoch_us(ts) // 1000 as \"Timestamp\", "
    "case when event_id % 2 = 1 then concat('bin.', lpad(cast(event_id % 7 as varchar), 6, '0')) end as BinLogFilename, "
    "case when event_id % 2 = 1 then event_id end as BinLogPosition, "
    "case when event_id % 2 = 0 then concat('u1:', event_id // 10 + 2) end as GTID, "
    "case when event_id % 2 = 0 then event_id % 5 + 1 end as SeqNo"
)


@check("p5_record_header", f"{HEADER_SQL} from events")
def record_header(spark, d):
    events = row_events(spark, d)
    return events.select(*[c.alias(n) for n, c in X.record_header(events).items()])


@check("p6_notices", f"select * exclude (r) from ({HEADER_SQL}, unnest(range(0, event_id % 4 + 1)) as r from events)")
def to_notices(spark, d):
    return X.to_notices(row_events(spark, d))


@check(
    "p7_query_records",
    named(
        "select 'QUERY' as Type, db as Database, tbl as \"Table\", epoch_us(ts) // 1000 as \"Timestamp\", query as sql_text from st",
        ("st", STATEMENTS),
    ),
)
def query_records(spark, d):
    return X.query_records(statements(spark, d)).select(
        "Type", "Database", "Table", "Timestamp", F.col("Data")["Sql"].alias("sql_text")
    )


@check(
    "p8_cast_image",
    "select p_partkey as id, cast(p_size as int) as size, p_name as name, cast(null as int) as brand, "
    "cast(p_size * 100 + 25 as double) / 100 as price, cast(p_size as bigint) as flags, concat(2000 + p_size, '-01-02') as day, "
    "p_size % 2 = 0 as bit_on from part",
)
def cast_image(spark, d):
    images = over(
        spark,
        d,
        "select map('id', cast(p_partkey as string), 'size', cast(p_size as string), 'name', p_name, 'brand', p_brand, "
        "'price', concat(p_size, '.25'), 'flags', cast(p_size as string), 'day', concat(2000 + p_size, '-01-02'), "
        "'bit_on', case when p_size % 2 = 0 then 'true' else 'false' end) as image from {part}",
        "part",
    )
    typed = R.cast_image(
        "image",
        [
            ("id", "bigint(20)"),
            ("size", "int(11)"),
            ("name", "varchar(55)"),
            ("brand", "smallint"),
            ("price", "decimal(10,2)"),
            ("flags", "set('a','b')"),
            ("day", "date"),
            ("bit_on", "bit(1)"),
        ],
    )
    return images.select(typed.alias("t")).select("t.*").withColumns(
        {"price": F.col("price").cast("double"), "day": F.col("day").cast("string")}
    )


TYPE_NAMES = (
    "select p_partkey, case p_size % 9 when 0 then concat('INT(', p_size, ') unsigned') when 1 then 'int unsigned' "
    "when 2 then concat('Decimal(', p_size, ',2)') when 3 then 'VARCHAR(9)' when 4 then 'json' when 5 then 'enum(1,2)' "
    "when 6 then 'LongText' when 7 then ' bigint' else 'varbinary(3)' end as name from {part}"
)


@check(
    "p9_normalize_type",
    f"with t as ({TYPE_NAMES.replace('{part}', 'part')}), b as (select p_partkey, lower(split_part(name, '(', 1)) as k from t) "
    "select p_partkey, case when k in ('int', 'decimal', 'varchar', 'enum', 'longtext', 'bigint') then k else 'unsupported' end as kind from b",
)
def normalize_type(spark, d):
    return over(spark, d, TYPE_NAMES, "part").select("p_partkey", R.normalize_type("name").alias("kind"))


LABELS = (
    "select event_id, case event_id % 9 when 0 then 'INSERT' when 1 then 'DELETE' when 2 then 'UPDATE' when 3 then 'UPSERT' "
    "when 4 then 'SELECT FOR UPDATE' when 5 then 'BEFORE UPDATE' when 6 then 'AFTER UPDATE' when 7 then 'insert' else event_type end as label, "
    "cast(user_id % 9 as int) as code from {events}"
)


@check(
    "p10_operation_codes",
    f"with l as ({LABELS.replace('{events}', 'events')}) select event_id, case label when 'INSERT' then 1 when 'DELETE' then 2 "
    "when 'UPDATE' then 3 when 'UPSERT' then 4 when 'SELECT FOR UPDATE' then 5 when 'BEFORE UPDATE' then 6 when 'AFTER UPDATE' then 7 "
    "else -1 end as code_of_label, case code when 1 then 'INSERT' when 2 then 'DELETE' when 3 then 'UPDATE' when 4 then 'UPSERT' "
    "when 5 then 'SELECT FOR UPDATE' when 6 then 'BEFORE UPDATE' when 7 then 'AFTER UPDATE' end as label_of_code from l",
)
def operation_codes(spark, d):
    return over(spark, d, LABELS, "events").select(
        "event_id", R.op_code("label").alias("code_of_label"), R.op_label_from_text(F.col("code").cast("string")).alias("label_of_code")
    )


@check(
    "p11_positional_columns",
    "select c_custkey as _id, c_name as full_name, c_nationkey as country, c_acctbal as balance, c_mktsegment as segment from customer",
)
def positional_columns(spark, d):
    return X.project_positional(table(spark, d, "customer"), ["_id", "full_name", "country", "balance", "segment"])


@check("p12_tag_tenant", "select c_custkey, c_name, concat('shop', c_nationkey) as dbName from customer")
def tag_tenant(spark, d):
    customers = table(spark, d, "customer")
    return X.tag_tenant(customers, F.concat(F.lit("shop"), F.col("c_nationkey").cast("string"))).select(
        "c_custkey", "c_name", "dbName"
    )


@check(
    "p13_type_result_set",
    "select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_quantity, l_shipdate, l_returnflag, "
    "cast(cast(l_linenumber as decimal(9, 2)) as double) as dec, cast(l_linenumber as double) as flt, "
    "l_linenumber = 1 as is_first, cast(cast(l_shipdate as date) as varchar) as day, cast(null as varchar) as nothing from lineitem",
)
def result_set_types(spark, d):
    rows = over(
        spark,
        d,
        "select l_orderkey, l_linenumber, l_quantity, l_shipdate, l_returnflag, cast(l_linenumber as decimal(9, 2)) as dec, "
        "cast(l_linenumber as float) as flt, l_linenumber = 1 as is_first, cast(l_shipdate as date) as day, null as nothing "
        "from {lineitem}",
        "lineitem",
    )
    return X.type_result_set(rows).withColumn("day", F.col("day").cast("string"))


DIRTY = (
    "select event_id, case when event_id % 13 = 0 then concat('x', user_id) when event_id % 17 = 0 then null "
    "else cast(user_id as string) end as who, case when event_id % 11 = 0 then '1996-02-31' else '1996-02-28' end as day from {events}"
)


@check(
    "p14_split_dirty",
    "select event_id, case when event_id % 13 = 0 or event_id % 17 = 0 then null else cast(user_id as int) end as who, "
    "case when event_id % 11 = 0 then null else '1996-02-28' end as day, "
    "concat_ws(',', case when event_id % 13 = 0 then 'who' end, case when event_id % 11 = 0 then 'day' end) as faults from events",
)
def split_dirty(spark, d):
    casts = {"who": "int", "day": "date"}
    clean, dirty = X.split_dirty(over(spark, d, DIRTY, "events"), casts)
    typed = dirty.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})
    both = clean.withColumn("faults", F.lit("")).unionByName(
        typed.withColumn("faults", F.array_join("dirty_columns", ",")).drop("dirty_columns")
    )
    return both.withColumn("day", F.col("day").cast("string"))


@check(
    "p15_message_envelope",
    with_changelog(
        "select pos, concat('{\"Type\":\"', type, '\",\"Database\":\"', db, '\",\"Table\":\"', tbl, '\",\"Timestamp\":', "
        "epoch_us(ts) // 1000, case when type = 'DELETE' then '' else concat(',\"Data\":{\"user\":\"', user_id, '\"}') end, '}') "
        "as message from changelog"
    ),
)
def message_envelope(spark, d):
    records = notices(spark, d).withColumns(
        {
            "Timestamp": F.unix_millis(F.col("ts").cast("timestamp")),
            "Data": F.when(F.col("Type") != "DELETE", F.create_map(F.lit("user"), F.col("user_id").cast("string"))),
        }
    )
    return records.select("pos", R.message_envelope().alias("message"))


@check(
    "p16_message_key",
    with_changelog(
        "select pos, concat(db, '.', tbl) as key, case when pos % 5 = 0 then timestamp '1970-01-01 00:00:00' "
        "else epoch_ms(pos * 86400001) end as event_time from changelog"
    ),
)
def message_key(spark, d):
    records = notices(spark, d).withColumn("Timestamp", F.when(F.col("pos") % 5 != 0, F.col("pos") * 86400001))
    return records.select("pos", R.message_key().alias("key"), R.message_time().cast("timestamp_ntz").alias("event_time"))


RAW_MESSAGES = (
    "select concat('t', user_id % 2) as topic, cast(event_id % 3 as int) as partition, event_id as offset, "
    "case when event_id % 7 = 3 then concat('{\"Type\":\"', event_type) when event_id % 11 = 5 then '[1,2]' "
    "when event_id % 13 = 6 then concat('{\"Type\":\"U\",\"Timestamp\":\"then\"}') else concat('{\"Type\":\"UPDATE\",\"Database\":\"db', "
    "user_id % 3, '\",\"Table\":\"', event_type, '\",\"Timestamp\":', event_id * 1000, ',\"Data\":', props, '}') end as value from {events}"
)


@check(
    "s1_change_messages",
    "select 'UPDATE' as Type, concat('db', user_id % 3) as Database, event_type as \"Table\", event_id * 1000 as \"Timestamp\", "
    "json_extract_string(props, '$.k') as k, concat('t', user_id % 2, '/', event_id % 3) as KafkaTopic, event_id as KafkaOffset "
    "from events where event_id % 7 <> 3 and event_id % 11 <> 5 and event_id % 13 <> 6",
)
def change_messages(spark, d):
    parsed = messages.parse_messages(over(spark, d, RAW_MESSAGES, "events"))
    return parsed.select(
        "Type", "Database", "Table", "Timestamp", F.col("Data")["k"].alias("k"), "KafkaTopic", "KafkaOffset"
    )


@check(
    "s1_quarantine",
    "select event_id as \"offset\", event_id % 3 as partition from events where event_id % 7 = 3 or event_id % 11 = 5 or event_id % 13 = 6",
)
def quarantine(spark, d):
    return messages.quarantine(over(spark, d, RAW_MESSAGES, "events")).select("offset", F.col("partition").cast("bigint").alias("partition"))


LISTED = {
    "customer": [("c_custkey", "bigint"), ("c_name", "text"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "text")],
    "events": [
        ("event_id", "bigint"),
        ("ts", "datetime"),
        ("user_id", "bigint"),
        ("event_type", "text"),
        ("value", "double"),
        ("props", "text"),
    ],
}


@check(
    "s4_schema_catalog",
    " union all ".join(
        f"select 'tpch' as db, '{t}' as tbl, {i} as ordinal, '{c}' as column, '{k}' as mysql_type, count({c}) as n_values from {t}"
        for t, columns in LISTED.items()
        for i, (c, k) in enumerate(columns)
    ),
)
def schema_catalog(spark, d):
    """The catalog of two tables, with the number of values found in each listed column."""
    tables = {name: table(spark, d, name) for name in LISTED}
    catalog = databases.catalog_of(spark, {("tpch", name): df for name, df in tables.items()})
    found = [
        df.agg(*[F.count(c).alias(c) for c in df.columns]).select(F.lit(name).alias("tbl"), F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_values")) for c in df.columns])
        ))
        for name, df in tables.items()
    ]
    return catalog.join(found[0].unionByName(found[1]), ["tbl", "column"], "left")


@check(
    "s6_documents",
    "with l as (select o_custkey as _id, o_orderkey as doc_no, o_totalprice as total, o_orderdate as created, "
    "row_number() over (partition by o_custkey order by o_orderkey desc) as r from orders) "
    "select _id, doc_no, total, created, cast(floor((year(created) * 12 + month(created) - 1) / 12.0) as int) as shard from l where r = 1",
)
def documents(spark, d):
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return sinks.documents(rows, ["_id", "doc_no", "total", "created"], "_id", "doc_no", "created", 12)


@check(
    "s7_lanes",
    "with l as (select event_id, case user_id % 4 when 0 then ['a'] when 1 then ['a', 'b'] when 2 then ['c'] else ['main'] end as ls from events) "
    "select lane, count(*) as n, cast(sum(event_id) as bigint) as ids from (select event_id, unnest(ls) as lane from l) group by lane",
)
def lanes(spark, d):
    rows = over(
        spark,
        d,
        "select event_id, case user_id % 4 when 0 then array('a') when 1 then array('a', 'b') when 2 then array('c') "
        "else cast(array() as array<string>) end as lanes from {events}",
        "events",
    )
    return sinks.lane_rows(rows, default="main").groupBy("lane").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


NESTED = (
    "select event_id, named_struct('who', named_struct('id', user_id, 'kind', event_type), "
    "'tags', case when event_id % 3 = 0 then array(event_type) when event_id % 3 = 1 then array(event_type, 'x') "
    "else array(event_type, 'x', 'y') end, "
    "'attrs', case when event_id % 4 = 0 then map('k', 'v', 'a/b', cast(user_id as string)) "
    "when event_id % 4 = 1 then map('k', cast(null as string)) else cast(map() as map<string,string>) end) as v, "
    "parse_json(props) as j, map('k', cast(user_id as string), '/k', 'whole', '_.stagePath', 's1', '_.trackingId', 't') as m from {events}"
)


def nested(spark, d):
    return over(spark, d, NESTED, "events")


@check(
    "n1_get_path",
    "select event_id, user_id as who_id, case when event_id % 3 = 0 then null else 'x' end as second_tag, "
    "case when event_id % 4 = 0 then 'v' end as k, 'whole' as whole, json_extract_string(props, '$.k') as from_json from events",
)
def get_path(spark, d):
    df = nested(spark, d)
    return df.select(
        "event_id",
        paths.get_path(df, "v", "/who/id").alias("who_id"),
        paths.get_path(df, "v", "/tags[1]").alias("second_tag"),
        paths.get_path(df, "v", "/attrs/k").alias("k"),
        paths.get_path(df, "m", "/k").alias("whole"),
        paths.get_path(df, "j", "/k").alias("from_json"),
    )


@check(
    "n2_has_path",
    "select event_id, event_id % 4 < 2 as has_k, event_id % 3 = 2 as has_third, false as has_other from events",
)
def has_path(spark, d):
    df = nested(spark, d)
    return df.select(
        "event_id",
        paths.has_path(df, "v", "/attrs/k").alias("has_k"),
        paths.has_path(df, "v", "/tags[2]").alias("has_third"),
        paths.has_path(df, "v", "/who/other").alias("has_other"),
    )


@check(
    "n3_set_path",
    "select event_id, user_id as old_id, -1 as new_id, 'added' as extra, 'end' as second_tag, "
    "case when event_id % 3 = 0 then 2 when event_id % 3 = 1 then 2 else 3 end as n_tags, 'z' as k from events",
)
def set_path(spark, d):
    df = nested(spark, d)
    old = paths.get_path(df, "v", "/who/id")
    df = df.withColumn("old_id", old)
    for path, value in (
        ("/who/id", F.lit(-1)),
        ("/who/extra", F.lit("added")),
        ("/tags[1]", F.lit("end")),
        ("/attrs/k", F.lit("z")),
    ):
        df = df.withColumn("v", paths.set_path(df, "v", path, value))
    return df.select(
        "event_id",
        "old_id",
        F.col("v.who.id").alias("new_id"),
        F.col("v.who.extra").alias("extra"),
        F.col("v.tags")[1].alias("second_tag"),
        F.size("v.tags").alias("n_tags"),
        F.col("v.attrs")["k"].alias("k"),
    )


@check(
    "n4_delete_path",
    "select event_id, event_type as kind, cast(event_id % 3 as int) as n_tags, case when event_id % 4 = 0 then 1 else 0 end as n_attrs, "
    "false as has_id from events",
)
def delete_path(spark, d):
    df = nested(spark, d)
    for path in ("/who/id", "/tags[0]", "/attrs/k", "/nowhere/at/all"):
        df = df.withColumn("v", paths.delete_path(df, "v", path))
    return df.select(
        "event_id",
        F.col("v.who.kind").alias("kind"),
        F.size("v.tags").alias("n_tags"),
        F.size("v.attrs").alias("n_attrs"),
        paths.has_path(df, "v", "/who/id").alias("has_id"),
    )


@check(
    "n5_list_paths",
    "select event_id, concat('|/who|/who/id|/who/kind|/tags|/tags[0]', case when event_id % 3 > 0 then '|/tags[1]' else '' end, "
    "case when event_id % 3 > 1 then '|/tags[2]' else '' end, '|/attrs', case event_id % 4 when 0 then '|/attrs/k|/attrs/a//b' "
    "when 1 then '|/attrs/k' else '' end) as paths from events",
)
def list_paths(spark, d):
    df = nested(spark, d)
    return df.select("event_id", F.array_join(paths.list_paths(df, "v"), "|").alias("paths"))


@check(
    "n7_header_attributes",
    "select event_id, '/k,k' as names, 3 as n_after_delete, cast(user_id as varchar) as k, concat('seen', event_id) as mark from events",
)
def header_attributes(spark, d):
    df = nested(spark, d)
    return df.select(
        "event_id",
        F.array_join(F.sort_array(R.attribute_names("m")), ",").alias("names"),
        F.size(R.delete_attribute("m", "k")).alias("n_after_delete"),
        R.get_attribute("m", "k").alias("k"),
        R.set_attribute("m", "mark", F.concat(F.lit("seen"), F.col("event_id").cast("string")))["mark"].alias("mark"),
    )


@check(
    "n8_lineage",
    "select event_id, case when event_id % 2 = 0 then 'filter' else concat(event_type, ':filter') end as stage_path, "
    "concat('src', user_id, '::', case when event_id % 2 = 0 then 'filter' else concat(event_type, ':filter') end) as tracking_id, "
    "concat('id', event_id) as previous_tracking_id from events",
)
def lineage(spark, d):
    rows = over(
        spark,
        d,
        "select event_id, concat('src', user_id) as source_id, case when event_id % 2 = 1 then event_type end as stage_path, "
        "concat('id', event_id) as tracking_id from {events}",
        "events",
    )
    return rows.select("event_id", *[c.alias(n) for n, c in R.lineage("filter", "source_id", "stage_path", "tracking_id").items()])
