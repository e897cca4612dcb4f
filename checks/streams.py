"""Streaming operators run over the events file until it is used up."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.changes import ANCHORED_TABLES, HOUR_MS, PUBLISH_SQL, ROUTES, TOPIC_SQL
from checks.extraction import EXTRACT_SQL, SETTINGS, order_notices, progress
from checks.logs import PUBLISH_LOG_SQL, half_catalog, image_log, numbered_sql
from checks.registry import changelog, check, notices, raw_log, table, with_changelog, with_raw_log
from tidelog.functions import offsets as O
from tidelog.operators.routing import route_topic
from tidelog.plans import flows
from tidelog.session import shared_dir
from tidelog.sources import sinks
from tidelog.streaming import batches as B
from tidelog.streaming import coalesce as C
from tidelog.streaming import extract as E


FILE_ROWS = 250_000  # of a staged log


def _folder(spark, name: str) -> str:
    return shared_dir(spark, "checks", f"{name}-{uuid.uuid4().hex}")


def _staged(spark, df, name: str, parts: int, order: str = "pos") -> str:
    """The rows as a folder of ``parts`` parts in log order, to be streamed part by part.

    Every part has the same number of files, so that a micro-batch of so many is one part, and no task writes more than a file of it.
    """
    path = f"{_folder(spark, name)}/input"
    last, rows = df.agg(F.max(order), F.count("*")).first()
    part = F.floor(F.col(order) * F.lit(parts) / (last + 1))
    files = _files_of_part(rows, parts)
    for n in range(parts):  # one after the other: a file stream reads in the order of writing
        own = df.filter(part == n)
        (own.repartition(files, order) if files > 1 else own.coalesce(1)).write.parquet(f"{path}/part={n}")
    return path


def _files_of_part(rows: int, parts: int) -> int:
    """So many that files have about FILE_ROWS rows, and that by far each is sure to get some."""
    return max(1, rows // parts // FILE_ROWS)


def _files_at_once(path: str, spark) -> int:
    """Files of the first part: those of one micro-batch."""
    return len(spark.read.parquet(f"{path}/part=0").inputFiles())


def _far_ahead(log, path: str, **names) -> None:
    """One more row a year later, so that all windows before it end."""
    ahead = log.agg((F.max("ts") + F.expr("INTERVAL '365' DAY")).alias("ts"), (F.max("pos") + 1).alias("pos"))
    ahead.select(*[F.lit(v).alias(c) for c, v in names.items()], "ts", "pos").write.parquet(f"{path}/part=9")


def _stream(spark, path: str, schema: T.StructType, one_by_one: bool = True):
    reader = C.use_rocksdb(spark).readStream.schema(schema)
    if one_by_one:
        reader = reader.option("maxFilesPerTrigger", _files_at_once(path, spark))
    return reader.parquet(path)


def _drain(stream, path: str, mode: str = "append"):
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{path}/output")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/output")


@check(
    "c2_coalesce_changes_stream",
    f"{ANCHORED_TABLES} select m.db, m.tbl, m.first_pos, m.n_merged, m.a as first_ts, m.last_at as last_ts from merged m",
)
def coalesce_changes_stream(spark, d):
    """Streamed in four parts; a row a year ahead, left out of the result, lets the last windows pass."""
    log = changelog(spark, d).select("db", "tbl", "ts", "pos")
    path = _staged(spark, log, "coalesce", 4)
    _far_ahead(log, path, db="", tbl="")
    stream = _stream(spark, path, log.schema)
    merged = C.coalesce_changes_stream(stream, ["db", "tbl"], "ts", HOUR_MS, "1 day", block_gaps=24)
    return (
        _drain(merged, _folder(spark, "coalesced"))
        .filter("tbl <> ''")
        .select(
            "db",
            "tbl",
            F.col("pos").alias("first_pos"),
            "n_merged",
            F.timestamp_micros("window_start").cast("timestamp_ntz").alias("first_ts"),
            F.timestamp_micros("window_last").cast("timestamp_ntz").alias("last_ts"),
        )
    )


@check("publish_notices_stream", PUBLISH_SQL)
def publish_notices_stream(spark, d):
    """The flagship on a stream: filter, route, merge, envelope."""
    log = notices(spark, d).select("Type", "Database", "Table", "ts", "pos")
    path = _staged(spark, log, "publish", 3)
    _far_ahead(log, path, Type="", Database="shop", Table="end of log")
    changes = _stream(spark, path, log.schema)
    published = flows.publish_stream(changes, ROUTES, "%.%", "sys_info.%,%.error", HOUR_MS, "1 day", block_gaps=24)
    return _drain(published, _folder(spark, "published"))


@check("publish_from_log_stream", PUBLISH_LOG_SQL)
def publish_from_log_stream(spark, d):
    """Raw log events to messages in one streaming query, cut in the middle of transactions; one notice per row of the first event."""
    log = image_log(spark, d)
    path = _staged(spark, log, "raw", 3)
    _far_ahead(log, path, server_id=0, event_type="GTID")
    published = flows.publish_stream_from_log(
        _stream(spark, path, log.schema),
        half_catalog(spark, d),
        F.lit(2),
        [("first", "db1.%"), ("rest", "%.%")],
        ignore="shop.%",
        gap_ms=7_200_000,
        watermark="1 day",
        block_gaps=12,
    )
    return _drain(published, _folder(spark, "published-log"))


@check("incremental_extract_stream", EXTRACT_SQL)
def incremental_extract_stream(spark, d):
    """Notices streamed in three parts; windows go on from micro-batch to micro-batch."""
    log = order_notices(spark, d).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    path, out = _staged(spark, log, "extract", 3), _folder(spark, "extracted")
    _far_ahead(log, path, Database="none")
    source = table(spark, d, "orders").selectExpr("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus as Database")
    pending = E.pending_notices(_stream(spark, path, log.schema), "sys_info.%", SETTINGS["interval_ms"], "30 days")
    extract = E.ExtractBatches(spark, f"{out}/state", lambda: source, "o_orderdate", progress(spark), SETTINGS["lag_ms"])
    query = (
        pending.writeStream.foreachBatch(
            extract.writer(lambda rows, n: rows.write.mode("overwrite").parquet(f"{out}/rows/batch={n}"))
        )
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/rows").drop("batch")


@check("c6_dedup_changes_stream", with_changelog("select distinct db, tbl from changelog"))
def dedup_changes_stream(spark, d):
    """With a delay longer than the log, one change per table passes."""
    log = notices(spark, d).select("Database", "Table", "ts", "pos")
    stream = _stream(spark, _staged(spark, log, "dedup", 4), log.schema)
    first = C.dedup_changes_stream(stream, watermark="3650 days")
    return _drain(first, _folder(spark, "deduped")).select(F.col("Database").alias("db"), F.col("Table").alias("tbl"))


@check(
    "s5_write_messages",
    with_changelog(
        f"select topic, concat(db, '.', tbl) as key, concat('{{\"Type\":\"', type, '\",\"Database\":\"', db, '\",\"Table\":\"', tbl, "
        f"'\",\"Timestamp\":', pos, '}}') as value from (select *, {TOPIC_SQL} as topic from changelog) where topic is not null"
    ),
)
def write_messages(spark, d):
    """Streamed to one folder per topic."""
    log = notices(spark, d).select("Type", "Database", "Table", F.col("pos").alias("Timestamp"))
    path = _staged(spark, log, "messages", 4, "Timestamp")
    routed = _stream(spark, path, log.schema, one_by_one=False).withColumn("topic", route_topic(ROUTES))
    out = _folder(spark, "topics")
    query = sinks.write_messages(sinks.messages(routed), f"{out}/checkpoint", "json", {"path": f"{out}/output"})
    query.awaitTermination()
    return spark.read.schema("key string, value string, topic string").json(f"{out}/output")


@check(
    "o7_progress_table",
    with_raw_log("select server_id, max(pos) as pos, concat('bin.000001:', max(pos)) as saved from raw_log group by server_id"),
)
def progress_table(spark, d):
    """Offsets saved after each micro-batch, filtered events included."""
    log = raw_log(spark, d).withColumn("offset", O.format_position(F.lit("bin.000001"), "pos"))
    stream = _stream(spark, _staged(spark, log, "progress", 3), log.schema)
    out = _folder(spark, "saved")
    progress = B.ProgressTable(spark, f"{out}/table")
    query = (
        stream.writeStream.foreachBatch(lambda batch, n: progress.save(batch, n))
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return progress.load().withColumnRenamed("offset", "saved")


@check(
    "log_batches_stream",
    numbered_sql("select pos, g as gtid, cast(seq_no as bigint) as seq_no, db, tbl from resolved"),
)
def log_batches(spark, d):
    """Transactions and table maps carried from micro-batch to micro-batch, cut in the middle of transactions."""
    log = raw_log(spark, d)
    stream = _stream(spark, _staged(spark, log, "log", 3), log.schema)
    out = _folder(spark, "numbered")
    carried = B.LogBatches(spark, f"{out}/state", block_bits=12)

    def then(rows, n: int) -> None:
        rows.select("pos", "gtid", "seq_no", "db", "tbl").write.mode("overwrite").parquet(f"{out}/rows/batch={n}")

    query = (
        stream.writeStream.foreachBatch(carried.writer(then))
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("pos", "gtid", "seq_no", "db", "tbl")


@check(
    "s6_document_runs",
    "with p as (select o_custkey as _id, o_orderkey as doc_no, o_totalprice as total, o_orderdate as created, "
    "floor(o_orderkey * 4 / ((max(o_orderkey) over () + 1) * 1.0)) as part from orders), "
    "b as (select *, row_number() over (partition by _id, part order by doc_no desc) as r, "
    "cast(floor((year(created) * 12 + month(created) - 1) / 12.0) as int) as shard from p), "
    "l as (select _id, doc_no, total, created, shard, row_number() over (partition by _id, shard order by doc_no desc) as newest from b where r = 1) "
    "select _id, doc_no, total, created, shard from l where newest = 1",
)
def document_runs(spark, d):
    """Orders in four micro-batches, each the last document per customer, upserted within their shards."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    stream = _stream(spark, _staged(spark, rows, "orders", 4, "o_orderkey"), rows.schema).select(*rows.columns)
    out = _folder(spark, "document-runs")
    write = sinks.write_document_runs(f"{out}/output", ["_id", "doc_no", "total", "created"], "_id", "doc_no", "created", 12)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return sinks.read_documents(spark, f"{out}/output", "_id", "doc_no")
