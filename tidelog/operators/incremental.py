"""High-water-mark extraction: half-open windows per database and the rows changed in them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidelog.functions.patterns import ignored_databases, names_in
from tidelog.functions.templates import render_query
from tidelog.operators.coalesce import DATABASE_GAP_MS, coalesce_by_database
from tidelog.operators.records import flag_dirty, tag_tenant, type_result_set
from tidelog.session import settle, small_side

DEEP = 16  # windows over each other, on average, from which the rows of the source are moved
PROGRESS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def drop_ignored_databases(df: DataFrame, patterns: str | None, database: str = "Database") -> DataFrame:
    """Without the databases of an ignore list: any item drops its whole database, whatever table it names."""
    return df.filter(~names_in(database, ignored_databases(patterns)))


def initial_watermark(
    notices: DataFrame, progress: DataFrame, notice_ts: str = "ts", database: str = "Database"
) -> DataFrame:
    """Notices with ``ts_start``: the stored progress of their database if it parses, else their own time.

    ``progress`` is ``(database, job_time string)``, one row per database.
    """
    stored = progress.select(
        F.col(progress.columns[0]).alias(database),
        F.try_to_timestamp("job_time", F.lit(PROGRESS_FORMAT)).alias("_stored"),
    )
    return (
        notices.join(stored, database, "left")
        .withColumn("ts_start", F.coalesce("_stored", F.col(notice_ts).cast("timestamp")))
        .drop("_stored")
    )


def advance_windows(
    releases: DataFrame,
    run_ts: str = "run_ts",
    lag_ms: int = 0,
    keys: Sequence[str] = ("Database",),
) -> DataFrame:
    """Contiguous half-open windows: each run of a key covers ``[end of the run before, run_ts - lag)``.

    The first run starts at its ``ts_start``. An end never lies before its start, so
    a large lag gives empty windows instead of reading rows twice. Runs of one key
    are at least a merge interval apart, which keeps the window per key small.
    """
    runs = W.partitionBy(*keys).orderBy(run_ts)
    upto = runs.rowsBetween(W.unboundedPreceding, 0)
    end = F.col(run_ts).cast("timestamp") - F.expr(f"INTERVAL '{lag_ms / 1000:.3f}' SECOND")
    return (
        releases.withColumn("_first", F.first("ts_start").over(upto))
        .withColumn("ts_end", F.greatest("_first", F.max(end).over(upto)))
        .withColumn("ts_start", F.coalesce(F.lag("ts_end").over(runs), F.col("_first")))
        .drop("_first")
    )


def query_catalog(
    notices: DataFrame,
    queries: dict[str, str],
    notice_ts: str = "ts",
    run_ts: str = "run_ts",
    database: str = "Database",
) -> DataFrame:
    """Several named queries per database, each with windows of its own, beginning a second before the first notice."""
    tasks = F.array(*[F.struct(F.lit(t).alias("task_id"), F.lit(q).alias("template")) for t, q in queries.items()])
    jobs = notices.withColumn("_task", F.explode(tasks)).withColumns(
        {
            "task_id": F.col("_task.task_id"),
            "template": F.col("_task.template"),
            "ts_start": F.col(notice_ts).cast("timestamp") - F.expr("INTERVAL '1' SECOND"),
        }
    )
    return advance_windows(jobs.drop("_task"), run_ts, 0, [database, "task_id"])


def delta_join(
    windows: DataFrame,
    source: DataFrame,
    ts: str,
    database: str = "Database",
    unit: str = "DAY",
    until: Column | None = None,
    pick: Sequence[Column | str] = (),
) -> DataFrame:
    """Source rows changed inside the windows of their database, with the window's bounds.

    The windows are written down first. Their outer bounds go into the scan of the
    source as plain values, which skips files and partitions outside; if the windows
    are small they are broadcast and the source is not moved, unless so many lie over each other (DEEP) that its rows are little beside the result. They are spread over
    calendar units and joined on (database, unit), so that otherwise a database that
    owns most rows is split by time, and no row meets windows of other units. Equal
    windows are joined as one, and their rows are repeated afterwards. ``pick`` says what to take of a row and its window
    (default: all columns of the source, and the bounds); it is computed before rows are repeated. A
    window without end reads up to ``until`` (default: now).
    """
    step = {"HOUR": "1 HOUR", "DAY": "1 DAY", "MONTH": "1 MONTH"}[unit]
    end = F.coalesce(F.col("ts_end"), until if until is not None else F.current_timestamp())
    wanted = windows.select(database, "ts_start", end.alias("ts_end")).filter(F.col("ts_start") < F.col("ts_end"))
    bounds = settle(wanted.groupBy(database, "ts_start", "ts_end").agg(F.count("*").cast("int").alias("_times")))
    start, stop = F.unix_micros("ts_start"), F.unix_micros("ts_end")
    covered = F.sum((stop - start) * F.col("_times").cast("double"))
    *outer, most, covered = bounds.agg(F.min(start), F.max(stop), F.max("_times"), covered).first()
    kind = source.schema[ts].dataType
    lo, hi = (F.timestamp_micros(F.lit(v).cast("bigint")).cast(kind) for v in outer)
    spread = bounds.withColumn(
        "_unit",
        F.explode(F.sequence(F.date_trunc(unit, "ts_start"), F.date_trunc(unit, "ts_end"), F.expr(f"INTERVAL {step}"))),
    )
    rows = (
        # a coarse bound: as dates both ends lose their time, so the last day belongs to it
        source.filter((F.col(ts) >= lo) & (F.col(ts) <= hi))
        .withColumn("_unit", F.date_trunc(unit, F.col(ts).cast("timestamp")))
    )
    if covered and covered > DEEP * (outer[1] - outer[0]):
        # what comes out is many times the source, so its rows are dealt evenly, however its files are cut
        rows = rows.repartition(int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.alias("r")
    w, at = small_side(spread).alias("w"), F.col(f"r.{ts}").cast("timestamp")
    inside = (
        (F.col(f"r.{database}") == F.col(f"w.{database}"))
        & (F.col("r._unit") == F.col("w._unit"))
        & (at >= F.col("w.ts_start"))
        & (at < F.col("w.ts_end"))
    )
    columns = [*(F.col(f"r.`{c}`") for c in source.columns), "w.ts_start", "w.ts_end"]
    joined = rows.join(w, inside).select(*columns, "w._times")
    found = joined.select(*pick, "_times") if pick else joined
    if (most or 1) == 1:
        return found.drop("_times")
    return found.withColumn("_time", F.explode(F.array_repeat(F.lit(True), F.col("_times")))).drop("_time", "_times")


def backfill(source: DataFrame, ts_start: str, ts: str, until: Column | None = None) -> DataFrame:
    """All source rows from a start time on; the window has no end of its own."""
    at = F.col(ts).cast("timestamp")
    end = until if until is not None else F.current_timestamp()
    return source.filter((at >= F.lit(ts_start).cast("timestamp")) & (at < end))


def extraction_windows(
    notices: DataFrame,
    progress: DataFrame,
    ignore: str | None = None,
    interval_ms: int = DATABASE_GAP_MS,
    lag_ms: int = 0,
    ts: str = "ts",
    order: str = "pos",
) -> DataFrame:
    """Coalesced, filtered notices with the window each release reads."""
    merged = coalesce_by_database(drop_ignored_databases(notices, ignore), ts, interval_ms, order)
    releases = merged.withColumns(
        {
            ts: F.timestamp_micros("window_start"),
            "run_ts": F.timestamp_micros(F.col("window_start") + F.lit(interval_ms * 1000)),
        }
    )
    return advance_windows(initial_watermark(releases, progress, ts), "run_ts", lag_ms)


def incremental_extract(
    notices: DataFrame,
    progress: DataFrame,
    source: DataFrame,
    source_ts: str,
    ignore: str | None = None,
    interval_ms: int = DATABASE_GAP_MS,
    lag_ms: int = 0,
    ts: str = "ts",
    order: str = "pos",
    unit: str = "DAY",
) -> DataFrame:
    """Typed source rows of all released windows, the database appended as ``dbName``.

    ``source`` is one table over all databases with a ``Database`` column.
    """
    windows = extraction_windows(notices, progress, ignore, interval_ms, lag_ms, ts, order)
    rows = delta_join(windows, source, source_ts, unit=unit)
    typed = type_result_set(rows.select(*source.columns))
    return tag_tenant(typed, F.col("Database")).drop("Database")


@dataclass
class Extracted:
    """One pass over the source: every row typed, or as it came with the names of the columns that did not fit.

    ``rows`` holds both, told apart by ``dirty_columns`` (empty: clean). ``counts`` knows how many there were of
    each once ``rows`` were written.
    """

    rows: DataFrame
    casts: dict[str, str]
    counts: Observation

    def clean(self, written: DataFrame) -> DataFrame:
        """The typed rows of ``written``, which are ``rows`` as read back from where they were written."""
        return written.filter(F.size("dirty_columns") == 0).drop("dirty_columns", "raw")

    def dirty(self, written: DataFrame) -> DataFrame:
        """The others, the cast columns as text as they came."""
        others = [F.col(f"raw.{c}").alias(c) if c in self.casts else F.col(c) for c in written.columns if c not in ("dirty_columns", "raw")]
        return written.filter(F.size("dirty_columns") > 0).select(*others, "dirty_columns")

    def check(self, error_limit: int = 0) -> dict[str, int]:
        """Numbers of clean and dirty rows; fails if more are dirty than the limit allows. After ``rows`` were written."""
        found = self.counts.get
        if found["dirty"] > error_limit:
            raise ValueError(f"{found['dirty']} dirty rows, {error_limit} allowed")
        return found


def extract_checked(rows: DataFrame, casts: dict[str, str], database: str = "Database") -> Extracted:
    """Extracted rows typed, tagged and cast, with those that do not fit told apart, in one pass.

    Nothing is computed twice and nothing is counted by a job of its own: the numbers are observed while the rows are written.
    """
    typed = tag_tenant(type_result_set(rows), F.col(database)).drop(database)
    flagged = flag_dirty(typed, casts)
    raw = F.when(F.size("dirty_columns") > 0, F.struct(*[F.col(f"_raw.{c}").cast("string").alias(c) for c in casts]))
    made = flagged.withColumn("raw", raw).drop("_raw")
    counts = Observation(f"extracted-{uuid.uuid4().hex}")
    bad = F.size("dirty_columns") > 0
    return Extracted(made.observe(counts, F.count_if(~bad).alias("clean"), F.count_if(bad).alias("dirty")), casts, counts)


def incremental_extract_checked(
    notices: DataFrame,
    progress: DataFrame,
    source: DataFrame,
    source_ts: str,
    casts: dict[str, str],
    path: str,
    error_limit: int = 0,
    ignore: str | None = None,
    interval_ms: int = DATABASE_GAP_MS,
    lag_ms: int = 0,
    ts: str = "ts",
    order: str = "pos",
    unit: str = "DAY",
) -> tuple[DataFrame, DataFrame]:
    """(clean, dirty) rows of all released windows: ``incremental_extract`` whose rows are also cast to their target types.

    The source is read once. Its rows are written to the new folder ``path``, clean and dirty ones in folders of their own,
    and the batch fails, leaving nothing at ``path``, if more than ``error_limit`` are dirty.
    """
    spark, staged = source.sparkSession, f"{path}.staged"
    where, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(target):
        raise ValueError(f"{path} is there already")
    windows = extraction_windows(notices, progress, ignore, interval_ms, lag_ms, ts, order)
    rows = delta_join(windows, source, source_ts, unit=unit).select(*source.columns)
    made = extract_checked(rows, casts)
    split = made.rows.withColumn("fits", F.size("dirty_columns") == 0)
    split.write.mode("overwrite").partitionBy("fits").parquet(staged)
    try:
        made.check(error_limit)
    except ValueError:
        files.delete(where, True)
        raise
    files.rename(where, target)
    written = spark.read.schema(split.schema).parquet(path)
    fits = F.col("fits")
    return made.clean(written.filter(fits).drop("fits")), made.dirty(written.filter(~fits).drop("fits"))


def extraction_queries(windows: DataFrame, template: str) -> DataFrame:
    """SQL text per window, for databases that are queried over JDBC."""
    return windows.withColumn("sql", render_query(template, "Database", "ts_start", "ts_end"))


def latest_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Last change per key. The rank filter is applied before the shuffle too, so a busy key sends one row per task."""
    newest = W.partitionBy(*keys).orderBy(*order)
    return changes.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def merge_incremental(
    snapshot: DataFrame, delta: DataFrame, keys: Sequence[str], order: str, type: str = "Type"
) -> DataFrame:
    """Snapshot (one row per key) with the last change per key applied: upserts replace or add rows, deletes remove them.

    At equal ``order`` a delta row wins over the snapshot. Only the delta is ranked; its keys meet the
    snapshot, which stays where it is while they are few (``small_side``).
    """
    last = settle(latest_per_key(delta, keys, [F.col(order).desc()]))
    changed = small_side(last.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(order).alias("_order")))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    newer = F.col(order) > F.col("_order")
    both = snapshot.join(changed, same, "left")
    kept = both.filter(F.col("_order").isNull() | newer).select(*snapshot.columns)
    # changes older than what the snapshot holds
    late = settle(snapshot.join(changed, same).filter(newer).select(*[F.col(k).alias(f"_{k}") for k in keys]))
    winners = last.join(small_side(late), same, "left_anti").filter(F.col(type) != "DELETE")
    return kept.unionByName(winners.drop(type))


def shard(date: Column | str, months_per_shard: int = 12) -> Column:
    """Number of the span of months a date falls into."""
    d = F.col(date) if isinstance(date, str) else date
    return F.floor((F.year(d) * 12 + F.month(d) - 1) / months_per_shard).cast("int")
