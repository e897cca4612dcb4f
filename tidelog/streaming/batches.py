"""Bounded micro-batches, progress that users can read, and log order carried over micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import patterns as P
from tidelog.operators.ordering import SERVER, high_water_offset, resolve_table_map, tx_sequence
from tidelog.operators.scan import BLOCK_BITS

BATCH_RECORDS = 1000
BATCH_WAIT_MS = 1000

# Options that bound a micro-batch, per kind of source.
BOUND_OPTIONS = {
    "kafka": "maxOffsetsPerTrigger",
    "parquet": "maxFilesPerTrigger",
    "json": "maxFilesPerTrigger",
    "text": "maxFilesPerTrigger",
    "csv": "maxFilesPerTrigger",
    "orc": "maxFilesPerTrigger",
}


def batch_bounds(
    fmt: str, limit: int = BATCH_RECORDS, asked: int | None = None, wait_ms: int = BATCH_WAIT_MS
) -> tuple[dict[str, str], dict[str, str]]:
    """(reader options, trigger) of micro-batches with the lower of two limits and a wait in between."""
    bound = limit if asked is None else min(limit, asked)
    return {BOUND_OPTIONS[fmt]: str(bound)}, {"processingTime": f"{wait_ms} milliseconds"}


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def kept_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose table below ``path`` was written to its end."""
    where, files = _files(spark, path)
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where) if s.isDirectory()]
    return sorted(int(n) for n in names if n.isdigit() and files.exists(_files(spark, f"{path}/{n}/_SUCCESS")[0]))


def remove_folders(spark: SparkSession, path: str, unused: Callable[[str], bool]) -> None:
    """Removes the folders directly below ``path`` whose names are ``unused``."""
    where, files = _files(spark, path)
    for status in files.listStatus(where):
        if status.isDirectory() and unused(status.getPath().getName()):
            files.delete(status.getPath(), True)


def keep_state(df: DataFrame, path: str, batch_id: int) -> None:
    """Writes what a batch leaves, whole, and removes all but it and what the batch before it left.

    Only the last batch of a stream is ever repeated, so a restart at any point finds what it needs, and
    the number of files does not grow with the number of batches.
    """
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/{batch_id}")
    older = [n for n in kept_batches(spark, path) if n < batch_id]
    for n in older[:-1]:
        where, files = _files(spark, f"{path}/{n}")
        files.delete(where, True)


def state_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """What batch ``batch_id - 1`` left; only the first batch of a stream may start from nothing."""
    if batch_id == 0:
        return None
    before = _read(spark, f"{path}/{batch_id - 1}")
    if before is None:
        raise ValueError(f"state of batch {batch_id - 1} is missing in {path}")
    return before


class ProgressTable:
    """High-water offset per key after the last batch that had rows.

    A batch adds its own to what the batches before it left and writes both as one table, so that ``load`` reads one
    folder however many batches there were. Repeating a batch overwrites its own folder, so a restart writes nothing twice.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = SERVER):
        self.spark, self.path, self.keys = spark, path, list(keys)

    def save(self, events: DataFrame, batch_id: int, offset: str = "offset", order: str = "pos") -> None:
        # a row per key, kept so that the batch behind them is read once
        rows = high_water_offset(events, offset, order, self.keys).persist()
        if not rows.isEmpty():
            before = [n for n in kept_batches(self.spark, self.path) if n < batch_id]
            both = rows.withColumn("_new", F.lit(1))
            if before:
                known = self.spark.read.parquet(f"{self.path}/{before[-1]}")
                both = both.unionByName(known.withColumn("_new", F.lit(0)))
            newest = both.groupBy(*self.keys).agg(
                F.max(order).alias(order), F.max_by("offset", F.struct(order, "_new")).alias("offset")
            )
            keep_state(newest.coalesce(1), self.path, batch_id)
        rows.unpersist()

    def load(self) -> DataFrame | None:
        """Last offset per key; None where nothing was saved yet."""
        saved = kept_batches(self.spark, self.path)
        return self.spark.read.parquet(f"{self.path}/{saved[-1]}") if saved else None


class LogBatches:
    """Transactions and table maps over the micro-batches of one log.

    Row numbers over a whole stream do not exist, so each micro-batch is numbered by
    the batch operators, continuing from what the batch before left open: per server
    its transaction and sequence number, per table id its last map. That state is a
    small table per batch id in the shared folder, of which the last two are kept; a repeated batch
    reads and writes the same ones.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str] = SERVER,
        order: str = "pos",
        block_bits: int = BLOCK_BITS,
    ):
        self.spark, self.path, self.keys, self.order, self.bits = spark, path, list(keys), order, block_bits

    def _keep(self, df: DataFrame, name: str, batch_id: int) -> None:
        keep_state(df, f"{self.path}/{name}", batch_id)

    def numbered(self, events: DataFrame, batch_id: int) -> DataFrame:
        """Numbered events, persisted because state and result both read them; unpersist when done."""
        before = state_before(self.spark, f"{self.path}/open", batch_id)
        numbered = tx_sequence(events, self.order, self.keys, self.bits, before).persist()
        tail = (
            numbered.withColumn("_seq", F.coalesce("seq_no", F.lit(0).cast("bigint")))
            .groupBy(*self.keys)
            .agg(
                F.max_by(F.struct("gtid", F.col("tx_start").alias("start")), self.order).alias("tx"),
                F.max_by("gtid", self.order).alias("_gtid"),
                F.max(F.struct(F.col("tx_start"), F.col("_seq"))).alias("_last"),
            )
            .select(*self.keys, F.when(F.col("_gtid").isNotNull(), F.col("tx")).alias("tx"), F.col("_last._seq").alias("seq_no"))
        )
        if before is not None:
            quiet = before.join(tail.select(*self.keys), self.keys, "left_anti")
            tail = tail.unionByName(quiet.select(*tail.columns))
        self._keep(tail, "open", batch_id)
        return numbered

    def resolved(self, events: DataFrame, batch_id: int) -> DataFrame:
        """Row events with their tables; ``events`` as given to or returned by ``numbered``."""
        columns = [*self.keys, self.order, "event_type", "table_id", "db", "tbl"]
        maps = events.filter(F.col("event_type") == "TABLE_MAP").select(*columns)
        before = state_before(self.spark, f"{self.path}/maps", batch_id)
        if before is not None:
            maps = maps.unionByName(before.select(*columns))
        last = maps.groupBy(*self.keys, "table_id", "event_type").agg(
            F.max_by(F.struct("db", "tbl"), self.order).alias("_t"), F.max(self.order).alias(self.order)
        ).select(*self.keys, self.order, "event_type", "table_id", "_t.db", "_t.tbl")
        self._keep(last, "maps", batch_id)
        if before is not None:
            events = events.unionByName(before.select(*columns), allowMissingColumns=True)
        return resolve_table_map(events, self.order, self.keys, self.bits)

    def writer(self, then: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """Function for ``foreachBatch``: numbered, resolved row events of each micro-batch go to ``then``."""

        def write(batch: DataFrame, batch_id: int) -> None:
            numbered = self.numbered(batch.filter(P.keep_row_events()), batch_id)
            then(self.resolved(numbered, batch_id), batch_id)
            numbered.unpersist()

        return write
