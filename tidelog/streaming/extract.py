"""High-water-mark extraction driven by a stream of notices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.coalesce import DATABASE_GAP_MS
from tidelog.operators.incremental import advance_windows, delta_join, drop_ignored_databases, initial_watermark
from tidelog.operators.records import tag_tenant, type_result_set
from tidelog.session import settle
from tidelog.streaming.batches import keep_state, state_before
from tidelog.streaming.coalesce import coalesce_changes_stream


def pending_notices(
    notices: DataFrame,
    ignore: str | None = None,
    interval_ms: int = DATABASE_GAP_MS,
    watermark: str = "10 seconds",
    ts: str = "ts",
    order: str = "pos",
) -> DataFrame:
    """Stream of (Database, ts, run_ts): one notice per database and interval, with the time it is released at."""
    kept = drop_ignored_databases(notices, ignore)
    merged = coalesce_changes_stream(kept, ["Database"], ts, interval_ms, watermark, order)
    return merged.select(
        "Database",
        F.timestamp_micros("window_start").alias("ts"),
        F.timestamp_micros(F.col("window_start") + F.lit(interval_ms * 1000)).alias("run_ts"),
    )


class ExtractBatches:
    """Windows per database continued from micro-batch to micro-batch.

    The end of each database's last window is kept in the shared folder, one small
    table per batch id (the last two of them), so a repeated batch reads the same windows again. A database
    that is new starts at its stored progress, else at its first notice.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        source: Callable[[], DataFrame],
        source_ts: str,
        progress: DataFrame,
        lag_ms: int = 0,
        unit: str = "DAY",
    ):
        self.spark, self.path, self.source, self.source_ts = spark, path, source, source_ts
        self.progress, self.lag_ms, self.unit = progress, lag_ms, unit

    def windows(self, releases: DataFrame, batch_id: int) -> DataFrame:
        before = state_before(self.spark, f"{self.path}/ends", batch_id)
        started = initial_watermark(releases, self.progress)
        if before is not None:
            ended = before.select("Database", F.col("ts_end").alias("_ended"))
            started = started.join(ended, "Database", "left").withColumn("ts_start", F.coalesce("_ended", "ts_start")).drop("_ended")
        windows = settle(advance_windows(started, "run_ts", self.lag_ms))
        ends = windows.select("Database", "ts_end")
        if before is not None:
            ends = ends.unionByName(before)
        keep_state(ends.groupBy("Database").agg(F.max("ts_end").alias("ts_end")), f"{self.path}/ends", batch_id)
        return windows

    def writer(self, then: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
        """Function for ``foreachBatch``: the typed, tagged rows of a micro-batch's windows go to ``then``."""

        def write(releases: DataFrame, batch_id: int) -> None:
            source = self.source()
            rows = delta_join(self.windows(releases, batch_id), source, self.source_ts, unit=self.unit)
            typed = type_result_set(rows.select(*source.columns))
            then(tag_tenant(typed, F.col("Database")).drop("Database"), batch_id)

        return write
