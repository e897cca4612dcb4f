"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20

CHECKPOINT_CONF = "spark.checkpoint.dir"

CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Rows after which a Parquet writer looks at what it holds, at least and at most.
PAGE_CONFS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "16"}

_LOCAL: dict[str, str] = {}  # by application, the folder of a local session without the setting


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps in logs, progress tables and SQL templates are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def tune(spark: SparkSession, shuffled_bytes: int, partition_bytes: int = 128 << 20) -> SparkSession:
    """Settings for a job that shuffles about ``shuffled_bytes``.

    Partitions are sized to fit a task's memory whatever the cluster's size; small ones
    are joined and skewed joins split while running.
    """
    partitions = max(spark.sparkContext.defaultParallelism, -(-shuffled_bytes // partition_bytes))
    for name, value in {
        "spark.sql.shuffle.partitions": partitions,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": partition_bytes,
        "spark.sql.files.maxPartitionBytes": partition_bytes,
    }.items():
        spark.conf.set(name, str(value))
    return use_utc(spark)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path below the folder all executors share, as named by spark.checkpoint.dir.

    Only a local session may go without the setting; it gets a temporary folder
    once, which every later call of the same application sees. The session's settings stay as they are.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        root = _LOCAL.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="tidelog-")
        _LOCAL[spark.sparkContext.applicationId] = root
    return os.path.join(root, *parts) if parts else root


def settle(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder and read from there: later uses neither compute nor wait for them."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def bound_pages(spark: SparkSession) -> None:
    """Pages and row groups of Parquet keep their size however long rows are, unless the session says how often to look.

    A writer looks after a hundred rows first and ten thousand later on; a page of so many long rows is compressed as a whole.
    """
    for name, rows in PAGE_CONFS.items():
        if not spark.conf.get(name, None):
            spark.conf.set(name, rows)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written down inside leaves no shuffle files behind; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP_CONF) if before is None else spark.conf.set(CLEANUP_CONF, before)


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Marked for broadcast if its rows, measured as text, stay below the bound; else left to a shuffle join.

    The optimizer does not know the size of what came from a list, a database or a
    long computation, and would shuffle the large side before it finds out.
    """
    size = df.agg(F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
