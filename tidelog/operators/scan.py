"""Running values over a log, without putting a whole log into one task.

A log is cut into blocks of its own order column (``order >> block_bits``).
Windows run inside ``(keys, block)``; one summary row per block carries the state
from block to block. With binlog positions a block of the default size is 64 MB
of log, so neither a block nor the list of summaries of a server grows out of a
task, however uneven the keys are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_BITS = 26


def _with_block(df: DataFrame, order: str, block_bits: int) -> DataFrame:
    return df.withColumn("_block", F.shiftright(F.col(order), block_bits))


def fill_forward(
    df: DataFrame,
    name: str,
    value: Column,
    known: Column,
    order: str = "pos",
    keys: Sequence[str] = ("server_id",),
    block_bits: int = BLOCK_BITS,
    strict: bool = False,
) -> DataFrame:
    """Add ``name``: the last ``value`` among the rows where ``known`` holds, up to this row.

    ``strict`` leaves the row itself out.
    """
    group = [*keys, "_block"]
    rows = _with_block(df, order, block_bits).withColumn("_value", F.when(known, value))
    in_block = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1 if strict else 0)
    earlier_blocks = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carries = (
        rows.groupBy(*group)
        .agg(F.max_by("_value", F.when(F.col("_value").isNotNull(), F.col(order))).alias("_tail"))
        .select(*group, F.last("_tail", ignorenulls=True).over(earlier_blocks).alias("_carry"))
        .filter(F.col("_carry").isNotNull())
    )
    return (
        rows.withColumn(name, F.last("_value", ignorenulls=True).over(in_block))
        .join(carries, group, "left")
        .withColumn(name, F.coalesce(F.col(name), F.col("_carry")))
        .drop("_block", "_value", "_carry")
    )


def running_sum(
    df: DataFrame,
    name: str,
    amount: Column,
    order: str = "pos",
    keys: Sequence[str] = ("server_id",),
    block_bits: int = BLOCK_BITS,
    strict: bool = False,
) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over the rows up to this one (before it, if ``strict``)."""
    group = [*keys, "_block"]
    rows = _with_block(df, order, block_bits).withColumn("_amount", amount.cast("bigint"))
    in_block = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1 if strict else 0)
    earlier_blocks = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    carries = (
        rows.groupBy(*group)
        .agg(F.sum("_amount").alias("_total"))
        .select(*group, F.sum("_total").over(earlier_blocks).alias("_carry"))
        .filter(F.col("_carry").isNotNull())
    )
    zero = F.lit(0).cast("bigint")
    return (
        rows.withColumn(name, F.coalesce(F.sum("_amount").over(in_block), zero))
        .join(carries, group, "left")
        .withColumn(name, F.col(name) + F.coalesce(F.col("_carry"), zero))
        .drop("_block", "_amount", "_carry")
    )


def number_transactions(
    events: DataFrame,
    starts: Column,
    counted: Column,
    order: str = "pos",
    keys: Sequence[str] = ("server_id",),
    block_bits: int = BLOCK_BITS,
    open_before: DataFrame | None = None,
) -> DataFrame:
    """Add ``tx`` (start row's gtid and order) and ``seq_no`` (counted rows since that start).

    ``open_before`` (keys, tx, seq_no) is the state the log continues from.
    """
    group = [*keys, "_block"]
    log = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)

    def numbered(rows: DataFrame) -> DataFrame:
        start = F.when(F.col("_starts"), F.struct(F.col("gtid").alias("gtid"), F.col(order).alias("start")))
        return (
            rows.withColumn("tx", F.last(start, ignorenulls=True).over(log))
            .withColumn("_rows", F.sum(F.col("_counted").cast("bigint")).over(log))
            .withColumn("_skip", F.last(F.when(F.col("_starts"), F.col("_rows")), ignorenulls=True).over(log))
            .withColumn("seq_no", F.col("_rows") - F.coalesce(F.col("_skip"), F.lit(0)))
            .drop("_rows", "_skip", "_starts", "_counted")
        )

    rows = _with_block(events, order, block_bits).withColumns(
        {"_starts": F.coalesce(starts, F.lit(False)), "_counted": F.coalesce(counted, F.lit(False))}
    )
    tails = (
        numbered(rows.select(*group, order, "gtid", "_starts", "_counted"))
        .groupBy(*group)
        .agg(F.max_by(F.struct("tx", "seq_no"), order).alias("_tail"))
        .select(*group, "_tail.tx", "_tail.seq_no")
    )
    if open_before is not None:
        tails = tails.unionByName(open_before.select(*keys, F.lit(-1).cast("bigint").alias("_block"), "tx", "seq_no"))
    blocks = W.partitionBy(*keys).orderBy("_block")
    since_start = W.partitionBy(*keys, "_run").orderBy("_block").rowsBetween(W.unboundedPreceding, 0)
    carries = (
        tails.withColumn("_run", F.count("tx").over(blocks.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("_open", F.first("tx").over(since_start))
        .withColumn("_seen", F.sum("seq_no").over(since_start))
        .select(
            *group,
            F.lag("_open").over(blocks).alias("_open"),
            F.lag("_seen").over(blocks).alias("_seen"),
        )
        .filter(F.col("_seen").isNotNull())
    )
    return (
        numbered(rows)
        .join(carries, group, "left")
        .withColumn(
            "seq_no",
            F.col("seq_no") + F.when(F.col("tx").isNull(), F.coalesce(F.col("_seen"), F.lit(0))).otherwise(F.lit(0)),
        )
        .withColumn("tx", F.coalesce("tx", "_open"))
        .drop("_block", "_open", "_seen")
    )
