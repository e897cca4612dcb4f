"""Intermediate tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidelog.session import shared_dir


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """The folder goes when the session ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


def stored(df: DataFrame) -> DataFrame:
    """The rows written once as Parquet to the folder all executors share, and read from there. The files go when the session ends."""
    spark = df.sparkSession
    path = shared_dir(spark, f"table-{uuid.uuid4().hex}")
    df.write.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
