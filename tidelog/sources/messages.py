"""Change messages from Kafka or files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.patterns import BLANKS

# Timestamps are read as text first: a number in quotes is one too.
MESSAGE = "Type string, Database string, Table string, Timestamp string, Data map<string,string>, _corrupt string"


def read_raw(
    spark: SparkSession, fmt: str = "kafka", options: dict[str, str] | None = None, stream: bool = True
) -> DataFrame:
    """Unparsed messages with a text ``value``; Kafka adds topic, partition and offset.

    Files are read line by line (``text``) or, with any other format, by their own schema.
    """
    reader = (spark.readStream if stream else spark.read).format(fmt).options(**(options or {}))
    raw = reader.load()
    return raw.withColumn("value", F.col("value").cast("string")) if "value" in raw.columns else raw


def _readable(value: str) -> Column:
    """Array with the parsed message, empty if it cannot be read. Exploding it parses each message only once."""
    parsed = F.from_json(value, MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})

    def valid(m: Column) -> Column:
        time_fits = m["Timestamp"].isNull() | m["Timestamp"].try_cast("bigint").isNotNull()
        return m.isNotNull() & m["_corrupt"].isNull() & time_fits

    is_object = F.btrim(F.col(value), F.lit(BLANKS)).startswith("{")
    return F.when(is_object, F.filter(F.array(parsed), valid))


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Message fields with ``KafkaTopic`` (topic/partition) and ``KafkaOffset``; unreadable messages are left out."""
    from_kafka = {"topic", "partition", "offset"} <= set(raw.columns)
    where = F.concat_ws("/", "topic", F.col("partition").cast("string")) if from_kafka else F.lit(None).cast("string")
    return raw.select(
        F.explode(_readable(value)).alias("_m"),
        where.alias("KafkaTopic"),
        (F.col("offset") if from_kafka else F.lit(None).cast("bigint")).alias("KafkaOffset"),
    ).select(
        "_m.Type",
        "_m.Database",
        "_m.Table",
        F.col("_m.Timestamp").cast("bigint").alias("Timestamp"),
        "_m.Data",
        "KafkaTopic",
        "KafkaOffset",
    )


def quarantine(raw: DataFrame, value: str = "value") -> DataFrame:
    """The messages that ``parse_messages`` leaves out, as they came."""
    return raw.filter(F.coalesce(F.size(_readable(value)), F.lit(0)) <= 0)


def read_change_messages(
    spark: SparkSession, fmt: str = "kafka", options: dict[str, str] | None = None, stream: bool = True
) -> DataFrame:
    return parse_messages(read_raw(spark, fmt, options, stream))
