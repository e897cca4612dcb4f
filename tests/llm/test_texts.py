"""Rows that go through Python in batches of bounded size."""

import pyarrow as pa
from common import documents
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from tidelog.llm import texts


def _sizes(spark, keep):
    docs = documents(spark, ["x"] * 600).coalesce(1).withColumn("text", F.when(F.col("doc_id") != 7, F.repeat(F.lit("word "), 10_000)))
    made = texts.map_texts(docs, "text", keep, [StructField("size", LongType())], lambda batch: [pa.array([batch.nbytes] * len(batch))])
    return made, made.select("row.doc_id", "size").collect()


def test_batches_are_bounded_however_long_the_texts(spark):
    """30 MB of texts in one partition; all were one batch."""
    for keep in (["doc_id"], ["doc_id", "text"]):
        made, found = _sizes(spark, keep)
        assert sorted(r.doc_id for r in found) == list(range(600))
        assert max(r["size"] for r in found) < 2 * texts.BATCH_BYTES
    rows = made.select("row.*").agg(F.count("text"), F.min(F.length("text")), F.sum(F.length("text"))).first()
    assert tuple(rows) == (599, 50_000, 599 * 50_000)


def test_bound_of_the_session_stays(spark):
    before = spark.conf.get(texts.BATCH_CONF, None)
    spark.conf.set(texts.BATCH_CONF, "12345678")
    try:
        texts.bound_batches(spark)
        assert spark.conf.get(texts.BATCH_CONF) == "12345678"
    finally:
        spark.conf.unset(texts.BATCH_CONF) if before is None else spark.conf.set(texts.BATCH_CONF, before)


def test_kept_text_is_sent_once(spark):
    made, _ = _sizes(spark, ["doc_id", "text"])
    assert made._jdf.queryExecution().analyzed().children().head().output().size() == 1
