"""A training corpus from raw documents: language, near copies, benchmark passages, personal data, packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import decontaminate, language, neardup, pii
from tidelog.llm.queries import PSEUDONYM_KEY, packed, table
from tidelog.session import shared_dir, small_side

MIN_SCORE = 0.5  # of the language, below which a document goes


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told; null texts and those without letters go."""
    model = language.learn(docs.where(~language.held_out(F.col("doc_id"))), "text", "lang", by="doc_id")
    found = language.predict(docs, "text", docs.columns, *model)
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share 80 per cent of their five-word shingles, that with the smallest id."""
    found = neardup.near_duplicates(docs, n=5, percent=80)
    return docs.join(small_side(found.where("not kept").select("doc_id").distinct()), "doc_id", "left_anti").select(docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than half of every benchmark item."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def pseudonymized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced in their texts."""
    return pii.pseudonyms(docs, "text", PSEUDONYM_KEY, count="llm_replaced").select(docs.columns)


def in_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents and their places in sequences."""
    return packed(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_near_copies),
    ("decontamination", without_benchmarks),
    ("pseudonyms", pseudonymized),
    ("packing", in_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written to the shared folder and read from there."""
    rows, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        stage(spark, rows, sf_dir).write.parquet(f"{folder}/{name}")
        rows = spark.read.parquet(f"{folder}/{name}")
    return rows
