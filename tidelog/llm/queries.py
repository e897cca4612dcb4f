"""One query per operator over its whole table, and the SQL it is checked against where SQL can say it."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import decontaminate, forest, language, licenses, neardup, negatives, packing, pii, planes, substrings, tokens, warc, whitening
from tidelog.llm.tables import delete_on_exit
from tidelog.session import settle, shared_dir, small_side

TOKENIZERS = os.path.dirname(public_tokenizers.path("word_bpe_49k.json"))  # all executors have it
SEQUENCE_TOKENS = 2048
LONG_TOKENS = 1024
COMPONENTS = 16
END_ID = 2
PSEUDONYM_KEY = "a key for the checks; give your own"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold parts of which benchmark items, and do they hold enough of them to be contaminated?"""
    docs, items = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text")
    found = decontaminate.overlaps(docs, items)
    return found.withColumn("contaminated", F.col("covered") >= decontaminate.COVERAGE * F.col("item_words"))


REVISIT_BYTES = 100  # payloads from this length on are written once


@query(
    "op2_warc",
    """with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html) as n, sha256(html) as digest from p),
f as (select *, case when n >= 100 then min(page_id) over (partition by digest) end as first from d)
select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
  case when first is not null and first is distinct from page_id then 'revisit' else 'response' end as record_type,
  case when first is distinct from page_id then first end as refers_to from f""",
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as archives, equal payloads once, and what is read back from these.

    Null html is an empty payload. A page without an id is no other's response; one whose payload no page with
    an id has is a response.
    """
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    pages = pages.withColumn("payload", F.coalesce("html", F.lit("")).cast("binary"))
    pages = pages.withColumn("digest", F.sha2("payload", 256)).withColumn("n", F.octet_length("payload"))
    several = pages.where(F.col("n") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("of"))
    several = small_side(settle(several.where("of > 1 and first is not null").select("digest", "first")))
    named = pages.join(several, "digest", "left").withColumn("again", F.coalesce(~F.col("first").eqNullSafe(F.col("page_id")) & F.col("first").isNotNull(), F.lit(False)))

    def record_id(page_id: str) -> Column:
        parts = F.regexp_replace(F.md5(F.coalesce(F.col(page_id).cast("string"), F.lit("")).cast("binary")), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
        return F.concat(F.lit("<urn:uuid:"), parts, F.lit(">"))

    records = named.select(
        F.when(F.col("again"), "revisit").otherwise("response").alias("record_type"),
        record_id("page_id").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit("1970-01-01T00:00:00Z").alias("date"),
        F.when(F.col("again"), record_id("first")).alias("refers_to"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.create_map(
            F.lit("X-Page-Id"), F.col("page_id").cast("string"),
            F.lit("X-Refers-To-Page-Id"), F.when(F.col("again"), F.col("first")).cast("string"),
            F.lit("X-Payload-Length"), F.col("n").cast("string"),
        ).alias("headers"),
        F.when(~F.col("again"), F.col("payload")).alias("payload"),
    )
    folder = shared_dir(spark, f"warc-{uuid.uuid4().hex}")
    warc.write_warc(records, folder)
    delete_on_exit(spark, folder)
    # the payloads as read are measured and hashed anew; a revisit has none, but says what its response's is
    again = F.col("record_type") == "revisit"
    header = lambda name: F.element_at("headers", F.lit(name))
    return warc.read_warc(spark, folder, types=["response", "revisit"]).select(
        header("X-Page-Id").cast("bigint").alias("page_id"),
        F.when(again, header("X-Payload-Length").cast("bigint")).otherwise(F.octet_length("payload").cast("bigint")).alias("payload_bytes"),
        F.when(again, F.substring_index("payload_digest", ":", -1)).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        "record_type",
        header("X-Refers-To-Page-Id").cast("bigint").alias("refers_to"),
    )


@query("op3_substrings")
def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the strings of 50 bytes that a document with a smaller id has?"""
    return substrings.repeated_strings(table(spark, sf_dir, "documents", "doc_id", "text"), length=50)


@query("op4_neighbours")
def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which twenty vectors found are nearest to every twentieth one?"""
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return forest.neighbours(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where in which sequence of 2048 tokens is each piece of each document?"""
    return packed(table(spark, sf_dir, "documents", "doc_id", "text"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = packing.token_pieces(docs, "text", ["doc_id"], f"{TOKENIZERS}/word_bpe_49k.json", SEQUENCE_TOKENS)
    pieces = pieces.select(
        "row.doc_id", "piece", "start", (F.octet_length("ids") / 4).cast("bigint").alias("length"), F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(pieces, "length", ["doc_id", "piece", "ids_crc32"], SEQUENCE_TOKENS)


@query("op6_licenses")
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which passages of which documents are license texts or notices?"""
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"), "text", ["doc_id"]).select("row.*", "start", "license", "reduction", "missing", "added", "confirmed")


@query("op7_language")
def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In which language is each document, as learned from four fifths of them?"""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = language.learn(docs.where(~language.held_out(F.col("doc_id"))), "text", "lang", by="doc_id")
    found = language.predict(docs, "text", ["doc_id"], *model)
    return found.select("row.doc_id", language.held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


@query("op8_near_duplicates")
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents share at least 80 per cent of their four-word shingles, directly or through others?"""
    return neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), n=4, percent=80)


@query("op9_pseudonyms")
def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with numbers, dates, addresses and secrets replaced by pseudonyms of the same format."""
    return pii.pseudonyms(table(spark, sf_dir, "documents", "doc_id", "text"), "text", PSEUDONYM_KEY)


@query("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tokens has each document, and is it over the limit?"""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    docs = docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    found = tokens.count_tokens(docs, "text", ["doc_id", "n_bytes"], f"{TOKENIZERS}/byte_bpe_50k.json")
    return found.select("row.*", "n_tokens", (F.col("n_tokens") > LONG_TOKENS).alias("over_limit"))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors on a grid, projected on the leading components of their covariance, each with variance 1."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    rows = rows.select("vec_id", whitening.on_grid(F.col("embedding"), 64, 1_000_000).alias("x"))
    fitted, several = whitening.fit(rows, "x", COMPONENTS)
    made = whitening.whiten(rows, "x", ["vec_id"], fitted)
    made = made.select("row.vec_id", F.col("deviation").cast("bigint").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*(F.lit(float(e)) for e in fitted.explained)).cast("array<double>")
    return made.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fitted.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(whitening.identity_error(fitted, several)).cast("double").alias("identity_error"),
    )


@query("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token ids of all documents in files of byte planes, and what is read back from these."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    folder = shared_dir(spark, f"planes-{uuid.uuid4().hex}")
    planes.write_ids(planes.encoded(docs, "text", "doc_id", f"{TOKENIZERS}/word_bpe_49k.json", END_ID), folder)
    delete_on_exit(spark, folder)
    found = planes.read_ids(spark, folder)
    return found.select(F.col("key").alias("doc_id"), "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query(
    "op13_negatives",
    """with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda c: floor(256 * cast(c as double))) as x from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
s as (select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
  cast(list_inner_product(a.x, r.x) as bigint) as score
  from v a join v r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as int) as rank,
  vec_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10""",
)
def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every hundredth vector and each of its five best positives, which ten rows of other labels score just below?"""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", moved.alias("label"), whitening.on_grid(F.col("embedding"), 256, 0).alias("vector"))
    return negatives.hard_negatives(rows, rows.where("vec_id % 100 = 0"))
