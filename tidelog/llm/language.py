"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from tidelog.llm.texts import blocks, map_texts

UNKNOWN = "und"
ORDERS = (1, 2, 3)
BUCKET_BITS = 16
SAMPLE_DOCS = 20_000  # of each language, for learning
CHARS = 1 << 18  # worked on at once

_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _tables(known: list[np.ndarray] = []) -> list[np.ndarray]:  # noqa: B006  made once per worker
    """For each code point, its lower case, and 0 for what is no letter."""
    if not known:
        low = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if (ch := chr(c)).isalpha():
                low[c] = ord(l) if len(l := ch.lower()) == 1 else c
        known.append(low)
    return known


def grams(chars: np.ndarray) -> np.ndarray:
    """Buckets of all n-grams that begin or end in a letter; what is no letter is 0."""
    found = []
    for n in ORDERS:
        if len(chars) < n:
            break
        parts = [chars[i : len(chars) - n + 1 + i] for i in range(n)]
        total = np.full(len(parts[0]), n, np.uint64)
        for part, factor in zip(parts, _FACTORS):
            total += part * factor
        total ^= total >> np.uint64(29)
        total *= _FACTORS[0]
        total >>= np.uint64(64 - BUCKET_BITS)
        found.append(np.where((parts[0] != 0) | (parts[-1] != 0), total.astype(np.int64), -1))
    return found


def gram_blocks(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the text, bucket) of every n-gram of every text, about ``CHARS`` characters at a time.

    A block is a sparse matrix of texts and buckets: one entry for each n-gram found.
    """
    low = _tables()[0]
    for first, data, offsets in blocks(texts):
        codes = low[np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)].astype(np.uint64)
        ends = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets]
        # texts are set apart by two characters that are no letters, so that no n-gram joins two of them
        own = np.repeat(np.arange(len(offsets) - 1), np.diff(ends))
        spaced = np.zeros(len(codes) + 2 * len(offsets), np.uint64)
        place = np.arange(len(codes)) + 2 * own + 2
        spaced[place] = codes
        owner = np.zeros(len(spaced), np.int64)
        owner[place] = own
        for step in range(0, len(spaced), CHARS):
            piece = spaced[step : step + CHARS + max(ORDERS) - 1]
            for n, buckets in zip(ORDERS, grams(piece)):
                buckets = buckets[:CHARS] if len(piece) > CHARS else buckets
                # the n-gram belongs to the text of its letters: that of its first character, or of its last
                at = np.arange(step, step + len(buckets))
                mine = np.where(spaced[at] != 0, owner[at], owner[np.minimum(at + n - 1, len(owner) - 1)])
                real = buckets >= 0
                yield first + mine[real], buckets[real]


def held_out(doc_id: Column) -> Column:
    """Is the document kept from learning?"""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(labelled: DataFrame, text: str, lang: str, by: str, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """The languages, sorted, and the log-probabilities: one row per bucket, and one for the priors.

    ``labelled`` holds the rows to learn from; those without a language or text are left out.
    N-grams are counted in at most about ``sample_docs`` documents of each language, chosen
    by a hash of ``by``; the priors come from all rows. The result has (buckets + 1) numbers
    for each language, whatever the size of the input.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(by).alias("by"))
    rows = rows.where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    size = 1 << BUCKET_BITS
    if not langs:
        return [], np.zeros((size + 1, 0))
    share = F.element_at(F.create_map(*(F.lit(x) for l in langs for x in (l, min(1.0, sample_docs / sizes[l])))), F.col("lang"))
    chosen = F.pmod(F.xxhash64(F.col("by").cast("string"), F.lit("learn")), F.lit(1 << 30)) < share * float(1 << 30)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(langs), size), np.int64)
        for batch in batches:
            if batch.num_rows:
                own = np.array([langs.index(l) for l in batch.column(1).to_pylist()])
                for at, buckets in gram_blocks(batch.column(0)):
                    counts += np.bincount(own[at] * size + buckets, minlength=counts.size).reshape(counts.shape)
        which, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(which, pa.int32()), pa.array(bucket, pa.int32()), pa.array(counts[which, bucket], pa.int64())],
            names=["lang", "bucket", "n"],
        )

    summed = rows.where(chosen).select("text", "lang").mapInArrow(count, "lang int, bucket int, n bigint")
    found = summed.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.ones((size, len(langs)))
    counts[found["bucket"].to_numpy(), found["lang"].to_numpy()] += found["n"].to_numpy()
    priors = np.array([sizes[l] for l in langs], float)
    return langs, np.log(np.vstack([counts / counts.sum(axis=0), priors / priors.sum()]))


def predict(docs: DataFrame, text: str, keep: list[str], langs: list[str], log_probs: np.ndarray) -> DataFrame:
    """Columns ``row`` (of ``keep``), ``lang_pred`` and ``score``, the probability of that language.

    Null texts, texts without a letter, and all texts if nothing was learned: ``und`` with 0.
    Of equally likely languages the first by name is taken.
    """
    model = docs.sparkSession.sparkContext.broadcast(log_probs)

    def compute(texts: pa.Array) -> list[pa.Array]:
        table = model.value
        totals = np.tile(table[-1], (len(texts), 1))
        seen = np.zeros(len(texts), bool)
        for at, buckets in gram_blocks(texts):
            if len(at):
                starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                totals[at[starts]] += np.add.reduceat(table[buckets], starts, axis=0)
                seen[at[starts]] = True
        if not langs:
            return [pa.array([UNKNOWN] * len(texts)), pa.array(np.zeros(len(texts)))]
        best = totals.argmax(axis=1)
        odds = np.exp(totals - totals.max(axis=1, keepdims=True))
        names = [langs[b] if s else UNKNOWN for b, s in zip(best, seen)]
        return [pa.array(names, pa.string()), pa.array(np.where(seen, 1 / odds.sum(axis=1), 0.0))]

    return map_texts(docs, text, keep, [StructField("lang_pred", StringType()), StructField("score", DoubleType())], compute)
