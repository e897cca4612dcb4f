"""Texts of Arrow batches as numpy arrays: rows through Python, words and their hashes."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

BLOCK_BYTES = 1 << 18  # worked on at once; what is computed from them takes a hundred times as much memory
BATCH_BYTES = 2 << 20  # of rows that go to Python together, about
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

# White space of the word rule, space and tab to carriage return.
WHITE_SPACE = bytes([9, 10, 11, 12, 13, 32])


def give_back() -> None:
    """Memory that is free goes back to the system: workers live on, and the next ones need it."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


def bound_batches(spark: SparkSession) -> None:
    """Rows go to Python in batches of about BATCH_BYTES, unless the session says how many bytes; else 10,000 rows are one, however long."""
    if not spark.conf.get(BATCH_CONF, None):
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def map_texts(
    docs: DataFrame, text: str, keep: list[str], fields: list[StructField], compute: Callable[[pa.Array], list[pa.Array]]
) -> DataFrame:
    """Columns ``row`` (a struct of ``keep``) and ``fields``, which ``compute`` makes from a batch of texts.

    The kept columns stay in a struct, so that none clashes with a computed one. A text that is kept is sent once.
    """
    bound_batches(docs.sparkSession)
    kept = StructType([docs.schema[c] for c in keep])
    held = keep.index(text) if text in keep else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row = batch.column(0)
            out = pa.StructArray.from_arrays([row.field(i) for i in range(len(keep))], names=keep)
            texts = batch.column(1) if held is None else row.field(held)
            yield pa.RecordBatch.from_arrays([out, *compute(texts)], names=["row", *(f.name for f in fields)])
            give_back()

    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), *([F.col(f"`{text}`").alias("text")] if held is None else []))
    return rows.mapInArrow(run, StructType([StructField("row", kept), *fields]))


def blocks(texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about ``size`` bytes: index of the first one, their bytes, their offsets. Null is empty."""
    if pa.types.is_large_string(texts.type):
        kind, item = pa.large_string(), np.int64
    else:
        kind, item = pa.string(), np.int32
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count or texts.type != kind:
        texts = pc.fill_null(texts, "").cast(kind)
    if not len(texts):
        return
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, item)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, side="right")) - 1)
        last = min(last, len(texts))
        yield first, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def fold_table(separators: bytes) -> np.ndarray:
    """For each byte a random number, the same for A-Z as for a-z, and 0 for separators."""
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
    table[65:91] = table[97:123]
    table[list(separators)] = 0
    return table


_BASE = np.uint64(0x5851F42D4C957F2D)


def _powers(n: int, known: list[np.ndarray] = []) -> np.ndarray:  # noqa: B006  grown once per worker
    if not known or len(known[0]) < n:
        known[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(n, 64) - 1, _BASE)])]
    return known[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words in a block, the number of words before each text, and where each word starts."""
    values = table[data]
    inside = values != 0
    before = np.r_[False, inside[:-1]] if len(inside) else inside
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), starts
    place = np.arange(len(data)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(data)]))
    place[~inside] = 0
    values *= _powers(int(place.max()) + 1)[place]
    hashes = mix(np.add.reduceat(values, starts))
    return hashes, np.searchsorted(starts, offsets), starts


_STEPS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; a shorter text has one, of all its words; no words, none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total += words[i : len(words) - width + 1 + i] * _STEPS[i]
    return mix(total)
