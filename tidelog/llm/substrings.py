"""Removing byte strings that an earlier document already has, by anchored suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.suffixes import _BACK, _SECOND_BACK, _powers, anchors, prefix_hashes, second_hashes, sort_suffixes, span_hashes
from tidelog.llm.tables import stored
from tidelog.llm.texts import blocks, bound_batches, give_back, mix
from tidelog.operators.groups import whole_groups
from tidelog.session import settle, shuffles_dropped, small_side

LENGTH = 50  # bytes of a repeated string
CROWD = 500  # contexts of one anchor that are sorted in one task; larger crowds are resolved window by window, by their bytes
MARKS_BYTES = 192 << 20  # of the places found, as text, up to which they go to the documents; beyond that both are shuffled
AT_ONCE = 1 << 15  # bytes of texts whose anchors are looked for together: what is computed from them stays in the processor's cache
CONTEXTS_AT_ONCE = 20_000  # that leave a task together, about
COMBINED_ROWS = 250_000  # anchors of a task looked at together, about
PART_BYTES = 8 << 20  # of texts whose anchors, half a million, are judged in one task
PARCEL_BYTES = 1 << 20  # of parcels that leave a task together, about
SAMPLE_DOCS = 20_000  # looked through for hot anchors, about
HOT_ROWS = 100  # of an anchor in these, from which it counts as hot


def _numbered(first: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each anchor of some texts: which text it is in, and its number among the anchors of that text."""
    owner = np.searchsorted(offsets, first, "right") - 1
    return owner, np.arange(len(owner)) - np.searchsorted(owner, owner)


def _contexts(data: np.ndarray, length: int, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each anchor of some texts: its hash, two independent hashes of its context, which is the bytes of all its windows, its text and number."""
    prefixes, back = prefix_hashes(data), _powers(len(data) + 1, _BACK)
    places, hashes, first, last = anchors(data, length, prefixes, offsets)
    owner, number = _numbered(first, offsets)
    if not len(places):
        return hashes, hashes, hashes, owner, number
    one = mix(span_hashes(prefixes, back, first, last - first + length))
    two = mix(span_hashes(second_hashes(data), _powers(len(data) + 1, _SECOND_BACK), first, last - first + length))
    return hashes, one, two, owner, number


PLAIN, COVERED, HOT = range(3)


def _combined(columns: list[np.ndarray], hot: np.ndarray) -> list[np.ndarray]:
    """Anchors of some documents, made ready to be dealt by ``anchor``: (anchor, context, second, doc, place, kind).

    A context that an earlier one of these documents has is COVERED and goes anywhere; an anchor that is known to be HOT is
    dealt by its context, too. So neither copies nor common passages bring their documents together in one task.
    """
    anchor, context, second, doc, place = columns
    kind = np.full(len(anchor), PLAIN, np.int8)
    if not len(anchor):
        return [*columns, kind]
    together = anchor ^ mix(context.view(np.uint64)).view(np.int64) ^ second
    order = np.argsort(together)
    a, c, s, d = (x[order] for x in (anchor, context, second, doc))
    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (c[1:] != c[:-1]) | (s[1:] != s[:-1])])
    first = np.repeat(np.minimum.reduceat(d, new), np.diff(np.r_[new, len(d)]))
    covered = order[d > first]
    anchor = anchor.copy()
    if len(hot):
        busy = hot[np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)] == anchor
        kind[busy] = HOT
        anchor[busy] ^= mix(context[busy].view(np.uint64)).view(np.int64)
    kind[covered] = COVERED
    anchor[covered] = mix(doc[covered].view(np.uint64) * np.uint64(31) + place[covered].astype(np.uint64)).view(np.int64)
    return [anchor, context, second, doc, place, kind]


def _found(batches: Iterator[pa.RecordBatch], length: int, hot: np.ndarray) -> Iterator[list[np.ndarray]]:
    """The anchors of (document, text) rows, about COMBINED_ROWS at a time, made ready by ``_combined``."""
    found, n = [], 0
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for first, data, offsets in blocks(batch.column(1), AT_ONCE):
            *hashes, owner, number = _contexts(data, length, offsets)
            found.append((*(x.view(np.int64) for x in hashes), ids[first + owner], number.astype(np.int32)))
            n += len(owner)
            if n > COMBINED_ROWS:
                columns = [np.concatenate(x) for x in zip(*found)]
                found, n = [], 0
                yield _combined(columns, hot)
                give_back()
    if found:
        columns = [np.concatenate(x) for x in zip(*found)]
        del found
        yield _combined(columns, hot)
        del columns
        give_back()


def _planes(values: np.ndarray, width: int) -> np.ndarray:
    """The lower ``width`` bytes of whole numbers, byte by byte: what is the same in many of them stands together."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)


def _width(values: np.ndarray) -> int:
    return max(1, -(-int(values.max(initial=0)).bit_length() // 8))


HEAD = 6  # numbers in front of a parcel


def _parcels(columns: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """Anchors that are ready, as one binary value for each part that they are dealt to; what is COVERED only as document and place.

    Rows of hashes hardly compress, and their other columns are mostly zeros: so packed an anchor takes 24 to 27 bytes instead of 32.
    """
    anchor, context, second, doc, place, kind = columns
    unsigned, lowest = anchor.view(np.uint64), int(doc.min(initial=np.iinfo(np.int64).max))
    part = (mix(unsigned) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)  # anchors are the smallest of many hashes, so not even themselves
    known = np.flatnonzero(kind == COVERED)
    known = known[np.argsort(part[known])]
    rest = np.flatnonzero(kind != COVERED)
    rest = rest[np.argsort(part[rest] << np.uint64(40) | unsigned[rest] >> np.uint64(24))]
    cuts = [np.searchsorted(part[rows], np.arange(parts + 1, dtype=np.uint64)) for rows in (rest, known)]
    docs = doc.view(np.uint64) - np.array([lowest]).view(np.uint64)
    widths = _width(docs), _width(place)
    steps = _planes(np.diff(unsigned[rest], prepend=np.uint64(0)), 8)
    marked = [[_planes(x[rows], w) for x, w in zip((docs, place), widths)] for rows in (rest, known)]
    hashes, hot = [x[rest] for x in (context, second)], (kind[rest] == HOT).astype(np.uint8)
    numbers, parcels, size = [], [], 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(parcels, pa.binary())], names=["part", "rows"])

    for p in np.unique(part).tolist():
        (a, b), (c, d) = ((int(x[p]), int(x[p + 1])) for x in cuts)
        head = np.array([b - a, d - c, lowest, *widths, anchor[rest[a]] if b > a else 0], "<i8")
        pieces = [head, steps[:, a:b], *(x[a:b] for x in hashes), hot[a:b], *(x[:, a:b] for x in marked[0]), *(x[:, c:d] for x in marked[1])]
        numbers.append(p)
        parcels.append(b"".join(x.tobytes() for x in pieces))
        size += len(parcels[-1])
        if size > PARCEL_BYTES:
            yield out()
            numbers, parcels, size = [], [], 0
    if numbers:
        yield out()


def _unpacked(parcel: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of a parcel: anchor, context, second, doc, place, kind of what is open; doc and place of what is COVERED."""
    n, known, lowest, *widths, first = np.frombuffer(parcel, "<i8", HEAD).tolist()
    at = 8 * HEAD

    def taken(rows: int, width: int) -> np.ndarray:
        nonlocal at
        planes = np.frombuffer(parcel, np.uint8, rows * width, at).reshape(width, rows)
        at += rows * width
        values = np.zeros((rows, 8), np.uint8)
        values[:, :width] = planes.T
        return values.view("<i8")[:, 0]

    def marks(rows: int) -> list[np.ndarray]:
        doc, place = (taken(rows, w) for w in widths)
        return [doc + np.int64(lowest), place.astype(np.int32)]

    steps = taken(n, 8)
    steps[:1] = first
    hashes = []
    for _ in range(2):
        hashes.append(np.frombuffer(parcel, "<i8", n, at))
        at += 8 * n
    hot = taken(n, 1)
    return [np.cumsum(steps), *hashes, *marks(n), np.where(hot > 0, np.int8(HOT), np.int8(PLAIN))], marks(known)


def _hot_anchors(docs: DataFrame, length: int, n: int) -> np.ndarray:
    """Anchors that many of some documents have, SAMPLE_DOCS of ``n`` at most or so. They are only dealt otherwise; no result depends on them."""
    if not n:
        return np.zeros(0, np.int64)
    names = ["anchor", "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _found(batches, length, np.zeros(0, np.int64)):
            yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[5])], names=names)

    some = docs.select("doc", "text").sample(min(1.0, SAMPLE_DOCS / n), seed=3).mapInArrow(run, "anchor bigint, kind tinyint")
    rows = some.where(F.col("kind") == PLAIN).groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") >= HOT_ROWS).collect()
    return np.sort(np.array([r["anchor"] for r in rows], np.int64))


def _dealt_anchors(docs: DataFrame, length: int) -> DataFrame:
    """The anchors of all documents as parcels, those of equal anchors in one partition, and so many partitions that each is sorted in memory."""
    spark = docs.sparkSession
    n, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(spark.sparkContext.defaultParallelism, -(-(size or 0) // PART_BYTES))
    sent = spark.sparkContext.broadcast(_hot_anchors(docs, length, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _found(batches, length, sent.value):
            yield from _parcels(columns, parts)

    return docs.select("doc", "text").mapInArrow(run, "part int, rows binary").repartitionById(parts, "part").select("rows")


def _out(anchor: np.ndarray, doc: np.ndarray, place: np.ndarray, covered: bool) -> pa.RecordBatch:
    columns = [pa.array(anchor), pa.array(doc), pa.array(place), pa.array(np.full(len(doc), covered))]
    return pa.RecordBatch.from_arrays(columns, names=["anchor", "doc", "place", "covered"])


def _sorted_out(held: list[list]) -> Iterator[pa.RecordBatch]:
    """The judgement on what is open in the parcels of a partition, whose columns are given up one by one."""
    columns = []
    for i in range(6):
        columns.append(np.concatenate([x[i] for x in held]))
        for x in held:
            x[i] = None
    order = np.argsort(columns[0])
    same = np.diff(columns[0][order]) == 0
    order = order[(columns[5][order] == HOT) | np.r_[same, False] | np.r_[False, same]]  # others are alone with their anchors
    if not len(order):
        return
    columns = [x[order] for x in columns]
    order = np.lexsort(columns[3::-1])
    anchor, context, second, doc, place, kind = (x[order] for x in columns)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1]) | (second[1:] != second[:-1])]
    starts, run = np.flatnonzero(new), np.cumsum(new) - 1
    same = anchor[starts[1:]] == anchor[starts[:-1]]
    several = (np.r_[False, same] | np.r_[same, False])[run] | (kind == HOT)
    first = doc == doc[starts][run]
    real = anchor ^ np.where(kind == HOT, mix(context.view(np.uint64)).view(np.int64), 0)
    for rows, covered in ((~first, True), (first & several, False)):
        yield _out(real[rows], doc[rows], place[rows], covered)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the parcels of a partition, which has all that is PLAIN of an anchor or HOT of its context: those whose whole context an earlier document
    has (``covered``), and those of the first document with a context, if the anchor has another context, too, or is a hot one."""
    held = []
    for batch in batches:
        for parcel in batch.column(0):
            open_, (doc, place) = _unpacked(parcel.as_buffer())
            if len(open_[0]):
                held.append(open_)
            if len(doc):
                yield _out(np.zeros(len(doc), np.int64), doc, place, True)
    if held:
        yield from _sorted_out(held)
    del held
    give_back()


def _open_contexts(docs: DataFrame, length: int) -> DataFrame:
    """The bytes of the contexts in ``alone``, under their anchors, and those of each window of the contexts in ``crowded``."""

    def made(found: list[list[np.ndarray]], context: list[bytes]) -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(x)) for x in zip(*found)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(context, pa.binary())], names=["key", "doc", "start", "windows", "ahead", "context"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, context = batch.column(0).to_numpy(), [], []
            lists = [[np.array(x.as_py() or [], np.int64) for x in batch.column(i)] for i in (2, 3)]
            for begin, data, offsets in blocks(batch.column(1), AT_ONCE):
                prefixes = prefix_hashes(data)
                places, hashes, first, last = anchors(data, length, prefixes, offsets)
                counts = np.bincount(_numbered(first, offsets)[0], minlength=len(offsets) - 1)
                before = np.cumsum(counts) - counts
                alone, crowded = (
                    np.concatenate([x[x < n] + b for x, n, b in zip(wanted[begin : begin + len(counts)], counts, before)]) for wanted in lists
                )
                at = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[crowded], last[crowded])] or [np.zeros(0, np.int64)])
                hashed = mix(span_hashes(prefixes, _powers(len(data) + 1, _BACK), at, length)) if len(at) else np.zeros(0, np.uint64)
                none = np.zeros(len(at), np.int64)
                owner = np.searchsorted(offsets, np.r_[first[alone], at], "right") - 1
                found.append(
                    [
                        np.r_[hashes[alone], hashed].view(np.int64), ids[begin + owner], np.r_[first[alone], at] - offsets[owner],
                        np.r_[last[alone] - first[alone] + 1, none], np.r_[places[alone] - first[alone], none],
                    ]
                )
                whole = data.tobytes()
                context += [whole[a : b + length] for a, b in zip(first[alone].tolist(), last[alone].tolist())]
                context += [whole[a : a + length] for a in at.tolist()]
                if len(context) > CONTEXTS_AT_ONCE:
                    yield made(found, context)
                    found, context = [], []
            if found:
                yield made(found, context)
            give_back()

    kind = "key bigint, doc bigint, start bigint, windows bigint, ahead bigint, context binary"
    return docs.select("doc", "text", "alone", "crowded").mapInArrow(run, kind)


def _runs(doc: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Spans of windows that follow each other."""
    new = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)]) if len(doc) else np.zeros(0, np.int64)
    last = np.r_[new[1:], len(doc)][: len(new)] - 1
    return pa.RecordBatch.from_arrays([pa.array(doc[new]), pa.array(start[new]), pa.array(start[last] + length)], names=["doc", "start", "end"])


def _sorted_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Spans that earlier documents have, from the suffixes of all contexts of each anchor.

    Equal windows have their anchor in the same place, so only suffixes that start as far from it are sorted together.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, firsts in whole_groups(batches, ["key"]):
            doc, start, windows, ahead = (table[c].to_numpy() for c in ("doc", "start", "windows", "ahead"))
            texts = table["context"].to_pylist()
            data = np.frombuffer(b"".join(texts), np.uint8)
            begins = np.cumsum([0, *map(len, texts)])[:-1]
            owner = np.repeat(np.arange(len(doc)), windows)
            shift = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
            group = np.searchsorted(firsts, owner, "right")
            away = shift - ahead[owner]
            dealt = np.lexsort((away, group))
            owner, shift, group, away = owner[dealt], shift[dealt], group[dealt], away[dealt]
            group = np.cumsum(np.r_[True, (group[1:] != group[:-1]) | (away[1:] != away[:-1])])
            order, equal = sort_suffixes(data, begins[owner] + shift, group, length)
            runs = np.flatnonzero(~equal)
            lowest = np.minimum.reduceat(doc[owner[order]], runs)[np.cumsum(~equal) - 1]
            hit = np.sort(order[doc[owner[order]] > lowest])
            place = np.lexsort((start[owner[hit]] + shift[hit], doc[owner[hit]]))
            yield _runs(doc[owner[hit]][place], (start[owner[hit]] + shift[hit])[place], length)

    some = contexts.select("key", "doc", "start", "windows", "ahead", "context").repartition("key").sortWithinPartitions("key", "doc", "start")
    return some.mapInArrow(run, "doc bigint, start bigint, end bigint")


def _covers(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where in its text the context of each anchor starts and ends, and the number of anchors before each text."""
    _, _, first, last = anchors(data, length, offsets=offsets)
    begins = offsets[_numbered(first, offsets)[0]]
    return first - begins, last + length - begins, np.searchsorted(first, offsets)


def _results(rows: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies, places, spans = (batch.column(i).to_pylist() for i in (2, 3, 4))
            sizes, removed, counts, digests = [], [], [], []
            for begin, data, offsets in blocks(batch.column(1), AT_ONCE):
                starts, ends, cuts = _covers(data, offsets, length) if any(places[begin : begin + len(offsets) - 1]) else (None, None, None)
                for i in range(len(offsets) - 1):
                    text, row = data[offsets[i] : offsets[i + 1]], begin + i
                    steps = np.zeros(len(text) + 1, np.int64)
                    if copies[row] and len(text) >= length:
                        steps[0], steps[-1] = 1, -1
                    elif places[row] or spans[row]:
                        if places[row]:
                            at = np.array(places[row], np.int64) + cuts[i]
                            at = at[at < cuts[i + 1]]
                            np.add.at(steps, starts[at], 1)
                            np.add.at(steps, ends[at], -1)
                        for span in spans[row] or []:
                            if span["end"] <= len(text):
                                steps[span["start"]] += 1
                                steps[span["end"]] -= 1
                    gone = np.cumsum(steps[:-1]) > 0
                    sizes.append(len(text))
                    removed.append(int(gone.sum()))
                    counts.append(int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0)
                    digests.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
            columns = [pa.array(x, pa.int64()) for x in (sizes, removed, counts)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, pa.array(digests, pa.string())], names=names)
            give_back()

    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def repeated_strings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, once all bytes are removed that lie in a string of ``length``
    bytes that also starts in a document with a smaller id.

    Null texts are empty. Rows without an id remove nothing and keep all. Rows with the same id and text are judged alike;
    texts that differ under one id are not told apart, so ids have to be unique but for repeated rows.

    Of equal texts only the first is looked into; the others go whole. A window of ``length`` bytes has an anchor
    (``suffixes.anchors``), the same one wherever it occurs, so that only one in sixteen places is shuffled. An anchor
    whose whole context an earlier document has is settled by that. What is left are anchors with several contexts: the
    suffixes of their windows are sorted (``suffixes.sort_suffixes``), and equal neighbours go by the smallest document.
    An anchor with more than CROWD contexts is not brought together: its windows are grouped by their bytes, each on its own.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    several = rows.where(F.octet_length("text") >= length).groupBy("digest").agg(F.min("doc").alias("first"), F.count("*").alias("n"))
    with shuffles_dropped(spark):
        several = small_side(settle(several.where("n > 1").select("digest", "first")))
        rows = rows.join(several, "digest", "left").withColumn("copy", F.coalesce(F.col("first") < F.col("doc"), F.lit(False))).drop("digest", "first")
        own = rows.where("not copy and doc is not null")

        judged = stored(_dealt_anchors(own, length).mapInArrow(_judged, "anchor bigint, doc bigint, place int, covered boolean"))
        several = judged.where("not covered").groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), F.count("*").alias("n"))
        several = settle(several.where("low < high").select("anchor", (F.col("n") > CROWD).alias("crowd")))
        open_ = judged.where("not covered").join(several, "anchor").select("doc", "place", "crowd")
        every = judged.where("covered").select("doc", "place", F.lit(None).cast("boolean").alias("crowd")).union(open_)
        place = F.col("place")
        marks = every.groupBy("doc").agg(
            F.array_distinct(F.collect_list(F.when(F.col("crowd").isNull(), place))).alias("places"),
            F.array_distinct(F.collect_list(F.when(~F.col("crowd"), place))).alias("alone"),
            F.array_distinct(F.collect_list(F.when(F.col("crowd"), place))).alias("crowded"),
        )
        marks = stored(marks)

        wanted = small_side(marks.where("size(alone) + size(crowded) > 0").select("doc", "alone", "crowded"), MARKS_BYTES)
        contexts = stored(_open_contexts(own.join(wanted, "doc"), length))
        windows = contexts.where("windows = 0")
        lows = settle(windows.groupBy("key", "context").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("key", "context", "low"))
        crowd = windows.join(lows, ["key", "context"]).where("low < doc").select("doc", "start", (F.col("start") + length).alias("end"))
        spans = _sorted_spans(contexts.where("windows > 0"), length).union(crowd)
        spans = spans.distinct().groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
        made = small_side(stored(marks.where("size(places) > 0").select("doc", "places").join(spans, "doc", "full")), MARKS_BYTES)
    return _results(rows.join(made, "doc", "left").select("doc", "text", "copy", "places", "spans"), length)
