"""Repeated strings against all windows of all documents; suffix order against Python's."""

import hashlib
import os
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from common import documents, edited, prose

from tidelog.llm import substrings
from tidelog.llm.substrings import repeated_strings
from tidelog.llm.suffixes import anchors, sort_suffixes

SF_DIR = "/root/testdata/sf0.001"


def brute(ids, texts, length):
    first = {}
    data = [(t or "").encode() for t in texts]
    for d, b in zip(ids, data):
        if d is not None:
            for i in range(len(b) - length + 1):
                w = b[i : i + length]
                first[w] = min(d, first.get(w, d))
    out = []
    for d, b in zip(ids, data):
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if d is not None and first[b[i : i + length]] < d:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


@pytest.fixture(scope="module")
def texts():
    base = [" ".join(prose(s, 80, 3000)) for s in range(8)]
    passage = " ".join(prose(77, 30, 3000))
    out = list(base)
    out += [" ".join(edited(base[s % 8].split(), s, 1 + s % 5)) for s in range(24)]
    out += [f"{' '.join(prose(200 + s, 20))} {passage} {' '.join(prose(300 + s, 20))}" for s in range(15)]
    out += [passage[3:52], passage[3:53], passage[3:54], "é" * 24 + "a", "é" * 25, "é" * 26, "b" + "é" * 25]
    out += ["ab" * 200, "ab" * 30, "ba" * 40, "x" * 49, "x" * 49, "x" * 50, "x" * 300, "x" * 50, "", None, base[0], base[0]]
    return out


@pytest.mark.parametrize("crowd, hot, together", [(500, 100, 10**6), (2, 100, 50), (500, 2, 50), (2, 1, 10**6)])
def test_against_all_windows(spark, texts, monkeypatch, crowd, hot, together):
    """However anchors are dealt and whatever counts as a crowd."""
    monkeypatch.setattr(substrings, "CROWD", crowd)
    monkeypatch.setattr(substrings, "HOT_ROWS", hot)
    monkeypatch.setattr(substrings, "COMBINED_ROWS", together)
    monkeypatch.setattr(substrings, "MARKS_BYTES", 0 if hot == 2 else 1 << 20)
    ids = list(range(len(texts)))
    random.Random(3).shuffle(ids)
    df = documents(spark, texts, ids, extra="doc,n_bytes,places,spans,copy")
    assert rows(repeated_strings(df)) == brute(ids, texts, 50)


def test_rows_without_id_and_repeated_rows(spark, texts):
    some, ids = [texts[0], texts[0], texts[8], texts[0], texts[8], texts[0]], [7, None, 9, 7, 9, 3]
    assert rows(repeated_strings(documents(spark, some, ids))) == brute(ids, some, 50)


def test_contexts_whose_hashes_share_36_bits(spark):
    from tidelog.llm.suffixes import _BACK, _powers, prefix_hashes, span_hashes
    from tidelog.llm.texts import mix

    ends = "urxtjfixtryjxcerqxahpybz", "otihbydngksdgknhxkeyzdzs"  # around an anchor, and what differs on both sides of it
    some = [f"{ends[0]}{a}uqgadjbavqlylrimtfcp{b}{ends[1]}" for a, b in (("tsjkek", "akagbi"), ("lrnodx", "ijjsex"), ("ouspjf", "qjxkkn"), ("gmyqaj", "hqefrk"))]
    hashes = []
    for text in some:
        data = np.frombuffer(text.encode(), np.uint8)
        hashes.append(int(mix(span_hashes(prefix_hashes(data), _powers(81, _BACK), np.array([0]), 80))[0]) >> 28)
    assert hashes[0] == hashes[1] and hashes[2] == hashes[3]
    got = rows(repeated_strings(documents(spark, some, [1, 2, 3, 4])))
    assert got == brute([1, 2, 3, 4], some, 50) and not any(r[2] for r in got)


def test_empty_table(spark):
    assert repeated_strings(documents(spark, ["x"]).where("false")).collect() == []


def test_long_text(spark):
    long = " ".join(prose(1, 60000, 50000))
    some = ["start " + long[100000:100200] + " end", long, long[:1000]]
    assert rows(repeated_strings(documents(spark, some, [2, 5, 9]))) == brute([2, 5, 9], some, 50)


def test_anchors_are_those_of_the_window_alone():
    draw = random.Random(1)
    for letters in (1, 2, 4, 200):
        data = np.array([draw.randrange(letters) for _ in range(300)], np.uint8)
        places, hashes, first, last = anchors(data, 50)
        assert first[0] == 0 and last[-1] == 250 and (first[1:] == last[:-1] + 1).all()
        for p, h, a, b in zip(places, hashes, first, last):
            for w in range(a, b + 1):
                place, own, *_ = anchors(data[w : w + 50], 50)
                assert place[0] == p - w and own[0] == h and 0 <= p - w <= 30


def test_suffixes_are_sorted():
    draw = random.Random(2)
    for letters in (1, 2, 30):
        data = np.array([draw.randrange(letters) for _ in range(400)], np.uint8)
        at = np.array([draw.randrange(390) for _ in range(150)])
        group = np.sort([draw.randrange(9) for _ in range(150)])
        order, equal = sort_suffixes(data, at, group, 10)
        said = [(g, bytes(data[a : a + 10])) for g, a in zip(group[order], at[order])]
        assert sorted(order.tolist()) == list(range(150)) and said == sorted(said)
        assert equal.tolist() == [False] + [x == y for x, y in zip(said, said[1:])]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")
def test_query_on_the_table(spark):
    from tidelog.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert rows(QUERIES["op3_substrings"](spark, SF_DIR)) == brute([r.doc_id for r in docs], [r.text for r in docs], 50)


def test_anchors_of_many_texts_are_those_of_each_alone():
    """Texts are looked at together, so that many short ones do not cost a call each; short, empty and periodic ones among them."""
    draw = random.Random(4)
    sizes = [0, 49, 50, 51, 300, 0, 0, 10, 80, 99, 49, 200, 0]
    some = [np.array([draw.randrange(k) for _ in range(n)], np.uint8) for k in (1, 2, 200) for n in draw.sample(sizes, len(sizes))]
    offsets = np.cumsum([0, *map(len, some)])
    got = anchors(np.concatenate(some), 50, offsets=offsets)
    each = [anchors(x, 50) for x in some]
    for i, moved in enumerate((True, False, True, True)):
        assert got[i].tolist() == [v for x, o in zip(each, offsets.tolist()) for v in (x[i] + o if moved else x[i]).tolist()]
    *_, owner, number = substrings._contexts(np.concatenate(some), 50, offsets)
    assert list(zip(owner.tolist(), number.tolist())) == [(i, j) for i, x in enumerate(each) for j in range(len(x[0]))]


def test_anchors_of_one_text_do_not_depend_on_what_is_beside_it():
    """Cutting the data elsewhere changes neither places nor hashes."""
    draw = random.Random(5)
    text = np.array([draw.randrange(3) for _ in range(500)], np.uint8)
    alone = anchors(text, 50)
    for before, after in ((0, 7), (1, 0), (60, 60), (31, 200)):
        data = np.concatenate([np.full(before, 1, np.uint8), text, text[:after]])
        places, hashes, first, last = anchors(data, 50, offsets=np.array([0, before, before + 500, len(data)]))
        own = (first >= before) & (first < before + 500)
        assert (places[own] - before).tolist() == alone[0].tolist() and hashes[own].tolist() == alone[1].tolist()
        assert (first[own] - before).tolist() == alone[2].tolist() and (last[own] - before).tolist() == alone[3].tolist()


def _shuffle_files(spark):
    """Sizes of the shuffle files on disk, by name."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}


def test_steps_leave_no_shuffle_files_behind(spark, texts, monkeypatch):
    """Of eight steps each writes its rows down; all shuffles together took five times the input."""
    monkeypatch.setattr(substrings, "MARKS_BYTES", 0)
    ids = list(range(len(texts)))
    df = documents(spark, texts, ids)
    old = set(_shuffle_files(spark))
    found = repeated_strings(df)
    until = time.time() + 20  # they are removed in the background
    while (left := set(_shuffle_files(spark)) - old) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert rows(found) == brute(ids, texts, 50)


def test_parcels_hold_anchors_as_they_came():
    """Open anchors of equal hash in one part, and no more than 27 bytes for each; what is covered only as document and place."""
    draw = np.random.default_rng(3)
    n = 20000
    anchor, context, second = (draw.integers(-(1 << 63), (1 << 63) - 1, (31, n)).view(np.uint64).min(axis=0).view(np.int64) for _ in range(3))
    anchor[100:200] = anchor[:100]
    for lowest, ids, places in ((-(1 << 63), 1 << 62, 1 << 30), (7_000_000_000, 4000, 200), (5, 1, 1)):
        doc, place = draw.integers(0, ids, n) + lowest, draw.integers(0, places, n).astype(np.int32)
        kind = draw.choice([substrings.PLAIN, substrings.COVERED, substrings.HOT], n, p=[0.8, 0.1, 0.1]).astype(np.int8)
        for parts in (1, 7, 50):
            parcels = [x for batch in substrings._parcels([anchor, context, second, doc, place, kind], parts) for x in batch.column(1)]
            got = [substrings._unpacked(x.as_buffer()) for x in parcels]
            where = [set(x[0][0].tolist()) for x in got]
            assert len(parcels) <= parts and max(map(len, where)) < 1.3 * n / parts and sum(map(len, where)) == len(set().union(*where))
            rest, known = kind != substrings.COVERED, kind == substrings.COVERED
            said = sorted(t for x in got for t in zip(*(c.tolist() for c in x[0])))
            assert said == sorted(zip(*(c[rest].tolist() for c in (anchor, context, second, doc, place, kind))))
            assert sorted(t for x in got for t in zip(*(c.tolist() for c in x[1]))) == sorted(zip(doc[known].tolist(), place[known].tolist()))
            if ids == 4000:
                assert len(pa.compress(b"".join(x.as_py() for x in parcels), "lz4_raw", asbytes=True)) < 27 * n
