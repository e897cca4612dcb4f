"""String tiling against a plain version, and contaminated documents against all pairs."""

import random
import re
import time

import numpy as np
from common import documents, prose

from tidelog.llm import decontaminate
from tidelog.llm.decontaminate import covered, overlaps, tiles, uncontaminated


def slow_tiles(doc, item, least):
    """Greedy string tiling as first described: all matches are compared anew for each longest one."""
    free_doc, free_item, out = [True] * len(doc), [True] * len(item), []
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                n = 0
                while i + n < len(doc) and j + n < len(item) and doc[i + n] == item[j + n] and free_doc[i + n] and free_item[j + n]:
                    n += 1
                best = max(best, (n, -j, -i))
        n, j, i = best[0], -best[1], -best[2]
        if n < least:
            return out
        free_doc[i : i + n] = free_item[j : j + n] = [False] * n
        out.append((i, j, n))


def test_tiles_are_the_greedy_ones():
    draw = random.Random(4)
    for _ in range(300):
        letters = draw.choice([2, 3, 8])
        doc, item = ([draw.randrange(letters) for _ in range(draw.randrange(30))] for _ in range(2))
        least = draw.choice([2, 3, 5])
        got = tiles(np.array(doc, np.uint64), np.array(item, np.uint64), least)
        want = slow_tiles(doc, item, least)
        assert sorted(n for *_, n in got) == sorted(n for *_, n in want), (doc, item, least)
        for i, j, n in got:
            assert doc[i : i + n] == item[j : j + n]
        for side in (0, 1):
            places = [p for t in got for p in range(t[side], t[side] + t[2])]
            assert len(places) == len(set(places))


def test_equal_hashes_of_different_windows(monkeypatch):
    monkeypatch.setattr(decontaminate, "_BASE", np.uint64(1))  # a hash is the sum of its tokens
    monkeypatch.setattr(decontaminate, "_BACK", np.uint64(1))
    test_tiles_are_the_greedy_ones()


def test_repetitive_texts_take_no_longer():
    item = np.full(30, 7, np.uint64)
    start = time.monotonic()
    assert tiles(np.full(500_000, 7, np.uint64), item) == [(0, 0, 30)]  # a text of 1 MB
    assert time.monotonic() - start < 1
    start = time.monotonic()
    assert covered(np.tile(np.arange(1, 4, dtype=np.uint64), 100_000), np.tile(np.arange(1, 4, dtype=np.uint64), 400)) == 1200
    assert time.monotonic() - start < 2


def test_only_parts_with_seeds_are_tiled():
    draw = random.Random(5)
    for _ in range(200):
        doc, item = (np.array([draw.randrange(4) + 1 for _ in range(draw.randrange(60))], np.uint64) for _ in range(2))
        assert covered(doc, item, 4) == sum(n for *_, n in tiles(doc, item, 4))


ITEMS = [" ".join(prose(s, 30)) for s in range(6)] + ["too short", "", None]


def cases():
    one = ITEMS[0].split()
    return [
        "start, " + ITEMS[0].upper().replace(" ", ", ") + " end",  # case and punctuation
        " ".join([*one[20:], "x", *one[10:20], "y", *one[:10]]),  # reordered passages
        " ".join(one[:10]),  # a third
        "nothing of the kind",
        None,
        "",
        " ".join(prose(50, 5000)) + " " + ITEMS[1] + " " + ITEMS[2],
        ITEMS[1],
        ITEMS[1],
    ]


def test_overlaps_against_all_pairs(spark, monkeypatch):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    want = []
    for d, doc in enumerate(cases()):
        for i, item in enumerate(ITEMS):
            a, b = words(doc), words(item)
            n = sum(t[2] for t in tiles(*(np.array([hash(w) & (2**63 - 1) for w in x], np.uint64) for x in (a, b)))) if a and b else 0
            if n:
                want.append((d, i, len(b), n))
    items = spark.createDataFrame(list(enumerate(ITEMS)), "item_id bigint, text string")
    docs = documents(spark, cases(), extra="row,hits,item_id")
    for at_once in (1 << 20, 40):  # one part, and several
        monkeypatch.setattr(decontaminate, "SEEDS_AT_ONCE", at_once)
        got = sorted(tuple(r) for r in overlaps(docs, items).select("doc_id", "item_id", "item_words", "covered").collect())
        assert got == sorted(want)
        clean = uncontaminated(docs, items)
        assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 5] and clean.columns == docs.columns
    assert (1, 0, 30, 30) in want and (2, 0, 30, 10) in want


def test_a_text_of_many_items_is_sent_once(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SEEDS_AT_ONCE", 60)
    texts = [ITEMS[0]] * 50 + ITEMS[1:6]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    parts = [p.value for p in decontaminate._parts(items, "text", 5)]
    assert sum(len(keys) for keys, *_ in parts) == 6 and len(parts) > 1
    assert all(len(values) < 60 + 26 for _, _, values, _ in parts)
    got = overlaps(documents(spark, [ITEMS[0], ITEMS[0]]), items)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == [(d, i) for d in range(2) for i in range(50)]


def test_empty_tables(spark):
    items = spark.createDataFrame(list(enumerate(ITEMS)), "item_id bigint, text string")
    docs = documents(spark, cases())
    assert overlaps(docs.where("false"), items).collect() == []
    assert overlaps(docs, items.where("false")).collect() == []
    assert uncontaminated(docs, items.where("false")).count() == len(cases())
