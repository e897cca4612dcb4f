"""Near-duplicates against all pairs."""

import re

import pytest
from common import documents, edited, prose

from tidelog.llm import graph, neardup
from tidelog.llm.graph import components
from tidelog.llm.neardup import DISTANCE, chunk_keys, near_duplicates, signatures, word_sets


def shingle_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def brute(ids, texts, n, percent):
    sets = [shingle_set(t, n) for t in texts]
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, d in enumerate(ids):
        low[root(i)] = min(d, low.get(root(i), d))
    return sorted((d, len(sets[i]), low[root(i)], low[root(i)] == d) for i, d in enumerate(ids))


def rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


@pytest.fixture(scope="module")
def texts():
    base = [prose(s, 60 + 5 * s) for s in range(12)]
    out = [" ".join(b) for b in base]
    out += [" ".join(edited(base[s % 12], s, s % 5)) for s in range(40)]
    chain = base[3]
    for s in range(12):  # each near the one before, the ends far apart
        chain = edited(chain, 100 + s, 2)
        out.append(" ".join(chain))
    out += ["", " \t\n", None, "One two", "one  TWO", "ONE", "É é", "é é", out[0], out[0].upper(), "a b c d", "a b c d a b c d"]
    return out


def test_against_all_pairs(spark, texts):
    ids = [1000 - 7 * i for i in range(len(texts))]
    df = documents(spark, texts, ids, extra="n_shingles,kept,component_id,node,digest")
    assert rows(near_duplicates(df, n=4)) == brute(ids, texts, 4, 80)


@pytest.mark.parametrize("at_once", [100_000, 3000])
def test_large_group_of_near_copies(spark, monkeypatch, at_once):
    monkeypatch.setattr(neardup, "ITEMS_AT_ONCE", at_once)  # one block, and several
    base = prose(1, 150)
    texts = [" ".join(edited(base, s, 1 + s % 9)) for s in range(300)] + [" ".join(base)] * 50
    assert rows(near_duplicates(documents(spark, texts))) == brute(range(350), texts, 5, 80)


def test_rows_without_id_and_repeated_ids(spark):
    one, two = " ".join(prose(1, 50)), " ".join(prose(2, 50))
    got = near_duplicates(documents(spark, [one, one, one, two, one], [None, 3, 5, 5, 5])).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted(
        [(None, None, True), (3, 3, True), (5, 3, False), (5, 3, False), (5, 3, False)], key=str
    )


def test_repeated_id_joins_its_texts(spark):
    one, two = " ".join(prose(1, 50)), " ".join(prose(2, 50))
    got = near_duplicates(documents(spark, [one, one, two, two], [1, 2, 2, 3]))
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {(1, 1), (2, 1), (3, 1)}


def test_empty_table(spark):
    assert near_duplicates(documents(spark, ["x"]).where("false")).collect() == []


def far_signatures(t):
    """Two texts with 80 of 100 words in common, whose signatures share a key and differ in more than DISTANCE values."""
    base = [f"w{t}x{i}" for i in range(90)]
    return [" ".join(base), " ".join(base[:80] + [f"v{t}x{i}" for i in range(10)])]


def test_near_sets_with_far_signatures(spark):
    texts = [x for t in (2320, 3469, 9050) for x in far_signatures(t)]
    assert rows(near_duplicates(documents(spark, texts), n=1)) == brute(range(6), texts, 1, 80)
    assert {c for _, _, c, _ in brute(range(6), texts, 1, 80)} == {0, 2, 4}


def test_near_sets_with_far_signatures_in_blocks():
    import numpy as np
    import pyarrow as pa

    from tidelog.llm.neardup import _links_of_unit

    sets = list(word_sets(pa.array(far_signatures(3469)), 1))
    signs, sizes = signatures(sets), np.array([len(x) for x in sets])
    assert (signs[0] != signs[1]).sum() > DISTANCE
    side = {"node": np.array([1, 2]), "component": np.array([1, 2]), "common": sizes, "items": sets, "size": sizes, "sign": signs.astype(np.uint16)}
    key = min(np.intersect1d(*chunk_keys(signs)), key=lambda k: int(k) >> 48)
    assert _links_of_unit(int(key), True, [side, side], 80) == [(1, 2)]


def test_chunks_guarantee_the_distance():
    import numpy as np

    draw = np.random.default_rng(5)
    for _ in range(200):
        one = draw.integers(0, 1 << 16, 32).astype(np.uint64)
        two = one.copy()
        two[draw.choice(32, DISTANCE, replace=False)] ^= np.uint64(1)
        assert np.intersect1d(chunk_keys(one[None]), chunk_keys(two[None])).size


def test_pairs_are_compared_under_their_first_key():
    import numpy as np

    from tidelog.llm.neardup import _first_shared

    draw = np.random.default_rng(6)
    one = draw.integers(0, 3, (20, 32)).astype(np.uint16)
    first, apart = _first_shared(one, one[:7])
    keys = chunk_keys(one.astype(np.uint64))
    for i in range(20):
        for j in range(7):
            shared = [k for k in range(32) if keys[i, k] == keys[j, k]]
            assert first[i, j] == (min(int(keys[i, k]) >> 48 for k in shared) if shared else 32)
            assert apart[i, j] == (one[i] != one[j]).sum()


def test_signatures_estimate_similarity():
    import numpy as np
    import pyarrow as pa

    base = prose(9, 400, words=5000)
    sets = list(word_sets(pa.array([" ".join(base), " ".join(base[:360] + prose(10, 40, 5000))]), 1))
    one, two = signatures(sets)
    true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    assert abs((one == two).mean() - true) < 0.25


@pytest.mark.parametrize("at_once", [500_000, 15])
def test_components(spark, monkeypatch, at_once):
    monkeypatch.setattr(graph, "LINKS_AT_ONCE", at_once)
    links = [(1, 2), (2, 3), (9, 8), (8, 3), (20, 21), (21, 20), (5, 5)] + [(i, i + 1) for i in range(100, 140)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {1: 1, 2: 1, 3: 1, 8: 1, 9: 1, 20: 20, 21: 20} | {i: 100 for i in range(100, 141)}
    assert got == want
