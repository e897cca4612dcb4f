"""Whitening: eigenvectors against numpy's, the whole against a plain computation, odd vectors."""

import os
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from tidelog.llm import whitening
from tidelog.llm.eigen import below, largest, leading, tridiagonal
from tidelog.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def matrices():
    draw = np.random.default_rng(3)
    turned, _ = np.linalg.qr(draw.standard_normal((40, 40)))
    for n in (1, 2, 3, 30, 64):
        x = draw.standard_normal((200, n))
        yield x.T @ x
    yield np.eye(20)
    yield np.zeros((5, 5))
    yield np.diag([5.0] * 10 + [3.0] * 10)
    yield turned @ np.diag([7.0] * 20 + [1.0] * 20) @ turned.T
    yield turned @ np.diag(10.0 ** -np.arange(40)) @ turned.T
    x = draw.standard_normal((100, 6))
    x = np.c_[x, x]
    yield x.T @ x
    apart = np.zeros((20, 20))
    apart[:10, :10] = apart[10:, 10:] = np.cov(draw.standard_normal((10, 50)))
    yield apart * 1e200


def test_eigenvectors():
    for a in matrices():
        values, vectors = leading(a, 16)
        scale = np.abs(a).max() or 1.0
        want = np.linalg.eigvalsh(a / scale)[::-1][:16]
        assert np.allclose(values / scale, want, atol=1e-13, rtol=1e-13)
        assert np.abs((a / scale) @ vectors.T - (values / scale)[:, None].T * vectors.T).max() < 1e-13 * len(a)
        assert np.abs(vectors @ vectors.T - np.eye(len(vectors))).max() < 1e-13


def test_counts_and_tridiagonal_form():
    draw = np.random.default_rng(4)
    a = draw.standard_normal((12, 12))
    a = a + a.T
    diagonal, off, _ = tridiagonal(a)
    whole = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    values = np.linalg.eigvalsh(a)
    assert np.allclose(np.linalg.eigvalsh(whole), values, atol=1e-12)
    at = np.r_[values - 1e-9, values + 1e-9, 0.0]
    assert below(diagonal, off, at).tolist() == [int((values < x).sum()) for x in at]
    assert np.allclose(largest(diagonal, off, 12), values[::-1], atol=1e-12)


def plain(rows):
    """{vec_id: (deviation, centred)} and n, e, V by plain means, from the different vectors."""
    kept = [(i, [floor(64 * float(c)) + 1000000 for c in v]) for i, v in rows if v is not None and all(c is not None and isfinite(c) for c in v)]
    different = sorted({tuple(x) for _, x in kept})
    n, sums = len(different), [sum(c) for c in zip(*different)]
    means = [Fraction(s, n) for s in sums]
    z = np.array([[float(c - m) for c, m in zip(x, means)] for x in different])
    out = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums)), np.array([float(c - m) for c, m in zip(x, means)])) for i, x in kept]
    return out, n, z.T @ z / n


def compared(rows, got):
    want, n, v = plain(rows)
    values = np.linalg.eigvalsh(v)[::-1]
    values = values[values > 1e-10 * values[0]][:16]
    assert len(got) == len(want) * len(values)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
        assert r.n == n and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / np.trace(v)) < 1e-12
    w = np.array([[by_id[i][c + 1].whitened for c in range(len(values))] for i, _, _ in want])
    z = np.array([x for _, _, x in want])
    assert {by_id[i][1].deviation == d for i, d, _ in want} == {True}
    # the components that give these projections are eigenvectors, whatever their sign
    components = np.linalg.lstsq(z, w * np.sqrt(values), rcond=None)[0].T
    components = components @ np.linalg.pinv(z) @ z
    assert np.abs(components @ v - values[:, None] * components).max() < 1e-9 * values[0]
    assert np.abs(np.linalg.norm(components, axis=1) - 1).max() < 1e-9


def test_query_against_plain_computation(spark, tmp_path):
    draw = np.random.default_rng(5)
    vectors = (draw.standard_normal((60, 5)) @ draw.standard_normal((5, 20))).astype(np.float32).tolist()
    rows = list(enumerate(vectors)) + [(100 + i, vectors[0]) for i in range(40)]  # many copies
    rows += [(200, None), (201, [None] + [0.5] * 19), (202, [float("nan")] * 20), (203, [float("inf")] + [0.0] * 19), (0, vectors[3])]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id bigint, embedding array<float>, label int, row string")
    frame.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op11_whitening"](spark, str(tmp_path)).collect()
    # two rows of one id: both are there, and told apart by their deviations
    want = [d for i, d, _ in plain(rows)[0] if i == 0]
    assert len(set(want)) == 2 and {r.deviation for r in got if r.vec_id == 0} == set(want)
    compared(rows[:-1], [r for r in got if r.vec_id != 0 or r.deviation == want[0]])


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "id int, x array<bigint>, row int")


def test_lengths_nulls_equal_and_no_vectors(spark):
    rows = [(1, [1, 2], 0), (2, [3, 5], 0), (3, [4, 4], 0), (4, [1, 2, 3], 0), (5, None, 0), (6, [], 0), (None, [1, 2], None)]
    fitted, several = whitening.fit(frame_of(spark, rows), "x", 16)
    assert (fitted.n, fitted.sums, len(fitted.values)) == (3, [8, 11], 2)
    got = whitening.whiten(frame_of(spark, rows), "x", ["id", "row"], fitted).collect()
    assert sorted((r.row.id or 0) for r in got) == [0, 1, 2, 3]
    assert {int(r.deviation) for r in got if r.row.id in (None, 1)} == {(3 - 8) ** 2 + (6 - 11) ** 2}
    assert whitening.identity_error(fitted, several) < 1e-12
    for nothing in ([(1, [7, 7], 0)] * 3, [(1, None, 0)], []):
        fitted, several = whitening.fit(frame_of(spark, nothing), "x", 16)
        assert len(fitted.values) == 0 and whitening.identity_error(fitted, several) is None
        assert {tuple(r.whitened) for r in whitening.whiten(frame_of(spark, nothing), "x", ["id"], fitted).collect()} <= {()}
    with pytest.raises(ValueError):
        whitening.fit(frame_of(spark, [(1, [1] * 5000, 0)]), "x", 16)


def test_wide_numbers_are_exact(spark):
    big = 1 << 61
    rows = [(1, [big, 0], 0), (2, [-big, 1], 0), (3, [big - 1, 5], 0)]
    fitted, _ = whitening.fit(frame_of(spark, rows), "x", 1)
    assert fitted.sums == [big - 1, 6]
    assert fitted.squares(np.array([rows[0][1]])) == [(3 * big - (big - 1)) ** 2 + 36]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")
def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compared(rows, QUERIES["op11_whitening"](spark, SF_DIR).collect())
