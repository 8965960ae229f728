"""Whitening against NumPy's eigenvectors, spectrum slicing, edge cases."""

import math
import random
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from condmon.llm import whitening as W
from condmon.llm.queries import queries
from condmon.llm.spectrum import below, leading

from .conftest import SF_SMALL

DDL = "vec_id bigint, embedding array<float>, component string, n string"


def brute(vectors):
    """Exact sums and covariance; eigenvectors by NumPy."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    dev = [[n * r[j] - s[j] for j in range(d)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in dev), n**3)) for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    centred = np.array([[float(Fraction(v, n)) for v in r] for r in dev])
    return [sum(v * v for v in r) for r in dev], values, vectors, centred


def table(spark, vectors, ids=None):
    ids = list(range(len(vectors))) if ids is None else ids
    return spark.createDataFrame([(i, v, "x", "y") for i, v in zip(ids, vectors, strict=True)], DDL)


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["vec_id"], {})[r["component"]] = r
    return out


def test_query_against_numpy(spark):
    raw = {r["vec_id"]: r["embedding"] for r in pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pylist()}
    got = by_id(queries()["op13_whiten_embeddings"](spark, SF_SMALL))
    assert set(got) == set(raw)
    ids = sorted(raw)
    deviation, values, vectors, centred = brute([raw[i] for i in ids])
    shares = values / values.sum()
    white = centred @ vectors[:, :32] / np.sqrt(values[:32])
    mine = np.array([[got[i][k]["whitened"] for k in range(1, 33)] for i in ids])
    signs = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * signs - white).max() < 1e-8
    for i, dev in zip(ids, deviation, strict=True):
        assert sorted(got[i]) == list(range(1, 33))
        assert {r["deviation"] for r in got[i].values()} == {dev}
    assert all(abs(got[ids[0]][k]["explained"] / shares[k - 1] - 1) < 1e-9 for k in range(1, 33))
    errors = {r["identity_error"] for rows in got.values() for r in rows.values()}
    assert len(errors) == 1 and errors.pop() < 1e-9
    assert np.abs(mine.T @ mine / len(ids) - np.eye(32)).max() < 1e-9


def test_dropped_rows_repeats_and_clashing_columns(spark):
    rng = random.Random(3)
    good = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(40)]
    hot = [good[0]] * 30
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [1e30] * 5, [1.0, 2.0]]
    vectors = good + hot + bad
    ids = [*range(39), None, *[0] * 30, *range(100, 107)]
    rows = W.whiten(table(spark, vectors, ids)).collect()
    assert len(rows) == 70 * 5 and {r["n"] for r in rows} == {70}
    assert {r["vec_id"] for r in rows} == {None, *range(39)}
    same = [r["whitened"] for r in rows if r["vec_id"] == 0 and r["component"] == 1]
    assert len(same) == 31 and len(set(same)) == 1
    deviation, values, vectors, centred = brute(np.float32(good + hot).tolist())
    white = centred @ vectors / np.sqrt(values)
    for k in range(5):
        one = [r["whitened"] for r in rows if r["vec_id"] == 1 and r["component"] == k + 1]
        assert abs(abs(one[0]) - abs(white[1, k])) < 1e-9
    assert {r["deviation"] for r in rows if r["vec_id"] == 1} == {deviation[1]}


def test_no_variance_no_rows(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[]]):
        df = W.whiten(table(spark, vectors))
        assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert df.collect() == []


def test_rank_and_equal_eigenvalues(spark):
    flat = [[float(i), 2.0 * i, 1.0] for i in range(7)]  # one direction
    rows = W.whiten(table(spark, flat)).collect()
    assert {r["component"] for r in rows} == {1} and all(abs(r["explained"] - 1) < 1e-12 for r in rows)
    cube = [[float(s >> b & 1) for b in range(6)] for s in range(64)]  # six equal eigenvalues
    rows = W.whiten(table(spark, cube)).collect()
    assert len(rows) == 64 * 6 and max(r["identity_error"] for r in rows) < 1e-9


def test_large_entries_stay_exact(spark):
    big = [[2.0**40, 1.0], [-(2.0**40), 3.0], [0.0, -7.0], [2.0**41, 2.0]]
    rows = by_id(W.whiten(table(spark, big)))
    deviation = brute(big)[0]
    for i, d in enumerate(deviation):
        assert rows[i][1]["deviation"] == (d if d < 1 << 63 else None)


@pytest.mark.parametrize("kind", range(6))
def test_spectrum(kind):
    rng = np.random.default_rng(kind)
    for n in (1, 2, 3, 9, 30):
        if kind == 0:
            a = rng.standard_normal((n, n))
            a = a @ a.T
        elif kind == 1:
            a = np.eye(n) * 3
        elif kind == 2:
            a = np.diag(rng.integers(0, 4, n).astype(float))
        elif kind == 3:
            b = rng.standard_normal((n, max(1, n // 3)))
            a = b @ b.T
        elif kind == 4:
            a = rng.standard_normal((n, n))
            a = a + a.T
        else:  # close pairs
            q, _ = np.linalg.qr(rng.standard_normal((n, n)))
            a = (q * np.concatenate([[5, 5, 5 + 1e-9, 5 - 1e-7], np.linspace(1, 2, n)])[:n]) @ q.T
            a = (a + a.T) / 2
        w = np.sort(np.linalg.eigvalsh(a))[::-1]
        for s in rng.uniform(w.min() - 1, w.max() + 1, 5):
            assert below(a, s) == (w < s).sum()
        v, u = leading(a, 32, W.FLOOR)
        k = len(v)
        assert k == sum(x > max(W.FLOOR * w[0], 1e-12) for x in w)
        assert np.abs(v - w[:k]).max(initial=0) < 1e-12 * max(1, np.abs(w).max())
        assert np.abs(u.T @ u - np.eye(k)).max(initial=0) < 1e-12
        assert np.abs(a @ u - u * v).max(initial=0) < 1e-11 * max(1, np.abs(w).max())
