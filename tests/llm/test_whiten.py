"""Whitening against a dense eigendecomposition, and on odd rows and spectra."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import queries, whiten

SCHEMA = "vec_id bigint, embedding array<float>"


def dense(vectors, k=32):
    """(x, exact deviations, eigenvalues, eigenvectors) by numpy on all rows at once."""
    x = np.floor(64 * np.asarray(vectors, dtype=np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    off = x - np.array(sums) / n
    e, v = np.linalg.eigh(off.T @ off / n)
    return off, deviation, e[::-1][:k], v[:, ::-1][:, :k], np.trace(off.T @ off / n)


def table(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id if "vec_id" in df.columns else r.id, {})[r.component] = r
    return out


def compare(got, ids, vectors, k):
    off, deviation, e, v, trace = dense(vectors, k)
    want = off @ v / np.sqrt(e)
    have = np.array([[got[i][c + 1].whitened for c in range(k)] for i in ids])
    signs = np.sign((have * want).sum(axis=0))
    assert np.abs(have * signs - want).max() < 1e-7
    for row, i in enumerate(ids):
        assert set(got[i]) == set(range(1, k + 1))
        for c in range(k):
            r = got[i][c + 1]
            assert r.n == len(ids) and int(r.deviation) == deviation[row]
            assert math.isclose(r.explained, e[c] / trace, rel_tol=1e-9) and r.identity_error < 1e-9


def test_query_equals_dense_eigenvectors(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    out = queries.op11_embedding_whitening(spark, folder)
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
                                "whitened": "double", "explained": "double", "identity_error": "double"}
    compare(table(out), [i for i, _ in rows], [v for _, v in rows], 32)


def test_odd_rows_are_left_out(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(np.float32(c)) for c in rng.standard_normal(5) * [9, 5, 3, 2, 1]]) for i in range(40)]
    good += [(40, good[0][1]), (41, good[0][1])]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [float("nan")] * 5),
           (104, [1.0, 2.0, float("inf"), 3.0, 4.0]), (105, [1.0, 2.0, 3.0])]
    docs = spark.createDataFrame(good + odd, SCHEMA).withColumns(
        {"id": F.lit("x"), "x": F.lit(1), "n": F.lit(2), "component": F.lit(3)}).repartition(5)
    got = table(whiten.whiten(docs))
    assert set(got) == {i for i, _ in good}
    compare(got, [i for i, _ in good], [v for _, v in good], 5)


def test_empty_constant_and_few_rows(spark):
    assert whiten.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whiten.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).count() == 0
    got = table(whiten.whiten(spark.createDataFrame(
        [(1, [1.0, 2.0, 5.0]), (2, [3.0, 2.0, 1.0]), (None, [4.0, 2.0, 8.0])], SCHEMA)))
    assert all(set(x) == {1, 2} for x in got.values()) and len(got) == 3  # three rows span two directions


def test_large_entries_raise(spark):
    docs = spark.createDataFrame([(1, [1e30, 2.0]), (2, [3.0, 2.0])], SCHEMA)
    with pytest.raises(Exception, match="above 2\\*\\*40"):
        whiten.whiten(docs).collect()


def spectrum(values, n=600, seed=3):
    rng = np.random.default_rng(seed)
    d = len(values)
    u, _ = np.linalg.qr(rng.standard_normal((n, d)))
    v, _ = np.linalg.qr(rng.standard_normal((d, d)))
    return (u * values) @ v.T


@pytest.mark.parametrize("values, passes", [
    (np.geomspace(1000, 1, 64), 70), (np.r_[[50.0] * 40, [3.0] * 24], 130), (np.geomspace(1, 1e-8, 200), 90),
    (np.r_[np.geomspace(1000, 100, 40), np.full(300, 0.5)], 100), (np.r_[np.linspace(9, 8, 10), np.zeros(20)], 20),
    (np.r_[[70.0, 70.0, 70.0], np.geomspace(60, 20, 50), np.geomspace(1, 0.01, 200)], 100),
    (np.r_[np.ones(20), np.geomspace(1, 1e-6, 30), np.zeros(30)], 90)])
def test_bidiagonalisation_finds_repeated_and_missing_directions(values, passes):
    x = spectrum(values)
    calls = []

    def product(p):
        calls.append(1)
        u = x @ p
        return u @ u, x.T @ u

    found, vectors = whiten.bidiagonalise(product, len(values), 32)
    want = np.sort(values)[::-1][:32]
    assert np.abs(found - want[:len(found)]).max() < 1e-11 * want[0] and (want[len(found):] == 0).all()
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    assert np.abs(x.T @ (x @ vectors) - vectors * found ** 2).max() < 1e-11 * want[0] ** 2
    assert len(calls) <= passes


def test_deviations_are_exact_in_all_ranges():
    rng = np.random.default_rng(4)
    for size, n in ((100, 50), (1 << 30, 1000), (1 << 45, 10**12)):
        x = rng.integers(-size, size, (20, 7))
        sums = [int(v) * n // 20 + 3 for v in x.sum(axis=0)]
        want = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
        assert whiten.deviations(x, n, sums) == want
