import math

import numpy as np
import pytest

from tickloom.llm import whitening
from tickloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(vectors):
    """Rows of (vector) by numpy's own decomposition: n, deviations, whitened up to sign, explained."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], object)
    listed = np.array(sorted({tuple(row) for row in x}), object)
    n, s = len(listed), listed.sum(0)
    centred = np.array([[float(a * n - b) / n for a, b in zip(row, s)] for row in listed])
    v = centred.T @ centred / n
    e, c = np.linalg.eigh(v)
    e, c = e[::-1][:16], c[:, ::-1][:, :16]
    rows = np.array([[float(a * n - b) / n for a, b in zip(row, s)] for row in x])
    deviation = [sum(int(n * a - b) ** 2 for a, b in zip(row, s)) for row in x]
    return n, deviation, rows @ c / np.sqrt(e), e / np.trace(v)


def check(got, ids, vectors, k):
    n, deviation, white, explained = brute(vectors)
    got = got.sort_values(["vec_id", "component"])
    assert len(got) == len(ids) * k and set(got["n"]) == {n}
    table = got["whitened"].to_numpy().reshape(-1, k)
    signs = np.sign((table * white[:, :k]).sum(0))
    assert np.allclose(table * signs, white[:, :k], atol=1e-8)
    assert list(got["deviation"])[::k] == deviation
    assert np.allclose(got["explained"].to_numpy()[:k], explained[:k], rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_query_against_an_eigensolver(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    got = QUERIES["op13_whitening"](spark, SF).toPandas()
    check(got, [r["vec_id"] for r in rows], [r["embedding"] for r in rows], 16)


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [1, 1, 1, 1, 1], [3, 3, 1, 1, 0], [9, 1e-6, 1e-9, 0, 0], [2, 2 + 1e-13, 2, 1, 1 - 1e-14], [1e9, 1, 1, 1, 1]])
def test_spectrum_of_planted_values(values):
    q, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((5, 5)))
    for basis in (q, np.eye(5)):
        a = basis @ np.diag(values) @ basis.T
        e, v = whitening.spectrum((a + a.T) / 2, 5)
        assert np.allclose(e, sorted(values, reverse=True), atol=1e-14 * max(values) * 5)
        assert np.allclose(v.T @ v, np.eye(5), atol=1e-13)
        assert np.linalg.norm(a @ v - v * e) < 1e-13 * max(values)


def test_spectrum_where_the_middle_is_an_eigenvalue():
    a = np.array([[0.0, 1, 0], [1, 0, 1], [0, 1, 0]])
    e, _ = whitening.spectrum(a, 3)
    assert np.allclose(e, [2**0.5, 0, -(2**0.5)], atol=1e-14)
    big = np.random.default_rng(3).standard_normal((200, 200))
    big = big @ big.T
    e, v = whitening.spectrum(big, 16)
    assert np.allclose(e, np.linalg.eigvalsh(big)[::-1][:16], rtol=1e-12)


def test_polar_factor_of_a_nearly_singular_matrix():
    q, _ = np.linalg.qr(np.random.default_rng(2).standard_normal((6, 6)))
    a = q @ np.diag([1, -1, 1e-3, -1e-9, 1e-14, 0.5]) @ q.T
    u = whitening.polar_factor((a + a.T) / 2)
    assert np.allclose(u @ u, np.eye(6), atol=1e-12)
    assert np.allclose(u, q @ np.diag([1, -1, 1, -1, 1, 1]) @ q.T, atol=1e-2)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.1, -0.2, 3.0], [5.5, 0.0, 1.0], [0.1, -0.2, 3.0], [-4.0, 2.0, 9.0], [0.1, -0.2, 3.001], [70.0, -100.0, 2.0]]
    rows = [(i, v, "x", i) for i, v in enumerate(good)]
    rows += [(50, None, "x", 0), (51, [1.0, None, 2.0], "x", 0), (52, [nan, 1.0, 1.0], "x", 0), (53, [inf, 1.0, 1.0], "x", 0),
             (54, [1.0], "x", 0), (55, [], "x", 0), (56, [1e300, 1.0, 1.0], "x", 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string, n long")
    got = whitening.whiten(frame, whitening.fit(frame)).toPandas()
    check(got, range(6), good, 3)
    null_key = spark.createDataFrame([(None, good[0]), (None, good[1])], "vec_id long, embedding array<double>")
    got = whitening.whiten(null_key, whitening.fit(null_key)).toPandas()
    assert len(got) == 2 and got["vec_id"].isna().all() and set(got["component"]) == {1}


def test_empty_single_and_null_tables(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        got = whitening.whiten(frame, whitening.fit(frame))
        assert got.count() == 0
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_64_bits_is_null(spark):
    frame = spark.createDataFrame([(i, [1e12 * i, 1.0 * (i % 2)]) for i in range(3)], "vec_id long, embedding array<double>")
    got = whitening.whiten(frame, whitening.fit(frame), key="vec_id").toPandas()
    assert got["deviation"].isna().any() and np.isfinite(got["whitened"]).all()
