import math

import numpy as np
import pytest
from helpers import BIG

from signalloom.llm import whitening
from signalloom.llm.whitening import leading, whiten

SCHEMA = "vec_id long, embedding array<float>, component string, n string, x string, d string, y0 string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, *["x"] * 5) for i, v in rows], SCHEMA)


def plain(rows, k=8):
    """By the whole covariance and a dense eigensolver."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) and abs(c) < 2**42 for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    d = np.array(x, dtype=np.float64) - np.array([s / n for s in sums])
    v = d.T @ d / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    dev = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    return [i for i, _ in good], n, dev, d @ q / np.sqrt(e), e / np.trace(v)


def compare(spark, rows, k=8):
    ids, n, dev, white, explained = plain(rows, k)
    got = whiten(table(spark, rows)).toPandas()
    assert len(got) == len(ids) * white.shape[1] and (got.n == n).all() and got.identity_error.max() <= 1e-9 and got.residual.max() < 1e-9
    for j in range(white.shape[1]):
        part = got[got.component == j + 1]
        np.testing.assert_allclose(part.explained, explained[j], rtol=1e-9)
        mine = {i: (w, v) for i, w, v in zip(part.vec_id, part.whitened, part.deviation)}
        sign = np.sign(sum(mine[i][0] * w for i, w in zip(ids, white[:, j])))
        for i, w, v in zip(ids, white[:, j], dev):
            assert abs(mine[i][0] * sign - w) < 1e-6 and mine[i][1] == v


def test_against_the_whole_covariance(spark):
    rng = np.random.default_rng(3)
    scale = np.array([4.0, 3.0, 2.5, 2.0, 1.7, 1.4, 1.2, 1.0, *np.linspace(0.8, 0.05, 52)])
    x = rng.normal(size=(700, 60)) * scale @ np.linalg.qr(rng.normal(size=(60, 60)))[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    compare(spark, rows + [(1000, None), (1001, [None] * 60), (1002, [float("nan")] * 60), (1003, [float("inf")] + [0.0] * 59), (1004, []), (1005, [1e30] * 60)])
    compare(spark, rows[:300] + [(2000 + i, rows[0][1]) for i in range(200)])  # a vector that is a third of all


def test_few_dimensions_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(BIG + i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(50, 3)))]
    compare(spark, rows)
    got = whiten(table(spark, [(None, rows[0][1]), *rows, rows[1], (7, [1.0, 2.0])])).collect()
    assert {r.n for r in got} == {52} and sorted(r.vec_id for r in got if r.vec_id is not None) == sorted([BIG + i for i in range(50) for _ in range(3)] + [BIG + 1] * 3)
    assert len([r for r in got if r.vec_id is None]) == 3


def test_tables_without_components(spark):
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, [(1, [1.0, 2.0])] * 4)).count() == 0
    assert whiten(table(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [3.0, 6.0])])).count() == 3  # one direction only


def test_deviation_is_exact_or_null():
    x = np.array([[1 << 40, 5], [7, 9]])
    sums = [int(c) for c in x.sum(axis=0)]
    assert whitening.deviations(x, 2, sums, 1 << 62) == [None, None]
    far = [[3_000_000_019, 0], [0, 1]]
    assert whitening.deviations(np.array(far), 1, [0, 0], 1 << 40) == [9000000114000000361, 1]


@pytest.mark.parametrize("spectrum", [[1.0] * 80, [10.0**-i for i in range(80)], [1e6, 5.0, 4.9999, 4.9, 4.8, 4.7, 4.6, 4.5, 4.4, *[1.0] * 71], [3.0, 2.0, 1.0, *[0.0] * 77]])
def test_spectra(spectrum):
    """Equal, very steep, nearly equal and deficient spectra."""
    q = np.linalg.qr(np.random.default_rng(5).normal(size=(80, 80)))[0]
    v = q * np.array(spectrum) @ q.T
    e, u, _ = leading(lambda b: v @ b, 80, 8)
    np.testing.assert_allclose(e, spectrum[:8], atol=1e-11 * spectrum[0])
    np.testing.assert_allclose(v @ u, u * e, atol=1e-9 * spectrum[0])
    np.testing.assert_allclose(u.T @ u, np.eye(8), atol=1e-11)
