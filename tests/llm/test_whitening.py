import math

import numpy as np
import pytest
from txrisk.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, ids string, x int, component string, n int"


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(i, v, "a", 1, None, 2) for i, v in rows], SCHEMA).repartition(partitions)


def vectors(n, width, seed=0, spread=None):
    rng = np.random.default_rng(seed)
    spread = np.linspace(0.2, 2.0, width) if spread is None else spread
    return [[float(c) for c in row] for row in rng.standard_normal((n, width)) * spread]


def brute(rows):
    """vec_id -> (deviation, whitened by component) with numpy's own eigenvectors, and the eigenvalues."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    spread = n * x - sums
    centred = spread.astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:32], axes[:, ::-1][:, :32]
    real = values > 1e-12 * values[0]
    mapped = centred @ (axes[:, real] / np.sqrt(values[real]))
    return [i for i, _ in kept], (spread**2).sum(axis=1), mapped, values[real], np.trace(centred.T @ centred / n)


def compare(found, rows):
    ids, deviations, mapped, values, trace = brute(rows)
    k = len(values)
    assert len(found) == len(ids) * k
    got = {}
    for r in found:
        got.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    signs = None
    for i, deviation, want in zip(ids, deviations, mapped):
        own = got[i, deviation]
        assert sorted(own) == list(range(1, k + 1))
        row = np.array([own[c][0].whitened for c in range(1, k + 1)])
        if signs is None:
            signs = np.sign(row * want)
        np.testing.assert_allclose(row * signs, want, atol=1e-8)
    assert {r.n for r in found} == {len(ids)}
    assert all(abs(r.explained * trace / values[r.component - 1] - 1) < 1e-9 for r in found)
    assert max(r.identity_error for r in found) < 1e-9


@pytest.mark.parametrize("width", [3, 40, 90])
def test_whitened_rows_equal_numpy(spark, width):
    rows = list(enumerate(vectors(400, width)))
    compare(whitening.whiten(table(spark, rows)).collect(), rows)


def test_awkward_rows(spark):
    rows = list(enumerate(vectors(60, 5)))
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1])]
    rows += [(100, None), (101, [None] + [1.0] * 4), (102, [math.nan] + [1.0] * 4), (103, [math.inf] * 5), (104, [])]
    compare(whitening.whiten(table(spark, rows)).collect(), rows)


def test_tables_without_a_direction(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []
    assert whitening.whiten(table(spark, [(i, [1.0, 2.0]) for i in range(9)])).collect() == []


def test_vectors_of_different_lengths_are_an_error(spark):
    with pytest.raises(Exception, match="different lengths|entries have no common"):
        whitening.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0])])).collect()


@pytest.mark.parametrize(
    "spectrum",
    [
        np.linspace(50, 60, 200),  # nearly flat
        np.array([1e6, 1e4, *np.linspace(1, 2, 198)]),  # a few dominate
        np.array([5.0] * 150 + [1.0] * 50),  # a run of equal ones wider than the block
        np.array([7.0] * 3 + [0.0] * 197),  # rank three
    ],
)
def test_leading_pairs_of_known_spectra(spectrum):
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    matrix = (basis * spectrum) @ basis.T
    found = whitening.leading(lambda q: matrix @ q, 200)
    want = np.sort(spectrum)[::-1][:32]
    np.testing.assert_allclose(found.values, want, atol=1e-9 * want[0])
    residual = matrix @ found.vectors - found.vectors * found.values
    assert np.abs(residual).max() < 1e-9 * want[0]
    np.testing.assert_allclose(found.vectors.T @ found.vectors, np.eye(32), atol=1e-12)
