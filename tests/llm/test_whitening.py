"""Whitening against a dense eigendecomposition, exact integers, and matrices that are hard for the solver."""

from __future__ import annotations

import numpy as np
import pytest

from lapidar.llm import whitening
from lapidar.llm.whitening import COMPONENTS, SCALE, SHIFT, leading, minres

SCHEMA = "vec_id long, embedding array<float>, label int, n int, `key` string"


def expected(rows, components=COMPONENTS):
    """Per row that takes part: vec_id and its exact deviation; n, eigenvalues, vectors, centred rows."""
    whole = [(i, [int(np.floor(SCALE * float(c))) + SHIFT for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = lambda x: np.array([(n * a - s) / n for a, s in zip(x, sums)])
    c = np.array([centred(x) for x in fit])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > len(values) * 2.3e-16 * values[0]).sum()))
    deviation = [(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in whole]
    return n, deviation, values, vectors[:, :k], np.array([centred(x) for _, x in whole])


def check(found, rows):
    n, deviation, values, vectors, centred = expected(rows)
    k = vectors.shape[1]
    assert len(found) == len(rows) * k
    assert sorted({(str(r["vec_id"]), r["deviation"]) for r in found}) == sorted({(str(i), d) for i, d in deviation})
    assert {r["n"] for r in found} == {n} and max(r["identity_error"] for r in found) < 1e-9
    for component in range(1, k + 1):
        of = [r for r in found if r["component"] == component]
        assert {round(r["explained"] * values.sum() / values[component - 1], 9) for r in of} == {1.0}
        ours = sorted((str(r["vec_id"]), abs(r["whitened"])) for r in of)
        theirs = centred @ vectors[:, component - 1] / np.sqrt(values[component - 1])
        theirs = sorted((str(i), abs(w)) for (i, _), w in zip(deviation, theirs, strict=True))
        assert [i for i, _ in ours] == [i for i, _ in theirs]
        np.testing.assert_allclose([w for _, w in ours], [w for _, w in theirs], rtol=1e-7, atol=1e-9)


@pytest.mark.parametrize("length", [1, 5, 24])
def test_rows_match_a_dense_eigendecomposition(spark, length):
    random = np.random.default_rng(length)
    scale = np.linspace(9, 1, length)
    vectors = [(i, (random.standard_normal(length) * scale).astype(np.float32).tolist()) for i in range(120)]
    vectors += [(i, vectors[3][1]) for i in range(200, 260)] + [(7, vectors[7][1]), (None, vectors[8][1])]
    apart = [None, [], [None] * length, [1.0] * (length + 1), [float("nan")] * length, [float("inf")] * length, [1e30] * length]
    rows = [(i, v, 1, 2, "k") for i, v in vectors + [(900 + j, v) for j, v in enumerate(apart)]]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    check(found, vectors)


def test_wide_entries_stay_exact(spark):
    vectors = [(0, [1e12, -3.0]), (1, [2e12, 5.0]), (2, [-1e12, 0.25]), (3, [5e13, 1.0]), (4, [2.0**55, 7.0])]
    rows = [(i, [np.float32(c).item() for c in v]) for i, v in vectors]
    found = whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    n, deviation, *_ = expected(rows)
    fits = {i: d if d < 1 << 63 else None for i, d in deviation}
    assert {r["vec_id"]: r["deviation"] for r in found} == fits and None in fits.values()
    near = [(i, [1e6 + i, float(i * i)]) for i in range(9)]
    found = whitening.whitened(spark.createDataFrame(near, "vec_id long, embedding array<double>")).collect()
    check(found, near)


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whitened(spark.createDataFrame(rows, schema)).collect() == []
    # rank one: a single component
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]
    found = whitening.whitened(spark.createDataFrame(line, schema)).collect()
    assert {r["component"] for r in found} == {1} and found[0]["explained"] == pytest.approx(1)


@pytest.mark.parametrize(
    "values",
    [np.linspace(1.5, 0.5, 130), 1 / np.arange(1, 200), np.r_[np.ones(20) + 1e-7 * np.arange(20), np.linspace(0.9, 0.1, 90)], np.r_[np.ones(7), np.zeros(30)]],
    ids=["close", "falling", "cluster", "few"],
)
def test_residuals_reach_double_precision(values):
    random = np.random.default_rng(2)
    q = np.linalg.qr(random.standard_normal((len(values), len(values))))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, vectors = leading(lambda v: a @ v, len(a), COMPONENTS)
    np.testing.assert_allclose(found, np.sort(values)[::-1][:COMPONENTS], atol=1e-14 * values.max())
    assert np.linalg.norm(a @ vectors - vectors * found, axis=0).max() < 1e-13 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(COMPONENTS)).max() < 1e-13


def test_minres_solves_indefinite_systems():
    random = np.random.default_rng(3)
    a = random.standard_normal((30, 30))
    a, b = a + a.T, random.standard_normal((30, 4))
    b[:, 3] = 0
    np.testing.assert_allclose(a @ minres(lambda v: a @ v, b, 90, 1e-13), b, atol=1e-9)
