"""Whitening against numpy's own eigenvectors and exact fractions."""

from __future__ import annotations

from collections import Counter
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from foliospark.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, n long, whitened string, component int, x int, deviation long"
FOLDER = "/root/testdata/sf0.01"


def whole(vector):
    return tuple(floor(64 * float(c)) + 1_000_000 for c in vector)


def check(found, rows, count=16):
    """Every column of the result against plain numpy over the rows."""
    good = [(n, whole(v)) for n, v in rows if v and all(c is not None and isfinite(c) for c in v)]
    fit = sorted({x for _, x in good})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for x in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    usable = min(count, int((values > 1e-9 * values[0]).sum()))
    assert Counter((r.vec_id, r.component) for r in found) == Counter((i, k + 1) for i, _ in good for k in range(usable))
    spread = {x: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in fit}
    exact = Counter((i, spread[x]) for i, x in good for _ in range(usable))
    assert Counter((r.vec_id, r.deviation) for r in found) == exact
    assert {r.n for r in found} == {n}
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-4
    for r in found:
        assert abs(r.explained - values[r.component - 1] / np.trace(covariance)) <= 1e-9 * r.explained
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
    where = {x: i for i, x in enumerate(fit)}
    gaps = np.abs(np.diff(np.r_[values, 0]))
    for k in range(usable):
        if min(gaps[k], gaps[k - 1] if k else np.inf) < 1e-6 * values[0]:
            continue  # no vector of its own
        expected = centred @ vectors[:, k] / np.sqrt(values[k])
        pairs = [(expected[where[x]], by_row[i, spread[x]][k + 1]) for i, x in good]
        sign = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-6


def test_query_equals_eigenvectors_of_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check(queries.registry()["op13_whitening"](spark, FOLDER).collect(), rows)


def frame(spark, rows):
    return spark.createDataFrame([(n, v, 1, "x", 2, 3, 4) for n, v in rows], SCHEMA)


def made(seed, rows, length, scales=None):
    random = np.random.default_rng(seed)
    scales = np.array(scales) if scales else random.uniform(0.1, 3, length)
    return [(n, (random.standard_normal(length) * scales).astype(np.float32).tolist()) for n in range(rows)]


@pytest.mark.parametrize("length", [1, 2, 3, 20])
def test_vectors_of_any_length(spark, length):
    rows = made(length, 60, length)
    check(whitening.components(frame(spark, rows)).collect(), rows)


def test_any_rows(spark):
    good = made(5, 40, 4)
    odd = [(None, good[0][1]), (3, None), (4, [None, 1.0, 1.0, 1.0]), (5, [float("nan")] * 4), (6, [float("inf"), 0.0, 0.0, 0.0]), (7, [])]
    rows = good + odd + [good[1], good[1], (900, good[2][1])]
    found = whitening.components(frame(spark, rows)).collect()
    check(found, rows)
    other = rows + [(n, [1.0, 2.0]) for n in range(1000, 1010)] + [(2000, [3e38, 0.0, 0.0, 0.0])]
    assert len(whitening.components(frame(spark, other)).collect()) == len(found)


def test_nothing_to_whiten(spark):
    assert whitening.components(frame(spark, [])).collect() == []
    assert whitening.components(frame(spark, [(1, []), (2, None)])).collect() == []
    assert whitening.components(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    flat = [(n, [float(n), 5.0, 2.0 * n]) for n in range(10)]
    found = whitening.components(frame(spark, flat)).collect()
    check(found, flat)
    assert {r.component for r in found} == {1}


def test_large_entries_are_exact(spark):
    rows = [(n, [float(2**40 + (n * 7919) % 101), float(n), -float(2**30 * (n % 5))]) for n in range(30)]
    found = whitening.components(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    good = [whole(v) for _, v in rows]
    n, sums = len(set(good)), [sum(c) for c in zip(*set(good))]
    for r in found:
        exact = sum((n * a - s) ** 2 for a, s in zip(good[r.vec_id], sums))
        assert r.deviation == (exact if exact < 2**63 else None)
    assert found[0].identity_error < 1e-4


def test_sums_do_not_depend_on_partitions(spark):
    rows = made(9, 500, 6)
    fits = [whitening.fit(frame(spark, rows).repartition(p)) for p in (1, 7)]
    assert fits[0].sums == fits[1].sums and (fits[0].components == fits[1].components).all()


@pytest.mark.parametrize("large", [1, 10**5, 2**45])
def test_products_are_exact(large):
    random = np.random.default_rng(1)
    z = random.integers(-large, large, (50, 3))
    sums = whitening.Products(3)
    sums.add(z)
    sums.add(z)
    expected = 2 * (z.T.astype(object) @ z.astype(object))
    assert (sums.close() == expected).all()


@pytest.mark.parametrize("seed", range(30))
def test_inertia_counts_equal_eigenvalues(seed):
    random = np.random.default_rng(seed)
    n = int(random.integers(1, 30))
    a = random.standard_normal((n, n))
    a = a + a.T
    if seed % 3 == 0:
        np.fill_diagonal(a, 0)
    values = np.linalg.eigvalsh(a)
    for shift in [-1.0, 0.0, 0.5, *(values[:-1] + np.diff(values) / 2)]:
        assert whitening.count_above(a, shift) == (values > shift).sum()


@pytest.mark.parametrize(
    "values",
    [
        [5.0, 4.0, 3.0, 2.0, 1.0],
        [5.0, 5.0, 5.0, 1.0, 0.5, 0.0, 0.0],
        [1.0, 1.0 - 1e-13, 0.5],
        [1.0, 1.0 - 1e-9, 1.0 - 2e-9, 0.1],
        [1e6, 1.0, 1e-6],
        [0.0, 0.0],
        [2.0] * 9,
        list(np.geomspace(1, 1e-8, 40)),
    ],
)
def test_leading_pairs_of_known_spectra(values):
    n = len(values)
    q, _ = np.linalg.qr(np.random.default_rng(n).standard_normal((n, n)))
    matrix = (q * np.array(values)) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.eigenpairs(matrix, 16)
    blur = 1e-13 * max(1, n) * max(values)
    assert len(found) >= min(16, sum(v > 100 * blur for v in values)) and len(found) <= min(16, sum(v > 0 for v in values))
    assert np.allclose(found, sorted(values)[::-1][: len(found)], rtol=0, atol=10 * blur)
    assert np.abs(vectors @ vectors.T - np.eye(len(found))).max(initial=0) < 1e-8
    assert np.abs(matrix @ vectors.T - vectors.T * found).max(initial=0) <= 100 * blur
