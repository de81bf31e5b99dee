from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def plain(vectors, components=4):
    """The same by numpy's own eigenvalues."""
    usable = [v for v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in v] for v in usable], dtype=object)
    fitted = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, sums = len(fitted), fitted.sum(axis=0)
    y = ((fitted * n - sums) / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:components]
    values, vectors, trace = values[order], vectors[:, order], values.sum()
    white = ((x * n - sums) / n).astype(float) @ vectors / np.sqrt(values)
    return n, ((x * n - sums) ** 2).sum(axis=1), white, values / trace


@pytest.mark.parametrize("n", [1, 2, 5, 30])
def test_pivot_counts_are_eigenvalue_counts(n):
    rng = np.random.default_rng(n)
    for _ in range(10):
        a = rng.standard_normal((n, n))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in np.append(rng.standard_normal(5) * 3, 0.0):
            assert whitening.positive_pivots(a, shift) == (values > shift).sum()


def test_pivots_of_a_zero_diagonal():
    assert whitening.positive_pivots(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


@pytest.mark.parametrize("values", [[9, 4, 1, 0.5], [5, 5 - 1e-9, 2, 1], [3, 3, 3, 1], [1e6, 1, 1e-6, 1e-9], [7, 2, 0, 0]])
def test_leading_components(values):
    rng = np.random.default_rng(3)
    basis, _ = np.linalg.qr(rng.standard_normal((12, 12)))
    wanted = np.array(values + [0.0] * 8)
    a = (basis * wanted) @ basis.T
    found, vectors = whitening.leading((a + a.T) / 2, 4)
    kept = [v for v in values if v > 1e-8]
    assert len(found) >= len(kept)
    assert np.allclose(found[:len(kept)], kept, rtol=1e-9, atol=1e-12)
    assert np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-10)
    assert np.allclose(a @ vectors, vectors * found, atol=1e-9 * max(values))


def test_no_direction():
    assert len(whitening.leading(np.zeros((3, 3)), 4)[0]) == 0


def test_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    copies = rows.filter("vec_id % 3 = 0").withColumn("vec_id", F.col("vec_id") + 10_000)
    rows = rows.unionByName(copies)
    vectors = {r["vec_id"]: r["embedding"] for r in rows.collect()}
    found = whitening.whitened(rows, "vec_id", "embedding", whitening.fit(rows, "embedding")).collect()
    assert len(found) == 4 * len(vectors)
    ids = sorted(vectors)
    n, deviation, white, explained = plain([vectors[i] for i in ids])
    place = {i: k for k, i in enumerate(ids)}
    signs = {}
    for r in found:
        k, c = place[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[k] and r["identity_error"] < 1e-9
        assert math.isclose(r["explained"], explained[c], rel_tol=1e-9)
        assert math.isclose(abs(r["whitened"]), abs(white[k, c]), rel_tol=1e-6, abs_tol=1e-9)
        if abs(white[k, c]) > 1e-3:
            signs.setdefault(c, set()).add(r["whitened"] * white[k, c] > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_unusable_vectors_and_repeats(spark):
    data = [
        (1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []),
        (7, [1.0, 2.0]), (None, [0.5, -1.0]), (9, [1.0, 2.0, 3.0]), (10, [-0.25, 4.0]), (10, [-0.25, 4.0]), (11, [3e38, 0.0]),
    ]
    rows = spark.createDataFrame([(i, v, "a", 1) for i, v in data], "vec_id bigint, embedding array<float>, x string, component int")
    model = whitening.fit(rows, "embedding")
    found = whitening.whitened(rows, "vec_id", "embedding", model).collect()
    assert sorted((r["vec_id"] or 0, r["component"]) for r in found) == sorted(
        (i, c) for i in (0, 1, 7, 10, 10) for c in (1, 2)
    )
    assert {r["n"] for r in found} == {3}
    _, deviation, _, _ = plain([v for i, v in data if i in (1, None, 10)], 2)
    assert {r["deviation"] for r in found} == set(deviation)


def test_vectors_without_a_direction(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    for rows in (same, same.limit(0)):
        assert whitening.whitened(rows, "vec_id", "embedding", whitening.fit(rows, "embedding")).count() == 0


def test_numbers_beyond_a_long(spark):
    rows = spark.createDataFrame([(1, [1e15, 0.0]), (2, [-1e15, 0.0]), (3, [3.0, 1.0])], "vec_id bigint, embedding array<double>")
    found = whitening.whitened(rows, "vec_id", "embedding", whitening.fit(rows, "embedding")).collect()
    assert {r["deviation"] is None for r in found if r["vec_id"] != 3} == {True}
    assert max(abs(r["whitened"]) for r in found) < 2
