"""Whitening against numpy and whole-number arithmetic."""

from __future__ import annotations

import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from groundburn.llm import whitening
from groundburn.llm.queries import QUERIES
from groundburn.llm.whitening import WhitenRules

DDL = "vec_id long, embedding array<float>, label int, whitened string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "own") for i, v in enumerate(vectors)], DDL)


def brute(vectors, k):
    """Exact sums and deviations; numpy's own eigenvectors."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    deviation = [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x]
    y = np.array([[(n * r[j] - sums[j]) / n for j in range(d)] for r in x])
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:k]
    return deviation, y @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(v)


def table_of(found, k):
    rows = sorted(found.collect(), key=lambda r: (r["vec_id"], r["component"]))
    w = np.array([r["whitened"] for r in rows], float).reshape(-1, k)
    return rows, w


def test_whole_table_matches_brute_force(spark, sf):
    rows, w = table_of(QUERIES["op12_whitening"](spark, sf), 8)
    given = pq.read_table(f"{sf}/embeddings.parquet").sort_by("vec_id")
    deviation, expected, shares = brute(given["embedding"].to_pylist(), 8)
    assert [r["vec_id"] for r in rows[::8]] == given["vec_id"].to_pylist()
    assert [r["deviation"] for r in rows[::8]] == deviation
    assert {r["n"] for r in rows} == {given.num_rows}
    signs = np.sign((w * expected).sum(axis=0))  # either sign, but one for all rows
    np.testing.assert_allclose(w, expected * signs, atol=1e-9)
    np.testing.assert_allclose([r["explained"] for r in rows[:8]], shares, rtol=1e-9)
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    np.testing.assert_allclose(np.cov(w.T, bias=True), np.eye(8), atol=1e-9)


def test_vectors_that_do_not_count(spark):
    good = np.random.default_rng(1).standard_normal((40, 3)).astype(np.float32).tolist()
    bad = [None, [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 1.0, 2.0], [], [1.0], [1.0, 2.0, 3.0, 4.0]]
    found = whitening.components_of(frame(spark, good[:20] + bad + good[20:]), keep=["vec_id", "whitened", "label"])
    assert found.columns == ["vec_id", "label", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows, w = table_of(found, 3)
    assert {r["vec_id"] for r in rows} == set(range(20)) | set(range(27, 47))
    deviation, expected, _ = brute(good, 3)
    assert [r["deviation"] for r in rows[::3]] == deviation
    np.testing.assert_allclose(np.abs(w), np.abs(expected), atol=1e-9)


def test_equal_vectors_and_few_vectors(spark):
    rows, _ = table_of(whitening.components_of(frame(spark, [[1.0, 2.0]] * 7)), 2)
    assert [(r["whitened"], r["explained"], r["identity_error"], r["deviation"], r["n"]) for r in rows] == [(None, 0.0, 0.0, 0, 7)] * 14
    rows, _ = table_of(whitening.components_of(frame(spark, [[0.0, 0.0, 0.0], [1.0, 2.0, 3.0]])), 3)
    assert [r["whitened"] is None for r in rows] == [False, True, True] * 2
    assert abs(rows[0]["whitened"]) == pytest.approx(1.0) and rows[0]["explained"] == pytest.approx(1.0)
    rows, _ = table_of(whitening.components_of(frame(spark, [[5.0, 1.0]])), 2)
    assert [r["whitened"] for r in rows] == [None, None]


def test_hot_vector(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((60, 4)).astype(np.float32).tolist() + [[9.0, 9.0, -9.0, 0.5]] * 40
    rows, w = table_of(whitening.components_of(frame(spark, vectors).repartition(5)), 4)
    deviation, expected, _ = brute(vectors, 4)
    assert [r["deviation"] for r in rows[::4]] == deviation
    np.testing.assert_allclose(np.abs(w), np.abs(expected), atol=1e-9)


@pytest.mark.parametrize("vectors", [[], [None, [None, 1.0]]])
def test_no_vectors(spark, vectors):
    found = whitening.components_of(frame(spark, vectors))
    assert found.count() == 0
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["component"] == "int"


def test_far_entries_do_not_wrap():
    x = np.array([[(1 << 61) + 100_000, 0], [-(1 << 61) + 100_000, 7], [5, -3]], np.int64)
    sums = [int(x[:, j].astype(object).sum()) for j in range(2)]
    exact = [sum((3 * int(r[j]) - sums[j]) ** 2 for j in range(2)) for r in x]
    assert whitening.deviations(x, 3, tuple(sums)) == [v if v < 1 << 63 else None for v in exact]
    small = np.array([[10, 20], [30, 45], [11, 22]], np.int64)
    sums = (51, 87)
    assert whitening.deviations(small, 3, sums) == [sum((3 * int(r[j]) - sums[j]) ** 2 for j in range(2)) for r in small]


@pytest.mark.parametrize("kind", ["random", "equal", "clusters", "diagonal", "rank one"])
def test_eigenvectors(kind):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
    values = {"random": rng.random(30) * 10, "equal": np.full(30, 3.0), "clusters": np.r_[np.full(6, 5.0), np.full(24, 1.0)] + rng.random(30) * 1e-9,
              "diagonal": np.arange(30.0), "rank one": np.r_[7.0, np.zeros(29)]}[kind]
    a = np.diag(values) if kind == "diagonal" else q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    found, components = whitening.leading(a, 8)
    np.testing.assert_allclose(found, np.sort(values)[::-1][:8], atol=1e-13 * values.max())
    np.testing.assert_allclose(components @ components.T, np.eye(8), atol=1e-12)
    np.testing.assert_allclose(a @ components.T, components.T * found, atol=1e-12 * values.max())


def test_sturm_count_against_numpy():
    rng = np.random.default_rng(4)
    d, e = rng.standard_normal(12), rng.standard_normal(11)
    values = np.linalg.eigvalsh(np.diag(d) + np.diag(e, 1) + np.diag(e, -1))
    at = np.linspace(-5, 5, 41)
    assert whitening.sturm_count(d, e, at).tolist() == [(values < x).sum() for x in at]


def test_rules_are_parameters(spark):
    rows, w = table_of(whitening.components_of(frame(spark, [[0.5], [1.5], [2.5]]), WhitenRules(components=1, scale=2, shift=0)), 1)
    assert [r["deviation"] for r in rows] == [(3 * x - 9) ** 2 for x in (1, 3, 5)]
