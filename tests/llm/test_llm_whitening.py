"""Whitening and its eigenvectors against full decompositions."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweave.llm import queries, whitening
from caseweave.llm.jacobi_davidson import EPS, leading_pairs


def integers(rows, scale=1024, offset=100_000):
    """(id, x) of the rows that take part."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in good]
    d = max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 0
    return [(i, [math.floor(scale * float(c)) + offset for c in v]) for i, v in good if len(v) == d]


def decomposed(x):
    """Eigenvalues falling, vectors and trace of the covariance, centred exactly before rounding."""
    n = len(x)
    sums = [int(s) for s in np.sum(np.array(x, object), axis=0)]
    c = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, sums, strict=True)] for row in x])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    return values[::-1], vectors[:, ::-1], float(np.trace(c.T @ c / n)), c, sums


def test_query_against_full_decomposition(spark, sf):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    kept = integers(rows)
    values, vectors, trace, c, sums = decomposed([x for _, x in kept])
    got = queries.op12_whitening(spark, sf).collect()
    assert len(got) == 8 * len(kept) and len({(r["vec_id"], r["component"]) for r in got}) == len(got)
    found = {(r["vec_id"], r["component"]): r for r in got}
    n = len(kept)
    for k in range(8):
        want = c @ vectors[:, k] / math.sqrt(values[k])
        mine = np.array([found[i, k + 1]["whitened"] for i, _ in kept])
        sign = np.sign(want @ mine)
        # rounding of the eigenvector grows with the inverse of the gap to its neighbours
        gap = min(abs(values[k] - v) for j, v in enumerate(values) if j != k) / values[0]
        assert np.abs(mine - sign * want).max() < 1e-12 / gap
        assert found[kept[0][0], k + 1]["explained"] == pytest.approx(values[k] / trace, rel=1e-12)
    for i, x in kept:
        r = found[i, 1]
        assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-11


def test_odd_rows(spark):
    """Nulls, other lengths, ties, repeated rows and ids, a null id, columns with names of results."""
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=5).round(3).tolist()) for i in range(60)]
    rows += rows[:7] + [(3, [0.5] * 5), (None, [0.25] * 5), (70, None), (71, []), (72, [nan] + [0.0] * 4), (73, [inf] * 5), (74, [None] * 5), (75, [1.0] * 4), (76, [-inf] * 5)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, whitened string, x int").repartition(4)
    found, model, error = whitening.whitened_rows(df, "vec_id", "embedding", 1024, 100_000)
    kept = integers(rows)
    values, vectors, trace, c, sums = decomposed([x for _, x in kept])
    assert model.n == len(kept) == 69 and model.sums == sums and len(model.values) == 5 and error < 1e-12
    assert np.allclose(model.values, values, rtol=1e-13) and model.trace == pytest.approx(trace, rel=1e-13)
    want = sorted((i if i is not None else -1, sum((69 * a - s) ** 2 for a, s in zip(x, sums, strict=True))) for i, x in kept)
    got = found.collect()
    assert sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["deviation"]) for r in got) == want
    again = np.array([r["whitened"] for r in got])
    assert np.allclose(again.T @ again / 69, np.eye(5), atol=1e-12)


def test_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<double>"
    same = spark.createDataFrame([(i, [0.5, 0.25, 1.0]) for i in range(9)], schema)
    found, model, error = whitening.whitened_rows(same, "vec_id", "embedding", 1024, 100_000)
    assert [(r["deviation"], r["whitened"]) for r in found.collect()] == [(0, [])] * 9 and len(model.values) == 0 and error == 0.0
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], schema)  # a line in space
    found, model, error = whitening.whitened_rows(flat, "vec_id", "embedding", 1024, 100_000)
    assert len(model.values) == 1 and model.values[0] == pytest.approx(model.trace, rel=1e-14) and error < 1e-12
    empty = same.limit(0)
    found, model, error = whitening.whitened_rows(empty, "vec_id", "embedding", 1024, 100_000)
    assert found.collect() == [] and model.n == 0


def test_deviations_beyond_a_long_are_null(spark):
    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, [2.0**31, 0.0]), (2, [1.0, 2.0**20])], "vec_id long, embedding array<double>")
    found, model, _ = whitening.whitened_rows(df, "vec_id", "embedding", 1, 7)
    rows = {i: x for i, x in integers([(0, [0.0, 0.0]), (1, [2.0**31, 0.0]), (2, [1.0, 2.0**20])], 1, 7)}
    for r in found.collect():
        exact = sum((3 * a - s) ** 2 for a, s in zip(rows[r["vec_id"]], model.sums, strict=True))
        assert r["deviation"] == (exact if exact < 2**63 else None)
    assert any(r["deviation"] is None for r in found.collect())


@pytest.mark.parametrize("shape", ["decay", "flat", "clusters", "low rank", "graded"])
def test_leading_pairs(shape):
    rng = np.random.default_rng(1)
    d = 300
    values = {
        "decay": 1 / (1 + np.arange(d)) ** 0.7, "flat": 1 + rng.random(d) / 100, "clusters": np.repeat([5.0, 5.0 - 1e-9, 1.0], 100),
        "low rank": np.r_[np.arange(5, 0, -1.0), np.zeros(d - 5)], "graded": 10.0 ** -np.arange(d).clip(0, 300),
    }[shape]
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    v = (turn * values) @ turn.T
    v = (v + v.T) / 2
    taken = 0

    def product(block):
        nonlocal taken
        taken += 1
        assert block.shape[1] <= 16  # never the whole space at once
        return v @ block

    e, q, products = leading_pairs(product, d, 8)
    assert products == taken
    assert np.abs(e - np.sort(values)[::-1][:8]).max() < 1e-13 * values.max()
    assert np.abs(q.T @ q - np.eye(8)).max() < 1e-13
    assert np.linalg.norm(v @ q - q * e, axis=0).max() <= 80 * EPS * values.max()


def test_leading_pairs_of_small_spaces():
    for d in (1, 2, 7, 9):
        v = np.diag(np.arange(1.0, d + 1))
        e, q, _ = leading_pairs(lambda w, v=v: v @ w, d, 8)
        assert np.allclose(e, np.arange(d, max(0, d - 8), -1.0), rtol=1e-14) and q.shape == (d, min(8, d))
    e, q, _ = leading_pairs(lambda w: 0 * w, 20, 8)
    assert (e == 0).all()


def test_result_is_the_same_for_any_partitions(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet")
    one, many = (whitening.whitened_rows(rows.repartition(p), "vec_id", "embedding", 1024, 100_000)[0] for p in (1, 13))
    both = one.join(many.select("vec_id", F.col("whitened").alias("other")), "vec_id")
    a, b = (np.array([r[c] for r in both.collect()]) for c in ("whitened", "other"))
    signs = np.sign((a * b).sum(axis=0))
    assert np.abs(a - b * signs).max() < 1e-9
