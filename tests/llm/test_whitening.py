"""Whitening against dense eigenvectors of the covariance of the distinct integer vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from sieveline.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>"


def dense(vectors: list, k: int = 4):
    """(n, sums, explained, whitened by vector) by a dense eigendecomposition."""
    ok = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for v in ok), default=0)
    ints = {i: tuple([math.floor(256 * c) for c in v] + [0] * (d - len(v))) for i, v in enumerate(ok)}
    x = np.array(sorted(set(ints.values())), float).reshape(-1, d)
    n, sums = len(x), [sum(int(v) for v in c) for c in x.T]
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return n, sums, values / np.trace(centred.T @ centred / n), {t: (np.array(t, float) - x.mean(axis=0)) @ vectors / np.sqrt(values) for t in x.astype(int).tolist() and map(tuple, x.astype(int).tolist())}


def check(rows: list, vectors: dict, k: int = 4) -> None:
    n, sums, explained, white = dense(list(vectors.values()), k)
    d = len(sums)
    by = {}
    for r in rows:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
        assert r["n"] == n and abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9 and r["identity_error"] < 1e-8
    good = {i: v for i, v in vectors.items() if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    assert set(by) == set(good)
    signs = None
    for i, v in good.items():
        t = tuple([math.floor(256 * c) for c in v] + [0] * (d - len(v)))
        assert sorted(by[i]) == list(range(1, k + 1))
        assert all(r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(t, sums, strict=True)) for r in by[i].values())
        got, want = np.array([by[i][c]["whitened"] for c in range(1, k + 1)]), white[t]
        if signs is None and (np.abs(want) > 0.05).all():
            signs = np.sign(got * want)
    for i, v in good.items():
        t = tuple([math.floor(256 * c) for c in v] + [0] * (d - len(v)))
        assert np.allclose([by[i][c]["whitened"] for c in range(1, k + 1)], signs * white[t], rtol=1e-7, atol=1e-7)


def test_given_embeddings(spark, data):
    from sieveline.llm.queries import QUERIES

    table = spark.read.parquet(f"{data}/embeddings.parquet")
    check(QUERIES["op11_lanczos_whitening"](spark, data).collect(), {r["vec_id"]: r["embedding"] for r in table.collect()})


def test_missing_repeated_and_mixed(spark):
    rng = np.random.default_rng(3)
    vectors = {i: [float(c) for c in rng.standard_normal(7 if i % 5 else 4) * [9, 5, 3, 2, 1, 1, 1][: 7 if i % 5 else 4]] for i in range(120)}
    vectors |= {200 + i: vectors[i] for i in range(40)} | {300: None, 301: [1.0, None], 302: [math.nan] * 7, 303: [math.inf], 304: []}
    table = spark.createDataFrame([(i, v, 1, "n") for i, v in vectors.items()], SCHEMA + ", x int, n string").repartition(5)
    check(W.whiten(table).collect(), vectors)


def test_too_few_dimensions_and_rows(spark):
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], SCHEMA)
    rows = W.whiten(line).collect()
    assert {r["component"] for r in rows} == {1} and len(rows) == 9 and all(abs(r["explained"] - 1) < 1e-12 for r in rows)
    assert W.whiten(line.where("vec_id = 3")).collect() == [] and W.whiten(line.where("vec_id < 0")).collect() == []
    assert W.whiten(spark.createDataFrame([(1, []), (2, [])], SCHEMA)).collect() == []
    with pytest.raises(TypeError):
        W.whiten(line.withColumn("embedding", W.F.lit("x")))


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [float(2**40 * i), 1.0]) for i in range(4)]
    found = {r["vec_id"]: r for r in W.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[0]["deviation"] is None and found[0]["distance"] == pytest.approx(256 * 2**40 * 1.5)


@pytest.mark.parametrize("values", [np.r_[np.full(9, 5.0), np.ones(60)], np.r_[1e6, 1e3, 1.0, 1e-2, np.full(40, 1e-6)], np.r_[4.0, 3.0, 2.0, 1.0, np.zeros(30)], np.linspace(1, 2, 300), np.r_[np.ones(3), np.zeros(2)], np.ones(1)], ids=["repeated", "graded", "rank4", "dense", "small", "one"])
def test_lanczos(values):
    """Repeated, widely graded, vanishing and close eigenvalues; a basis that has to be restarted."""
    rng = np.random.default_rng(1)
    d = len(values)
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    a = (q * values) @ q.T
    k = min(4, d)
    found, vectors = W.lanczos(lambda v: a @ v, d, 4, basis=60)
    assert np.allclose(found, np.sort(values)[::-1][:k], rtol=1e-10, atol=1e-9 * values.max())
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
    assert np.abs(a @ vectors - vectors * found).max() < 1e-9 * values.max()
