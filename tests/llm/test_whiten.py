"""Whitening: exact sums against whole numbers, the covariance against fractions, odd rows."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from keepwell.llm import queries, whiten

DDL = "vec_id long, embedding array<float>, component int"


def brute(rows: list[list[float]], k: int):
    """The fit list, exact covariance and the whitened values, one number after another."""
    xs = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in rows]
    fit = sorted(set(xs))
    n, d = len(fit), len(fit[0])
    s = [sum(x[i] for x in fit) for i in range(d)]
    v = [[Fraction(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in fit), n ** 3) for j in range(d)] for i in range(d)]
    e, u = np.linalg.eigh(np.array([[float(c) for c in r] for r in v]))
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    dev = [sum((n * x[i] - s[i]) ** 2 for i in range(d)) for x in xs]
    white = [np.array([float(Fraction(n * x[i] - s[i], n)) for i in range(d)]) @ u / np.sqrt(e) for x in xs]
    return n, dev, white, e / float(sum(v[i][i] for i in range(d)))


def check(rows, vectors, k):
    n, dev, white, explained = brute(vectors, k)
    sign = None
    for i, (d, w) in enumerate(zip(dev, white, strict=True)):
        mine = sorted((r for r in rows if r["vec_id"] == i), key=lambda r: r["component"])
        assert [r["component"] for r in mine] == list(range(1, k + 1))
        assert all(r["n"] == n and int(r["deviation"]) == d for r in mine)
        assert np.allclose([r["explained"] for r in mine], explained, rtol=1e-9)
        got = np.array([r["whitened"] for r in mine])
        sign = np.sign(got * w) if sign is None else sign
        assert np.allclose(got, w * sign, atol=1e-8)


def test_square_sums_are_exact():
    rng = np.random.default_rng(1)
    for bits in (3, 23, 24, 25, 40, 61):
        p = rng.integers(-(1 << bits), 1 << bits, size=(40_000, 3), dtype=np.int64)
        assert whiten.square_sums(p).tolist() == [sum(int(x) ** 2 for x in col) for col in p.T]
    assert whiten.square_sums(np.zeros((0, 2), np.int64)).tolist() == [0, 0]


def test_polarisation_gives_the_covariance():
    rng = np.random.default_rng(2)
    y = rng.integers(-50, 50, size=(30, 4))
    y = 30 * y - y.sum(axis=0)
    own, pairs = (y ** 2).sum(axis=0).tolist(), {(i, j): int(((y[:, i] + y[:, j]) ** 2).sum()) for i in range(4) for j in range(i + 1, 4)}
    assert np.array_equal(whiten.covariance(30, own, pairs), (y.T @ y) / 30 ** 3)


def test_against_whole_numbers(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(60, 5)) * [1, .7, .5, .3, .2]).astype("f4").tolist()
    vectors += [vectors[0]] * 25 + [vectors[1]] * 3  # repeats count once in the fit
    docs = spark.createDataFrame([(i, v, 9) for i, v in enumerate(vectors)], DDL).repartition(7)
    model = whiten.fit(docs, components=3)
    assert model.n == 60 and model.identity_error < 1e-9
    check(whiten.transform(docs, model).collect(), vectors, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [[0.0, 1.0, 2.0], [1.0, 0.0, 2.0], [0.5, 0.25, 2.0], [2.0, 2.5, 2.0]]
    rows = [(i, v, 0) for i, v in enumerate(good)] + [(9, None, 0), (10, [nan, 1.0, 1.0], 0), (11, [inf, 1.0, 1.0], 0), (12, [None, 1.0, 1.0], 0),
                                                      (13, [1.0], 0), (14, [], 0), (None, good[0], 0), (0, good[1], 0)]
    docs = spark.createDataFrame(rows, DDL)
    model = whiten.fit(docs)
    found = whiten.transform(docs, model).collect()
    assert model.n == 4 and len(found) == 6 * 3  # the third entry never varies: a component without variance
    assert {r["component"] for r in found if r["whitened"] is None} == {3}
    assert sorted({r["vec_id"] for r in found}, key=str) == [0, 1, 2, 3, None]
    for empty in (docs.limit(0), docs.where("vec_id = 9"), docs.where("vec_id = 14")):
        assert whiten.transform(docs, whiten.fit(empty)).collect() == []
    same = docs.where("vec_id = 1")
    alone = whiten.transform(same, whiten.fit(same)).collect()
    assert len(alone) == 3 and all(r["whitened"] is None and r["deviation"] == 0 and r["explained"] == 0 for r in alone)
    with pytest.raises(ValueError, match="named like a result"):
        whiten.transform(docs, model, id_col="component")
    far = spark.createDataFrame([(0, [1e15], 0), (1, [-1e15], 0), (2, [0.0], 0)], "vec_id long, embedding array<double>, component int")
    assert whiten.fit(far).n == 3  # still exact
    with pytest.raises(Exception, match="too far apart|[Oo]verflow"):
        whiten.fit(spark.createDataFrame([(0, [1e17]), (1, [-1e17])], "vec_id long, embedding array<double>"))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    vectors = [r["embedding"] for r in spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()]
    rows = queries.op12_embedding_whitening(spark, sf).collect()
    assert len(rows) == 16 * len(vectors) and {r["identity_error"] < 1e-9 for r in rows} == {True}
    n, dev, white, explained = brute(vectors, 16)
    by = {(r["vec_id"], r["component"]): r for r in rows}
    sign = np.sign([by[0, k + 1]["whitened"] * white[0][k] for k in range(16)])
    for i in range(len(vectors)):
        assert by[i, 1]["deviation"] == dev[i] and by[i, 1]["n"] == n
        assert np.allclose([by[i, k + 1]["whitened"] for k in range(16)], white[i] * sign, atol=1e-7)
    assert np.allclose([by[0, k + 1]["explained"] for k in range(16)], explained, rtol=1e-9)
