"""Whitening against a plain eigendecomposition."""

import math

import numpy as np
import pytest
from conftest import DATA
from pyspark.sql import functions as F

from corpuslake.llm import whitening
from corpuslake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def plain(vectors, components=32):
    """(x, eigenvalues by falling size, eigenvectors) of the covariance with divisor n."""
    x = np.array([[math.floor(64 * float(c)) for c in v] for v in vectors], float)
    x -= x.mean(0)
    value, vector = np.linalg.eigh(x.T @ x / len(x))
    return x, value[::-1], vector[:, ::-1]


def check(rows, vectors, components=32, close=1e-8):
    x, value, vector = plain(vectors.values())
    ids = list(vectors)
    wide = {}
    for r in rows:
        wide.setdefault(r.vec_id, {})[r.component] = r
    assert wide.keys() == vectors.keys()
    width = len(wide[ids[0]])
    got = np.array([[wide[i][k].whitened for k in range(1, width + 1)] for i in ids])
    for k in range(width):
        want = x @ vector[:, k] / math.sqrt(value[k])
        assert min(np.abs(got[:, k] - want).max(), np.abs(got[:, k] + want).max()) < close
        assert wide[ids[0]][k + 1].explained == pytest.approx(value[k] / value.sum(), rel=1e-9)
    centred = got - got.mean(0)
    assert np.abs(centred.T @ centred / len(got) - np.eye(width)).max() < 1e-10
    assert {r.n for r in rows} == {len(ids)} and all(0 <= r.identity_error < 1e-9 for r in rows)
    whole = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in vectors[i]] for i in ids]
    sums = [sum(c) for c in zip(*whole, strict=True)]
    for i, v in zip(ids, whole, strict=True):
        assert {r.deviation for r in wide[i].values()} == {sum((len(ids) * a - s) ** 2 for a, s in zip(v, sums, strict=True))}
    return width


def test_query_over_the_whole_table(spark):
    rows = spark.read.parquet(f"{DATA}/embeddings.parquet").collect()
    got = QUERIES["op12_embedding_whitening"](spark, DATA).collect()
    assert check(got, {r.vec_id: r.embedding for r in rows}) == 32


def test_ill_conditioned_vectors(spark):
    """Columns that are nearly the same: eigenvalues from 1e9 down to 1."""
    draw = np.random.default_rng(1)
    base = draw.integers(-40_000, 40_000, (400, 1))
    x = base + draw.integers(-3, 4, (400, 12)) * np.array([1, 1, 2, 4, 8, 50, 100, 300, 900, 2000, 4000, 9000])
    vectors = {i: (v / 64).tolist() for i, v in enumerate(x)}
    got = whitening.whiten(spark.createDataFrame(list(vectors.items()), SCHEMA)).collect()
    assert check(got, vectors, close=1e-6) == 12


def test_directions_without_spread(spark):
    """A constant dimension, and two that are the same: as many components as directions."""
    draw = np.random.default_rng(2)
    x = draw.normal(size=(300, 6))
    x[:, 2], x[:, 5] = 0.5, x[:, 1]
    vectors = {i: v.tolist() for i, v in enumerate(x.astype(np.float32))}
    got = whitening.whiten(spark.createDataFrame([(i, [float(c) for c in v]) for i, v in vectors.items()], SCHEMA)).collect()
    assert check(got, vectors) == 4


def test_fewer_rows_than_dimensions(spark):
    draw = np.random.default_rng(3)
    vectors = {i: [float(np.float32(c)) for c in v] for i, v in enumerate(draw.normal(size=(5, 20)))}
    assert check(whitening.whiten(spark.createDataFrame(list(vectors.items()), SCHEMA)).collect(), vectors) == 4


def test_factor_composes_to_the_gram_matrix(spark):
    draw = np.random.default_rng(4)
    x = draw.integers(-1000, 1000, (200, 8)) + 1_000_000
    df = spark.createDataFrame([(v.tolist(),) for v in x], "x array<long>")
    n, sums = whitening.totals(df, 8)
    r = whitening.factor(df, whitening.Centred(n, sums), 8)
    centred = x - x.mean(0)
    assert n == 200 and sums.tolist() == x.sum(0).tolist()
    assert r.T @ r == pytest.approx(centred.T @ centred, rel=1e-10)


def test_edges(spark):
    rows = [
        (1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.25, -1.0]), (2, None), (3, []), (4, [1.0, None]), (5, [float("nan"), 1.0]),
        (6, [float("-inf"), 1.0]), (7, [1e30, 1.0]), (8, [1.0]), (9, [3.0, 2.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "x", "component", "n", "whitened", "__c")})
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (9, 1), (9, 2)]
    assert {r.n for r in got} == {4}
    empty = whitening.whiten(df.limit(0))
    assert empty.collect() == [] and empty.columns == whitening.whiten(df).columns
    equal = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(9)], SCHEMA)
    assert whitening.whiten(equal).collect() == [] and whitening.whiten(equal.limit(1)).collect() == []


def test_deviations_beyond_a_long(spark):
    big = whitening.Centred(3, np.array([0, 3_000_000_000_000]))
    assert big.deviations(np.array([[0, 10**12], [10**9, 10**12], [2**40, 0]])) == [0, 9 * 10**18, None]
