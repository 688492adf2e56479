"""Whitening against numpy's eigenvectors of the whole covariance, and its edge cases."""

import math

import numpy as np
import pytest

from revlens.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, id string, x int, c string"


def make(spark, vectors):
    return spark.createDataFrame([(i, v, "i", 1, "c") for i, v in vectors], SCHEMA)


def run(df, **settings):
    rows = whitening.whole_numbers(df)
    return whitening.whiten(rows, whitening.fit(rows, **settings))


def brute(vectors):
    """{(row, component): whitened}, deviations and shares of the variance, by one dense covariance."""
    x = np.floor(256 * np.array(vectors, "f4").astype("f8"))
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    values, v = np.linalg.eigh(centred.T @ centred / n)
    values, v = values[::-1], v[:, ::-1]
    sums = [int(t) for t in s]
    deviation = [sum((n * int(a) - b) ** 2 for a, b in zip(row, sums)) for row in x]
    return n, (x - s / n) @ v[:, :4] / np.sqrt(values[:4]), deviation, values / values.sum()


def check(found, vectors, tolerance=1e-8):
    n, whitened, deviation, share = brute(vectors)
    rows = {(r["id"], r["component"]): r for r in found.collect()}
    assert len(rows) == 4 * len(vectors)
    for k in range(4):
        mine = np.array([rows[i, k + 1]["whitened"] for i in range(len(vectors))])
        theirs = whitened[:, k]
        sign = 1 if mine @ theirs > 0 else -1
        assert np.abs(mine - sign * theirs).max() < tolerance
        assert rows[0, k + 1]["explained"] == pytest.approx(share[k], rel=1e-9)
    assert [rows[i, 1]["deviation"] for i in range(len(vectors))] == deviation
    assert {r["n"] for r in rows.values()} == {n} and max(r["identity_error"] for r in rows.values()) < 1e-9


def test_against_dense_covariance(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((700, 70)) * np.linspace(1, 0.5, 70) * 0.13).tolist()
    vectors += vectors[:50] + [vectors[3]] * 100
    check(run(make(spark, list(enumerate(vectors))), degree=8), vectors)


def test_flat_spectrum_needs_a_growing_block(spark):
    """The block starts with two guards and the leading values hardly differ."""
    rng = np.random.default_rng(2)
    vectors = (rng.standard_normal((900, 24))).tolist()
    check(run(make(spark, list(enumerate(vectors))), guard=2, degree=3), vectors, 1e-6)


def test_query_on_the_given_table(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id")
    vectors = [r["embedding"] for r in table.collect()]
    found = queries.QUERIES["op12_whitening"](spark, folder).withColumnRenamed("vec_id", "id")
    assert [r["vec_id"] for r in table.select("vec_id").collect()] == list(range(len(vectors)))
    check(found, vectors)


def test_edges(spark):
    good = [(i, [float(i), float(i * i % 7), -float(i)]) for i in range(8)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [math.nan, 1.0, 1.0]), (103, [math.inf, 1.0, 1.0]),
           (104, [1.0]), (105, []), (106, [1e30, 0.0, 0.0])]
    rows = run(make(spark, good + bad + [(None, [1.0, 1.0, -1.0]), (3, good[3][1])])).collect()
    assert {r["id"] for r in rows} == {*range(8), None}
    assert {r["component"] for r in rows} == {1, 2}  # the third entry is the first one's opposite
    assert {r["n"] for r in rows} == {8} and len(rows) == 2 * 10


def test_nothing_to_whiten(spark):
    assert run(make(spark, [])).count() == 0
    assert run(make(spark, [(1, None)])).count() == 0
    assert run(make(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0


def test_large_whole_numbers_stay_exact(spark):
    big = 2.0 ** 40
    vectors = [[big, 0.0], [0.0, big], [1.0, 1.0]]
    rows = run(make(spark, list(enumerate(vectors)))).collect()
    x = [[int(256 * v) for v in row] for row in vectors]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((3 * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert {r["deviation"] for r in rows} == {v if v < 2 ** 63 else None for v in exact}
