"""Whitening against a dense decomposition and whole-number sums."""

import math

import duckdb
import numpy as np

from conftest import SF_DIR
from profilelake.llm import queries, whitening

VECTORS = "vec_id bigint, embedding array<float>, label int"


def reference(vectors, components=32):
    """(n, deviations, components, variances, trace) with NumPy and Python numbers."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    deviations = [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x]
    centred = np.array([[(n * r[j] - sums[j]) / n for j in range(d)] for r in x])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return n, deviations, centred, basis[:, order], values[order], values.sum()


def check(rows, vectors, components=32, far=1e-8):
    n, deviations, centred, basis, values, trace = reference([v for _, v in vectors], components)
    places = {i: k for k, (i, _) in enumerate(vectors)}
    white = centred @ basis / np.sqrt(values)
    got = np.zeros_like(white)
    for r in rows:
        k, c = places[r.vec_id], r.component - 1
        got[k, c] = r.whitened
        assert r.n == n and int(r.deviation) == deviations[k]
        assert abs(r.explained - values[c] / trace) <= 1e-9 * values[c] / trace
        assert r.identity_error < 1e-9
    assert len(rows) == n * len(values)
    got *= np.sign((got * white).sum(axis=0))
    assert np.abs(got - white).max() < far


def test_query(spark):
    rows = queries.op13_whitening(spark, SF_DIR).collect()
    vectors = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet'").fetchall()
    check(rows, vectors)
    assert {type(r.deviation) for r in rows} == {int}


def test_dropped_rows_and_odd_columns(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(np.float32(c)) for c in rng.standard_normal(6) * [9, 5, 3, 2, 1, 0.5]]) for i in range(80)]
    bad = [(900, None, 1), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (902, [float("nan")] + [0.0] * 5, 1),
           (903, [0.0] * 5 + [float("inf")], None)]
    table = spark.createDataFrame([(i, v, None) for i, v in vectors] + bad, VECTORS)
    table = table.selectExpr("*", "'x' AS n", "'y' AS ids", "'z' AS component").repartition(5)
    check(whitening.whiten(table).collect(), vectors)


def test_rank_ties_and_lengths(spark):
    # Rank two in five dimensions; the others carry nothing and are left out.
    rng = np.random.default_rng(2)
    vectors = [(i, [float(a), float(b), 0.0, float(a), 7.0]) for i, (a, b) in enumerate(rng.integers(-9, 9, (60, 2)))]
    rows = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in vectors], VECTORS)).collect()
    check(rows, vectors, components=2)
    # Equal variances in every direction: the Krylov space of one start is one-dimensional.
    corners = [(i, [1.0 if i == j else 0.0 for j in range(8)]) for i in range(8)]
    rows = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in corners], VECTORS)).collect()
    assert len(rows) == 8 * 7 and max(r.identity_error for r in rows) < 1e-9
    assert all(abs(r.explained - 1 / 7) < 1e-12 for r in rows)
    # A short vector is zero where it has no entry; repeated and null ids stay.
    short = spark.createDataFrame([(1, [1.0], 0), (1, [0.0, 2.0], 0), (None, [3.0, 1.0], 0), (4, [], 0)], VECTORS)
    got = whitening.whiten(short).collect()
    full = [[1.0, 0.0], [0.0, 2.0], [3.0, 1.0], [0.0, 0.0]]
    assert sorted(int(r.deviation) for r in got if r.component == 1) == sorted(reference(full)[1])


def test_no_variance(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 5, [(1, [], 0)], [(1, None, 0)]):
        assert whitening.whiten(spark.createDataFrame(rows, VECTORS)).count() == 0


def test_leading_components_of_wide_vectors(spark):
    """Steps end before the number of dimensions, with equal variances among the wanted ones."""
    rng = np.random.default_rng(3)
    basis, _ = np.linalg.qr(rng.standard_normal((120, 120)))
    scales = np.concatenate([[90, 70, 50, 30], np.full(116, 0.6)])
    data = (rng.standard_normal((500, 120)) * scales) @ basis.T
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(data)]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], VECTORS)
    check(whitening.whiten(df, components=4).collect(), vectors, components=4)


def test_deviations_beyond_64_bits():
    whole = np.array([[3_000_000_000, -5]])
    n, rest = 10**9, np.array([7, 8])
    assert int(whitening._deviations(whole, n, rest)[0].as_py()) == sum(
        (n * int(w) - int(r)) ** 2 for w, r in zip(whole[0], rest)
    )
