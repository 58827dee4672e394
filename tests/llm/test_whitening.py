"""Whitening against numpy's own eigenvalues and exact whole-number sums."""

import math

import numpy as np
import pytest

from ledgerlens.llm import whitening

VECTORS = "vec_id bigint, embedding array<float>, x string, c string, label int"


def rotated(values, seed=0):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((len(values), len(values))))
    return (q * np.array(values)) @ q.T


SPECTRA = [
    [5, 4, 3, 2, 1, 0.5],
    [1, 1, 1, 1, 1],
    [7, 7, 7, 1e-3, 1e-5, 0],
    [1, 1 - 1e-9, 1 - 2e-9, 0.5, 0.1],
    [1e12, 1e3, 1, 1e-3],
    [3, 0, 0, 0, 0, 0],
    [2.5],
    [2, 1],
    list(np.random.default_rng(3).random(64)),
    list(1 / np.arange(1, 97) ** 2),
]


@pytest.mark.parametrize("values", SPECTRA)
def test_leading_eigenvalues(values):
    matrix = rotated(values)
    matrix = (matrix + matrix.T) / 2
    wanted = np.linalg.eigvalsh(matrix)[::-1][:4]
    found = whitening.leading(matrix, 4)
    scale = max(abs(wanted))
    assert found.certified
    assert np.abs(found.values - wanted).max() <= 1e-13 * scale * len(values)
    assert np.abs(found.vectors @ found.vectors.T - np.eye(len(wanted))).max() < 1e-13
    assert np.abs(matrix @ found.vectors.T - found.vectors.T * found.values).max() <= 1e-12 * scale


def test_inertia_counts():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 30):
        for _ in range(20):
            m = rng.standard_normal((size, size))
            m = m + m.T
            assert whitening.positive_pivots(m) == (np.linalg.eigvalsh(m) > 0).sum()
    assert whitening.positive_pivots(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1
    assert whitening.positive_pivots(np.zeros((3, 3))) == 0
    assert whitening.leading(np.zeros((3, 3)), 4).values.tolist() == [0, 0, 0]


def check(rows, result, size):
    """All columns against a plain computation over ``rows`` of (vec_id, vector)."""
    used = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(x) for _, x in used}))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.sum(axis=0) / n
    matrix = centred.T @ centred / n
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(4, size)
    assert len(result) == k * len(rows)
    by_row = {}
    for r in result:
        by_row.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    signs = {}
    for i, x in used:
        projected = (np.array(x) - np.array(sums) / n) @ vectors[:, :k] / np.sqrt(values[:k])
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        for c in range(k):
            for r in by_row[i][c + 1]:
                assert (r["n"], r["deviation"]) == (n, deviation)
                if abs(projected[c]) > 1e-6:
                    sign = signs.setdefault(c, 1.0 if r["whitened"] * projected[c] > 0 else -1.0)
                    assert abs(sign * r["whitened"] - projected[c]) < 1e-9
                assert abs(r["explained"] - values[c] / np.trace(matrix)) < 1e-12
                assert 0 <= r["identity_error"] < 1e-9


def test_query_equals_plain_computation(spark, folder):
    from ledgerlens.llm.queries import op12_embedding_whitening

    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(rows, op12_embedding_whitening(spark, folder).collect(), 64)


def test_hard_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(v) for v in np.float32(rng.standard_normal(3) * [9, 2, 1])]) for i in range(200)]
    good += [(1000 + i, good[5][1]) for i in range(300)] + [(8, good[8][1])]
    bad = [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [1.0, float("nan"), 2.0]), (5, [float("inf"), 1.0, 2.0]), (6, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, "a", "b", 1) for i, v in good + bad], VECTORS).repartition(5)
    check(good, whitening.whiten(df).collect(), 3)
    one = whitening.whiten(df.repartition(1)).collect()
    many = whitening.whiten(df.repartition(13)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_degenerate_tables(spark):
    def run(rows):
        return sorted(map(tuple, whitening.whiten(spark.createDataFrame([(i, v, "", "", 0) for i, v in rows], VECTORS)).collect()), key=repr)

    assert run([]) == []
    assert run([(1, None), (2, [])]) == []
    assert run([(1, [1.0, 2.0])]) == [(1, 1, 1, 0, None, None, None), (1, 2, 1, 0, None, None, None)]
    two = run([(1, [0.0, 1.0]), (None, [0.0, 3.0]), (1, [0.0, 1.0])])
    assert [(r[0], r[1], r[2], r[3], r[4] if r[4] is None else abs(r[4]), r[5]) for r in two] == [
        (1, 1, 2, 512**2, 1.0, 1.0), (1, 1, 2, 512**2, 1.0, 1.0),
        (1, 2, 2, 512**2, None, 0.0), (1, 2, 2, 512**2, None, 0.0),
        (None, 1, 2, 512**2, 1.0, 1.0), (None, 2, 2, 512**2, None, 0.0),
    ]
    huge = run([(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 3.0])])
    assert len(huge) == 6 and huge[0][3] is None
