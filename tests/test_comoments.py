"""Co-moments of blocks against numpy, whatever the blocks."""

import numpy as np
import pytest

from ledgerlens.functions.comoments import CoMoments, co_moments
from ledgerlens.operators import quality


def table(rows=700, width=12, seed=1):
    rng = np.random.default_rng(seed)
    values = rng.normal(1e6, 3, (rows, width)) + rng.normal(0, 2, (rows, 1))
    values[:, 3] = 7.1
    values[:, 5] *= -1
    valid = rng.random((rows, width)) < 0.8
    valid[:, 0] = True
    valid[:, 7] = False
    return values, valid


def expected(values, valid):
    width = values.shape[1]
    found = np.full((width, width), np.nan)
    for i in range(width):
        for j in range(width):
            both = valid[:, i] & valid[:, j]
            x, y = values[both, i], values[both, j]
            if len(x) > 1 and np.ptp(x) > 0 and np.ptp(y) > 0:
                found[i, j] = 1.0 if i == j else np.corrcoef(x, y)[0, 1]
    return found


@pytest.mark.parametrize("cuts", [[], [1], [100, 101, 350], list(range(0, 700, 7))])
def test_blocks_merge_without_loss(cuts):
    values, valid = table()
    total = CoMoments.empty(values.shape[1])
    for a, b in zip([0, *cuts], [*cuts, len(values)]):
        if b > a:
            total = total.merged(CoMoments.of(values[a:b], valid[a:b]))
    assert np.allclose(total.correlation(), expected(values, valid), atol=1e-9, equal_nan=True)
    both = valid[:, 1] & valid[:, 2]
    assert total.covariance()[1, 2] == pytest.approx(np.cov(values[both, 1], values[both, 2])[0, 1], rel=1e-9)
    assert total.mean[1, 2] == pytest.approx(values[both, 1].mean(), rel=1e-12)


def test_a_hundred_columns_of_a_table(spark):
    values, valid = table(rows=300, width=100)
    names = [f"a.{i}" for i in range(100)]
    rows = [tuple(float(v) if ok else None for v, ok in zip(a, b)) for a, b in zip(values, valid)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(5)
    found = quality.correlation_matrix(df, names).collect()
    wanted = expected(values, valid)
    assert len(found) == 100 * 100
    for r in found:
        w = wanted[names.index(r["column_a"]), names.index(r["column_b"])]
        assert r["correlation"] is None if np.isnan(w) else r["correlation"] == pytest.approx(w, abs=1e-9)
    none = co_moments(df.limit(0), names[:3])
    assert (none.n == 0).all() and np.isnan(none.correlation()).all()
