"""Many k-means runs in shared passes."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import kmeans
from ledgerlens.operators.kmeans import Run, fit_runs


def frame(spark, points, weights=None):
    rows = [([float(v) for v in p], 1.0 if weights is None else float(weights[i])) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "point array<double>, weight double")


def lloyd(points, weights, centres):
    for _ in range(200):
        at = ((points[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        centres = np.array([np.average(points[at == i], axis=0, weights=weights[at == i]) if (at == i).any() else c for i, c in enumerate(centres)])
    return (((points - centres[at]) ** 2).sum(1) * weights).sum()


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(1)
    return np.concatenate([rng.normal(size=(80, 3)) + middle for middle in rng.normal(size=(5, 3)) * 12])


def test_a_run_is_at_a_fixed_point_and_the_same_alone(spark, blobs):
    runs = [Run(k, seed) for k in (2, 5) for seed in (1, 2, 3)]
    fits = fit_runs(frame(spark, blobs), runs)
    for run, (cost, centres) in zip(runs, fits):
        assert len(centres) == run.k and centres == sorted(centres)
        assert cost == pytest.approx(lloyd(blobs, np.ones(len(blobs)), np.array(centres)), rel=1e-6)
    alone = [fit_runs(frame(spark, blobs[::-1]).repartition(7), [run])[0] for run in runs[3:5]]
    assert [c for c, _ in alone] == pytest.approx([c for c, _ in fits[3:5]], rel=1e-6)
    truth = sum(((blobs[i : i + 80] - blobs[i : i + 80].mean(0)) ** 2).sum() for i in range(0, 400, 80))
    assert min(c for c, _ in fits[3:]) == pytest.approx(truth, rel=1e-6)


def test_passes_follow_the_longest_run(spark, blobs, monkeypatch):
    seen, one = [], kmeans._pass
    monkeypatch.setattr(kmeans, "_pass", lambda points, centres: seen.append(len(centres)) or one(points, centres))
    longest = 0
    for seed in range(4):
        seen.clear()
        fit_runs(frame(spark, blobs), [Run(4, seed)])
        longest = max(longest, len(seen))
    seen.clear()
    fit_runs(frame(spark, blobs), [Run(4, seed) for seed in range(4)])
    assert len(seen) == longest and seen[0] == 4


def test_weights_repeated_rows_and_bad_rows(spark):
    points = [(0.0,), (1.0,), (10.0,), (13.0,)]
    weighted = fit_runs(frame(spark, points, [3, 1, 1, 2]), [Run(2, 1)])
    repeated = frame(spark, [points[0]] * 3 + points[1:] + [points[3], (float("nan"),)])
    assert fit_runs(repeated, [Run(2, 1)]) == weighted == [(pytest.approx(6.75), [[0.25], [12.0]])]
    same = fit_runs(frame(spark, [(1.0, 2.0)] * 5), [Run(3, 1), Run(1, 1)])
    assert same == [(0.0, [[1.0, 2.0]] * 3), (0.0, [[1.0, 2.0]])]
    with pytest.raises(ValueError):
        fit_runs(frame(spark, points).filter(F.lit(False)), [Run(2, 1)])


def test_a_pass_over_blocks_adds_up_every_point_once():
    rng = np.random.default_rng(4)
    points, weights = rng.integers(0, 6, size=(5_000, 3)).astype(float), rng.integers(1, 4, 5_000).astype(float)
    batch = pa.RecordBatch.from_pydict({"point": pa.array(points.tolist()), "weight": pa.array(weights), "hash": pa.array(np.arange(5_000))})
    blocks = list(kmeans._pack(iter([batch.slice(0, 10), batch.slice(10)])))
    assert [len(b["weights"][0].as_py()) // 8 for b in blocks] == [10, 2_048, 2_048, 894]
    # Whole numbers, so that many points are equally far from two centres: the lowest gets them.
    centres = {3: np.array([[1.0, 1, 1], [3, 1, 1], [1, 3, 5]]), 8: np.array([[2.0, 2, 2], [2, 2, 2]])}
    (found,) = kmeans._sums(centres)(iter(blocks))
    lines = found.to_pylist()
    assert [(r["run"], r["centre"]) for r in lines] == [(3, 0), (3, 1), (3, 2), (8, 0), (8, 1)]
    for line in lines:
        at = ((points[:, None] - centres[line["run"]][None]) ** 2).sum(-1).argmin(1) == line["centre"]
        assert line["weight"] == weights[at].sum()
        assert [line[f"s{j}"] for j in range(3)] == pytest.approx((points[at] * weights[at, None]).sum(0))
