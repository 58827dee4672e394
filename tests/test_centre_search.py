"""The search of many centres against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import centre_search
from ledgerlens.functions.centre_search import RATIO, CentreIndex
from ledgerlens.operators import cluster_eval, segments


def table(spark, points, weights=None, own=None):
    weights = [0.0] * len(points) if weights is None else weights
    own = [-1] * len(points) if own is None else own
    rows = [(i, i, int(o), float(w), [float(v) for v in p]) for i, (p, w, o) in enumerate(zip(points, weights, own))]
    return spark.createDataFrame(rows, "id long, row long, own long, weight double, point array<double>")


def found(df):
    return {r["row"]: (r["id"], r["value"]) for r in df.collect()}


@pytest.fixture
def crowded(monkeypatch):
    """Small limits, so that a few points already need several rings, parts and tasks."""
    monkeypatch.setattr(centre_search, "PIVOTS", 5)
    monkeypatch.setattr(centre_search, "CENTRES_PER_CELL", 8)
    monkeypatch.setattr(centre_search, "CENTRES_PER_PART", 7)
    monkeypatch.setattr(centre_search, "POINTS_PER_TASK", 40)


def test_nearest_equals_brute_force(spark, crowded):
    rng = np.random.default_rng(1)
    # A third of all points and of all centres crowd around one place.
    spots = np.where(rng.random(600) < 0.34, 0, rng.integers(1, 30, 600))
    points = rng.normal(size=(30, 4))[spots] * 5 + rng.normal(size=(600, 4)) * 0.2
    centres = points[rng.choice(600, 250, replace=False)]
    apart = ((points[:, None] - centres[None]) ** 2).sum(-1)
    result = found(CentreIndex.build(table(spark, centres)).search(table(spark, points)))
    assert len(result) == 600
    assert [result[i][0] for i in range(600)] == apart.argmin(axis=1).tolist()
    assert [result[i][1] for i in range(600)] == pytest.approx(apart.min(axis=1).tolist())


def test_own_centre_never_counts_and_ties_go_to_the_lowest_id(spark, crowded):
    grid = [(float(x), float(y)) for x in range(12) for y in range(12)]
    result = found(CentreIndex.build(table(spark, grid)).search(table(spark, grid, own=range(len(grid)))))
    matrix = np.array(grid)
    apart = ((matrix[:, None] - matrix[None]) ** 2).sum(-1)
    np.fill_diagonal(apart, np.inf)
    assert [result[i] for i in range(len(grid))] == [(int(a), 1.0) for a in apart.argmin(axis=1)]


def test_ratio_equals_brute_force(spark, crowded):
    rng = np.random.default_rng(2)
    centres, weights = rng.normal(size=(200, 3)), rng.random(200) * np.where(np.arange(200) % 50, 1, 40)
    centres[7] = centres[8]  # equal centres are no partners
    result = found(CentreIndex.build(table(spark, centres, weights)).search(table(spark, centres, weights, range(200)), RATIO))
    apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(-1))
    with np.errstate(divide="ignore"):
        ratio = np.where(apart > 0, (weights[:, None] + weights[None]) / apart, 0)
    assert [result[i][1] for i in range(200)] == pytest.approx(ratio.max(axis=1).tolist())


def test_points_meet_only_open_cells(spark):
    """Separate groups: a point is compared with few of the centres."""
    rng = np.random.default_rng(3)
    points = np.repeat(rng.normal(size=(64, 2)) * 1000, 64, axis=0) + rng.normal(size=(4096, 2))
    index = CentreIndex.build(table(spark, points))
    cells = index.cells
    homes = cells.home(points[:200])
    hopes = cells.hopes(centre_search.NEAREST, points[:200], np.zeros(200))
    bound = ((points[:200, None] - points[None]) ** 2).sum(-1)
    np.fill_diagonal(bound, np.inf)
    open_cells = (hopes <= bound.min(axis=1)[:, None]).sum(axis=1)
    assert len(cells.cell) > 100 and open_cells.mean() < 0.1 * len(cells.cell)
    assert homes.max() < len(cells.cell)


def test_edges(spark):
    with pytest.raises(ValueError):
        CentreIndex.build(table(spark, [(1.0, 2.0)]).filter("false"))
    one = CentreIndex.build(table(spark, [(1.0, 2.0)]))
    assert found(one.search(table(spark, [(1.0, 2.0)], own=[0]))) == {0: (None, None)}
    assert found(one.search(table(spark, [(1.0, 2.0), (float("nan"), 0.0)]))) == {0: (0, 0.0)}
    assert found(one.search(table(spark, [(1.0, 2.0)]).filter("false"))) == {}


def test_assignment_keeps_rows_without_features(spark):
    df = spark.createDataFrame([(1, 0.0), (1, 0.0), (2, 9.0), (3, None)], "id int, x double")
    centres = spark.createDataFrame([(0, [0.0]), (1, [10.0])], "id long, point array<double>")
    kept = segments.nearest_centroid_assign(df, ["x"], centres, "c")
    assert kept.columns == ["id", "x", "c"]
    assert sorted((r["id"], r["c"] if r["c"] is not None else -1) for r in kept.collect()) == [(1, 0), (1, 0), (2, 1), (3, -1)]


def test_many_cluster_quality_equals_the_shipped_centres(spark, monkeypatch):
    rng = np.random.default_rng(5)
    label = rng.integers(0, 40, 1_000)
    points = rng.normal(size=(40, 3))[label] * 4 + rng.normal(size=(1_000, 3))
    df = spark.createDataFrame([(int(c), *map(float, p)) for c, p in zip(label, points)], "c int, x double, y double, z double").cache()
    few = cluster_eval.cluster_quality(df, ["x", "y", "z"], "c")
    monkeypatch.setattr(cluster_eval, "MAX_CLUSTERS", 10)
    many = cluster_eval.cluster_quality(df.withColumn("v", F.array("x", "y", "z")), "v", "c")
    assert many == pytest.approx(few)


def test_many_cluster_quality_of_one_cluster(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 1), (None, 1), (5.0, None)], "x double, c int")
    one = cluster_eval.many_cluster_quality(df, ["x"], "c")
    assert one["davies_bouldin"] is None and one["calinski_harabasz"] is None and one["wcss"] == 0.5
