"""Micro-clusters and density clusters against brute force."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import density, segments
from ledgerlens.operators import microclusters as micro
from ledgerlens.plans.registry import MODEL_FEATURES
from ledgerlens.plans.stages import prepared

JOIN = density.join_by_key
POINT = "id bigint, x double, y double, z double, flag tinyint, kind string"


def rows(n=2_000, seed=1):
    """Clumps of all sizes over two flags, some points repeated often, some far from everything."""
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-6, 6, (12, 3))
    result = []
    for i in range(n):
        c = centres[int(rng.integers(12))] if rng.random() < 0.9 else rng.uniform(-9, 9, 3)
        p = c + rng.normal(0, 0.1 + 0.4 * rng.random(), 3)
        if i % 50 == 0:
            p = centres[0]
        result.append((i, *map(float, p), int(rng.integers(2)), "ab"[int(rng.integers(2))]))
    return result


def frame(spark, data):
    return spark.createDataFrame(data, POINT)


def test_micro_clusters_hold_their_rows_within_the_radius(spark):
    df = frame(spark, rows())
    found = micro.build(df, ["x", "y", "z", "flag"], 0.5)
    assert found.space.exact == ("flag",)
    ids = found.summaries.select("id", F.col("id").cast("int").alias("label"))
    labelled = found.label(df, ids, "m").collect()
    members = {}
    for r in labelled:
        members.setdefault(r["m"], []).append((r["x"], r["y"], r["z"], r["flag"]))
    table = {r["id"]: r for r in found.table().collect()}
    assert set(members) == set(table) and len(table) < 500
    for m, points in members.items():
        p = np.array(points)
        spread = math.sqrt(((p - p.mean(axis=0)) ** 2).sum(axis=1).mean())
        assert spread <= 0.5 + 1e-6
        assert table[m]["n"] == len(p)
        assert table[m]["radius"] == pytest.approx(spread, abs=1e-6)
        assert [table[m][c] for c in ("x", "y", "z", "flag")] == pytest.approx(p.mean(axis=0).tolist(), abs=1e-6)


def test_micro_clusters_do_not_depend_on_rows_order_or_partitions(spark, monkeypatch):
    df = frame(spark, rows())

    def table(given):
        return sorted(map(tuple, segments.microclusters(given, ["x", "y", "z", "flag"], 0.5).collect()))

    first = table(df.coalesce(1))
    assert first == table(df.orderBy(F.rand(3)).repartition(9))
    monkeypatch.setattr(micro, "AT_ONCE", 7)
    assert table(df.coalesce(1)) == table(df.orderBy(F.desc("x")).repartition(5))


def test_micro_clusters_of_odd_tables(spark):
    def table(data, features, **named):
        return segments.microclusters(frame(spark, data), features, 0.5, **named).collect()

    assert table([], ["x", "y"]) == []
    assert [r["n"] for r in table([(1, None, 0.0, 0.0, None, None)] * 3 + [(2, 0.0, 0.0, 0.0, None, None)], ["x", "y", "flag"])] == [4]
    by_kind = table([(i, 0.1 * i, 0.0, 0.0, 0, "ab"[i % 2]) for i in range(4)], ["x", "kind"], exact=["kind"])
    assert sorted((r["kind"], r["n"]) for r in by_kind) == [("a", 2), ("b", 2)]
    flags_only = table([(i, 0.0, 0.0, 0.0, i % 2, "a") for i in range(10)], ["flag"])
    assert sorted((r["flag"], r["n"], r["radius"]) for r in flags_only) == [(0, 5, 0.0), (1, 5, 0.0)]


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="needs the larger tables")
def test_micro_clusters_compress_the_ledger_tenfold(spark):
    model = prepared(spark, "/root/testdata/sf0.1")
    table = segments.microclusters(model, MODEL_FEATURES).agg(F.count("*"), F.sum("n"), F.max("radius")).first()
    assert table[0] * 10 <= table[1] and table[2] <= 0.3


def brute_labels(points, weights, reach, min_size, min_samples, size_in_rows=False):
    """Mutual reachability over all pairs; sets of members per cluster, everything else is noise."""
    far = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    core = []
    for d in far:
        order = np.argsort(d, kind="stable")
        enough = np.cumsum(weights[order]) >= min_samples
        core.append(d[order][enough.argmax()] if enough.any() else np.inf)
    core = np.array(core)
    linked = (np.maximum(far, np.maximum(core[:, None], core[None, :])) <= reach) & (core <= reach)[:, None]
    label, clusters = np.full(len(points), -1), []
    for i in range(len(points)):
        if core[i] <= reach and label[i] < 0:
            label[i], stack, members = i, [i], []
            while stack:
                at = stack.pop()
                members.append(at)
                for j in np.flatnonzero(linked[at] & (label < 0)):
                    label[j] = i
                    stack.append(j)
            if (weights[members].sum() if size_in_rows else len(members)) >= min_size:
                clusters.append(frozenset(members))
    return core, set(clusters)


def as_points(spark, data):
    """Every row as a point of its own, with some weights."""
    df = frame(spark, data).withColumn("n", F.when(F.col("id") % 7 == 0, 5).otherwise(1).cast("bigint"))
    where = micro.space(df, ["x", "y", "z", "flag"], 0.3)
    return df.select("id", "n", where.kind().alias("kind"), where.point().alias("point")), where


@pytest.mark.parametrize("reach, min_size, in_rows", [(0.35, 5, False), (0.9, 20, True), (1.4, 3, False)])
def test_density_labels_equal_brute_force(spark, monkeypatch, reach, min_size, in_rows):
    monkeypatch.setattr(density, "POINTS_PER_PART", 40)
    points, where = as_points(spark, rows())
    points = points.cache()
    plain = np.array([r["point"] for r in points.orderBy("id").collect()])
    weights = np.array([5 if i % 7 == 0 else 1 for i in range(len(plain))])
    core, clusters = brute_labels(plain, weights, reach, min_size, 10, in_rows)
    found = density.core_distances(points, where, 10, reach)
    assert {r["id"]: r["core_distance"] for r in found.collect()} == pytest.approx(dict(enumerate(core)))
    labels = {}
    for r in density.density_labels(points, where, reach, min_size, 10, in_rows).collect():
        labels.setdefault(r["label"], set()).add(r["id"])
    noise = labels.pop(-1, set())
    assert {frozenset(m) for m in labels.values()} == clusters and len(clusters) > 1
    assert noise == set(range(len(plain))) - set().union(*clusters)
    assert sorted(labels) == list(range(len(labels)))


def test_nearest_labels_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(density, "POINTS_PER_PART", 30)
    core, where = as_points(spark, rows(300, seed=2))
    core = core.withColumn("label", (F.col("id") % 11).cast("int")).cache()
    data = rows(2_000, seed=3) + [(5_000 + i, 1.0, 1.0, 1.0, 0, "a") for i in range(500)]
    plain = np.array([r["point"] for r in core.orderBy("id").collect()])
    for reach in (0.4, 2.5):
        found = density.nearest_labels(frame(spark, data), where, core, reach, "label")
        assert found.columns == ["id", "x", "y", "z", "flag", "kind", "label"]
        for r in found.collect():
            far = np.sqrt(((plain - np.array([r["x"], r["y"], r["z"], float(r["flag"])])) ** 2).sum(axis=1))
            assert r["label"] == (int(far.argmin()) % 11 if far.min() <= reach else -1)


def test_nearest_kernel_measures_few_points_by_differences(monkeypatch):
    def points(ids, values, labels):
        made = density._Points(None)
        made.ids, made.n, made.points, made.labels = ids, np.ones(len(ids)), values, labels
        return made

    rng = np.random.default_rng(5)
    for scale, shift in ((1.0, 0.0), (1e-3, 1e6)):
        own = rng.normal(shift, scale, (300, 7))
        core = np.concatenate([rng.normal(shift, scale, (900, 7)), own[:50], own[:50]])  # ties: the smaller id
        own[-1] = np.nan
        reach = 2.0 * scale
        far = density.squared_distances(own, core)
        expected = [int(np.argmin(f)) if np.min(f) <= reach * reach else None for f in far]
        with monkeypatch.context() as patched:
            patched.setattr(density, "squared_distances", lambda *_: pytest.fail("all pairs are measured"))
            kernel = density._Nearest(points(np.arange(len(own)), own, None), reach)
            whole = points(np.arange(len(core)), core, np.arange(len(core)))
            for start in range(0, len(core), 130):
                kernel.add(whole.slice(start, 130))
        assert kernel.result().column("label").to_pylist() == expected
        assert 50 < sum(e is not None for e in expected) < len(own)


def test_labels_come_back_by_digest(spark, monkeypatch):
    joined = []
    monkeypatch.setattr(density, "join_by_key", lambda rows, table, keys, *args: joined.append([rows.schema[k].dataType.simpleString() for k in keys]) or JOIN(rows, table, keys, *args))
    core, where = as_points(spark, rows(300, seed=2))
    data = [(0, 0.0, 1.0, 1.0, 0, "a"), (1, -0.0, 1.0, 1.0, 0, "a"), (2, float("nan"), 1.0, 1.0, 0, "a"), (3, None, 1.0, 1.0, None, None)]
    density.nearest_labels(frame(spark, data), where, core.withColumn("label", F.lit(1)), 9.0, "label").collect()
    assert joined[-1] == ["bigint", "bigint"]


def test_reach_follows_the_data_and_small_tables_are_noise(spark):
    found = micro.build(frame(spark, rows(500)), ["x", "y", "z", "flag"], 0.3)
    _, reach = density.clusters_of(found, None, 5, 10)
    _, wider = density.clusters_of(found, None, 5, 10, core_share=0.99)
    assert 0.6 <= reach < wider
    few = segments.density_cluster_centres(frame(spark, rows(4)), ["x", "y", "z", "flag"])
    assert {r["cluster_birch_hdbscan"] for r in few.collect()} == {-1}
    none = segments.density_cluster_centres(frame(spark, []), ["x", "y", "z", "flag"])
    assert none.collect() == []


def test_most_of_the_ledger_is_clustered_at_the_default_threshold(spark):
    model = prepared(spark, "/root/testdata/sf0.01")
    found = segments.density_cluster_centres(model, MODEL_FEATURES)
    noise = found.agg(F.avg((F.col("cluster_birch_hdbscan") == -1).cast("double"))).first()[0]
    assert noise < 0.1
