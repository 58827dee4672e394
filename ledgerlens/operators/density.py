"""Density clusters over weighted points, by mutual reachability.

A point's core distance is the distance within which ``min_samples`` rows lie, its own
included. Points with a core distance of at most ``reach`` are core points; two of them are
linked when they are at most ``reach`` apart. Linked core points form a cluster; small
clusters, and points that are not core, are noise (-1).

Neighbours are found by a join on blocks: a grid over the widest dimensions whose cells are
as wide as the search goes, so a point's neighbours are in its own block and those that
touch it. A block's points are dealt into parts of bounded size, and every part sees the
points around it in batches; what it keeps are a few distances, a forest or one nearest
point per own point, never pairs. Points that differ in a whole-number flag are at least 1
apart, so narrower searches stay within the flags' values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.components import connected_components
from ledgerlens.functions.distance import squared_distances
from ledgerlens.functions.ordering import with_global_index
from ledgerlens.functions.quantiles import values_at_ranks
from ledgerlens.functions.rowdigest import HALVES, digest_halves
from ledgerlens.functions.skew import join_by_key
from ledgerlens.operators.microclusters import MicroClusters, Space
from ledgerlens.session import cut_lineage

GRID_DIMENSIONS = 3
POINTS_PER_PART = 2_000
PARTS_LABELLED_IN_ONE = 8
OTHERS_AT_ONCE = 1_000


# --- the join of points with the points around them -------------------------------------


def ranges(points: DataFrame, dimensions: int) -> list[float]:
    """Largest minus smallest value of the first ``dimensions`` coordinates."""
    if not dimensions:
        return []
    values = [F.get("point", F.lit(i)) for i in range(dimensions)]
    row = points.agg(*[(F.max(v) - F.min(v)).alias(f"r{i}") for i, v in enumerate(values)]).first()
    return [row[f"r{i}"] or 0.0 for i in range(dimensions)]


def widest(points: DataFrame, dimensions: int, count: int = GRID_DIMENSIONS) -> list[int]:
    """The dimensions, among the first ``dimensions``, with the largest range."""
    found = ranges(points, dimensions)
    return sorted(range(dimensions), key=lambda i: (-found[i], i))[:count]


def _kind_key(space: Space, width: float) -> Column:
    """What two points within ``width`` must have in common: exact features that no distance can bridge."""
    names = space.exact if width < 1 else [f for f in space.exact if f not in space.numbers]
    return F.struct(*[F.col("kind")[f].alias(f) for f in names]) if names else F.lit(0)


def meet(
    own: DataFrame, others: DataFrame, space: Space, width: float, dims: Sequence[int], kernel: Callable[..., "Kernel"], schema: str,
    parts_in_one: int = 1,
) -> DataFrame:
    """Show every point of ``own`` the points of ``others`` within ``width`` (and more), and return what ``kernel`` made of them.

    Both have id, n, kind, point; ``others`` has a label too.
    """
    base = [F.floor(F.get("point", F.lit(d)) / F.lit(width)).cast("bigint") for d in dims] or [F.lit(0).cast("bigint")]
    steps = list(product((-1, 0, 1), repeat=len(dims))) if dims else [(0,)]
    around = F.array(*[F.array(*[b + F.lit(s) for b, s in zip(base, step)]) for step in steps])
    placed = own.select("id", "n", "point", _kind_key(space, width).alias("kind_key"), F.array(*base).alias("block"))
    blocks = placed.groupBy("kind_key", "block").agg(F.count("*").alias("points"))
    blocks = cut_lineage(blocks.withColumn("parts", F.ceil(F.col("points") / (POINTS_PER_PART * parts_in_one)).cast("int")))
    mine = join_by_key(placed, blocks, ["kind_key", "block"], "points", "inner")
    mine = mine.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    near = others.select("id", "n", "point", "label", _kind_key(space, width).alias("kind_key"), F.explode(around).alias("block"))
    near = near.join(blocks.select("kind_key", "block", "parts"), ["kind_key", "block"])
    near = near.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    key = [F.xxhash64("kind_key", "block", "part").alias("_h"), F.hash("kind_key", "block", "part").alias("_g")]
    both = mine.select(*key, F.lit(0).alias("_role"), "id", "n", "point", F.lit(None).cast("int").alias("label")).unionByName(
        near.select(*key, F.lit(1).alias("_role"), "id", "n", "point", "label")
    )
    ordered = both.repartition("_h", "_g").sortWithinPartitions("_h", "_g", "_role", "id")
    return ordered.mapInArrow(_streamed(kernel), schema)


def _streamed(kernel: Callable[..., "Kernel"]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, active = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, g, role = (batch.column(i).to_numpy() for i in range(3))
            change = (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | (role[1:] != role[:-1])
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(h)]
            for a, b in zip(cuts, cuts[1:]):
                if (h[a], g[a]) != key:
                    if active:
                        yield active.result()
                    key, own, active = (h[a], g[a]), [], None
                part = _Points(batch.slice(a, b - a))
                if role[a] == 0:
                    own.append(part)
                    continue
                active = active or kernel(_Points.joined(own))
                for start in range(0, b - a, OTHERS_AT_ONCE):
                    active.add(part.slice(start, OTHERS_AT_ONCE))
        if active:
            yield active.result()

    return run


class _Points:
    """ids, weights, coordinates and labels of some rows."""

    def __init__(self, batch: pa.RecordBatch | None):
        if batch is not None:
            self.ids, self.n = batch.column(3).to_numpy(), batch.column(4).to_numpy()
            flat = batch.column(5).flatten().to_numpy(zero_copy_only=False)
            self.points = flat.reshape(batch.num_rows, -1)
            self.labels = batch.column(6).fill_null(-1).to_numpy()

    def slice(self, start: int, count: int) -> "_Points":
        result = _Points(None)
        for name in ("ids", "n", "points", "labels"):
            setattr(result, name, getattr(self, name)[start : start + count])
        return result

    @staticmethod
    def joined(parts: list["_Points"]) -> "_Points":
        result = _Points(None)
        for name in ("ids", "n", "points", "labels"):
            setattr(result, name, np.concatenate([getattr(p, name) for p in parts]))
        return result


class Kernel:
    """What one part of a block makes of the points around it."""

    def __init__(self, own: _Points):
        self.own = own

    def add(self, others: _Points) -> None:
        raise NotImplementedError

    def result(self) -> pa.RecordBatch:
        raise NotImplementedError


class _CoreDistances(Kernel):
    """The nearest few points of each; as each stands for a row at least, ``min_samples`` of them are enough."""

    def __init__(self, own: _Points, min_samples: int, width: float):
        super().__init__(own)
        self.min_samples, self.limit = min_samples, width * width
        self.nearest = np.full((len(own.ids), min_samples), np.inf)
        self.weights = np.zeros((len(own.ids), min_samples))

    def add(self, others: _Points) -> None:
        distances = squared_distances(self.own.points, others.points)
        distances[distances > self.limit] = np.inf
        distances = np.concatenate([self.nearest, distances], axis=1)
        weights = np.concatenate([self.weights, np.broadcast_to(others.n, (len(self.own.ids), len(others.ids)))], axis=1)
        best = np.argpartition(distances, self.min_samples - 1, axis=1)[:, : self.min_samples]
        self.nearest = np.take_along_axis(distances, best, axis=1)
        self.weights = np.take_along_axis(weights, best, axis=1)

    def result(self) -> pa.RecordBatch:
        order = np.argsort(self.nearest, axis=1, kind="stable")
        nearest = np.take_along_axis(self.nearest, order, axis=1)
        weights = np.where(np.isinf(nearest), 0, np.take_along_axis(self.weights, order, axis=1))
        enough = weights.cumsum(axis=1) >= self.min_samples
        core = np.sqrt(nearest[np.arange(len(nearest)), enough.argmax(axis=1)])
        return pa.RecordBatch.from_arrays(
            [pa.array(self.own.ids), pa.array(core, mask=~enough.any(axis=1))], names=["id", "core_distance"]
        )


class _Links(Kernel):
    """A forest of the links of the part's own points: at most one link for each point it saw or has."""

    def __init__(self, own: _Points, reach: float):
        super().__init__(own)
        self.limit = reach * reach
        self.root = np.arange(len(own.ids))
        self.seen: list[tuple[int, int]] = []

    def add(self, others: _Points) -> None:
        close = squared_distances(self.own.points, others.points) <= self.limit
        for j in np.flatnonzero(close.any(axis=0)).tolist():
            mine = np.flatnonzero(close[:, j])
            roots = np.unique(self.root[mine])
            if len(roots) > 1:
                self.root[np.isin(self.root, roots[1:])] = roots[0]
            self.seen.append((int(others.ids[j]), int(self.own.ids[mine[0]])))

    def result(self) -> pa.RecordBatch:
        u = np.concatenate([self.own.ids, np.array([a for a, _ in self.seen], np.int64)])
        v = np.concatenate([self.own.ids[self.root], np.array([b for _, b in self.seen], np.int64)])
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


class _Nearest(Kernel):
    """The label of each point's nearest other point within reach; ties go to the smallest id.

    A matrix product gives distances up to a rounding error, whose bound leaves each point
    the few others that may be its nearest; only these are measured by differences.
    """

    def __init__(self, own: _Points, reach: float):
        super().__init__(own)
        self.limit = reach * reach
        self.best = np.full(len(own.ids), np.inf)
        self.label = np.full(len(own.ids), -1, np.int64)
        self.origin: np.ndarray | None = None

    def add(self, others: _Points) -> None:
        if self.origin is None:
            self.origin = np.nan_to_num(others.points[0], posinf=0.0, neginf=0.0)
        for start in range(0, len(self.own.ids), POINTS_PER_PART):
            self._add(slice(start, start + POINTS_PER_PART), others)

    def _add(self, at: slice, others: _Points) -> None:
        x, y, best = self.own.points[at], others.points, self.best[at]
        row, column = self._candidates(x, y, best)
        found = np.zeros(len(row))
        for a, b in zip(x.T, y.T):
            apart = a[row] - b[column]
            found += apart * apart
        order = np.lexsort((column, found, row))  # points come by id
        row, column, found = row[order], column[order], found[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        closer = first[(found[first] <= self.limit) & (found[first] < best[row[first]])]
        self.best[at][row[closer]] = found[closer]
        self.label[at][row[closer]] = others.labels[column[closer]]

    def _candidates(self, x: np.ndarray, y: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``x``, row of ``y``) among which is each row's nearest, if it is within reach and nearer than the best so far."""
        x, y = x - self.origin, y - self.origin
        x_square, y_square = np.square(x).sum(axis=1), np.square(y).sum(axis=1)
        rough = x @ (-2 * y.T)
        rough += x_square[:, None]
        rough += y_square
        # More than twice what differences, products and sums can be off.
        slack = (8 * x.shape[1] + 64) * np.finfo(float).eps * (x_square + y_square.max())
        return np.nonzero(rough <= (np.minimum(np.minimum(rough.min(axis=1), best), self.limit) + slack)[:, None])

    def result(self) -> pa.RecordBatch:
        labels = pa.array(self.label.astype(np.int32), mask=np.isinf(self.best))
        return pa.RecordBatch.from_arrays([pa.array(self.own.ids), labels], names=["id", "label"])


# --- clusters --------------------------------------------------------------------------


def core_distances(points: DataFrame, space: Space, min_samples: int, width: float, share: float = 1.0) -> DataFrame:
    """Exact core distances, searched in rings of doubling width until ``share`` of the points have theirs.

    Points without one (fewer than ``min_samples`` rows in all, or beyond the last ring)
    have null, which is more than any distance found.
    """
    total, rows = points.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    others = points.withColumn("label", F.lit(0))
    if rows < min_samples:
        return points.select("id", "n", F.lit(None).cast("double").alias("core_distance"))
    known, left = None, points
    dims = widest(points, len(space.measured))
    farthest = math.sqrt(sum(r * r for r in ranges(points, len(space.measured) + len(space.numbers))))
    while True:
        found = meet(
            left, others, space, width, dims,
            lambda own, w=width: _CoreDistances(own, min_samples, w), "id bigint, core_distance double",
        )
        found = cut_lineage(found)
        new = found.filter("core_distance IS NOT NULL")
        known = new if known is None else cut_lineage(known.unionByName(new))
        if known.count() >= share * total or width > farthest:
            return points.select("id", "n").join(known, "id", "left")
        left = points.join(known.select("id"), "id", "left_anti")
        width *= 2


def chosen_reach(cores: DataFrame, core_share: float) -> float | None:
    """The core distance that ``core_share`` of the points keep within; None if too few have one."""
    known = cores.filter("core_distance IS NOT NULL")
    rank = max(0, math.ceil(core_share * cores.count()) - 1)
    return values_at_ranks(known, "core_distance", [rank])[0] if rank < known.count() else None


def density_labels(
    points: DataFrame, space: Space, reach: float, min_cluster_size: int, min_samples: int, size_in_rows: bool = False,
    cores: DataFrame | None = None,
) -> DataFrame:
    """id, n, label of every point: clusters of ``min_cluster_size`` core points (or their rows) and more, by first id; else -1."""
    if cores is None:
        near = points.withColumn("label", F.lit(0))
        dims = widest(points, len(space.measured))
        schema = "id bigint, core_distance double"
        cores = meet(points, near, space, reach, dims, lambda own: _CoreDistances(own, min_samples, reach), schema)
    dense = cut_lineage(points.join(cores.filter(F.col("core_distance") <= reach).select("id"), "id", "left_semi"))
    dims = widest(dense, len(space.measured))
    links = meet(dense, dense.withColumn("label", F.lit(0)), space, reach, dims, lambda own: _Links(own, reach), "u bigint, v bigint")
    members = connected_components(links)
    placed = dense.select("id", "n").join(members.withColumnRenamed("node", "id"), "id", "left")
    placed = cut_lineage(placed.select("id", "n", F.coalesce("component", "id").alias("component")))
    sizes = placed.groupBy("component").agg(F.count("*").alias("size"), F.sum("n").alias("rows"))
    large = cut_lineage(sizes.filter(F.col("rows" if size_in_rows else "size") >= min_cluster_size).select("component", "size"))
    numbered = with_global_index(large, "component", name="label").select("component", "size", F.col("label").cast("int").alias("label"))
    labelled = join_by_key(placed.select("id", "component"), numbered, ["component"], "size", "inner").select("id", "label")
    return points.select("id", "n").join(labelled, "id", "left").select("id", "n", F.coalesce("label", F.lit(-1)).alias("label"))


def clusters_of(
    found: MicroClusters, reach: float | None, min_cluster_size: int, min_samples: int, size_in_rows: bool = False, core_share: float = 0.9
) -> tuple[DataFrame, float]:
    """Labels of the micro-clusters, and the reach: twice the threshold, or more where fewer than ``core_share`` were core points."""
    points, space = found.points(), found.space
    cores = None
    if reach is None:
        cores = cut_lineage(core_distances(points, space, min_samples, 2 * space.threshold, core_share))
        reach = max(2 * space.threshold, chosen_reach(cores, core_share) or 0.0)
    return density_labels(points, space, reach, min_cluster_size, min_samples, size_in_rows, cores), reach


def nearest_labels(df: DataFrame, space: Space, core: DataFrame, reach: float, name: str) -> DataFrame:
    """Every row with the label of its nearest core point (id, n, kind, point, label) within ``reach``, else -1.

    Equal rows are searched once; rows find their label again by a 128-bit digest of their
    values, which sorts faster than the values, and a digest that many rows have is joined
    by broadcast.
    """
    rows = df.withColumns({"_point": space.point(), "_kind": space.kind()})
    rows = rows.withColumns(digest_halves(["_kind", "_point"])).drop("_kind", "_point")
    values = df.select(space.kind().alias("kind"), space.point().alias("point"))
    distinct = values.groupBy("kind", "point").agg(F.count("*").alias("n"))
    distinct = cut_lineage(distinct.withColumn("id", F.monotonically_increasing_id()))
    dims = widest(core, len(space.measured))
    found = meet(distinct, core, space, reach, dims, lambda own: _Nearest(own, reach), "id bigint, label int", PARTS_LABELLED_IN_ONE)
    halves = [half.alias(column) for column, half in digest_halves(["kind", "point"]).items()]
    table = distinct.join(found.filter("label IS NOT NULL"), "id").select(*halves, "n", F.col("label").alias(name))
    return join_by_key(rows, cut_lineage(table), list(HALVES), "n", "left").drop(*HALVES).fillna({name: -1})
