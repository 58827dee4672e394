"""Micro-clusters: mergeable summaries (rows, sums, squares) of radius at most a threshold.

Rows are first summed up per cell of a fine grid, whose cells are narrow enough to keep the
radius whatever they hold. Summaries are then merged in rounds over wider grids, each
shifted against the last one so that no border keeps neighbours apart: within a cell of a
wide grid, a summary joins the nearest cluster there as long as the joint radius stays
within the threshold. Flags and other exact features are part of every key and never
mixed. Radius is the root of the mean squared distance to the centre.

A fine cell's sums are whole numbers (offsets from the cell's corner in steps of its width
over 2^28), and what follows is ordered by content, so summaries depend neither on the
order of rows nor on the partitioning. A wide cell holds a bounded number of fine cells;
should it hold more than ``AT_ONCE`` summaries, they are merged that many at a time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.ordering import with_global_index
from ledgerlens.functions.skew import join_by_key
from ledgerlens.session import cut_lineage

STEPS = 1 << 28
HALF_BITS = 30
AT_ONCE = 4_096
# Width of a round's grid, in thresholds, and how far it is shifted, in widths.
ROUNDS = ((3.0, 0.0), (3.0, 0.5), (4.0, 0.25), (4.0, 0.75))


@dataclass(frozen=True)
class Space:
    """Which features are measured and which are exact; a null measure counts as 0."""

    measured: tuple[str, ...]
    exact: tuple[str, ...]
    threshold: float
    numbers: tuple[str, ...] = ()  # the exact features that are whole numbers or booleans

    @property
    def width(self) -> float:
        """Width of a grid whose cells have no point farther than the threshold from their middle."""
        return 2 * self.threshold / math.sqrt(max(1, len(self.measured)))

    def values(self) -> list[Column]:
        return [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in self.measured]

    def kind(self) -> Column:
        return F.struct(*self.exact) if self.exact else F.lit(0)

    def point(self) -> Column:
        """A row's values in the order of ``MicroClusters.points``."""
        flags = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in self.numbers]
        return F.array(*self.values(), *flags).cast("array<double>")

    def cell(self) -> Column:
        cells = [F.floor(v / F.lit(self.width)).cast("bigint") for v in self.values()]
        return F.array(*cells) if cells else F.array().cast("array<bigint>")


def space(df: DataFrame, features: Sequence[str], threshold: float = 0.3, exact: Sequence[str] | None = None) -> Space:
    """Flags (boolean and byte columns) are exact unless ``exact`` names others."""
    if exact is None:
        exact = [f for f in features if df.schema[f].dataType.simpleString() in ("boolean", "tinyint")]
    whole = ("boolean", "tinyint", "smallint", "int", "bigint")
    numbers = tuple(f for f in exact if df.schema[f].dataType.simpleString() in whole)
    return Space(tuple(f for f in features if f not in exact), tuple(exact), threshold, numbers)


@dataclass(frozen=True)
class MicroClusters:
    """``summaries``: id, kind, n, centre (of the measured features), scatter (sum of squared distances to
    the centre). ``cells``: the id that each fine cell (cell, kind) with its number of rows went into."""

    space: Space
    summaries: DataFrame
    cells: DataFrame

    def table(self) -> DataFrame:
        """One row per micro-cluster: id, n, every feature's centre (an exact feature's value), radius."""
        measured = [F.get("centre", F.lit(i)).alias(f) for i, f in enumerate(self.space.measured)]
        exact = [F.col("kind")[f].alias(f) for f in self.space.exact]
        return self.summaries.select("id", "n", *measured, *exact, F.sqrt(F.col("scatter") / F.col("n")).alias("radius"))

    def points(self) -> DataFrame:
        """id, n, kind and the whole centre as one array: measured features, then whole-number exact ones."""
        flags = [F.coalesce(F.col("kind")[f].cast("double"), F.lit(0.0)) for f in self.space.numbers]
        point = F.concat("centre", F.array(*flags)) if flags else F.col("centre")
        return self.summaries.select("id", "n", "kind", point.alias("point"))

    def label(self, df: DataFrame, labels: DataFrame, name: str, otherwise: int = -1) -> DataFrame:
        """Carry ``label`` per micro-cluster id to the rows; a cell with many rows is joined by broadcast."""
        table = self.cells.join(labels.select("id", F.col("label").alias(name)), "id", "left")
        table = table.select(F.col("cell").alias("_cell"), F.col("kind").alias("_kind"), "n", F.coalesce(name, F.lit(otherwise)).alias(name))
        celled = df.withColumns({"_cell": self.space.cell(), "_kind": self.space.kind()})
        return join_by_key(celled, cut_lineage(table), ["_cell", "_kind"], "n", "left").drop("_cell", "_kind").fillna({name: otherwise})


def fine_cells(df: DataFrame, space: Space) -> DataFrame:
    """One summary per occupied cell of the fine grid: cell, kind, n, centre, scatter. One shuffle of partial sums."""
    places = [v / F.lit(space.width) for v in space.values()]
    offsets = [F.round((p - F.floor(p)) * F.lit(float(STEPS))).cast("bigint") for p in places]
    names = [f"_o{i}" for i in range(len(offsets))]
    rows = df.select(space.kind().alias("kind"), space.cell().alias("cell"), *[o.alias(name) for o, name in zip(offsets, names)])
    square = reduce(lambda a, b: a + b, [F.col(o) * F.col(o) for o in names], F.lit(0).cast("bigint"))
    low = F.lit((1 << HALF_BITS) - 1).cast("bigint")
    summed = rows.withColumn("_sq", square).groupBy("kind", "cell").agg(
        F.count("*").alias("n"),
        F.sum(F.shiftright("_sq", HALF_BITS)).alias("_high"),
        F.sum(F.col("_sq").bitwiseAND(low)).alias("_low"),
        *[F.sum(o).alias(o) for o in names],
    )
    step = F.lit(space.width / STEPS)
    means = [F.col(o) / F.col("n") for o in names]
    squares = F.col("_high") * F.lit(float(1 << HALF_BITS)) + F.col("_low")
    scatter = squares - F.col("n") * reduce(lambda a, b: a + b, [m * m for m in means], F.lit(0.0))
    centre = [F.get("cell", F.lit(i)) * F.lit(space.width) + m * step for i, m in enumerate(means)]
    return summed.select(
        "cell", "kind", "n",
        (F.array(*centre) if centre else F.array().cast("array<double>")).alias("centre"),
        (F.greatest(F.lit(0.0), scatter) * step * step).alias("scatter"),
    )


def greedy(n: np.ndarray, centres: np.ndarray, scatter: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each summary in turn joins the nearest cluster so far if their joint radius is within the threshold.

    Returns the first member of every summary's cluster, and the clusters' rows, centres and scatter at that place.
    """
    limit = threshold * threshold
    n, centres, scatter = n.astype(float), centres.copy(), scatter.copy()
    into = np.arange(len(n))
    heads = np.empty(len(n), np.int64)
    heads[0], count = 0, 1
    means = np.empty_like(centres)
    means[0] = centres[0]
    for i in range(1, len(n)):
        apart = means[:count] - centres[i]
        distance = np.einsum("ij,ij->i", apart, apart)
        best = int(distance.argmin())
        at = heads[best]
        total = n[at] + n[i]
        joint = scatter[at] + scatter[i] + n[at] * n[i] / total * distance[best]
        if joint <= limit * total:
            centres[at] += (centres[i] - centres[at]) * (n[i] / total)
            n[at], scatter[at], into[i] = total, joint, at
            means[best] = centres[at]
        else:
            heads[count], means[count] = i, centres[i]
            count += 1
    return into, n, centres, scatter


_MERGED = "id bigint, into bigint, n bigint, centre array<double>, scatter double"


def _merge_round(summaries: DataFrame, width: float, shift: float, threshold: float) -> DataFrame:
    """Merge within the cells of one wide grid: every summary's id, and its cluster (on the row of its first member)."""
    block = F.transform("centre", lambda c: F.floor(c / F.lit(width) + F.lit(shift)).cast("bigint"))
    keyed = summaries.select(
        F.xxhash64("kind", block).alias("_h"), F.hash("kind", block).alias("_g"), "id", "n", "centre", "scatter"
    )
    ordered = keyed.repartition("_h", "_g").sortWithinPartitions("_h", "_g", F.desc("n"), "centre", "id")

    def finish(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        group = pa.Table.from_batches(parts).combine_chunks()
        ids, n, scatter = (group.column(c).to_numpy() for c in ("id", "n", "scatter"))
        centres = group.column("centre").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        new_n, new_centres, new_scatter = n.copy(), centres.copy(), scatter.copy()
        into = np.arange(len(ids))
        bounds = [*_bounds(group.column("_h").to_numpy(), group.column("_g").to_numpy()), len(ids)]
        # A group comes whole or in parts of AT_ONCE, so it is cut at the same places wherever batches end.
        cuts = [*(c for a, b in zip(bounds, bounds[1:]) for c in range(a, b, AT_ONCE)), len(ids)]
        for a, b in zip(cuts, cuts[1:]):
            if b - a > 1:
                found, rows, means, spread = greedy(n[a:b], centres[a:b], scatter[a:b], threshold)
                into[a:b] = found + a
                new_n[a:b], new_centres[a:b], new_scatter[a:b] = rows.astype(np.int64), means, spread
        arrays = [
            pa.array(ids), pa.array(ids[into]), pa.array(new_n.astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1, dtype=np.int32) * centres.shape[1]), pa.array(new_centres.ravel())),
            pa.array(new_scatter),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["id", "into", "n", "centre", "scatter"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last group of a batch may go on in the next one.
            last = _bounds(batch.column(0).to_numpy(), batch.column(1).to_numpy())[-1]
            same = bool(held) and held[-1].column(0)[-1] == batch.column(0)[0] and held[-1].column(1)[-1] == batch.column(1)[0]
            if held and not (same and last == 0):
                if same:
                    first = _bounds(batch.column(0).to_numpy(), batch.column(1).to_numpy())[1]
                    held.append(batch.slice(0, first))
                    batch, last = batch.slice(first), last - first
                yield finish(held)
                held = []
            if not held and last:
                yield finish([batch.slice(0, last)])
                batch = batch.slice(last)
            held.append(batch)
            if sum(b.num_rows for b in held) >= AT_ONCE:
                group = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                whole = group.num_rows - group.num_rows % AT_ONCE
                yield finish([group.slice(0, whole)])
                held = [group.slice(whole)] if whole < group.num_rows else []
        if held:
            yield finish(held)

    return ordered.mapInArrow(run, _MERGED)


def _bounds(first: np.ndarray, second: np.ndarray) -> list[int]:
    """Where the groups of equal pairs start."""
    change = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    return [0, *(np.flatnonzero(change) + 1).tolist()]


def build(df: DataFrame, features: Sequence[str], threshold: float = 0.3, exact: Sequence[str] | None = None) -> MicroClusters:
    """Summaries of all rows, and the way from a row's cell to its summary."""
    where = space(df, features, threshold, exact)
    numbered = cut_lineage(with_global_index(fine_cells(df, where), "kind", "cell", name="id"))
    cells = numbered.select("cell", "kind", "n", "id")
    summaries = numbered.select("id", "kind", "n", "centre", "scatter")
    kinds = numbered.select("id", "kind")
    if where.measured:
        for width, shift in ROUNDS:
            merged = cut_lineage(_merge_round(summaries, width * threshold, shift, threshold))
            cells = cells.join(merged.select("id", "into"), "id").select("cell", "kind", "n", F.col("into").alias("id"))
            heads = merged.filter(F.col("id") == F.col("into")).drop("into")
            summaries = heads.join(kinds, "id").select("id", "kind", "n", "centre", "scatter")
    return MicroClusters(where, cut_lineage(summaries), cut_lineage(cells))
