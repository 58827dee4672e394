"""The best centre of every point when there are too many centres to ship with tasks.

Centres are kept in cells: the centres around one pivot (a centre drawn by hash) within one
ring of distances from it. By the triangle inequality a point ``d`` from the pivot is at
least ``max(d - high, low - d)`` from every centre of a ring ``low..high``. A point first
meets one part of the cell that looks nearest, which gives it a bound, then the parts of
those cells only that the bound leaves open. What travels with tasks is the table of pivots
and rings, whose size is set by ``PIVOTS`` and ``RINGS``; centres and points meet by a
shuffle on cells, with the points of a crowded cell dealt over several tasks and read in
batches.

Two measures are searched: the nearest centre, and the centre with the largest
``(weight + weight of the centre) / distance``, which Davies-Bouldin asks for. A point's
``own`` centre never counts. Ties go to the lowest centre id. Points and centres with a null
or non-finite coordinate take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.distance import nearest, squared_distances
from ledgerlens.functions.skew import join_by_key
from ledgerlens.session import cut_lineage

PIVOTS, RINGS = 256, 16
CENTRES_PER_CELL = 32
CENTRES_PER_PART = 1_000
POINTS_PER_TASK = 200_000
POINTS_AT_ONCE = 500
SLACK = 1e-9

NEAREST, RATIO = "nearest", "ratio"

VISIT = "row bigint, own bigint, weight double, point array<double>, cell int, part int"
FOUND = "row bigint, own bigint, weight double, value double, id bigint"
FIRST = f"{FOUND}, point array<double>, cell int, part int"


def usable(point: str) -> Column:
    """No coordinate is null, NaN or infinite."""
    return F.coalesce(F.forall(point, lambda v: v.isNotNull() & (F.abs(v) < float("inf"))), F.lit(False))


def _costs(measure: str, squared: np.ndarray, weights: np.ndarray, others: np.ndarray) -> np.ndarray:
    """What is searched for the smallest value: squared distance, or the negative ratio."""
    if measure == NEAREST:
        return squared
    with np.errstate(divide="ignore", invalid="ignore"):
        ratios = -(weights[:, None] + others[None, :]) / np.sqrt(squared)
    return np.where(squared > 0, ratios, np.inf)


def _best(measure: str, points: np.ndarray, own: np.ndarray, weights: np.ndarray, ids: np.ndarray, centres: np.ndarray, others: np.ndarray):
    """Per point the smallest cost among these centres (in order of their ids) and whose it is."""
    costs = _costs(measure, squared_distances(points, centres), weights, others)
    costs[own[:, None] == ids[None, :]] = np.inf
    at = costs.argmin(axis=1)
    value = costs[np.arange(len(at)), at]
    return value, np.where(np.isinf(value), -1, ids[at])


@dataclass(frozen=True)
class Cells:
    """Pivots, and per cell its pivot, ring bounds, largest weight and number of parts."""

    pivot_ids: np.ndarray
    pivots: np.ndarray
    pivot_weights: np.ndarray
    cell: np.ndarray
    of: np.ndarray
    low: np.ndarray
    high: np.ndarray
    top: np.ndarray
    parts: np.ndarray

    def lowest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower bounds of the distance to every cell, and the distances to the cells' pivots."""
        away = np.sqrt(squared_distances(points, self.pivots))[:, self.of]
        bound = np.maximum(0.0, np.maximum(away - self.high, self.low - away))
        return np.maximum(0.0, bound - SLACK * (away + self.high)), away

    def home(self, points: np.ndarray) -> np.ndarray:
        bound, away = self.lowest(points)
        return (bound + 0.01 * away).argmin(axis=1)

    def hopes(self, measure: str, points: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The lowest cost that any centre of a cell could have."""
        bound, _ = self.lowest(points)
        if measure == NEAREST:
            return bound * bound * (1 - SLACK)
        with np.errstate(divide="ignore"):
            return np.where(bound > 0, -(weights[:, None] + self.top[None, :]) / bound * (1 + SLACK), -np.inf)


@dataclass(frozen=True)
class CentreIndex:
    cells: Cells
    centres: DataFrame  # id, point, weight, cell, part

    @staticmethod
    def build(centres: DataFrame) -> CentreIndex:
        """Index centres given as id (long), point (doubles) and weight (double)."""
        centres = centres.select("id", "point", "weight").filter(usable("point"))
        count = centres.count()
        if not count:
            raise ValueError("there are no centres to search")
        wanted = max(1, min(PIVOTS, count // CENTRES_PER_CELL))
        drawn = sorted(centres.orderBy(F.xxhash64("id"), "id").limit(wanted).collect(), key=lambda r: r["id"])
        pivots = [list(r["point"]) for r in drawn]
        rings = max(1, min(RINGS, count // (wanted * CENTRES_PER_CELL)))
        placed = cut_lineage(centres.withColumn("_near", nearest("point", pivots)).select(
            "id", "point", "weight", F.col("_near.id").alias("pivot"), F.sqrt("_near.distance").alias("away")
        ))
        if rings > 1:
            shares = [(i + 1) / rings for i in range(rings - 1)]
            edges = placed.groupBy("pivot").agg(F.percentile_approx("away", shares, 1_000).alias("edges"))
            placed = placed.join(edges, "pivot")  # one line per pivot
            ring = F.size(F.filter("edges", lambda e: e < F.col("away")))
        else:
            ring = F.lit(0)
        celled = placed.withColumn("cell", (F.col("pivot") * RINGS + ring).cast("int"))
        table = sorted(
            celled.groupBy("cell", "pivot").agg(
                F.min("away").alias("low"), F.max("away").alias("high"), F.max("weight").alias("top"), F.count("*").alias("n")
            ).collect(),
            key=lambda r: r["cell"],
        )
        parts = [-(-r["n"] // CENTRES_PER_PART) for r in table]
        of_cell = F.get(F.array(*[F.lit(p) for p in _by_number(table, parts)]), F.col("cell"))
        dealt = celled.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), of_cell).cast("int"))
        cells = Cells(
            np.array([r["id"] for r in drawn], np.int64), np.array(pivots, float), np.array([r["weight"] for r in drawn], float),
            np.array([r["cell"] for r in table]), np.array([r["pivot"] for r in table]),
            *[np.array([r[c] for r in table], float) for c in ("low", "high", "top")], np.array(parts),
        )
        return CentreIndex(cells, cut_lineage(dealt.select("id", "point", "weight", "cell", "part")))

    def search(self, points: DataFrame, measure: str = NEAREST) -> DataFrame:
        """``row, own, weight, value, id`` for points given as row (unique), own, weight and point.

        The value is the squared distance or the ratio; null, with a null id, where no other centre
        qualifies. Without an own centre, give -1.
        """
        cells = self.cells
        given = points.select(F.col("row").cast("bigint"), F.col("own").cast("bigint"), F.col("weight").cast("double"), "point")
        given = given.filter(usable("point"))
        first = cut_lineage(self._meet(given.mapInPandas(_homes(cells), VISIT), measure, FIRST))
        open_parts = first.mapInPandas(_still_open(cells, measure), VISIT)
        later = self._meet(open_parts, measure, FOUND)
        from_pivots = first.mapInPandas(_with_pivots(cells, measure), FOUND)
        best = later.unionByName(from_pivots).groupBy("row", "own", "weight").agg(F.min(F.struct("value", "id")).alias("best"))
        nothing = F.col("best.value") == float("inf")
        value = F.col("best.value") if measure == NEAREST else -F.col("best.value")
        return best.select(
            "row", "own", "weight", F.when(~nothing, value).alias("value"), F.when(~nothing, F.col("best.id")).alias("id")
        )

    def _meet(self, visits: DataFrame, measure: str, schema: str) -> DataFrame:
        """Show every visiting point the centres of its part."""
        visits = cut_lineage(visits)
        tasks = F.ceil(F.count("*") / POINTS_PER_TASK).cast("int")
        crowds = cut_lineage(visits.groupBy("cell", "part").agg(F.count("*").alias("n"), tasks.alias("tasks")))
        mine = join_by_key(visits, crowds, ["cell", "part"], "n", "inner")
        mine = mine.select(
            "cell", "part", F.pmod(F.xxhash64("row"), F.col("tasks")).cast("int").alias("task"), F.lit(1).alias("role"),
            "row", "own", "weight", "point",
        )
        shown = self.centres.join(crowds.drop("n"), ["cell", "part"]).select(
            "cell", "part", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("role"),
            F.col("id").alias("row"), F.lit(-1).cast("bigint").alias("own"), "weight", "point",
        )
        place = ["cell", "part", "task"]
        met = shown.unionByName(mine).repartition(*place).sortWithinPartitions(*place, "role", "row")
        return met.mapInPandas(_compared(measure, schema == FIRST), schema)


def _by_number(table: list, parts: list[int]) -> list[int]:
    """Parts by cell number, 1 for numbers without a cell."""
    known = {r["cell"]: p for r, p in zip(table, parts)}
    return [known.get(i, 1) for i in range(max(known) + 1)]


def _matrix(points: pd.Series) -> np.ndarray:
    return np.stack(points.to_numpy()).astype(float)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), POINTS_AT_ONCE):
            yield batch.iloc[start : start + POINTS_AT_ONCE]


def _homes(cells: Cells):
    """Send every point to one part of the cell that looks nearest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in _pieces(batches):
            at = cells.home(_matrix(piece["point"]))
            yield piece.assign(cell=cells.cell[at], part=piece["row"].to_numpy() % cells.parts[at])

    return run


def _from_pivots(cells: Cells, measure: str, piece: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The better of what the first visit found and the pivots; the lower id among equals."""
    value, ids = piece["value"].to_numpy(), piece["id"].to_numpy()
    there, whose = _best(
        measure, _matrix(piece["point"]), piece["own"].to_numpy(), piece["weight"].to_numpy(), cells.pivot_ids, cells.pivots, cells.pivot_weights
    )
    better = (there < value) | ((there == value) & (whose < ids))
    return np.where(better, there, value), np.where(better, whose, ids)


def _with_pivots(cells: Cells, measure: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in _pieces(batches):
            value, ids = _from_pivots(cells, measure, piece)
            yield piece[["row", "own", "weight"]].assign(value=value, id=ids)

    return run


def _still_open(cells: Cells, measure: str):
    """One visit for each part that could hold a centre as good as the best so far, the visited part left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in _pieces(batches):
            value, _ = _from_pivots(cells, measure, piece)
            hopes = cells.hopes(measure, _matrix(piece["point"]), piece["weight"].to_numpy())
            point, at = np.nonzero(hopes <= value[:, None])
            copies = cells.parts[at]
            point, at = np.repeat(point, copies), np.repeat(at, copies)
            part = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
            been = piece.iloc[point]
            new = (been["cell"].to_numpy() != cells.cell[at]) | (been["part"].to_numpy() != part)
            visits = been[["row", "own", "weight", "point"]].assign(cell=cells.cell[at], part=part)
            yield visits[new]

    return run


def _compared(measure: str, keep_point: bool):
    """Read a part's centres, then compare its points with them, batch by batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, held = None, []
        for batch in batches:
            where = batch[["cell", "part", "task", "role"]].to_numpy()
            cuts = [0, *(np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1).tolist(), len(where)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if place != tuple(where[a, :3]):
                    place, held = tuple(where[a, :3]), []
                part = batch.iloc[a:b]
                if where[a, 3] == 0:
                    held.append(part)
                    continue
                if len(held) != 1:
                    held = [pd.concat(held)]
                centres = held[0]
                ids, others, matrix = centres["row"].to_numpy(), centres["weight"].to_numpy(), _matrix(centres["point"])
                for piece in _pieces(iter([part])):
                    value, best = _best(
                        measure, _matrix(piece["point"]), piece["own"].to_numpy(), piece["weight"].to_numpy(), ids, matrix, others
                    )
                    columns = ["row", "own", "weight"] + (["point", "cell", "part"] if keep_point else [])
                    yield piece[columns].assign(value=value, id=best)

    return run
