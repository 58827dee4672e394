"""Many k-means runs in the same passes over the data.

Every pass is one Arrow map in which a task adds up, for each run still going, weight, sums
and cost per centre; one grouping of these few lines moves the centres of all runs. Runs
that no longer move drop out, so the number of passes follows the longest run, not how many
there are. Starting points are drawn in shared passes too: rounds of points drawn with a
chance proportional to their squared distance, then a weighted k-means++ among those drawn.

Points lie in blocks, a row each with the coordinates as one binary value, so that a pass
spends its time on products of matrices and none on single rows.

Equal points are added up first, and chance is a hash of the point, so that a fit does not
depend on the order or partitioning of the rows. Rows with a null or non-finite feature take
no part; of runs with more centres than different points, some centres coincide.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.centre_search import usable
from ledgerlens.session import cut_lineage, spread

ROUNDS = 2
OVERSAMPLING = 2
TOLERANCE = 1e-4
AT_ONCE = 2_048
BLOCK = "points binary, weights binary, hashes binary"
DRAWN = "run int, point array<double>"


@dataclass(frozen=True)
class Run:
    k: int
    seed: int


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres * centres).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


def _cost(points: np.ndarray, centres: np.ndarray, at: np.ndarray) -> np.ndarray:
    apart = points - centres[at]
    return np.einsum("ij,ij->i", apart, apart)


def _chance(hashes: np.ndarray, salt: int) -> np.ndarray:
    """A number in [0, 1) per point, another one for every salt (finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        z = hashes.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(salt + 1)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)).astype(float) / float(1 << 53)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(point, weight, hash) as blocks of at most ``AT_ONCE`` points."""
    for batch in batches:
        for start in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(start, AT_ONCE)
            widths = np.diff(part.column(0).offsets.to_numpy())
            if (widths != widths[0]).any():
                raise ValueError("all points must have the same number of coordinates")
            points = part.column(0).flatten().to_numpy(zero_copy_only=False)
            weights, hashes = (part.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            block = [pa.array([c.tobytes()], pa.binary()) for c in (points, weights, hashes)]
            yield pa.RecordBatch.from_arrays(block, names=["points", "weights", "hashes"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for points, weights, hashes in zip(*batch.columns):
            weight = np.frombuffer(weights.as_buffer(), float)
            yield np.frombuffer(points.as_buffer(), float).reshape(len(weight), -1), weight, np.frombuffer(hashes.as_buffer(), np.int64)


def _sums(centres: dict[int, np.ndarray]) -> Callable:
    """Per task one line for each run and centre: weight and the sums of the coordinates."""
    stacked = np.concatenate(list(centres.values()))
    lengths = (stacked * stacked).sum(axis=1)[:, None]
    ends = np.cumsum([len(c) for c in centres.values()]).tolist()
    starts = [0, *ends[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, sums = np.zeros(len(stacked)), np.zeros(stacked.shape)
        for points, weights, _ in _blocks(batches):
            apart = lengths - 2 * stacked @ points.T
            share = np.empty_like(apart)
            for low, high in zip(starts, ends):
                own = apart[low:high]
                nearest = own == own.min(axis=0)
                if np.count_nonzero(nearest) != len(points):  # the lowest among equals
                    nearest = np.arange(high - low)[:, None] == own.argmin(axis=0)
                np.multiply(nearest, weights, out=share[low:high])
            weight += share.sum(axis=1)
            sums += share @ points
        runs = np.repeat(list(centres), [len(c) for c in centres.values()]).astype(np.int32)
        places = np.concatenate([np.arange(len(c)) for c in centres.values()]).astype(np.int32)
        columns = {"run": runs, "centre": places, "weight": weight, **{f"s{j}": sums[:, j] for j in range(sums.shape[1])}}
        yield pa.RecordBatch.from_pydict({n: pa.array(c) for n, c in columns.items()})

    return run


def _pass(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """One pass for all given runs: weights per centre, mean points (the old ones where empty)."""
    width = next(iter(centres.values())).shape[1]
    schema = "run int, centre int, weight double, " + ", ".join(f"s{j} double" for j in range(width))
    totals = points.mapInArrow(_sums(centres), schema).groupBy("run", "centre").agg(
        *[F.sum(c).alias(c) for c in ("weight", *[f"s{j}" for j in range(width)])]
    ).collect()
    weights, means = {r: np.zeros(len(c)) for r, c in centres.items()}, {r: c.copy() for r, c in centres.items()}
    for line in totals:
        r, at = line["run"], line["centre"]
        weights[r][at] = line["weight"]
        if line["weight"] > 0:
            means[r][at] = np.array([line[f"s{j}"] for j in range(width)]) / line["weight"]
    return {r: (weights[r], means[r]) for r in centres}


def _costs(points: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, float]:
    """Weighted squared distances to the nearest centres, for all given runs in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = dict.fromkeys(centres, 0.0)
        for block, weights, _ in _blocks(batches):
            for r, c in centres.items():
                cost[r] += float(weights @ _cost(block, c, _nearest(block, c)))
        yield pa.RecordBatch.from_pydict({"run": pa.array(list(cost), pa.int32()), "cost": pa.array(list(cost.values()), pa.float64())})

    lines = points.mapInArrow(run, "run int, cost double").groupBy("run").agg(F.sum("cost").alias("cost")).collect()
    return {line["run"]: line["cost"] for line in lines}


def _draw(centres: dict[int, np.ndarray], factors: dict[int, float], salts: dict[int, int]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for points, weights, hashes in _blocks(batches):
            for r, c in centres.items():
                chosen = points[_chance(hashes, salts[r]) < factors[r] * weights * _cost(points, c, _nearest(points, c))]
                if len(chosen):
                    runs = pa.array(np.full(len(chosen), r, np.int32))
                    yield pa.RecordBatch.from_arrays([runs, pa.array(chosen.tolist(), pa.list_(pa.float64()))], names=["run", "point"])

    return run


def _settled(candidates: np.ndarray, weights: np.ndarray, run: Run) -> np.ndarray:
    """Weighted k-means++ among the candidates."""
    rng = np.random.default_rng(run.seed)
    chosen = [candidates[rng.choice(len(candidates), p=weights / weights.sum())]]
    nearest = ((candidates - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < run.k:
        chance = weights * nearest
        total = chance.sum()
        at = rng.choice(len(candidates), p=chance / total) if total > 0 else 0
        chosen.append(candidates[at])
        nearest = np.minimum(nearest, ((candidates - chosen[-1]) ** 2).sum(axis=1))
    return np.array(chosen)


def _starts(rows: DataFrame, points: DataFrame, runs: Sequence[Run]) -> dict[int, np.ndarray]:
    first = rows.agg(*[F.min_by("point", F.struct(F.xxhash64("hash", F.lit(r.seed), F.lit(r.k)), "point")).alias(f"p{i}") for i, r in enumerate(runs)]).first()
    candidates = {i: np.array([first[f"p{i}"]], float) for i in range(len(runs))}
    for turn in range(ROUNDS):
        costs = _costs(points, candidates)
        factors = {i: OVERSAMPLING * runs[i].k / cost if cost > 0 else 0.0 for i, cost in costs.items()}
        salts = {i: (r.seed * 1_009 + r.k) * ROUNDS + turn for i, r in enumerate(runs)}
        drawn: dict[int, list] = {i: [] for i in candidates}
        for line in points.mapInArrow(_draw(candidates, factors, salts), DRAWN).collect():
            drawn[line["run"]].append(line["point"])
        # In a fixed order, whatever task a point came from.
        candidates = {i: np.array([*c.tolist(), *sorted(drawn[i])]) for i, c in candidates.items()}
    weights = {i: found[0] for i, found in _pass(points, candidates).items()}
    return {i: _settled(candidates[i], weights[i], r) for i, r in enumerate(runs)}


def fit_runs(rows: DataFrame, runs: Sequence[Run], max_iter: int = 100) -> list[tuple[float, list[list[float]]]]:
    """Cost and centres (in lexicographic order) of every run over rows of ``point`` and ``weight``."""
    added = rows.filter(usable("point")).groupBy("point").agg(F.sum("weight").alias("weight")).filter("weight > 0")
    each = cut_lineage(added.withColumn("hash", F.xxhash64("point")))
    points = spread(each).select("point", "weight", "hash").mapInArrow(_pack, BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not points.head(1):
            raise ValueError("there are no points to cluster")
        centres = _starts(each, points, runs)
        going = dict(centres)
        for _ in range(max_iter):
            for r, (_, moved) in _pass(points, going).items():
                still = np.sqrt(((moved - going[r]) ** 2).sum(axis=1)).max() > TOLERANCE
                centres[r] = moved
                if still:
                    going[r] = moved
                else:
                    del going[r]
            if not going:
                break
        costs = _costs(points, centres)
    finally:
        points.unpersist()
    return [(costs[i], sorted(centres[i].tolist())) for i in range(len(runs))]
