"""Isolation forest: trees grown in parallel from small samples, all rows scored in batches.

A tree sees 256 rows, so each is grown whole in one group of that size. The node tables
(at most 511 nodes per tree) travel with the scoring function; their size follows from
the parameters, not from the data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.quantiles import exact_quantiles
from ledgerlens.operators import sampling
from ledgerlens.session import cut_lineage, spread

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double"
EULER_GAMMA = 0.5772156649015329


def average_path(rows: int) -> float:
    """Expected depth of an unsuccessful search in a binary tree of that many rows."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (math.log(rows - 1.0) + EULER_GAMMA) - 2.0 * (rows - 1.0) / rows


@dataclass(frozen=True)
class Forest:
    """Node tables as arrays indexed by tree and node; a leaf points to itself."""

    features: tuple[str, ...]
    sample_rows: int
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    children: np.ndarray
    path: np.ndarray

    def mean_path(self, points: np.ndarray) -> np.ndarray:
        """Average over the trees of the depth at which each point is isolated."""
        n = len(points)
        by_feature = np.ascontiguousarray(points.T).ravel()
        rows, total = np.arange(n), np.zeros(n)
        for feature, threshold, children, path in zip(self.feature, self.threshold, self.children, self.path):
            at = np.zeros(n, dtype=np.int64)
            for _ in range(self.depth):
                value = by_feature.take(feature.take(at) * n + rows)
                at = children.take(2 * at + (value > threshold.take(at)))
            total += path.take(at)
        return total / len(self.feature)


def _grow(points: np.ndarray, tree: int, depth_limit: int, rng: np.random.Generator) -> list[tuple]:
    """Split a sample at random until rows are alone, equal, or the depth limit is reached."""
    nodes: list[list] = [[tree, 0, 0, 0.0, 0, 0, 0.0]]
    open_nodes = [(0, points, 0)]
    while open_nodes:
        at, rows, depth = open_nodes.pop()
        low, high = rows.min(axis=0), rows.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= depth_limit or len(rows) <= 1 or not len(varying):
            nodes[at][4:] = [at, at, depth + average_path(len(rows))]
            continue
        feature = int(rng.choice(varying))
        cut = float(rng.uniform(low[feature], high[feature]))
        below = rows[:, feature] <= cut
        children = []
        for part in (rows[below], rows[~below]):
            children.append(len(nodes))
            nodes.append([tree, len(nodes), 0, 0.0, 0, 0, 0.0])
            open_nodes.append((children[-1], part, depth + 1))
        nodes[at][2:] = [feature, cut, *children, 0.0]
    return [tuple(n) for n in nodes]


def fit_isolation_forest(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], trees: int = 100, sample_rows: int = 256, seed: int = 42
) -> Forest:
    """Grow trees on hash-drawn samples; the result does not depend on how rows are partitioned.

    Trees draw from a stored pool of ``trees * sample_rows`` rows (all rows, when fewer).
    """
    filled = df.select(*keys, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    pool = cut_lineage(sampling.fixed_size_random(filled, trees * sample_rows, keys, seed))
    pooled = pool.count()
    drawn_rows = min(sample_rows, pooled)
    share = (sample_rows + 10 * math.sqrt(sample_rows) + 50) / max(pooled, 1)
    drawn = pool.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    lot = sampling.unit_hash(["tree", *keys], seed)
    # a tree's 256 lowest lots lie below this share by ten standard deviations
    chosen = drawn.withColumn("_lot", lot).filter(F.col("_lot") <= share)
    rank = F.row_number().over(Window.partitionBy("tree").orderBy("_lot", *keys))
    samples = chosen.withColumn("_rank", rank).filter(F.col("_rank") <= sample_rows)
    depth = math.ceil(math.log2(max(sample_rows, 2)))
    names = list(features)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        ordered = group.sort_values("_rank")[names].to_numpy(dtype=float)
        rows = _grow(ordered, tree, depth, np.random.default_rng([seed, tree]))
        return pd.DataFrame(rows, columns=["tree", "node", "feature", "threshold", "left", "right", "path"])

    nodes = samples.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    shape = (trees, int(nodes["node"].max()) + 1)
    at = (nodes["tree"], nodes["node"])
    feature, threshold, path = np.zeros(shape, dtype=np.int64), np.zeros(shape), np.zeros(shape)
    children = np.zeros((*shape, 2), dtype=np.int64)
    feature[at], threshold[at], path[at] = nodes["feature"], nodes["threshold"], nodes["path"]
    children[at] = nodes[["left", "right"]]
    return Forest(tuple(features), drawn_rows, depth, feature, threshold, children.reshape(trees, -1), path)


def isolation_score(forest: Forest) -> Column:
    """Anomaly score of a row in (0, 1); higher is easier to isolate."""
    norm = average_path(forest.sample_rows) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            points = np.column_stack([s.to_numpy(dtype=float) for s in batch])
            yield pd.Series(np.power(2.0, -forest.mean_path(points) / norm))

    return score(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in forest.features])


def isolation_forest_flag(
    df: DataFrame, keys: Sequence[str], features: Sequence[str] = ("amount", "origError", "destError"), contamination: float = 0.01,
    trees: int = 100, sample_rows: int = 256, seed: int = 42, name: str = "flag_IsoForest",
) -> DataFrame:
    """Flag the share ``contamination`` of rows that are easiest to isolate.

    Rows are scored once and stored with their score; the exact cut is applied to them.
    """
    df = spread(df)
    forest = fit_isolation_forest(df, features, keys, trees, sample_rows, seed)
    scored = cut_lineage(df.withColumn("isolation_score", isolation_score(forest)))
    cut = exact_quantiles(scored, ["isolation_score"], [1 - contamination])["isolation_score"][0]
    return scored.withColumn(name, (F.col("isolation_score") > F.lit(cut)).cast("int"))


def isolation_report(flagged: DataFrame, features: Sequence[str] = ("amount", "origError", "destError"), flag: str = "flag_IsoForest") -> DataFrame:
    """Flagged rows and share, with the extremes of each feature among them."""
    hit = F.col(flag) == 1
    return flagged.agg(
        F.count(F.when(hit, 1)).alias("anomalies"),
        F.avg(flag).alias("share"),
        *[f(F.when(hit, F.col(c))).alias(f"{n}_{c}") for c in features for n, f in (("max", F.max), ("min", F.min))],
    )
