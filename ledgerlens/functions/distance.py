"""Squared distances from a row to a few given centres.

Features given as columns against few centres become plain arithmetic inside generated
code. Vectors in an array column, or many centres, go through Arrow batches to numpy.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

INLINE_TERMS = 256
MAX_CENTRE_VALUES = 4_000_000

Features = str | Sequence[str]
Centres = Sequence[Sequence[float]]


def _checked(centres: Centres) -> np.ndarray:
    matrix = np.asarray(centres, dtype=float)
    if matrix.size > MAX_CENTRE_VALUES:
        raise ValueError(f"{matrix.size} centre values are too many to ship with every task")
    return matrix


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """By differences, dimension by dimension, so equal points are exactly 0 apart."""
    total = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T):
        apart = x[:, None] - y[None, :]
        total += apart * apart
    return total


def vector(features: Features) -> Column:
    """The features of a row as one array of doubles."""
    if isinstance(features, str):
        return F.col(features).cast("array<double>")
    return F.array(*[F.col(f).cast("double") for f in features])


def _inline(features: Features, centres: Centres) -> list[Column] | None:
    if isinstance(features, str) or len(features) * len(centres) > INLINE_TERMS:
        return None
    return [
        reduce(lambda a, b: a + b, [(F.col(f) - F.lit(float(v))) * (F.col(f) - F.lit(float(v))) for f, v in zip(features, centre)])
        for centre in centres
    ]


def _batch_distances(batch: pd.Series, matrix: np.ndarray) -> np.ndarray:
    points = np.stack(batch.to_numpy())
    return np.stack([np.square(points - centre).sum(axis=1) for centre in matrix], axis=1)


def nearest(features: Features, centres: Centres) -> Column:
    """Struct of the nearest centre's number and squared distance; ties go to the lowest number."""
    inline = _inline(features, centres)
    if inline is not None:
        best = F.array_min(F.array(*[F.struct(d.alias("distance"), F.lit(i).alias("id")) for i, d in enumerate(inline)]))
        return F.struct(best["id"].alias("id"), best["distance"].alias("distance"))
    matrix = _checked(centres)

    @F.pandas_udf("id int, distance double")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = _batch_distances(batch, matrix)
                at = found.argmin(axis=1)
                yield pd.DataFrame({"id": at, "distance": found[np.arange(len(at)), at]})
            else:
                yield pd.DataFrame({"id": [], "distance": []})

    return search(vector(features))


def own_and_other(features: Features, centres: Centres, position: Column) -> Column:
    """Struct of squared distances to a row's own centre (by 0-based position) and to the closest other."""
    inline = _inline(features, centres)
    if inline is not None:
        distances = F.array(*inline)
        others = F.array(*[F.when(position != i, d) for i, d in enumerate(inline)])
        return F.struct(F.get(distances, position).alias("own"), F.array_min(others).alias("other"))
    matrix = _checked(centres)

    @F.pandas_udf("own double, other double")
    def split(points: pd.Series, at: pd.Series) -> pd.DataFrame:
        if not len(points):
            return pd.DataFrame({"own": [], "other": []})
        found = _batch_distances(points, matrix)
        rows, own_at = np.arange(len(found)), at.to_numpy()
        own = found[rows, own_at].copy()
        found[rows, own_at] = np.inf
        return pd.DataFrame({"own": own, "other": found.min(axis=1)})

    return split(vector(features), position)
