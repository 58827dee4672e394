"""Co-moments of many columns in one pass: for every pair, over the rows that have both values.

A block holds, per ordered pair (i, j), the number of rows with both values, the mean and the
sum of squared deviations of column i over them, and the centred cross product. A batch
becomes a block by four matrix products; blocks merge without loss, so a task keeps one
block, a few tasks merge the blocks of the others, and the driver sees a handful of matrices
as wide as the columns, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MERGING_TASKS = 4
ROUNDING = 1e-13


@dataclass
class CoMoments:
    n: np.ndarray
    mean: np.ndarray
    squares: np.ndarray
    products: np.ndarray

    @staticmethod
    def empty(width: int) -> "CoMoments":
        return CoMoments(*(np.zeros((width, width)) for _ in range(4)))

    @staticmethod
    def of(values: np.ndarray, valid: np.ndarray) -> "CoMoments":
        """The block of some rows; values that are not valid may hold anything."""
        # Centred by a value of the column itself, so that a constant column stays exactly constant.
        first = values[valid.argmax(axis=0), np.arange(values.shape[1])]
        first = np.where(valid.any(axis=0), first, 0.0)
        x = np.where(valid, values - first, 0.0)
        v = valid.astype(float)
        n = v.T @ v
        some = np.maximum(n, 1.0)
        sums, raw = x.T @ v, (x * x).T @ v
        squares = raw - sums * sums / some
        # What only rounding left of the squares is nothing: the column is constant over these rows.
        squares[squares <= ROUNDING * raw] = 0.0
        return CoMoments(n, np.where(n > 0, first[:, None] + sums / some, 0.0), squares, x.T @ x - sums * sums.T / some)

    def merged(self, other: "CoMoments") -> "CoMoments":
        n = self.n + other.n
        weight = self.n * other.n / np.maximum(n, 1.0)
        apart = np.where(weight > 0, other.mean - self.mean, 0.0)
        mean = np.where(self.n > 0, self.mean, 0.0) + np.where(self.n > 0, apart * other.n / np.maximum(n, 1.0), other.mean)
        return CoMoments(
            n, mean, self.squares + other.squares + apart * apart * weight,
            self.products + other.products + apart * apart.T * weight,
        )

    def to_bytes(self) -> bytes:
        return np.stack([self.n, self.mean, self.squares, self.products]).tobytes()

    @staticmethod
    def from_bytes(data: bytes, width: int) -> "CoMoments":
        return CoMoments(*np.frombuffer(data).reshape(4, width, width).copy())

    def correlation(self) -> np.ndarray:
        """Pearson correlations; NaN where a column does not vary over the pair's rows."""
        spread = np.sqrt(self.squares * self.squares.T)
        with np.errstate(invalid="ignore", divide="ignore"):
            found = np.where(spread > 0, self.products / spread, np.nan)
        varies = np.diagonal(self.squares) > 0
        found[np.diag_indices(len(found))] = np.where(varies, 1.0, np.nan)
        return found

    def covariance(self) -> np.ndarray:
        """Sample covariances over the rows of each pair."""
        return self.products / np.maximum(self.n - 1, 1.0)


def co_moments(df: DataFrame, columns: Sequence[str]) -> CoMoments:
    """Fit over all rows; columns are read as doubles, and only nulls are missing values."""
    width = len(columns)

    def fit(batches):
        block = CoMoments.empty(width)
        for batch in batches:
            if batch.num_rows:
                values = np.column_stack([c.fill_null(0.0).to_numpy() for c in batch.columns])
                valid = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
                block = block.merged(CoMoments.of(values, valid))
        yield pa.RecordBatch.from_arrays([pa.array([block.to_bytes()], pa.binary())], names=["block"])

    def merge(batches):
        block = CoMoments.empty(width)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                block = block.merged(CoMoments.from_bytes(data, width))
        yield pa.RecordBatch.from_arrays([pa.array([block.to_bytes()], pa.binary())], names=["block"])

    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    merged = doubles.mapInArrow(fit, "block binary").repartition(MERGING_TASKS).mapInArrow(merge, "block binary")
    total = CoMoments.empty(width)
    for row in merged.toLocalIterator():
        total = total.merged(CoMoments.from_bytes(bytes(row["block"]), width))
    return total
