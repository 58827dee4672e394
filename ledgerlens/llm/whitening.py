"""Embedding whitening by spectrum slicing.

The covariance V of the distinct vectors is summed up block by block. Its leading
eigenvalues are isolated by inertia counts: the number of positive pivots of an LDL^T
factorisation of V - s I is the number of eigenvalues above s (Sylvester), so halving finds,
for the k-th largest one, an interval that holds it alone. Rayleigh quotient iteration
from there converges cubically. Counts on both sides of the result then certify its number;
a result that is not the wanted one narrows the interval and starts again. Eigenvalues that
no count can separate in double precision form a group, for which any orthonormal basis of
their space is right.

Sums are exact: entries are whole numbers, they are centred by the whole number next to the
mean before they are multiplied, and products are summed in blocks that doubles hold
without rounding (as long as the centred entries stay below 2^26 and the squares' sum below
2^53). So the result does not depend on the partitioning. The matrix has as many
rows as a vector has entries, whatever the table; only it comes to the driver.

Defined cases: vectors that are null, empty, or hold null or non-finite entries are dropped,
as are those whose length is not the most frequent one (ties: the shorter). Entries are
cut to the range of long. Repeated rows each have their output, and rows without an id have
null for it. A component whose variance is zero (up to rounding) has null for ``whitened``
and explains 0; with no variance at all ``explained`` is null as well. ``deviation`` is null where it is
beyond a long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import prepare, stored

COMPONENTS = 4
SCALE = 256
MERGING_TASKS = 16
EPS = float(np.finfo(float).eps)
_LONG = 2**63 - 1


# --- eigenvalues of a symmetric matrix --------------------------------------------------


def positive_pivots(matrix: np.ndarray) -> int:
    """How many eigenvalues are positive: the inertia of an LDL^T factorisation.

    Pivots are single entries or 2 x 2 blocks, chosen by the largest entries left
    (Bunch and Parlett), so growth stays bounded for indefinite matrices.
    """
    a = np.array(matrix, float)
    positive = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        i = int(diagonal.argmax())
        off = np.abs(a)
        np.fill_diagonal(off, 0.0)
        at = int(off.argmax())
        largest = off.flat[at]
        if diagonal[i] == 0.0 and largest == 0.0:
            return positive
        if diagonal[i] >= 0.6404 * largest:
            pivot = a[i, i]
            positive += pivot > 0
            rest = np.delete(np.arange(len(a)), i)
            column = a[rest, i]
            a = a[np.ix_(rest, rest)] - np.outer(column, column / pivot)
        else:
            r, s = divmod(at, len(a))
            block = a[np.ix_([r, s], [r, s])]
            positive += 1  # the block's determinant is negative: one eigenvalue of each sign
            rest = np.delete(np.arange(len(a)), [r, s])
            columns = a[np.ix_(rest, [r, s])]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(block, columns.T)
            a = (a + a.T) / 2
    return positive


@dataclass(frozen=True)
class Spectrum:
    """Leading eigenvalues, falling, unit eigenvectors as rows, and whether counts confirm their numbers."""

    values: np.ndarray
    vectors: np.ndarray
    certified: bool


def leading(matrix: np.ndarray, count: int) -> Spectrum:
    """The ``count`` largest eigenvalues of a symmetric positive semidefinite matrix, or all if there are fewer."""
    size = len(matrix)
    count = min(count, size)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if scale == 0.0:
        return Spectrum(np.zeros(count), np.eye(count, size), True)
    unit = matrix / scale  # all eigenvalues in [-1, 1]
    floor = 8 * size * EPS
    above: dict[float, int] = {}

    def number_above(shift: float) -> int:
        if shift not in above:
            above[shift] = positive_pivots(unit - shift * np.eye(size))
        return above[shift]

    values, vectors, certified = [], np.empty((0, size)), True
    for k in range(1, count + 1):
        low, high = -floor, 1.0 + floor
        for shift, n in above.items():
            if n >= k:
                low = max(low, shift)
            else:
                high = min(high, shift)
        value, vector = _isolated(unit, k, low, high, floor, vectors, number_above)
        values.append(value)
        vectors = np.vstack([vectors, vector])
        certified &= number_above(value - 2 * floor) >= k and number_above(value + 2 * floor) < k
    order = np.argsort(-np.array(values), kind="stable")
    return Spectrum(np.array(values)[order] * scale, _orthonormal(vectors[order]), bool(certified))


def _isolated(unit, k, low, high, floor, before, number_above) -> tuple[float, np.ndarray]:
    """The k-th largest eigenvalue, inside (low, high], with an eigenvector orthogonal to those before."""
    size = len(unit)
    rng = np.random.default_rng(k)
    while True:
        while high - low > 2 * floor and not (number_above(low) == k and number_above(high) == k - 1 and high - low < 0.1 * abs(high)):
            middle = (low + high) / 2
            if number_above(middle) >= k:
                low = middle
            else:
                high = middle
        value = (low + high) / 2
        vector = _without(rng.standard_normal(size), before)
        for step in range(12):
            vector = _without(_solved(unit - value * np.eye(size), vector, floor), before)
            quotient = float(vector @ unit @ vector)
            # The middle of the interval is kept as the shift until the vector points the right way.
            if step >= 2 and low - floor <= quotient <= high + floor:
                if abs(quotient - value) <= EPS:
                    break
                value = quotient
        quotient = float(vector @ unit @ vector)
        residual = float(np.abs(unit @ vector - quotient * vector).max())
        if high - low <= 2 * floor or (low - floor <= quotient <= high + floor and residual <= floor):
            return quotient, vector
        # Some other eigenvalue was met: take the half that holds the wanted one.
        middle = (low + high) / 2
        if number_above(middle) >= k:
            low = middle
        else:
            high = middle


def _solved(matrix: np.ndarray, vector: np.ndarray, floor: float) -> np.ndarray:
    """A solution, of a matrix moved by a little where the given one has none."""
    try:
        found = np.linalg.solve(matrix, vector)
        if np.isfinite(found).all():
            return found
    except np.linalg.LinAlgError:
        pass
    return np.linalg.solve(matrix + floor * np.eye(len(matrix)), vector)


def _without(vector: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The unit vector along the part of ``vector`` that is orthogonal to the rows of ``before``."""
    vector = vector / np.linalg.norm(vector)
    for _ in range(2):
        vector = vector - before.T @ (before @ vector)
    return vector / np.linalg.norm(vector)


def _orthonormal(vectors: np.ndarray) -> np.ndarray:
    result = np.empty((0, vectors.shape[1]))
    for v in vectors:
        result = np.vstack([result, _without(v, result)])
    return result


# --- the fit ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """``n`` distinct vectors with the exact ``sums``; eigenvalues and unit eigenvectors (rows) of their covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    certified: bool

    @property
    def usable(self) -> np.ndarray:
        """Components with a variance above what rounding alone can give."""
        return self.values > 64 * len(self.sums) * EPS * self.trace

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of x projected on the components, over the roots of their variances; NaN where there is none."""
        centre, rest = _centre(self.n, self.sums)
        centred = (x.astype(float) - centre) - rest  # the whole part first, which is exact
        roots = np.sqrt(np.where(self.usable, self.values, np.nan))
        return (centred @ self.vectors.T) / roots

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the entries of (n x - S)^2, exactly; None beyond a long."""
        width = max(1, x.shape[1])
        largest = int(np.abs(x.astype(float)).max(initial=0)) + 1
        bound = self.n * largest + max(map(abs, self.sums), default=0)
        if bound * bound * width <= _LONG:
            return ((x * self.n - np.array(self.sums)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [d if d <= _LONG else None for d in exact]


def whole_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and x, the entries as whole numbers floor(256 c), of the rows that take part."""
    finite = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = df.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("c"))
    rows = rows.filter(F.col("c").isNotNull() & (F.size("c") > 0) & finite)
    x = F.transform("c", lambda c: F.floor(c * F.lit(float(SCALE))).cast("bigint"))
    return rows.select("vec_id", x.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def _split_sums(x: np.ndarray) -> list[int]:
    """Exact sums of the columns of a batch of longs."""
    high, low = (x >> 32).sum(axis=0).tolist(), (x & 0xFFFFFFFF).sum(axis=0).tolist()
    return [(h << 32) + v for h, v in zip(high, low)]


def _counts_and_sums(distinct: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and the sums of their entries, in halves that longs hold."""

    def run(batches):
        n, sums = 0, [0] * size
        for batch in batches:
            if batch.num_rows:
                n += batch.num_rows
                sums = [a + b for a, b in zip(sums, _split_sums(_matrix(batch.column(0))))]
        parts = [(i, n, s >> 32, s & 0xFFFFFFFF) for i, s in enumerate(sums)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*parts)], names=["i", "n", "high", "low"])

    partial = distinct.select("x").mapInArrow(run, "i bigint, n bigint, high bigint, low bigint")
    rows = partial.groupBy("i").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]).collect()
    totals = {r["i"]: (int(r["high"]) << 32) + int(r["low"]) for r in rows}
    return (int(rows[0]["n"]) if rows else 0), [totals.get(i, 0) for i in range(size)]


def _summed(partial: DataFrame, size: int) -> np.ndarray:
    """The sum of matrices, one a partition: a few tasks add them up, the driver adds what these give."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total += np.frombuffer(data)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["data"])

    merged = partial.repartition(MERGING_TASKS).mapInArrow(run, "data binary")
    return sum((np.frombuffer(r["data"]) for r in merged.toLocalIterator()), np.zeros(size))


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The whole numbers next to the means, and what is left of the means."""
    whole = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(whole, float), np.array([(s - c * n) / n for s, c in zip(sums, whole)])


def covariance(distinct: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Covariance with divisor n, centred before multiplying."""
    size = len(sums)
    centre, rest = _centre(n, sums)

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch.column(0)).astype(float) - centre
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["data"])

    products = _summed(distinct.select("x").mapInArrow(run, "data binary"), size * size).reshape(size, size)
    matrix = products / n - np.outer(rest, rest)
    return (matrix + matrix.T) / 2


def fit(distinct: DataFrame, size: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on stored distinct vectors ``x`` of ``size`` entries; None without rows."""
    n, sums = _counts_and_sums(distinct, size)
    if not n:
        return None
    matrix = covariance(distinct, n, sums)
    spectrum = leading(matrix, components)
    return Whitening(n, sums, spectrum.values, spectrum.vectors, float(np.trace(matrix)), spectrum.certified)


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity; None without components."""
    usable = int(model.usable.sum())
    if not usable:
        return None

    def run(batches):
        total, sums = np.zeros((usable, usable)), np.zeros(usable)
        for batch in batches:
            if batch.num_rows:
                w = model.whitened(_matrix(batch.column(0)))[:, model.usable]
                total += w.T @ w
                sums += w.sum(axis=0)
        data = np.concatenate([total.ravel(), sums]).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])

    found = _summed(distinct.select("x").mapInArrow(run, "data binary"), usable * usable + usable)
    mean = found[usable * usable :] / model.n
    found = found[: usable * usable].reshape(usable, usable) / model.n - np.outer(mean, mean)
    return float(np.abs(found - np.eye(usable)).max())


RESULT = "vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per input row that takes part and component up to ``components`` (or the number of entries)."""
    spark = prepare(df.sparkSession)
    schema = RESULT.format(kind=df.schema[key].dataType.simpleString())
    rows = whole_vectors(df, key, vector)
    common = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], schema)
    size = common["size"]
    rows = rows.filter(F.size("x") == size)
    distinct = stored(rows.select("x").distinct())
    model = fit(distinct, size, components)
    error = identity_error(distinct, model)
    explained = [(float(v) / model.trace if u else 0.0) if model.trace > 0 else None for v, u in zip(model.values, model.usable)]

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            if not len(x):
                continue
            k = len(model.values)
            w = model.whitened(x).ravel()
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            deviation = pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k)))
            columns = [
                ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(w), model.n)), deviation,
                pa.array(w, mask=np.isnan(w)), pa.array(explained * len(x), pa.float64()), pa.array([error] * len(w), pa.float64()),
            ]
            names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, schema)
