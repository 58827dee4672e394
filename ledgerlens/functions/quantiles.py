"""Exact quantiles without gathering a whole column in one task.

Reading exact ranks off a sorted column in one task is fine for a million values and impossible for a cluster-sized column, so larger inputs are narrowed first:
each pass over the (pruned) columns counts rows around a
bracket of two values and sketches what lies between them; only when few enough values
remain are those gathered and sorted. Counts decide, the sketch only proposes, so the
result does not depend on sketch accuracy.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIRECT_ROWS = 1_000_000
COLUMNS_PER_SORT = 4
GRID_STEPS = 250
SKETCH_ACCURACY = 5_000

ColumnSpec = Sequence[str] | Mapping[str, Column]


@dataclass(frozen=True)
class NumericProfile:
    """Moments, extremes and exact quantiles of one column."""

    count: int
    mean: float | None
    stddev: float | None
    stddev_pop: float | None
    min: float | None
    max: float | None
    quantiles: dict[float, float | None]

    def fences(self, k: float = 1.5) -> tuple[float, float]:
        """Interquartile fences; the profile must hold the quartiles."""
        q1, q3 = self.quantiles[0.25], self.quantiles[0.75]
        spread = q3 - q1
        return q1 - k * spread, q3 + k * spread


@dataclass
class _Rank:
    """One wanted order statistic and the bracket known to hold it."""

    column: str
    rank: int
    low: float
    high: float
    proposal: tuple[float, float]
    value: float | None = None
    local_rank: int | None = None


def _as_doubles(df: DataFrame, columns: ColumnSpec) -> tuple[DataFrame, list[str]]:
    exprs = dict(columns) if isinstance(columns, Mapping) else {c: F.col(f"`{c}`") for c in columns}
    doubles = {n: e.cast("double") for n, e in exprs.items()}
    return df.select(*[F.when(~F.isnan(e), e).alias(n) for n, e in doubles.items()]), list(doubles)


def _around(grid: Sequence[float], local_rank: int, rows: int, low: float, high: float) -> tuple[float, float]:
    """The two sketched values that should enclose ``local_rank`` of ``rows`` values."""
    at = local_rank / max(rows - 1, 1) * GRID_STEPS
    left, right = math.floor(at) - 1, math.ceil(at) + 1
    return (
        grid[left] if left > 0 else low,
        grid[right] if right < GRID_STEPS else high,
    )


def _narrow(values: DataFrame, pending: list[_Rank], direct_rows: int) -> None:
    """One pass: verify every proposal and either settle it or propose a tighter one."""
    brackets = sorted({(r.column, *r.proposal) for r in pending})
    grid = F.expr(f"array({', '.join(f'{i / GRID_STEPS}D' for i in range(GRID_STEPS + 1))})")
    aggs = []
    for i, (name, low, high) in enumerate(brackets):
        x = F.col(f"`{name}`")
        inside = F.when((x > low) & (x < high), x)
        aggs += [
            F.count(F.when(x < low, 1)).alias(f"lt_low_{i}"),
            F.count(F.when(x <= low, 1)).alias(f"le_low_{i}"),
            F.count(F.when(x < high, 1)).alias(f"lt_high_{i}"),
            F.count(F.when(x <= high, 1)).alias(f"le_high_{i}"),
            F.percentile_approx(inside, grid, F.lit(SKETCH_ACCURACY)).alias(f"grid_{i}"),
        ]
    seen = values.agg(*aggs).first()
    position = {bracket: i for i, bracket in enumerate(brackets)}
    for target in pending:
        i = position[(target.column, *target.proposal)]
        low, high = target.proposal
        if target.rank < seen[f"lt_low_{i}"]:
            target.high, target.proposal = low, (target.low, low)
        elif target.rank >= seen[f"le_high_{i}"]:
            target.low, target.proposal = high, (high, target.high)
        elif target.rank < seen[f"le_low_{i}"]:
            target.value = low
        elif target.rank >= seen[f"lt_high_{i}"]:
            target.value = high
        else:
            target.low, target.high = low, high
            rows = seen[f"lt_high_{i}"] - seen[f"le_low_{i}"]
            local = target.rank - seen[f"le_low_{i}"]
            if rows <= direct_rows:
                target.local_rank = local
            else:
                target.proposal = _around(seen[f"grid_{i}"], local, rows, low, high)


def _gather(values: DataFrame, targets: list[_Rank]) -> None:
    """Sort the few values left inside each settled bracket and read the ranks off."""
    brackets = sorted({(t.column, t.low, t.high) for t in targets})
    wanted = {b: sorted({t.local_rank for t in targets if (t.column, t.low, t.high) == b}) for b in brackets}
    lists, picks = [], []
    for i, bracket in enumerate(brackets):
        name, low, high = bracket
        x = F.col(f"`{name}`")
        lists.append(F.sort_array(F.collect_list(F.when((x > low) & (x < high), x))).alias(f"s{i}"))
        picks.append(F.array(*[F.get(f"s{i}", F.lit(r)) for r in wanted[bracket]]).alias(f"v{i}"))
    row = values.agg(*lists).select(*picks).first()
    for target in targets:
        bracket = (target.column, target.low, target.high)
        target.value = row[f"v{brackets.index(bracket)}"][wanted[bracket].index(target.local_rank)]


def _gather_all(values: DataFrame, targets: list[_Rank]) -> None:
    """Read ranks off whole columns that are short enough to sort in one task."""
    wanted: dict[str, list[int]] = {}
    for target in targets:
        wanted.setdefault(target.column, []).append(target.rank)
    for start in range(0, len(wanted), COLUMNS_PER_SORT):
        names = list(wanted)[start : start + COLUMNS_PER_SORT]
        ordered = values.agg(*[F.sort_array(F.collect_list(f"`{n}`")).alias(n) for n in names])
        row = ordered.select(*[F.array(*[F.get(f"`{n}`", F.lit(r)) for r in wanted[n]]).alias(n) for n in names]).first()
        for target in targets:
            if target.column in names:
                target.value = row[target.column][wanted[target.column].index(target.rank)]


def _rank_pair(p: float, count: int) -> tuple[int, int]:
    """The two neighbouring ranks a quantile is interpolated between."""
    h = (count - 1) * p
    return math.floor(h), math.ceil(h)


def _settle(values: DataFrame, targets: list[_Rank], direct_rows: int) -> None:
    while True:
        pending = [t for t in targets if t.value is None and t.local_rank is None]
        if not pending:
            break
        _narrow(values, pending, direct_rows)
    gathered = [t for t in targets if t.value is None]
    if gathered:
        _gather(values, gathered)


def numeric_profile(
    df: DataFrame,
    columns: ColumnSpec,
    probs: Sequence[float] = (0.25, 0.5, 0.75),
    direct_rows: int = DIRECT_ROWS,
) -> dict[str, NumericProfile]:
    """Moments and exact linear-interpolated quantiles of several columns at once.

    Two passes for inputs of up to ``direct_rows`` values; larger ones take one more pass
    for each factor of about a hundred.
    """
    values, names = _as_doubles(df, columns)
    aggs = []
    for i, name in enumerate(names):
        x = F.col(f"`{name}`")
        aggs += [
            F.count(x).alias(f"n{i}"),
            F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"sd{i}"),
            F.stddev_pop(x).alias(f"sdp{i}"),
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
        ]
    base = values.agg(*aggs).first()
    counts = {n: base[f"n{i}"] for i, n in enumerate(names)}
    quantiles: dict[str, dict[float, float | None]] = {n: {p: None for p in probs} for n in names}
    targets = []
    for i, name in enumerate(names):
        bounds = (base[f"min{i}"], base[f"max{i}"])
        ranks = {r for p in probs for r in _rank_pair(p, counts[name])} if counts[name] else ()
        targets += [_Rank(name, rank, *bounds, proposal=bounds) for rank in ranks]
    small = [t for t in targets if counts[t.column] <= direct_rows]
    if small:
        _gather_all(values, small)
    _settle(values, targets, direct_rows)
    found = {(t.column, t.rank): t.value for t in targets}
    for name in names:
        for p in probs if counts[name] else ():
            low, high = _rank_pair(p, counts[name])
            a, b = found[(name, low)], found[(name, high)]
            quantiles[name][p] = a + (b - a) * ((counts[name] - 1) * p - low)
    return {
        n: NumericProfile(
            base[f"n{i}"], base[f"mean{i}"], base[f"sd{i}"], base[f"sdp{i}"], base[f"min{i}"], base[f"max{i}"], quantiles[n]
        )
        for i, n in enumerate(names)
    }


def exact_quantiles(
    df: DataFrame, columns: ColumnSpec, probs: Sequence[float], direct_rows: int = DIRECT_ROWS
) -> dict[str, list[float | None]]:
    """Exact quantiles of each column, in the order of ``probs``."""
    profile = numeric_profile(df, columns, probs, direct_rows)
    return {name: [p.quantiles[q] for q in probs] for name, p in profile.items()}


def values_at_ranks(df: DataFrame, column: str, ranks: Sequence[int], direct_rows: int = DIRECT_ROWS) -> list[float]:
    """The values at 0-based positions of a column's rising order, nulls and NaN left out.

    A column without values gives None for every position; a position beyond them raises.
    """
    values, _ = _as_doubles(df, [column])
    base = values.agg(F.count(f"`{column}`").alias("n"), F.min(f"`{column}`").alias("lo"), F.max(f"`{column}`").alias("hi")).first()
    if not base["n"]:
        return [None] * len(ranks)
    if any(not 0 <= r < base["n"] for r in ranks):
        raise ValueError(f"{column} has {base['n']} values, no positions {sorted(set(ranks))}")
    targets = [_Rank(column, r, base["lo"], base["hi"], proposal=(base["lo"], base["hi"])) for r in sorted(set(ranks))]
    if base["n"] <= direct_rows:
        _gather_all(values, targets)
    _settle(values, targets, direct_rows)
    found = {t.rank: t.value for t in targets}
    return [found[r] for r in ranks]


def count_values(df: DataFrame, column: str) -> int:
    """How many values other than null and NaN a column has."""
    return _as_doubles(df, [column])[0].agg(F.count(f"`{column}`")).first()[0]


def kth_largest(df: DataFrame, column: str, k: int, direct_rows: int = DIRECT_ROWS) -> float | None:
    """The k-th largest value other than null and NaN (1 = maximum), or None when there are fewer."""
    n = count_values(df, column)
    return None if not 0 < k <= n else values_at_ranks(df, column, [n - k], direct_rows)[0]
