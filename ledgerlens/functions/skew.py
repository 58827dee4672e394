"""Key joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1_000
FITS_ONE_TASK = 5_000_000


def _matches(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def join_by_key(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], size_col: str, how: str = "left_semi", total: int | None = None
) -> DataFrame:
    """Join ``rows`` with ``table``, which has one line per key and that key's row count.

    Keys with more than a thousandth of all counted rows are joined by broadcast, so
    their rows never meet in one task; there can be at most ``HOT_SHARE`` of them. All
    other keys take the ordinary shuffled join. When all counted rows together fit one
    task, no key needs special care. ``total`` is an upper bound on them, if known.
    """
    if total is None:
        total = table.agg(F.coalesce(F.sum(size_col), F.lit(0))).first()[0]
    if total <= FITS_ONE_TASK:
        return _joined(rows, table.drop(size_col), keys, how)
    is_hot = F.col(size_col) * HOT_SHARE > total
    hot = table.filter(is_hot).drop(size_col)
    cold = table.filter(~is_hot).drop(size_col)
    hot_keys = F.broadcast(hot.select(*keys))
    hot_rows = rows.join(hot_keys, _matches(rows, hot_keys, keys), "left_semi")
    other_rows = rows.join(hot_keys, _matches(rows, hot_keys, keys), "left_anti")
    return _joined(hot_rows, F.broadcast(hot), keys, how).unionByName(_joined(other_rows, cold, keys, how))


def _joined(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    if how == "left_semi":
        return rows.join(table, _matches(rows, table, keys), how)
    renamed = table.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in table.columns if c not in keys])
    condition = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(renamed[f"_key_{k}"]) for k in keys])
    return rows.join(renamed, condition, how).drop(*[f"_key_{k}" for k in keys])
