"""Profiling and data-quality checks on a transaction ledger."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.comoments import co_moments
from ledgerlens.functions.quantiles import ColumnSpec, numeric_profile
from ledgerlens.functions.rowdigest import HALVES, digest_halves, repeated_digests
from ledgerlens.functions.skew import join_by_key

TOLERANCE = 0.01


def count_where(condition: Column) -> Column:
    """Number of rows meeting a condition, as a long; nulls do not count."""
    return F.count(F.when(condition, 1))


def share_where(condition: Column) -> Column:
    """Share of rows meeting a condition; 0 for no rows."""
    return F.coalesce(F.try_divide(count_where(condition), F.count("*")), F.lit(0.0))


def unpivot(wide: DataFrame, label: str, fields: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Turn a one-row result into one row per label; ``fields`` maps label -> output -> input column."""
    structs = [
        F.struct(F.lit(name).alias(label), *[F.col(src).alias(out) for out, src in cols.items()])
        for name, cols in fields.items()
    ]
    return wide.select(F.inline(F.array(*structs)))


def columnwise(df: DataFrame, columns: Sequence[str], measures: Mapping[str, callable], label: str = "column_name") -> DataFrame:
    """Evaluate the same aggregates for several columns in one pass, one row per column."""
    aggs, fields = [], {}
    for i, name in enumerate(columns):
        fields[name] = {}
        for out, measure in measures.items():
            aggs.append(measure(F.col(f"`{name}`")).alias(f"{out}_{i}"))
            fields[name][out] = f"{out}_{i}"
    return unpivot(df.agg(*aggs), label, fields)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (), with_flags: bool = True) -> list[str]:
    """Names of numeric (and boolean) columns outside an exclusion list, in schema order."""
    kinds = (T.NumericType, T.BooleanType) if with_flags else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def describe_numeric(df: DataFrame, columns: ColumnSpec) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column."""
    profile = numeric_profile(df, columns)
    rows = [
        (name, p.count, p.mean, p.stddev, p.min, *[p.quantiles[q] for q in (0.25, 0.5, 0.75)], p.max)
        for name, p in profile.items()
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "column_name string, row_count long, mean double, std double, min double, q1 double, median double, q3 double, max double",
    )


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return columnwise(df, columns or df.columns, {"missing": lambda c: count_where(c.isNull())})


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier, fully equal row. Only rows whose digest repeats are compared in full."""
    rows = df.withColumns(digest_halves(df.columns))
    again = join_by_key(rows, repeated_digests(df, df.columns), list(HALVES), "_copies", "left_semi").drop(*HALVES)
    copies = again.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def duplicate_on_subset(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once. Key counts are pre-aggregated; hot keys are broadcast."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("_copies")).filter(F.col("_copies") > 1)
    return join_by_key(df, repeated, keys, "_copies", "left_semi")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    measure = F.approx_count_distinct if approximate else F.count_distinct
    return columnwise(df, columns or df.columns, {"distinct_values": measure})


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("row_count")).orderBy(F.desc("row_count"), F.asc(column))


def label_rate_by(df: DataFrame, by: str, label: str = "isFraud") -> DataFrame:
    return df.groupBy(by).agg(
        F.sum(label).cast("long").alias("label_sum"), F.avg(label).alias("label_mean"), F.count(label).alias("row_count")
    )


def origin_error() -> Column:
    return F.abs(F.col("oldbalanceOrg") - F.col("amount") - F.col("newbalanceOrig"))


def destination_error() -> Column:
    return F.abs(F.col("oldbalanceDest") + F.col("amount") - F.col("newbalanceDest"))


def ledger_mismatch(df: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Per side: rows whose balances do not add up, their share, and the error's distribution."""
    sides = {"origin": origin_error(), "destination": destination_error()}
    profile = numeric_profile(df, sides)
    counted = df.agg(
        F.count("*").alias("n"), *[count_where(e > tolerance).alias(f"bad_{s}") for s, e in sides.items()]
    ).first()
    rows = []
    for side, p in profile.items():
        bad = counted[f"bad_{side}"]
        share = bad / counted["n"] if counted["n"] else 0.0
        rows.append((side, bad, share, p.mean, p.stddev, p.min, *[p.quantiles[q] for q in (0.25, 0.5, 0.75)], p.max))
    return df.sparkSession.createDataFrame(
        rows,
        "side string, mismatches long, share double, mean double, std double, min double, q1 double, median double, q3 double, max double",
    )


def mismatch_by_account_class(df: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Mismatch counts per side, split by the class letter of that side's account id."""
    names = {"origin": ("nameOrig", origin_error()), "destination": ("nameDest", destination_error())}
    cells = {(s, c): (name, err) for s, (name, err) in names.items() for c in ("C", "M")}
    wide = df.agg(
        *[
            count_where(F.col(name).startswith(c) & (err > tolerance)).alias(f"{side}_{c}")
            for (side, c), (name, err) in cells.items()
        ]
    )
    structs = [
        F.struct(F.lit(s).alias("side"), F.lit(c).alias("account_class"), F.col(f"{s}_{c}").alias("mismatches"))
        for s, c in cells
    ]
    return wide.select(F.inline(F.array(*structs)))


def prefix_distribution(df: DataFrame, columns: Sequence[str] = ("nameOrig", "nameDest")) -> DataFrame:
    """Frequency of the first character of each id column, from a single pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.substring(c, 1, 1).alias("prefix")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("column_name", "prefix").agg(F.count("*").alias("row_count"))


def merchant_profile(df: DataFrame) -> DataFrame:
    """Merchant receivers: rows, rows with opening balance 0, labelled rows."""
    merchants = df.filter(F.col("nameDest").startswith("M"))
    return merchants.agg(
        F.count("*").alias("merchant_rows"),
        count_where(F.col("oldbalanceDest") == 0).alias("zero_balance_rows"),
        count_where(F.col("isFraud") == 1).alias("fraud_rows"),
    )


def merchant_balance_counts(df: DataFrame) -> DataFrame:
    return value_counts(df.filter(F.col("nameDest").startswith("M")), "oldbalanceDest")


def self_transactions(df: DataFrame) -> DataFrame:
    return df.filter(F.col("nameOrig") == F.col("nameDest"))


BALANCE_COLUMNS = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")


def negative_values(df: DataFrame, columns: Sequence[str] = BALANCE_COLUMNS) -> DataFrame:
    """Negatives per column, and under ``any_column`` the rows with at least one."""
    anywhere = reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns])
    wide = df.agg(
        count_where(anywhere).alias("any_column"), *[count_where(F.col(c) < 0).alias(c) for c in columns]
    )
    return unpivot(wide, "column_name", {c: {"negatives": c} for c in ("any_column", *columns)})


def missing_steps(df: DataFrame, column: str = "step", first: int = 1, last: int = 744) -> DataFrame:
    """Integers of a range that never occur in the column."""
    expected = df.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias(column))
    present = df.filter(F.col(column).between(first, last)).select(column).distinct()
    return expected.join(present, column, "left_anti")


STUCK_TYPES = ("PAYMENT", "TRANSFER", "CASH_OUT")


def stuck_balance(df: DataFrame, types: Sequence[str] = STUCK_TYPES) -> DataFrame:
    """Rows of the given types whose sender balance did not move, counted per type."""
    return value_counts(stuck_rows(df, types), "type")


def stuck_balance_profile(df: DataFrame, types: Sequence[str] = STUCK_TYPES) -> DataFrame:
    return describe_numeric(stuck_rows(df, types), ["oldbalanceOrg", "newbalanceOrig"])


def stuck_rows(df: DataFrame, types: Sequence[str] = STUCK_TYPES) -> DataFrame:
    return df.filter(F.col("type").isin(*types) & (F.col("oldbalanceOrg") == F.col("newbalanceOrig")))


def wrong_direction_balance(df: DataFrame) -> DataFrame:
    """Positive non-deposit rows where the sender gained or the receiver lost, by type and label."""
    moved = F.array_compact(
        F.array(
            F.when(F.col("newbalanceOrig") > F.col("oldbalanceOrg"), "origin_rose"),
            F.when(F.col("newbalanceDest") < F.col("oldbalanceDest"), "destination_fell"),
        )
    )
    suspects = df.filter((F.col("amount") > 0) & (F.col("type") != "CASH_IN"))
    return (
        suspects.select(F.explode(moved).alias("direction"), "type", "isFraud")
        .groupBy("direction", "type", "isFraud")
        .agg(F.count("*").alias("row_count"))
    )


def crosstab(df: DataFrame, row: Column, column: Column, values: Sequence, row_name: str, prefix: str) -> DataFrame:
    """Contingency counts of two expressions, one output column per listed value; absent pairs are 0."""
    return df.groupBy(row.alias(row_name)).agg(
        *[count_where(column == F.lit(v)).alias(f"{prefix}_{v}") for v in values]
    )


def zero_amount(df: DataFrame) -> DataFrame:
    zero = F.col("amount") == 0
    return df.agg(
        count_where(zero).alias("zero_rows"),
        F.coalesce(F.sum(F.when(zero, F.col("isFraud"))), F.lit(0)).cast("long").alias("zero_fraud_rows"),
    )


def zero_amount_listing(df: DataFrame) -> DataFrame:
    return df.filter((F.col("amount") == 0) & (F.col("isFraud") == 1))


def missed_by_flag(df: DataFrame) -> DataFrame:
    return df.filter((F.col("isFlaggedFraud") == 0) & (F.col("isFraud") == 1))


def iqr_and_tail_fence(df: DataFrame, column: str = "amount", tail: float = 0.999) -> DataFrame:
    """Upper interquartile fence and a tail quantile, with the rows beyond each."""
    profile = numeric_profile(df, [column], (0.25, 0.75, tail))[column]
    q1, q3, cut = (profile.quantiles[p] for p in (0.25, 0.75, tail))
    upper = profile.fences()[1]
    x = F.col(column)
    return df.agg(
        F.lit(q1).alias("q1"),
        F.lit(q3).alias("q3"),
        F.lit(upper).alias("upper_fence"),
        F.lit(cut).alias("tail_value"),
        count_where(x > upper).alias("beyond_fence"),
        share_where(x > upper).alias("beyond_fence_share"),
        count_where(x > cut).alias("beyond_tail"),
    )


def equal_width_bin(x: Column, low: float, high: float, bins: int) -> Column:
    """1-based right-closed bin of equal width; the lowest value joins the first bin."""
    if high <= low:
        return F.when(x.isNotNull(), F.lit(1))
    width = (high - low) / bins
    return F.least(F.lit(bins), F.greatest(F.lit(1), F.ceil((x - F.lit(low)) / F.lit(width)))).cast("int")


def entropy(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (), bins: int = 20) -> DataFrame:
    """Natural-log entropy of value shares; numeric columns are first cut into equal-width bins.

    One pass finds the ranges, one counts all columns' bins together.
    """
    keys: dict[str, Column] = {}
    if numeric:
        doubles = {c: F.col(c).cast("double") for c in numeric}
        ranges = df.agg(*[f(x).alias(f"{n}_{c}") for c, x in doubles.items() for n, f in (("lo", F.min), ("hi", F.max))]).first()
        for c, x in doubles.items():
            if ranges[f"lo_{c}"] is not None:
                keys[c] = equal_width_bin(x, ranges[f"lo_{c}"], ranges[f"hi_{c}"], bins).cast("string")
    keys.update({c: F.col(c).cast("string") for c in categorical})
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), k.alias("cell")) for c, k in keys.items()])
    counted = (
        df.select(F.inline(cells)).filter(F.col("cell").isNotNull()).groupBy("column_name", "cell").agg(F.count("*").alias("n"))
    )
    # H = ln(N) - sum(n ln n) / N, so cell shares need no second look at the total
    n = F.col("n").cast("double")
    return counted.groupBy("column_name").agg(
        (F.ln(F.sum(n)) - F.sum(n * F.ln(n)) / F.sum(n)).alias("entropy")
    )


def histogram(df: DataFrame, columns: Sequence[str], exclude: Sequence[str] = (), max_categories: int = 15, bins: int = 30) -> DataFrame:
    """Value counts for columns with few values, else an equal-width histogram, over all rows.

    Numeric bins are left-closed with the maximum in the last one. Text columns with many
    values are left out, as they have no width to cut.
    """
    wanted = [c for c in columns if c not in exclude]
    textual = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    probe = df.agg(
        *[F.approx_count_distinct(c, 0.02).alias(f"d_{c}") for c in wanted],
        *[f(F.col(c).cast("double")).alias(f"{n}_{c}") for c in wanted if c not in textual for n, f in (("lo", F.min), ("hi", F.max))],
    ).first()
    near = [c for c in wanted if probe[f"d_{c}"] < 2 * max_categories]
    exact = {}
    if near:
        exact = df.agg(*[F.count_distinct(c).alias(c) for c in near]).first().asDict()
    cells = []
    for c in wanted:
        if c in near and exact[c] < max_categories:
            cells.append(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("bucket")))
        elif c not in textual:
            low, high = probe[f"lo_{c}"], probe[f"hi_{c}"]
            width = (high - low) / bins
            index = F.least(F.lit(bins - 1), F.floor((F.col(c).cast("double") - F.lit(low)) / F.lit(width)))
            cells.append(F.struct(F.lit(c).alias("column_name"), index.cast("string").alias("bucket")))
    return (
        df.select(F.inline(F.array(*cells)))
        .filter(F.col("bucket").isNotNull())
        .groupBy("column_name", "bucket")
        .agg(F.count("*").alias("row_count"))
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in long form (both directions).

    Each pair takes the rows that have both values; all pairs come from one pass of mergeable
    blocks. Null where a column does not vary over them, on the diagonal too.
    """
    found = co_moments(df, columns).correlation()
    rows = [(a, b, None if np.isnan(found[i, j]) else float(found[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, correlation double")


def rate_by_binary(df: DataFrame, by: str, label: str = "isFraud") -> DataFrame:
    return df.groupBy(by).agg(F.avg(label).alias("label_mean"))


def subset_consistency(base: DataFrame, subset: DataFrame, flag: str) -> DataFrame:
    """Does a separately stored subset hold exactly as many rows as are flagged in its base?"""
    expected = base.agg(count_where(F.col(flag) == 1).alias("n")).scalar()
    return subset.agg(F.count("*").alias("actual")).select(
        expected.alias("expected"), "actual", (F.col("actual") == expected).alias("consistent")
    )


def head_tail_preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first and last rows by a unique key; the report's size is the feature."""
    first = df.orderBy(F.asc(key)).limit(n).withColumn("part", F.lit("head"))
    last = df.orderBy(F.desc(key)).limit(n).withColumn("part", F.lit("tail"))
    return first.unionByName(last)
