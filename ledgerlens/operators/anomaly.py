"""Statistical anomaly flags. Thresholds are fitted once and applied as literals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.quantiles import NumericProfile, numeric_profile
from ledgerlens.operators.quality import count_where, share_where, unpivot

MISMATCH_COLUMNS = ("origError", "destError")


def outside(x: Column, bounds: tuple[float, float]) -> Column:
    low, high = bounds
    return F.coalesce((x < F.lit(low)) | (x > F.lit(high)), F.lit(False)).cast("int")


def fit_fences(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> dict[str, tuple[float, float]]:
    profile = numeric_profile(df, columns, (0.25, 0.75))
    return {c: p.fences(k) for c, p in profile.items()}


def iqr_flag(df: DataFrame, column: str, bounds: tuple[float, float], name: str = "flag_IQR") -> DataFrame:
    return df.withColumn(name, outside(F.col(column), bounds))


def zscore_column(column: str, profile: NumericProfile, threshold: float = 3.0) -> Column:
    """1 where the value lies more than ``threshold`` sample deviations from the mean."""
    if not profile.stddev:
        return F.lit(0)
    z = (F.col(column) - F.lit(profile.mean)) / F.lit(profile.stddev)
    return F.coalesce(F.abs(z) > threshold, F.lit(False)).cast("int")


def zscore_flag(df: DataFrame, column: str, profile: NumericProfile, threshold: float = 3.0, name: str = "flag_ZScore") -> DataFrame:
    return df.withColumn(name, zscore_column(column, profile, threshold))


def flag_report(flagged: DataFrame, column: str, flag: str, facts: Mapping[str, float]) -> DataFrame:
    """What a detector did: its fitted numbers, flagged rows and share, extremes among them."""
    hit = F.col(flag) == 1
    return flagged.agg(
        *[F.lit(v).cast("double").alias(k) for k, v in facts.items()],
        count_where(hit).alias("anomalies"),
        share_where(hit).alias("share"),
        F.max(F.when(hit, F.col(column))).alias("max_anomaly"),
        F.min(F.when(hit, F.col(column))).alias("min_anomaly"),
    )


def iqr_report(df: DataFrame, column: str) -> DataFrame:
    profile = numeric_profile(df, [column], (0.25, 0.75))[column]
    q1, q3 = profile.quantiles[0.25], profile.quantiles[0.75]
    low, high = profile.fences()
    facts = {"q1": q1, "q3": q3, "iqr": q3 - q1, "lower_bound": low, "upper_bound": high}
    return flag_report(iqr_flag(df, column, (low, high)), column, "flag_IQR", facts)


def zscore_report(df: DataFrame, column: str, threshold: float = 3.0) -> DataFrame:
    profile = numeric_profile(df, [column], ())[column]
    facts = {"mean": profile.mean, "std": profile.stddev, "threshold": threshold}
    return flag_report(zscore_flag(df, column, profile, threshold), column, "flag_ZScore", facts)


def univariate_overlap(df: DataFrame, flags: Sequence[str] = ("flag_IQR", "flag_ZScore")) -> DataFrame:
    hits = reduce(lambda a, b: a + b, [F.col(f) for f in flags])
    return df.agg(count_where(hits >= 1).alias("at_least_one"), count_where(hits >= 2).alias("both"))


def balance_mismatch_flag(df: DataFrame, bounds: Mapping[str, tuple[float, float]], name: str = "flag_BalanceMismatch") -> DataFrame:
    """1 where any checked column is outside its fences; 0 when no column exists."""
    flags = [outside(F.col(c), b) for c, b in bounds.items() if c in df.columns]
    return df.withColumn(name, reduce(lambda a, b: a.bitwiseOR(b), flags) if flags else F.lit(0))


def balance_mismatch_bounds(df: DataFrame, columns: Sequence[str] = MISMATCH_COLUMNS) -> DataFrame:
    """Fences and flagged rows per checked column that exists."""
    present = [c for c in columns if c in df.columns]
    bounds = fit_fences(df, present)
    wide = df.agg(
        *[x for c, (lo, hi) in bounds.items() for x in (
            F.lit(lo).alias(f"lo_{c}"), F.lit(hi).alias(f"hi_{c}"), count_where(outside(F.col(c), (lo, hi)) == 1).alias(f"n_{c}"))]
    )
    return unpivot(wide, "column_name", {c: {"lower_bound": f"lo_{c}", "upper_bound": f"hi_{c}", "anomalies": f"n_{c}"} for c in present})
