"""Cleaning, projection and feature engineering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.functions.ordering import with_global_index
from ledgerlens.functions.quantiles import numeric_profile
from ledgerlens.functions.rowdigest import split_by_digest

MAX_CATEGORIES = 1_000
SCALED_COLUMNS = ("amount", "oldbalanceOrg", "oldbalanceDest", "origError", "destError", "step")


def dedup(df: DataFrame, key: str | None = None) -> DataFrame:
    """One row of each set of equal rows; with a row ``key``, of rows equal in all else, the lowest key stays.

    Rows whose digest is unlike all others stay where they are; only the rest are grouped by all columns.
    """
    keyed = key is not None and key in df.columns
    others = [c for c in df.columns if not (keyed and c == key)]
    single, repeated = split_by_digest(df, others)
    if not keyed:
        return single.unionByName(repeated.dropDuplicates())
    lowest = repeated.groupBy(*others).agg(F.min(key).alias(key)).select(*df.columns)
    return single.unionByName(lowest)


def drop_nonpositive_amount(df: DataFrame) -> DataFrame:
    return df.filter(F.col("amount") > 0)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def ledger_features(df: DataFrame) -> DataFrame:
    """Balance errors of both sides, merchant receiver and drained sender flags."""
    opening, closing = F.col("oldbalanceOrg"), F.col("newbalanceOrig")
    return df.withColumns(
        {
            "origError": F.abs(opening - F.col("amount") - closing),
            "destError": F.abs(F.col("oldbalanceDest") + F.col("amount") - F.col("newbalanceDest")),
            "isDestMerchant": F.col("nameDest").startswith("M").cast("byte"),
            "origDrainedToZero": ((opening > 0) & (closing == 0)).cast("byte"),
        }
    )


def one_hot(df: DataFrame, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Replace a category by one 0/1 byte column per value (observed ones unless given)."""
    if values is None:
        seen = df.select(column).distinct().filter(F.col(column).isNotNull()).limit(MAX_CATEGORIES + 1).collect()
        if len(seen) > MAX_CATEGORIES:
            raise ValueError(f"{column} has more than {MAX_CATEGORIES} values and cannot be one-hot encoded")
        values = sorted(r[0] for r in seen)
    flags = {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)).cast("byte") for v in values}
    return df.withColumns(flags).drop(column)


def inverse_one_hot(df: DataFrame, prefix: str, name: str) -> DataFrame:
    """Recover the category from its 0/1 columns; the first maximum wins."""
    columns = [c for c in df.columns if c.startswith(prefix)]
    top = F.greatest(*[F.col(c) for c in columns]) if len(columns) > 1 else F.col(columns[0])
    category = F.coalesce(*[F.when(F.col(c) == top, F.lit(c.removeprefix(prefix))) for c in columns])
    return df.withColumn(name, category)


def log1p_cols(df: DataFrame, columns: Sequence[str] = SCALED_COLUMNS) -> DataFrame:
    return df.withColumns({c: F.log1p(c) for c in columns})


ScalerParams = Mapping[str, tuple[float, float]]


def robust_scale_fit(df: DataFrame, columns: Sequence[str] = SCALED_COLUMNS) -> dict[str, tuple[float, float]]:
    """Median and interquartile range per column from exact quantiles; an empty range scales by 1."""
    profile = numeric_profile(df, columns)
    params = {}
    for name, p in profile.items():
        spread = p.quantiles[0.75] - p.quantiles[0.25]
        params[name] = (p.quantiles[0.5], spread if spread > 0 else 1.0)
    return params


def standard_scale_fit(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column scales by 1."""
    profile = numeric_profile(df, columns, probs=())
    return {n: (p.mean, p.stddev_pop if p.stddev_pop and p.stddev_pop > 0 else 1.0) for n, p in profile.items()}


def scale(df: DataFrame, params: ScalerParams) -> DataFrame:
    """Apply fitted centres and scales as literals: a plain projection, on batches or streams."""
    return df.withColumns({c: (F.col(c) - F.lit(center)) / F.lit(spread) for c, (center, spread) in params.items()})


def downcast(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


def model_input(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """Numeric and boolean columns outside the exclusion list as doubles, nulls as 0."""
    from ledgerlens.operators.quality import numeric_columns

    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in numeric_columns(df, exclude)])


def lookup(value: Column, table: Mapping[str, str]) -> Column:
    """Translate through a small literal table; unknown values pass through."""
    chain = None
    for known, label in table.items():
        chain = F.when(value == known, label) if chain is None else chain.when(value == known, label)
    return chain.otherwise(value)


def derive_dest_type(flag: Column) -> Column:
    """Receiver type from any of the encodings the merchant flag comes in."""
    text = F.lower(F.trim(flag.cast("string")))
    return F.when(text.isin(*fixed.TRUE_ENCODINGS), fixed.DEST_MERCHANT).otherwise(fixed.DEST_CUSTOMER)


def derive_drain_status(flag: Column) -> Column:
    return F.when(flag.cast("boolean"), fixed.DRAINED).otherwise(fixed.NOT_DRAINED)


def translate_categories(df: DataFrame) -> DataFrame:
    """Serving-language labels for the three category columns; already translated values stay."""
    maps = {
        "risk_level": fixed.RISK_LEVEL_LABELS,
        "anomaly_type": fixed.ANOMALY_TYPE_LABELS,
        "investigation_category": fixed.INVESTIGATION_LABELS,
    }
    return df.withColumns({c: lookup(F.col(c), m) for c, m in maps.items() if c in df.columns})


def assign_row_id(df: DataFrame, *order: str, column: str = "transaction_id") -> DataFrame:
    """Sequential zero-padded ids following a stated unique order, when there are none yet."""
    if column in df.columns:
        return df
    numbered = with_global_index(df, *order, name="_n")
    return numbered.withColumn(column, F.format_string("TX%08d", "_n")).drop("_n")


def standardize_schema(df: DataFrame, *order: str) -> DataFrame:
    """Bring a scored table to the serving shape, adding only what is absent.

    ``order`` is the unique order for new transaction ids, needed only without ids.
    """
    from ledgerlens.operators import risk

    if "type" in df.columns and "transaction_type" not in df.columns:
        df = df.withColumnRenamed("type", "transaction_type")
    if "transaction_type" not in df.columns and any(c.startswith("type_") for c in df.columns):
        df = inverse_one_hot(df, "type_", "transaction_type")
    have = set(df.columns)
    added: dict[str, Column] = {}
    if "high_risk" not in have and "risk_score" in have:
        structural = F.col("flag_HDBSCAN").cast("int") if "flag_HDBSCAN" in have else F.lit(0)
        added["high_risk"] = (F.col("risk_score") >= fixed.HIGH_RISK_SCORE) | (structural == 1)
    if "jenis_tujuan" not in have:
        source = F.col("isDestMerchant") if "isDestMerchant" in have else F.lit(None).cast("string")
        added["jenis_tujuan"] = derive_dest_type(source)
    if "status_kuras" not in have:
        source = F.col("origDrainedToZero") if "origDrainedToZero" in have else F.lit(False)
        added["status_kuras"] = derive_drain_status(source)
    df = translate_categories(df.withColumns(added)) if added else translate_categories(df)
    if "transaction_id" not in have:
        df = assign_row_id(df, *order)
    flagged = {"flag_IQR", "flag_ZScore", "flag_IsoForest", "flag_HDBSCAN"} <= have
    if flagged and "anomaly_reason" not in have:
        df = df.withColumn("anomaly_reason", risk.anomaly_reason_5(df.columns))
    if flagged and "anomaly_type" not in have:
        df = df.withColumn("anomaly_type", risk.anomaly_type_fallback(df.columns))
    if "risk_score" in have and "investigation_category" not in have:
        df = df.withColumn("investigation_category", risk.investigation_fallback(df.columns))
    return df


def cleaning_log(raw: DataFrame) -> DataFrame:
    """Rows removed by each cleaning step, from one pass that counts copies of equal rows."""
    distinct_rows = raw.groupBy(*raw.columns).agg(F.count("*").alias("_copies"))
    wide = distinct_rows.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("long").alias("duplicates"),
        F.count(F.when(~(F.col("amount") > 0) | F.col("amount").isNull(), 1)).alias("nonpositive"),
        F.coalesce(F.sum("_copies"), F.lit(0)).cast("long").alias("rows_in"),
        F.count(F.when(F.col("amount") > 0, 1)).alias("rows_out"),
    )
    steps = [("rows in", "rows_in"), ("duplicates removed", "duplicates"), ("zero-amount rows removed", "nonpositive"), ("rows out", "rows_out")]
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("position"), F.lit(s).alias("entry"), F.col(c).alias("row_count")) for i, (s, c) in enumerate(steps, 1)]))
    )
