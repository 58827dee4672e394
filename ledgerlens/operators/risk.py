"""Risk scoring, validation against labels, and summaries of a scored ledger."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.functions.quantiles import kth_largest, numeric_profile
from ledgerlens.operators import anomaly
from ledgerlens.operators.quality import count_where, unpivot


def is_set(flag: str) -> Column:
    return F.col(flag).cast("int") == 1


def _weighted(weights: dict[str, int]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(f) * w for f, w in weights.items()]).cast("int")


def risk_score(df: DataFrame) -> DataFrame:
    """Indicator count, weighted score, high and critical marks."""
    scored = df.withColumns(
        {
            "risk_indicator_count": _weighted(dict.fromkeys(fixed.METHOD_FLAGS, 1)),
            "risk_score": _weighted(fixed.SIGNAL_WEIGHTS),
        }
    )
    score = F.col("risk_score")
    return scored.withColumns(
        {
            "high_risk": ((score >= fixed.HIGH_RISK_SCORE) | is_set("flag_HDBSCAN")).cast("int"),
            "critical_risk": (score >= fixed.CRITICAL_RISK_SCORE).cast("int"),
        }
    )


def risk_level(score: Column) -> Column:
    return (
        F.when(score >= fixed.CRITICAL_RISK_SCORE, "Critical")
        .when(score >= fixed.HIGH_RISK_SCORE, "High")
        .when(score == 2, "Medium")
        .when(score == 1, "Low")
        .otherwise("Normal")
    )


def risk_level_rank(level: Column) -> Column:
    """Position of a level in rising order of risk."""
    return F.array_position(F.array(*[F.lit(v) for v in fixed.RISK_LEVELS]), level).cast("int") - 1


def anomaly_type() -> Column:
    """First matching description, from several indicators down to amount alone."""
    iso, structural = is_set("flag_IsoForest"), is_set("flag_HDBSCAN")
    return (
        F.when(F.col("risk_indicator_count") >= 3, "Multiple Indicators")
        .when(iso & structural, "Behavioral and Cluster Outlier")
        .when(is_set("flag_BalanceMismatch"), "Balance Mismatch")
        .when(iso, "Behavioral Outlier")
        .when(structural, "Cluster Outlier")
        .when(is_set("flag_IQR") | is_set("flag_ZScore"), "Extreme Transaction Amount")
        .otherwise("No Statistical Anomaly")
    )


def investigation_category() -> Column:
    fraud, high = is_set("isFraud"), is_set("high_risk")
    return (
        F.when((fraud & high) | (F.col("risk_score") >= fixed.CRITICAL_RISK_SCORE), "Potential Fraud")
        .when(is_set("flag_BalanceMismatch") & ~fraud, "Possible Data Quality Issue")
        .when(~fraud & high, "Rare Legitimate Transaction")
        .when(F.col("risk_indicator_count") >= 1, "Potential Risk / Monitor")
        .otherwise("Normal / Low Concern")
    )


def _joined_reasons(reasons: Sequence[tuple[str, str]], columns: Sequence[str], empty: str) -> Column:
    parts = [F.when(is_set(flag), text) for flag, text in reasons if flag in columns]
    joined = F.concat_ws("; ", *parts)
    return F.when(joined == "", empty).otherwise(joined)


def anomaly_reason(columns: Sequence[str]) -> Column:
    return _joined_reasons(fixed.REASONS, columns, fixed.NO_REASON)


def anomaly_reason_5(columns: Sequence[str]) -> Column:
    """Five-signal variant in the serving language."""
    return _joined_reasons(fixed.SERVING_REASONS, columns, fixed.NO_SERVING_REASON)


def _flag_or_zero(name: str, columns: Sequence[str]) -> Column:
    return F.col(name).cast("int") if name in columns else F.lit(0)


def anomaly_type_fallback(columns: Sequence[str]) -> Column:
    """Description derived from flags alone; structural outliers take precedence over balances."""
    label = fixed.ANOMALY_TYPE_LABELS
    iqr, z, iso, structural = (_flag_or_zero(f, columns) for f in fixed.METHOD_FLAGS)
    mismatch = _flag_or_zero("flag_BalanceMismatch", columns)
    return (
        F.when(iqr + z + iso + structural >= 3, label["Multiple Indicators"])
        .when((iso == 1) & (structural == 1), label["Behavioral and Cluster Outlier"])
        .when(structural == 1, label["Cluster Outlier"])
        .when(iso == 1, label["Behavioral Outlier"])
        .when(mismatch == 1, label["Balance Mismatch"])
        .when((iqr == 1) | (z == 1), label["Extreme Transaction Amount"])
        .otherwise(label["No Statistical Anomaly"])
    )


def investigation_fallback(columns: Sequence[str]) -> Column:
    """Category derived from score, label and flags, without a stored category."""
    label = fixed.INVESTIGATION_LABELS
    score = F.col("risk_score") if "risk_score" in columns else F.lit(0)
    fraud = F.col("isFraud").cast("boolean") if "isFraud" in columns else F.lit(False)
    iso, structural, mismatch = (
        _flag_or_zero(f, columns) for f in ("flag_IsoForest", "flag_HDBSCAN", "flag_BalanceMismatch")
    )
    critical = score >= fixed.CRITICAL_RISK_SCORE
    return (
        F.when(critical & ~fraud, label["Rare Legitimate Transaction"])
        .when(critical, label["Potential Fraud"])
        .when(score >= fixed.HIGH_RISK_SCORE, label["Potential Risk / Monitor"])
        .when((mismatch == 1) & (iso == 0) & (structural == 0), label["Possible Data Quality Issue"])
        .otherwise(label["Normal / Low Concern"])
    )


def describe_risk(flagged: DataFrame) -> DataFrame:
    """Score a ledger that already carries the five detector flags."""
    scored = risk_score(flagged)
    leveled = scored.withColumn("risk_level", risk_level(F.col("risk_score")))
    return leveled.withColumns(
        {
            "risk_level_rank": risk_level_rank(F.col("risk_level")),
            "anomaly_type": anomaly_type(),
            "investigation_category": investigation_category(),
            "anomaly_reason": anomaly_reason(leveled.columns),
        }
    )


def score_ledger(df: DataFrame, structural: str = "is_birch_hdbscan_outlier") -> DataFrame:
    """Fit all statistical thresholds in one go, flag, and score.

    Expects the isolation flag and the structural outlier mark among the columns.
    """
    columns = [c for c in ("amount", *anomaly.MISMATCH_COLUMNS) if c in df.columns]
    profile = numeric_profile(df, columns, (0.25, 0.75))
    bounds = {c: profile[c].fences() for c in columns}
    flagged = anomaly.iqr_flag(df, "amount", bounds.pop("amount"))
    flagged = anomaly.zscore_flag(flagged, "amount", profile["amount"])
    flagged = anomaly.balance_mismatch_flag(flagged, bounds)
    return describe_risk(flagged.withColumn("flag_HDBSCAN", F.col(structural)))


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Predicted high risk against the label, as a two-row table."""
    fraud, high = is_set("isFraud"), is_set("high_risk")
    wide = df.agg(
        count_where(fraud & high).alias("tp"),
        count_where(~fraud & high).alias("fp"),
        count_where(fraud & ~high).alias("fn"),
        count_where(~fraud & ~high).alias("tn"),
    )
    return unpivot(
        wide,
        "prediction",
        {
            "Predicted High Risk": {"actual_fraud": "tp", "actual_non_fraud": "fp"},
            "Predicted Not High Risk": {"actual_fraud": "fn", "actual_non_fraud": "tn"},
        },
    )


def validation_metrics(df: DataFrame) -> DataFrame:
    """Counts, precision, recall, F1, rates and enrichment, one row per metric; no division fails."""
    fraud, high = is_set("isFraud"), is_set("high_risk")
    base = df.agg(
        count_where(fraud & high).cast("double").alias("tp"),
        count_where(~fraud & high).cast("double").alias("fp"),
        count_where(fraud & ~high).cast("double").alias("fn"),
        count_where(~fraud & ~high).cast("double").alias("tn"),
        F.avg("isFraud").alias("rate"),
        F.avg(F.when(high, F.col("isFraud"))).alias("high_rate"),
    )
    zero = F.lit(0.0)
    ratios = base.withColumns(
        {
            "precision": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), zero),
            "recall": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), zero),
        }
    ).withColumns(
        {
            "f1": F.coalesce(
                F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero
            ),
            "enrichment": F.when(F.col("rate") > 0, F.col("high_rate") / F.col("rate")).otherwise(zero),
        }
    )
    names = {
        "TP": "tp", "FP": "fp", "FN": "fn", "TN": "tn", "Precision": "precision", "Recall": "recall", "F1": "f1",
        "Overall Fraud Rate": "rate", "High Risk Fraud Rate": "high_rate", "Fraud Enrichment": "enrichment",
    }
    return unpivot(ratios, "metric", {m: {"value": c} for m, c in names.items()})


def share_summary(df: DataFrame, column: str) -> DataFrame:
    """Rows and share of all rows per category. The window runs over one row per category."""
    counted = df.groupBy(column).agg(F.count("*").alias("transactions"))
    return counted.withColumn(
        "percentage", F.col("transactions") / F.sum("transactions").over(Window.partitionBy())
    )


def risk_summary(df: DataFrame) -> DataFrame:
    return share_summary(df, "risk_level").orderBy(risk_level_rank(F.col("risk_level")))


def anomaly_type_summary(df: DataFrame) -> DataFrame:
    return share_summary(df, "anomaly_type").orderBy(F.desc("transactions"), "anomaly_type")


def investigation_summary(df: DataFrame) -> DataFrame:
    return share_summary(df, "investigation_category").orderBy(F.desc("transactions"), "investigation_category")


def fraud_by_score(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("risk_score")
        .agg(
            F.count("isFraud").alias("transactions"),
            F.sum("isFraud").cast("long").alias("fraud_count"),
            F.avg("isFraud").alias("fraud_rate"),
        )
        .orderBy("risk_score")
    )


def method_overlap(df: DataFrame, methods: Sequence[str] = fixed.METHOD_FLAGS) -> DataFrame:
    """How many rows each pair of detectors flags together; all pairs from one pass."""
    wide = df.agg(*[count_where(is_set(a) & is_set(b)).alias(f"{a}__{b}") for a in methods for b in methods])
    return unpivot(wide, "method", {a: {b: f"{a}__{b}" for b in methods} for a in methods})


def cluster_risk_summary(df: DataFrame, by: str = "cluster_kmeans") -> DataFrame:
    grouped = df.groupBy(by).agg(
        F.count("*").alias("transactions"),
        F.sum("isFraud").cast("long").alias("fraud_count"),
        F.avg("isFraud").alias("fraud_rate"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.sum("high_risk").cast("long").alias("high_risk_count"),
        F.sum("critical_risk").cast("long").alias("critical_count"),
    )
    return grouped.withColumn("high_risk_rate", F.col("high_risk_count") / F.col("transactions")).orderBy(by)


def type_breakdown(df: DataFrame, type_columns: Sequence[str]) -> DataFrame:
    """Rows of each one-hot type, most frequent first."""
    wide = df.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in type_columns])
    return unpivot(wide, "transaction_type", {c: {"row_count": c} for c in type_columns}).orderBy(
        F.desc("row_count"), "transaction_type"
    )


TOP_ORDER = ("risk_score", "risk_indicator_count", "flag_BalanceMismatch")


def top_anomalies(df: DataFrame, n: int = 20_000, key: str = "transaction_id") -> DataFrame:
    """The ``n`` most suspicious rows by score, indicators, mismatch and amount (id breaks ties).

    Counts per combination of the small sort columns show which combinations are wholly
    in, and an exact rank of the amount settles the one that is cut. The final sort then
    handles about ``n`` rows rather than ``n`` from every partition.
    """
    groups = df.groupBy(*TOP_ORDER).agg(F.count("*").alias("n")).orderBy(*[F.desc(c) for c in TOP_ORDER]).collect()
    order = [F.desc(c) for c in (*TOP_ORDER, "amount")] + [F.asc(key)]
    taken, kept = 0, F.lit(False)
    for g in groups:
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(g[c])) for c in TOP_ORDER])
        if taken + g["n"] > n:
            cut = kth_largest(df.filter(same), "amount", n - taken)
            # Without a cut there are too few amounts: nulls fill up, by id.
            inside = F.lit(True) if cut is None else F.coalesce(F.col("amount") >= F.lit(cut), F.lit(False))
            kept = kept | (same & inside) if n > taken else kept
            break
        kept, taken = kept | same, taken + g["n"]
    return df.filter(kept).orderBy(*order).limit(n)
