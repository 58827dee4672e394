"""Anomaly detection and risk scoring queries."""

from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.functions.quantiles import numeric_profile
from ledgerlens.operators import anomaly, isolation, risk
from ledgerlens.operators.cleaning import one_hot
from ledgerlens.plans.registry import query, rounded, scored
from ledgerlens.plans.sql_views import FLAGGED, SCORED, SCORED_IN, quoted
from ledgerlens.session import cut_lineage
from ledgerlens.sources.ledger import scoring_input, table

TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")


@query("iqr_flag", FLAGGED + "SELECT transaction_id, amount, flag_IQR FROM flagged")
def iqr_flag(spark, folder):
    rows = scoring_input(spark, folder).select("transaction_id", "amount")
    return anomaly.iqr_flag(rows, "amount", anomaly.fit_fences(rows, ["amount"])["amount"])


@query(
    "iqr_report",
    FLAGGED
    + "SELECT round(a1, 6) AS q1, round(a3, 6) AS q3, round(a3 - a1, 6) AS iqr, round(a1 - 1.5 * (a3 - a1), 6) AS lower_bound, "
    "round(a3 + 1.5 * (a3 - a1), 6) AS upper_bound, anomalies, round(share, 8) AS share, max_anomaly, min_anomaly FROM fit, "
    "(SELECT sum(flag_IQR)::BIGINT AS anomalies, avg(flag_IQR) AS share, max(amount) FILTER (WHERE flag_IQR = 1) AS max_anomaly, "
    "min(amount) FILTER (WHERE flag_IQR = 1) AS min_anomaly FROM flagged)",
)


def iqr_report(spark, folder):
    report = anomaly.iqr_report(scoring_input(spark, folder), "amount")
    return rounded(rounded(report, 6, "q1", "q3", "iqr", "lower_bound", "upper_bound"), 8, "share")


@query(
    "iqr_report_lineitem",
    "WITH fit AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a1, quantile_cont(l_extendedprice, 0.75) AS a3 FROM lineitem) "
    "SELECT round(any_value(a1), 6) AS q1, round(any_value(a3), 6) AS q3, round(any_value(a3 - a1), 6) AS iqr, "
    "round(any_value(a1 - 1.5 * (a3 - a1)), 6) AS lower_bound, round(any_value(a3 + 1.5 * (a3 - a1)), 6) AS upper_bound, "
    "count(*) FILTER (WHERE out) AS anomalies, round(count(*) FILTER (WHERE out) / count(*), 8) AS share, "
    "max(x) FILTER (WHERE out) AS max_anomaly, min(x) FILTER (WHERE out) AS min_anomaly FROM "
    "(SELECT *, l_extendedprice AS x, l_extendedprice < a1 - 1.5 * (a3 - a1) OR l_extendedprice > a3 + 1.5 * (a3 - a1) AS out FROM lineitem, fit)",
)


def iqr_report_lineitem(spark, folder):
    report = anomaly.iqr_report(table(spark, folder, "lineitem"), "l_extendedprice")
    return rounded(rounded(report, 6, "q1", "q3", "iqr", "lower_bound", "upper_bound"), 8, "share")


@query("zscore_flag", FLAGGED + "SELECT transaction_id, amount, flag_ZScore FROM flagged")
def zscore_flag(spark, folder):
    rows = scoring_input(spark, folder).select("transaction_id", "amount")
    return anomaly.zscore_flag(rows, "amount", numeric_profile(rows, ["amount"], ())["amount"])


@query(
    "zscore_report",
    FLAGGED
    + "SELECT round(mu, 4) AS mean, round(sd, 4) AS std, 3.0::DOUBLE AS threshold, anomalies, round(share, 8) AS share, max_anomaly, min_anomaly FROM fit, "
    "(SELECT sum(flag_ZScore)::BIGINT AS anomalies, avg(flag_ZScore) AS share, max(amount) FILTER (WHERE flag_ZScore = 1) AS max_anomaly, "
    "min(amount) FILTER (WHERE flag_ZScore = 1) AS min_anomaly FROM flagged)",
)


def zscore_report(spark, folder):
    return rounded(rounded(anomaly.zscore_report(scoring_input(spark, folder), "amount"), 4, "mean", "std"), 8, "share")


@query(
    "univariate_overlap",
    FLAGGED + "SELECT count(*) FILTER (WHERE flag_IQR + flag_ZScore >= 1) AS at_least_one, count(*) FILTER (WHERE flag_IQR + flag_ZScore >= 2) AS both FROM flagged",
)


def univariate_overlap(spark, folder):
    rows = scoring_input(spark, folder).select("amount")
    profile = numeric_profile(rows, ["amount"], (0.25, 0.75))["amount"]
    flagged = anomaly.zscore_flag(anomaly.iqr_flag(rows, "amount", profile.fences()), "amount", profile)
    return anomaly.univariate_overlap(flagged)


@query("isolation_forest_flag")
def isolation_forest_flag(spark, folder):
    rows = cut_lineage(scoring_input(spark, folder).select("transaction_id", "amount", "origError", "destError"))
    return rounded(isolation.isolation_forest_flag(rows, ["transaction_id"]), 8, "isolation_score")


@query("isolation_report")
def isolation_report(spark, folder):
    rows = cut_lineage(scoring_input(spark, folder).select("transaction_id", "amount", "origError", "destError"))
    return isolation.isolation_report(isolation.isolation_forest_flag(rows, ["transaction_id"]))


@query("balance_mismatch_flag", FLAGGED + "SELECT transaction_id, flag_BalanceMismatch FROM flagged")
def balance_mismatch_flag(spark, folder):
    rows = scoring_input(spark, folder)
    flagged = anomaly.balance_mismatch_flag(rows, anomaly.fit_fences(rows, anomaly.MISMATCH_COLUMNS))
    return flagged.select("transaction_id", "flag_BalanceMismatch")


@query(
    "balance_mismatch_bounds",
    FLAGGED
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(any_value({p}1 - 1.5 * ({p}3 - {p}1)), 6) AS lower_bound, round(any_value({p}3 + 1.5 * ({p}3 - {p}1)), 6) AS upper_bound, "
        f"count(*) FILTER (WHERE {c} < {p}1 - 1.5 * ({p}3 - {p}1) OR {c} > {p}3 + 1.5 * ({p}3 - {p}1)) AS anomalies FROM flagged, fit"
        for c, p in (("origError", "o"), ("destError", "d"))
    ),
)


def balance_mismatch_bounds(spark, folder):
    return rounded(anomaly.balance_mismatch_bounds(scoring_input(spark, folder)), 6, "lower_bound", "upper_bound")


@query("risk_score", SCORED + "SELECT transaction_id, risk_indicator_count, risk_score, high_risk, critical_risk FROM scored")
def risk_score(spark, folder):
    return scored(spark, folder).select("transaction_id", "risk_indicator_count", "risk_score", "high_risk", "critical_risk")


@query("risk_level", SCORED + "SELECT transaction_id, risk_level, risk_level_rank FROM scored")
def risk_level(spark, folder):
    return scored(spark, folder).select("transaction_id", "risk_level", "risk_level_rank")


@query("anomaly_type", SCORED + "SELECT transaction_id, anomaly_type FROM scored")
def anomaly_type(spark, folder):
    return scored(spark, folder).select("transaction_id", "anomaly_type")


@query("investigation_category", SCORED + "SELECT transaction_id, investigation_category FROM scored")
def investigation_category(spark, folder):
    return scored(spark, folder).select("transaction_id", "investigation_category")


@query("anomaly_reason", SCORED + "SELECT transaction_id, anomaly_reason FROM scored")
def anomaly_reason(spark, folder):
    return scored(spark, folder).select("transaction_id", "anomaly_reason")


_REASONS_5 = ", ".join(f"CASE WHEN {f} = 1 THEN {quoted(t)} END" for f, t in fixed.SERVING_REASONS)


@query(
    "anomaly_reason_5",
    SCORED + f"SELECT transaction_id, CASE WHEN concat_ws('; ', {_REASONS_5}) = '' THEN {quoted(fixed.NO_SERVING_REASON)} ELSE concat_ws('; ', {_REASONS_5}) END AS anomaly_reason FROM scored",
)


def anomaly_reason_5(spark, folder):
    rows = scored(spark, folder)
    return rows.select("transaction_id", risk.anomaly_reason_5(rows.columns).alias("anomaly_reason"))


@query(
    "anomaly_type_fallback",
    SCORED
    + "SELECT transaction_id, CASE WHEN flag_IQR + flag_ZScore + flag_IsoForest + flag_HDBSCAN >= 3 THEN 'Banyak Indikator Sekaligus' "
    "WHEN flag_IsoForest = 1 AND flag_HDBSCAN = 1 THEN 'Perilaku & Struktur Klaster Menyimpang' WHEN flag_HDBSCAN = 1 THEN 'Klaster Menyimpang (Outlier)' "
    "WHEN flag_IsoForest = 1 THEN 'Perilaku Menyimpang (Outlier)' WHEN flag_BalanceMismatch = 1 THEN 'Ketidaksesuaian Saldo' "
    "WHEN flag_IQR = 1 OR flag_ZScore = 1 THEN 'Nominal Transaksi Ekstrem' ELSE 'Tidak Ada Anomali Statistik' END AS anomaly_type FROM scored",
)


def anomaly_type_fallback(spark, folder):
    rows = scored(spark, folder)
    return rows.select("transaction_id", risk.anomaly_type_fallback(rows.columns).alias("anomaly_type"))


@query(
    "investigation_fallback",
    SCORED
    + "SELECT transaction_id, CASE WHEN risk_score >= 5 AND isFraud = 0 THEN 'Transaksi Sah yang Jarang Terjadi' WHEN risk_score >= 5 THEN 'Berpotensi Fraud' "
    "WHEN risk_score >= 3 THEN 'Berpotensi Perlu Dipantau' WHEN flag_BalanceMismatch = 1 AND flag_IsoForest = 0 AND flag_HDBSCAN = 0 "
    "THEN 'Kemungkinan Masalah Kualitas Data' ELSE 'Normal / Perlu Perhatian Rendah' END AS investigation_category FROM scored",
)


def investigation_fallback(spark, folder):
    rows = scored(spark, folder)
    return rows.select("transaction_id", risk.investigation_fallback(rows.columns).alias("investigation_category"))


_VALIDATION = SCORED + """, c AS (SELECT
  count(*) FILTER (WHERE isFraud = 1 AND high_risk = 1)::DOUBLE AS tp, count(*) FILTER (WHERE isFraud = 0 AND high_risk = 1)::DOUBLE AS fp,
  count(*) FILTER (WHERE isFraud = 1 AND high_risk = 0)::DOUBLE AS fn, count(*) FILTER (WHERE isFraud = 0 AND high_risk = 0)::DOUBLE AS tn,
  avg(isFraud) AS rate, avg(isFraud) FILTER (WHERE high_risk = 1) AS high_rate FROM scored),
p AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS prec, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS rec FROM c)
SELECT metric, round(value, 8) AS value FROM (
 SELECT 'TP' AS metric, tp AS value FROM p UNION ALL SELECT 'FP', fp FROM p UNION ALL SELECT 'FN', fn FROM p UNION ALL SELECT 'TN', tn FROM p
 UNION ALL SELECT 'Precision', prec FROM p UNION ALL SELECT 'Recall', rec FROM p
 UNION ALL SELECT 'F1', CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END FROM p
 UNION ALL SELECT 'Overall Fraud Rate', rate FROM p UNION ALL SELECT 'High Risk Fraud Rate', high_rate FROM p
 UNION ALL SELECT 'Fraud Enrichment', CASE WHEN rate > 0 THEN high_rate / rate ELSE 0 END FROM p)"""


@query("validation_metrics", _VALIDATION)
def validation_metrics(spark, folder):
    return rounded(risk.validation_metrics(scored(spark, folder)), 8, "value")


@query(
    "confusion_matrix",
    SCORED
    + " UNION ALL ".join(
        f"SELECT '{name}' AS prediction, count(*) FILTER (WHERE isFraud = 1) AS actual_fraud, count(*) FILTER (WHERE isFraud = 0) AS actual_non_fraud FROM scored WHERE high_risk = {v}"
        for name, v in (("Predicted High Risk", 1), ("Predicted Not High Risk", 0))
    ),
)


def confusion_matrix(spark, folder):
    return risk.confusion_matrix(scored(spark, folder))


def _share_sql(column: str) -> str:
    return SCORED + f"SELECT {column}, count(*) AS transactions, round(count(*) / (SELECT count(*) FROM scored), 8) AS percentage FROM scored GROUP BY 1"


@query("risk_summary", _share_sql("risk_level"))
def risk_summary(spark, folder):
    return rounded(risk.risk_summary(scored(spark, folder)), 8, "percentage")


@query("anomaly_type_summary", _share_sql("anomaly_type"))
def anomaly_type_summary(spark, folder):
    return rounded(risk.anomaly_type_summary(scored(spark, folder)), 8, "percentage")


@query("investigation_summary", _share_sql("investigation_category"))
def investigation_summary(spark, folder):
    return rounded(risk.investigation_summary(scored(spark, folder)), 8, "percentage")


@query(
    "fraud_by_score",
    SCORED + "SELECT risk_score, count(*) AS transactions, sum(isFraud)::BIGINT AS fraud_count, round(avg(isFraud), 8) AS fraud_rate FROM scored GROUP BY 1",
)


def fraud_by_score(spark, folder):
    return rounded(risk.fraud_by_score(scored(spark, folder)), 8, "fraud_rate")


@query(
    "method_overlap",
    SCORED
    + " UNION ALL ".join(
        f"SELECT '{a}' AS method, " + ", ".join(f"count(*) FILTER (WHERE {a} = 1 AND {b} = 1) AS {b}" for b in fixed.METHOD_FLAGS) + " FROM scored" for a in fixed.METHOD_FLAGS
    ),
)


def method_overlap(spark, folder):
    return risk.method_overlap(scored(spark, folder))


@query(
    "cluster_risk_summary",
    SCORED
    + "SELECT cluster_kmeans, count(*) AS transactions, sum(isFraud)::BIGINT AS fraud_count, round(avg(isFraud), 8) AS fraud_rate, round(avg(risk_score), 8) AS avg_risk_score, "
    "sum(high_risk)::BIGINT AS high_risk_count, sum(critical_risk)::BIGINT AS critical_count, round(sum(high_risk) / count(*), 8) AS high_risk_rate FROM scored GROUP BY 1",
)


def cluster_risk_summary(spark, folder):
    return rounded(risk.cluster_risk_summary(scored(spark, folder)), 8, "fraud_rate", "avg_risk_score", "high_risk_rate")


@query(
    "type_breakdown",
    SCORED + " UNION ALL ".join(f"SELECT 'type_{t}' AS transaction_type, count(*) FILTER (WHERE type = '{t}') AS row_count FROM scored WHERE high_risk = 1" for t in TYPES),
)


def type_breakdown(spark, folder):
    hot = one_hot(scored(spark, folder).filter(F.col("high_risk") == 1).select("type"), "type", TYPES)
    return risk.type_breakdown(hot, [f"type_{t}" for t in TYPES])


_TOP = "ORDER BY risk_score DESC, risk_indicator_count DESC, flag_BalanceMismatch DESC, amount DESC, transaction_id LIMIT"


@query("top_anomalies", SCORED + f"SELECT transaction_id, risk_score, risk_indicator_count, flag_BalanceMismatch, amount, anomaly_reason FROM scored {_TOP} 2000")
def top_anomalies(spark, folder):
    top = risk.top_anomalies(cut_lineage(scored(spark, folder)), 2000)
    return top.select("transaction_id", "risk_score", "risk_indicator_count", "flag_BalanceMismatch", "amount", "anomaly_reason")


@query(
    "top_anomalies_20000",
    SCORED + f"SELECT count(*) AS rows, sum(isFraud)::BIGINT AS fraud_rows, min(amount) AS smallest, max(amount) AS largest FROM (SELECT * FROM scored {_TOP} 20000)",
)


def top_anomalies_20000(spark, folder):
    top = risk.top_anomalies(cut_lineage(scored(spark, folder)))
    return top.agg(
        F.count("*").alias("rows"), F.sum("isFraud").cast("long").alias("fraud_rows"), F.min("amount").alias("smallest"), F.max("amount").alias("largest")
    )
