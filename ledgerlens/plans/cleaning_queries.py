"""Cleaning and feature-engineering queries."""

from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.functions import text
from ledgerlens.operators import cleaning
from ledgerlens.plans.registry import query, rounded, scored
from ledgerlens.plans.sql_views import SCORED, SCORED_IN, TX, case_map
from ledgerlens.sources.ledger import scoring_input, table, transactions

TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")
SCALED = cleaning.SCALED_COLUMNS


@query("dedup", "SELECT DISTINCT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def dedup(spark, folder):
    return cleaning.dedup(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"))


@query("drop_nonpositive_amount", TX + "SELECT * FROM tx WHERE amount > 0")
def drop_nonpositive_amount(spark, folder):
    return cleaning.drop_nonpositive_amount(transactions(spark, folder))


@query("drop_columns", TX + "SELECT * EXCLUDE (isFlaggedFraud, nameOrig) FROM tx")
def drop_columns(spark, folder):
    return cleaning.drop_columns(transactions(spark, folder), "isFlaggedFraud", "nameOrig", "absent_column")


@query(
    "ledger_features",
    SCORED_IN + "SELECT transaction_id, origError, destError, isDestMerchant, origDrainedToZero FROM scored_in",
)


def ledger_features(spark, folder):
    rows = cleaning.ledger_features(cleaning.drop_nonpositive_amount(transactions(spark, folder)))
    return rows.select("transaction_id", "origError", "destError", "isDestMerchant", "origDrainedToZero")


_ONE_HOT = ", ".join(f"CASE WHEN type = '{t}' THEN 1 ELSE 0 END AS type_{t}" for t in TYPES)


@query("one_hot", TX + f"SELECT transaction_id, {_ONE_HOT} FROM tx")
def one_hot(spark, folder):
    return cleaning.one_hot(transactions(spark, folder).select("transaction_id", "type"), "type")


@query("inverse_one_hot", TX + "SELECT transaction_id, type AS transaction_type FROM tx")
def inverse_one_hot(spark, folder):
    hot = cleaning.one_hot(transactions(spark, folder).select("transaction_id", "type"), "type", TYPES)
    return cleaning.inverse_one_hot(hot, "type_", "transaction_type").select("transaction_id", "transaction_type")


@query("log1p_cols", SCORED_IN + "SELECT transaction_id, " + ", ".join(f"round(ln(1 + {c}), 8) AS {c}" for c in SCALED) + " FROM scored_in")
def log1p_cols(spark, folder):
    rows = cleaning.log1p_cols(scoring_input(spark, folder)).select("transaction_id", *SCALED)
    return rounded(rows, 8, *SCALED)


_LOGGED = SCORED_IN + ", logged AS (SELECT transaction_id, " + ", ".join(f"ln(1 + {c}) AS {c}" for c in SCALED) + " FROM scored_in)"
_ROBUST = ", ".join(
    f"quantile_cont({c}, 0.5) AS m_{c}, CASE WHEN quantile_cont({c}, 0.75) > quantile_cont({c}, 0.25) "
    f"THEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) ELSE 1 END AS r_{c}"
    for c in SCALED
)


@query(
    "robust_scale",
    _LOGGED + f", p AS (SELECT {_ROBUST} FROM logged) SELECT transaction_id, " + ", ".join(f"round(({c} - m_{c}) / r_{c}, 6) + 0.0 AS {c}" for c in SCALED) + " FROM logged, p",
)


def robust_scale(spark, folder):
    logged = cleaning.log1p_cols(scoring_input(spark, folder)).select("transaction_id", *SCALED)
    scaled = rounded(cleaning.scale(logged, cleaning.robust_scale_fit(logged)), 6, *SCALED)
    return scaled.withColumns({c: F.col(c) + F.lit(0.0) for c in SCALED})  # no negative zeros


@query(
    "downcast",
    SCORED_IN + "SELECT transaction_id, CAST(CAST(amount AS FLOAT) AS DOUBLE) AS amount, CAST(cluster_kmeans AS TINYINT) AS cluster_kmeans FROM scored_in",
)


def downcast(spark, folder):
    small = cleaning.downcast(scoring_input(spark, folder), {"amount": "float", "cluster_kmeans": "byte"})
    return small.select("transaction_id", F.col("amount").cast("double").alias("amount"), "cluster_kmeans")


_STANDARD = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS r_{c}" for c in SCALED)


@query(
    "standard_scale",
    SCORED_IN + f", p AS (SELECT {_STANDARD} FROM scored_in) SELECT transaction_id, " + ", ".join(f"round(({c} - m_{c}) / r_{c}, 6) AS {c}" for c in SCALED) + " FROM scored_in, p",
)


def standard_scale(spark, folder):
    rows = scoring_input(spark, folder).select("transaction_id", *SCALED)
    return rounded(cleaning.scale(rows, cleaning.standard_scale_fit(rows, SCALED)), 6, *SCALED)


_FEATURES = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "origError", "destError", "isDestMerchant", "origDrainedToZero", "flag_IsoForest")


@query("pick_numeric_features", SCORED_IN + "SELECT " + ", ".join(f"coalesce({c}, 0)::DOUBLE AS {c}" for c in _FEATURES) + " FROM scored_in")
def pick_numeric_features(spark, folder):
    return cleaning.model_input(scoring_input(spark, folder), fixed.NON_FEATURE_COLUMNS)


_SERVED = ("transaction_id", "transaction_type", "jenis_tujuan", "status_kuras", "high_risk", "risk_level", "anomaly_type", "investigation_category")


@query(
    "standardize_schema",
    SCORED
    + "SELECT transaction_id, type AS transaction_type, CASE WHEN isDestMerchant = 1 THEN 'Merchant' ELSE 'Nasabah' END AS jenis_tujuan, "
    "CASE WHEN origDrainedToZero = 1 THEN 'Terkuras Habis' ELSE 'Tidak Terkuras' END AS status_kuras, "
    "risk_score >= 3 OR flag_HDBSCAN = 1 AS high_risk, "
    f"{case_map('risk_level', fixed.RISK_LEVEL_LABELS)} AS risk_level, {case_map('anomaly_type', fixed.ANOMALY_TYPE_LABELS)} AS anomaly_type, "
    f"{case_map('investigation_category', fixed.INVESTIGATION_LABELS)} AS investigation_category FROM scored",
)


def standardize_schema(spark, folder):
    return cleaning.standardize_schema(scored(spark, folder).drop("high_risk")).select(*_SERVED)


@query("derive_dest_type", SCORED_IN + "SELECT transaction_id, CASE WHEN isDestMerchant = 1 THEN 'Merchant' ELSE 'Nasabah' END AS jenis_tujuan FROM scored_in")
def derive_dest_type(spark, folder):
    return scoring_input(spark, folder).select("transaction_id", cleaning.derive_dest_type(F.col("isDestMerchant")).alias("jenis_tujuan"))


@query(
    "derive_drain_status",
    SCORED_IN + "SELECT transaction_id, CASE WHEN origDrainedToZero = 1 THEN 'Terkuras Habis' ELSE 'Tidak Terkuras' END AS status_kuras FROM scored_in",
)


def derive_drain_status(spark, folder):
    return scoring_input(spark, folder).select("transaction_id", cleaning.derive_drain_status(F.col("origDrainedToZero")).alias("status_kuras"))


@query(
    "translate_categories",
    SCORED
    + f"SELECT transaction_id, {case_map('risk_level', fixed.RISK_LEVEL_LABELS)} AS risk_level, "
    f"{case_map('anomaly_type', fixed.ANOMALY_TYPE_LABELS)} AS anomaly_type, "
    f"{case_map('investigation_category', fixed.INVESTIGATION_LABELS)} AS investigation_category FROM scored",
)


def translate_categories(spark, folder):
    once = cleaning.translate_categories(scored(spark, folder).select("transaction_id", "risk_level", "anomaly_type", "investigation_category"))
    return cleaning.translate_categories(once)


@query(
    "assign_row_id",
    "SELECT printf('TX%08d', row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) AS transaction_id, o_orderkey FROM orders",
)


def assign_row_id(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderdate", "o_orderkey")
    return cleaning.assign_row_id(rows, "o_orderdate", "o_orderkey").select("transaction_id", "o_orderkey")


@query(
    "humanize_type",
    TX + f"SELECT transaction_id, {case_map('type', fixed.TRANSACTION_TYPE_LABELS)} AS label FROM tx",
)


def humanize_type(spark, folder):
    return transactions(spark, folder).select("transaction_id", text.humanize_type(F.col("type")).alias("label"))


@query(
    "step_to_day_hour",
    TX
    + "SELECT transaction_id, 'Hari ke-' || CAST((step - 1) // 24 + 1 AS VARCHAR) || ', ' || lpad(CAST((step - 1) % 24 AS VARCHAR), 2, '0') || ':00' AS label "
    "FROM tx",
)


def step_to_day_hour(spark, folder):
    return transactions(spark, folder).select("transaction_id", text.step_to_day_hour(F.col("step")).alias("label"))


@query(
    "number_formats",
    TX
    + "SELECT transaction_id, replace(format('{:.1f}%', step / 10 * 100), '.', ',') AS pct, "
    "replace(format('{:,}', CAST(round_even(amount, 0) AS BIGINT)), ',', '.') AS whole, "
    "'Rp' || translate(format('{:,.2f}', amount), ',.', '.,') AS money, replace(format('{:,.1f}x', isFraud + step / 2), '.', ',') AS multiple FROM tx",
)


def number_formats(spark, folder):
    return transactions(spark, folder).select(
        "transaction_id",
        text.format_pct(F.col("step") / 10, 1).alias("pct"),
        text.format_int(F.col("amount")).alias("whole"),
        text.format_rupiah(F.col("amount"), 2).alias("money"),
        text.format_multiplier(F.col("isFraud") + F.col("step") / 2).alias("multiple"),
    )


@query(
    "cleaning_log",
    "WITH pool AS (SELECT l_orderkey, l_linenumber, l_discount AS amount FROM lineitem) "
    "SELECT 1 AS position, 'rows in' AS entry, count(*) AS row_count FROM pool UNION ALL "
    "SELECT 2, 'duplicates removed', (SELECT count(*) FROM pool) - count(*) FROM (SELECT DISTINCT * FROM pool) UNION ALL "
    "SELECT 3, 'zero-amount rows removed', count(*) FROM (SELECT DISTINCT * FROM pool) WHERE NOT amount > 0 UNION ALL "
    "SELECT 4, 'rows out', count(*) FROM (SELECT DISTINCT * FROM pool) WHERE amount > 0",
)


def cleaning_log(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("amount"))
    return cleaning.cleaning_log(rows)
