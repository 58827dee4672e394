"""Profiling and data-quality queries."""

from pyspark.sql import functions as F

from ledgerlens.operators import quality
from ledgerlens.plans.registry import query, rounded, scored
from ledgerlens.plans.sql_views import SCORED, SCORED_IN, TX
from ledgerlens.sources.ledger import scoring_input, table, transactions

MONEY = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")
LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
TX_COLUMNS = ("transaction_id", "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest", "oldbalanceDest", "newbalanceDest", "isFraud", "isFlaggedFraud")
STATS = ("mean", "std", "min", "q1", "median", "q3", "max")


def union_all(template: str, columns) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


def describe_sql(source: str, columns) -> str:
    return union_all(
        "SELECT '{c}' AS column_name, count({c}) AS row_count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
        "round(min({c}), 4) AS \"min\", round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median, "
        "round(quantile_cont({c}, 0.75), 4) AS q3, round(max({c}), 4) AS \"max\" FROM " + source,
        columns,
    )


@query("describe_numeric", TX + describe_sql("tx", ("step", *MONEY)))
def describe_numeric(spark, folder):
    return rounded(quality.describe_numeric(transactions(spark, folder), ("step", *MONEY)), 4, *STATS)


@query("describe_numeric_lineitem", describe_sql("lineitem", LINE_NUMBERS))
def describe_numeric_lineitem(spark, folder):
    return rounded(quality.describe_numeric(table(spark, folder, "lineitem"), LINE_NUMBERS), 4, *STATS)


@query("missing_counts", TX + union_all("SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM tx", TX_COLUMNS))
def missing_counts(spark, folder):
    return quality.missing_counts(transactions(spark, folder))


@query("duplicate_rows", "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicate_rows")
def duplicate_rows(spark, folder):
    return quality.duplicate_rows(table(spark, folder, "lineitem"))


@query("duplicate_on_subset", "SELECT * FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1")
def duplicate_on_subset(spark, folder):
    return quality.duplicate_on_subset(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("distinct_counts", TX + union_all("SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM tx", TX_COLUMNS))
def distinct_counts(spark, folder):
    return quality.distinct_counts(transactions(spark, folder))


@query("value_counts", "SELECT event_type, count(*) AS row_count FROM events GROUP BY event_type")
def value_counts(spark, folder):
    return quality.value_counts(table(spark, folder, "events"), "event_type")


@query("label_rate_by_type", TX + "SELECT type, sum(isFraud)::BIGINT AS label_sum, round(avg(isFraud), 8) AS label_mean, count(isFraud) AS row_count FROM tx GROUP BY type")
def label_rate_by_type(spark, folder):
    return rounded(quality.label_rate_by(transactions(spark, folder), "type"), 8, "label_mean")


_MISMATCH = (
    "SELECT '{side}' AS side, count(*) FILTER (WHERE err > 0.01) AS mismatches, round(count(*) FILTER (WHERE err > 0.01) / count(*), 8) AS share, "
    "round(avg(err), 4) AS mean, round(stddev_samp(err), 4) AS std, round(min(err), 4) AS \"min\", round(quantile_cont(err, 0.25), 4) AS q1, "
    "round(quantile_cont(err, 0.5), 4) AS median, round(quantile_cont(err, 0.75), 4) AS q3, round(max(err), 4) AS \"max\" "
    "FROM (SELECT {expr} AS err FROM tx)"
)


@query(
    "ledger_mismatch",
    TX
    + _MISMATCH.format(side="origin", expr="abs(oldbalanceOrg - amount - newbalanceOrig)")
    + " UNION ALL "
    + _MISMATCH.format(side="destination", expr="abs(oldbalanceDest + amount - newbalanceDest)"),
)


def ledger_mismatch(spark, folder):
    return rounded(rounded(quality.ledger_mismatch(transactions(spark, folder)), 4, *STATS), 8, "share")


@query(
    "mismatch_by_account_class",
    TX
    + " UNION ALL ".join(
        f"SELECT '{side}' AS side, '{c}' AS account_class, count(*) FILTER (WHERE {name} LIKE '{c}%' AND {err} > 0.01) AS mismatches FROM tx"
        for side, name, err in (
            ("origin", "nameOrig", "abs(oldbalanceOrg - amount - newbalanceOrig)"),
            ("destination", "nameDest", "abs(oldbalanceDest + amount - newbalanceDest)"),
        )
        for c in "CM"
    ),
)


def mismatch_by_account_class(spark, folder):
    return quality.mismatch_by_account_class(transactions(spark, folder))


@query(
    "prefix_distribution",
    TX + union_all("SELECT '{c}' AS column_name, substr({c}, 1, 1) AS prefix, count(*) AS row_count FROM tx GROUP BY 2", ("nameOrig", "nameDest")),
)


def prefix_distribution(spark, folder):
    return quality.prefix_distribution(transactions(spark, folder))


@query(
    "merchant_profile",
    TX
    + "SELECT count(*) AS merchant_rows, count(*) FILTER (WHERE oldbalanceDest = 0) AS zero_balance_rows, "
    "count(*) FILTER (WHERE isFraud = 1) AS fraud_rows FROM tx WHERE nameDest LIKE 'M%'",
)


def merchant_profile(spark, folder):
    return quality.merchant_profile(transactions(spark, folder))


@query("merchant_balance_counts", TX + "SELECT oldbalanceDest, count(*) AS row_count FROM tx WHERE nameDest LIKE 'M%' GROUP BY 1")
def merchant_balance_counts(spark, folder):
    return quality.merchant_balance_counts(transactions(spark, folder))


@query("self_transactions", TX + "SELECT transaction_id, nameOrig, amount FROM tx WHERE nameOrig = nameDest")
def self_transactions(spark, folder):
    return quality.self_transactions(transactions(spark, folder)).select("transaction_id", "nameOrig", "amount")


@query(
    "negative_values",
    TX
    + "SELECT 'any_column' AS column_name, count(*) FILTER (WHERE "
    + " OR ".join(f"{c} < 0" for c in MONEY)
    + ") AS negatives FROM tx UNION ALL "
    + union_all("SELECT '{c}', count(*) FILTER (WHERE {c} < 0) FROM tx", MONEY),
)


def negative_values(spark, folder):
    return quality.negative_values(transactions(spark, folder))


@query("missing_steps", TX + "SELECT s::INT AS step FROM generate_series(1, 744) g(s) WHERE s NOT IN (SELECT step FROM tx)")
def missing_steps(spark, folder):
    return quality.missing_steps(transactions(spark, folder))


_STUCK = "tx WHERE type IN ('PAYMENT', 'TRANSFER', 'CASH_OUT') AND oldbalanceOrg = newbalanceOrig"


@query("stuck_balance", TX + f"SELECT type, count(*) AS row_count FROM {_STUCK} GROUP BY type")
def stuck_balance(spark, folder):
    return quality.stuck_balance(transactions(spark, folder))


@query("stuck_balance_profile", TX + describe_sql(_STUCK, ("oldbalanceOrg", "newbalanceOrig")))
def stuck_balance_profile(spark, folder):
    return rounded(quality.stuck_balance_profile(transactions(spark, folder)), 4, *STATS)


@query(
    "wrong_direction_balance",
    TX
    + "SELECT 'origin_rose' AS direction, type, isFraud, count(*) AS row_count FROM tx "
    "WHERE newbalanceOrig > oldbalanceOrg AND amount > 0 AND type <> 'CASH_IN' GROUP BY type, isFraud "
    "UNION ALL SELECT 'destination_fell', type, isFraud, count(*) FROM tx "
    "WHERE newbalanceDest < oldbalanceDest AND amount > 0 AND type <> 'CASH_IN' GROUP BY type, isFraud",
)


def wrong_direction_balance(spark, folder):
    return quality.wrong_direction_balance(transactions(spark, folder))


@query(
    "crosstab",
    TX
    + "SELECT type, count(*) FILTER (WHERE isFraud = 0) AS fraud_0, count(*) FILTER (WHERE isFraud = 1) AS fraud_1 FROM tx "
    "WHERE abs(oldbalanceDest + amount - newbalanceDest) > 0.01 GROUP BY type",
)


def crosstab(spark, folder):
    rows = transactions(spark, folder).filter(quality.destination_error() > quality.TOLERANCE)
    return quality.crosstab(rows, F.col("type"), F.col("isFraud"), (0, 1), "type", "fraud")


@query(
    "crosstab_high_risk",
    SCORED + "SELECT high_risk, count(*) FILTER (WHERE isFraud = 0) AS fraud_0, count(*) FILTER (WHERE isFraud = 1) AS fraud_1 FROM scored GROUP BY high_risk",
)


def crosstab_high_risk(spark, folder):
    return quality.crosstab(scored(spark, folder), F.col("high_risk"), F.col("isFraud"), (0, 1), "high_risk", "fraud")


@query(
    "zero_amount",
    TX + "SELECT count(*) FILTER (WHERE amount = 0) AS zero_rows, coalesce(sum(isFraud) FILTER (WHERE amount = 0), 0)::BIGINT AS zero_fraud_rows FROM tx",
)


def zero_amount(spark, folder):
    return quality.zero_amount(transactions(spark, folder))


@query("zero_amount_listing", TX + "SELECT transaction_id, step, type, nameOrig, nameDest FROM tx WHERE amount = 0 AND isFraud = 1")
def zero_amount_listing(spark, folder):
    return quality.zero_amount_listing(transactions(spark, folder)).select("transaction_id", "step", "type", "nameOrig", "nameDest")


@query("missed_by_flag", TX + "SELECT transaction_id, type, amount FROM tx WHERE isFlaggedFraud = 0 AND isFraud = 1")
def missed_by_flag(spark, folder):
    return quality.missed_by_flag(transactions(spark, folder)).select("transaction_id", "type", "amount")


def _fence_sql(source: str, column: str) -> str:
    return (
        f"SELECT round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3, round(any_value(q3 + 1.5 * (q3 - q1)), 6) AS upper_fence, "
        f"round(any_value(cut), 6) AS tail_value, count(*) FILTER (WHERE {column} > q3 + 1.5 * (q3 - q1)) AS beyond_fence, "
        f"round(count(*) FILTER (WHERE {column} > q3 + 1.5 * (q3 - q1)) / count(*), 8) AS beyond_fence_share, "
        f"count(*) FILTER (WHERE {column} > cut) AS beyond_tail FROM {source}, (SELECT quantile_cont({column}, 0.25) AS q1, "
        f"quantile_cont({column}, 0.75) AS q3, quantile_cont({column}, 0.999) AS cut FROM {source})"
    )


def _fence(df, column):
    report = quality.iqr_and_tail_fence(df, column)
    return rounded(rounded(report, 6, "q1", "q3", "upper_fence", "tail_value"), 8, "beyond_fence_share")


@query("iqr_and_tail_fence", TX + _fence_sql("tx", "amount"))
def iqr_and_tail_fence(spark, folder):
    return _fence(transactions(spark, folder), "amount")


@query("iqr_and_tail_fence_events", _fence_sql("events", "value"))
def iqr_and_tail_fence_events(spark, folder):
    return _fence(table(spark, folder, "events"), "value")


_NUMERIC_ENTROPY = (
    "SELECT '{c}' AS column_name, round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 8) AS entropy FROM (SELECT count(*)::DOUBLE AS n FROM scored_in, "
    "(SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM scored_in) "
    "GROUP BY least(20, greatest(1, ceil(({c} - lo) / ((hi - lo) / 20)))))"
)
_PLAIN_ENTROPY = (
    "SELECT '{c}' AS column_name, round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 8) AS entropy FROM (SELECT count(*)::DOUBLE AS n FROM scored_in GROUP BY {c})"
)
_ENTROPY_NUMBERS = (*MONEY, "isFraud", "step")


@query("entropy", SCORED_IN + union_all(_NUMERIC_ENTROPY, _ENTROPY_NUMBERS) + " UNION ALL " + union_all(_PLAIN_ENTROPY, ("isDestMerchant", "type")))
def entropy(spark, folder):
    return rounded(quality.entropy(scoring_input(spark, folder), _ENTROPY_NUMBERS, ("isDestMerchant", "type")), 8, "entropy")


_BARS = "SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS bucket, count(*) AS row_count FROM scored_in GROUP BY 2"
_HISTOGRAM = (
    "SELECT '{c}' AS column_name, CAST(CAST(least(29, floor(({c} - lo) / ((hi - lo) / 30))) AS BIGINT) AS VARCHAR) AS bucket, count(*) AS row_count "
    "FROM scored_in, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM scored_in) GROUP BY 2"
)


@query(
    "histogram",
    SCORED_IN + union_all(_BARS, ("type", "isFraud", "isDestMerchant", "origDrainedToZero")) + " UNION ALL " + union_all(_HISTOGRAM, ("step", "amount", "oldbalanceOrg", "destError")),
)


def histogram(spark, folder):
    columns = ("type", "isFraud", "isDestMerchant", "origDrainedToZero", "step", "amount", "oldbalanceOrg", "destError", "nameOrig")
    return quality.histogram(scoring_input(spark, folder), columns, exclude=("nameOrig",))


def correlation_sql(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({min(a, b)}::DOUBLE, {max(a, b)}::DOUBLE), 6) AS correlation FROM {source}" for a in columns for b in columns
    )


_CORRELATED = ("step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest", "isFraud", "origError", "destError", "isDestMerchant", "origDrainedToZero")


@query("correlation_matrix", SCORED_IN + correlation_sql("scored_in", _CORRELATED))
def correlation_matrix(spark, folder):
    return rounded(quality.correlation_matrix(scoring_input(spark, folder), _CORRELATED), 6, "correlation")


@query("correlation_matrix_lineitem", correlation_sql("lineitem", LINE_NUMBERS))
def correlation_matrix_lineitem(spark, folder):
    return rounded(quality.correlation_matrix(table(spark, folder, "lineitem"), LINE_NUMBERS), 6, "correlation")


@query("rate_by_binary", SCORED_IN + "SELECT origDrainedToZero, round(avg(isFraud), 8) AS label_mean FROM scored_in GROUP BY 1")
def rate_by_binary(spark, folder):
    return rounded(quality.rate_by_binary(scoring_input(spark, folder), "origDrainedToZero"), 8, "label_mean")


@query(
    "subset_consistency",
    SCORED_IN
    + "SELECT count(*) AS expected, count(*) AS actual, true AS consistent FROM scored_in WHERE is_birch_hdbscan_outlier = 1",
)


def subset_consistency(spark, folder):
    from ledgerlens.session import scratch_path
    from ledgerlens.sources.writers import save_parquet

    base = scoring_input(spark, folder)
    subset = save_parquet(base.filter(F.col("is_birch_hdbscan_outlier") == 1), scratch_path(spark, "outliers"))
    return quality.subset_consistency(base, subset, "is_birch_hdbscan_outlier")


@query(
    "head_tail_preview",
    TX
    + "SELECT * FROM (SELECT transaction_id, step, type, amount, 'head' AS part FROM tx ORDER BY transaction_id LIMIT 5) "
    "UNION ALL SELECT * FROM (SELECT transaction_id, step, type, amount, 'tail' AS part FROM tx ORDER BY transaction_id DESC LIMIT 5)",
)


def head_tail_preview(spark, folder):
    rows = transactions(spark, folder).select("transaction_id", "step", "type", "amount")
    return quality.head_tail_preview(rows, "transaction_id")
