"""The shared inputs as common table expressions, for SQL statements."""

from ledgerlens.functions import fixed_values as fixed


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def case_map(column: str, table: dict) -> str:
    arms = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in table.items())
    return f"CASE {column} {arms} ELSE {column} END"


TX = """WITH RECURSIVE b AS (
 SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderstatus AS st,
  CASE WHEN o.o_orderkey % 500 = 499 THEN 0.0
       WHEN o.o_orderkey % 50 = 0 THEN round(o.o_totalprice * 12, 2)
       ELSE o.o_totalprice END AS amount,
  CAST(o.o_orderdate AS DATE) AS d, c.c_acctbal AS bal,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'CASH_OUT' WHEN '2-HIGH' THEN 'TRANSFER'
   WHEN '3-MEDIUM' THEN 'PAYMENT' WHEN '4-NOT SPECIFIED' THEN 'CASH_IN' ELSE 'DEBIT' END AS type
 FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
), e AS (
 SELECT *, CASE WHEN type = 'PAYMENT' THEN 'M' ELSE 'C' END AS dp,
  CASE WHEN k % 10 = 0 THEN amount WHEN bal <= 0 THEN 0.0 ELSE round(bal * 60, 2) END AS ob
 FROM b
), f AS (
 SELECT *, CASE WHEN type = 'CASH_IN' THEN round(ob + amount, 2)
                WHEN ob > amount THEN round(ob - amount, 2) ELSE 0.0 END AS nb,
  CASE WHEN dp = 'M' THEN 0.0 ELSE round(amount * (k % 7), 2) END AS od
 FROM e
), tx AS (
SELECT printf('TX%08d', k) AS transaction_id,
 CAST(date_diff('day', DATE '1995-01-01', d) + 1 AS INT) AS step, type, amount,
 concat('C', CAST(ck AS VARCHAR(20))) AS nameOrig, ob AS oldbalanceOrg, nb AS newbalanceOrig,
 concat(dp, CAST((ck * 31 + k) % 5000 AS VARCHAR(20))) AS nameDest, od AS oldbalanceDest,
 CASE WHEN dp = 'M' THEN 0.0 WHEN st = 'P' THEN od ELSE round(od + amount, 2) END AS newbalanceDest,
 CASE WHEN type IN ('CASH_OUT','TRANSFER') AND ob > 0 AND nb = 0 AND k % 4 = 0 THEN 1 ELSE 0 END AS isFraud,
 CASE WHEN type = 'TRANSFER' AND ob > 0 AND nb = 0 AND k % 4 = 0 AND amount > 400000 THEN 1 ELSE 0 END AS isFlaggedFraud
FROM f
)"""

SCORED_IN = TX + """, scored_in AS (
SELECT *, abs(oldbalanceOrg - amount - newbalanceOrig) AS origError,
 abs(oldbalanceDest + amount - newbalanceDest) AS destError,
 CASE WHEN nameDest LIKE 'M%' THEN 1 ELSE 0 END AS isDestMerchant,
 CASE WHEN oldbalanceOrg > 0 AND newbalanceOrig = 0 THEN 1 ELSE 0 END AS origDrainedToZero,
 CAST(CAST(substr(transaction_id, 3) AS BIGINT) % 5 AS INT) AS cluster_kmeans,
 CASE WHEN CAST(substr(transaction_id, 3) AS BIGINT) % 150 = 0 THEN 1 ELSE 0 END AS flag_IsoForest,
 CASE WHEN CAST(substr(transaction_id, 3) AS BIGINT) % 100 = 0 THEN 1 ELSE 0 END AS is_birch_hdbscan_outlier
FROM tx WHERE amount > 0
)"""

_REASONS = ", ".join(
    f"CASE WHEN {flag} = 1 THEN {quoted(text)} END" for flag, text in fixed.REASONS
)

FLAGGED = SCORED_IN + """, fit AS (
 SELECT quantile_cont(amount, 0.25) AS a1, quantile_cont(amount, 0.75) AS a3, avg(amount) AS mu, stddev_samp(amount) AS sd,
  quantile_cont(origError, 0.25) AS o1, quantile_cont(origError, 0.75) AS o3,
  quantile_cont(destError, 0.25) AS d1, quantile_cont(destError, 0.75) AS d3
 FROM scored_in
), flagged AS (
 SELECT s.*,
  CASE WHEN amount < a1 - 1.5 * (a3 - a1) OR amount > a3 + 1.5 * (a3 - a1) THEN 1 ELSE 0 END AS flag_IQR,
  CASE WHEN abs((amount - mu) / sd) > 3 THEN 1 ELSE 0 END AS flag_ZScore,
  CASE WHEN origError < o1 - 1.5 * (o3 - o1) OR origError > o3 + 1.5 * (o3 - o1)
         OR destError < d1 - 1.5 * (d3 - d1) OR destError > d3 + 1.5 * (d3 - d1) THEN 1 ELSE 0 END AS flag_BalanceMismatch,
  is_birch_hdbscan_outlier AS flag_HDBSCAN
 FROM scored_in s, fit
)"""

SCORED = FLAGGED + f""", pointed AS (
 SELECT *, flag_IQR + flag_ZScore + flag_IsoForest + flag_HDBSCAN AS risk_indicator_count,
  flag_IQR + flag_ZScore + 2 * flag_IsoForest + 2 * flag_HDBSCAN AS risk_score FROM flagged
), marked AS (
 SELECT *, CASE WHEN risk_score >= 3 OR flag_HDBSCAN = 1 THEN 1 ELSE 0 END AS high_risk,
  CASE WHEN risk_score >= 5 THEN 1 ELSE 0 END AS critical_risk,
  CASE WHEN risk_score >= 5 THEN 'Critical' WHEN risk_score >= 3 THEN 'High' WHEN risk_score = 2 THEN 'Medium'
       WHEN risk_score = 1 THEN 'Low' ELSE 'Normal' END AS risk_level FROM pointed
), scored AS (
 SELECT *,
  CASE risk_level WHEN 'Normal' THEN 0 WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3 ELSE 4 END AS risk_level_rank,
  CASE WHEN risk_indicator_count >= 3 THEN 'Multiple Indicators'
       WHEN flag_IsoForest = 1 AND flag_HDBSCAN = 1 THEN 'Behavioral and Cluster Outlier'
       WHEN flag_BalanceMismatch = 1 THEN 'Balance Mismatch'
       WHEN flag_IsoForest = 1 THEN 'Behavioral Outlier'
       WHEN flag_HDBSCAN = 1 THEN 'Cluster Outlier'
       WHEN flag_IQR = 1 OR flag_ZScore = 1 THEN 'Extreme Transaction Amount'
       ELSE 'No Statistical Anomaly' END AS anomaly_type,
  CASE WHEN (isFraud = 1 AND high_risk = 1) OR risk_score >= 5 THEN 'Potential Fraud'
       WHEN flag_BalanceMismatch = 1 AND isFraud = 0 THEN 'Possible Data Quality Issue'
       WHEN isFraud = 0 AND high_risk = 1 THEN 'Rare Legitimate Transaction'
       WHEN risk_indicator_count >= 1 THEN 'Potential Risk / Monitor'
       ELSE 'Normal / Low Concern' END AS investigation_category,
  CASE WHEN concat_ws('; ', {_REASONS}) = '' THEN {quoted(fixed.NO_REASON)} ELSE concat_ws('; ', {_REASONS}) END AS anomaly_reason
 FROM marked
)"""

_BOOLEANS = ", ".join(
    f"{c} = 1 AS {c}"
    for c in ("isFraud", "high_risk", "flag_IQR", "flag_ZScore", "flag_IsoForest", "flag_HDBSCAN", "flag_BalanceMismatch")
)

SERVING = SCORED + f""", serving AS (
 SELECT transaction_id, step, type AS transaction_type, amount, oldbalanceOrg, oldbalanceDest, origError, destError,
  cluster_kmeans, risk_score, anomaly_reason, {_BOOLEANS},
  {case_map("risk_level", fixed.RISK_LEVEL_LABELS)} AS risk_level,
  {case_map("anomaly_type", fixed.ANOMALY_TYPE_LABELS)} AS anomaly_type,
  {case_map("investigation_category", fixed.INVESTIGATION_LABELS)} AS investigation_category,
  CASE WHEN isDestMerchant = 1 THEN 'Merchant' ELSE 'Nasabah' END AS jenis_tujuan,
  CASE WHEN origDrainedToZero = 1 THEN 'Terkuras Habis' ELSE 'Tidak Terkuras' END AS status_kuras
 FROM scored
)"""

CUBE = SERVING + f""", cube AS (
 SELECT {", ".join(fixed.CUBE_COLUMNS)}, count(*) AS n FROM serving GROUP BY ALL
)"""


def _binned(column: str) -> str:
    """Label by the surviving quantile edges of a column, from the list ``e_<column>``."""
    edges, name = f"e_{column}", quoted(column + "_")
    sets = " ".join(
        f"WHEN {bins + 1} THEN [{', '.join(quoted(v) for v in labels)}]" for bins, labels in fixed.BIN_LABELS.items()
    )
    code = f"len(list_filter({edges}[2:-2], lambda e: e < {column}))"
    return f"CASE WHEN len({edges}) > 1 THEN {name} || (CASE len({edges}) {sets} END)[{code} + 1] END AS {column}_bin"


_EDGES = ", ".join(
    f"list_sort(list_distinct(quantile_cont({c}, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e_{c}" for c in fixed.BINNED_COLUMNS
)

BINNED = SCORED_IN + f""", edges AS (SELECT {_EDGES} FROM scored_in),
binned AS (SELECT s.*, {", ".join(_binned(c) for c in fixed.BINNED_COLUMNS)} FROM scored_in s, edges)"""

_ITEMS = ", ".join(
    [
        "'type_' || type",
        "CASE WHEN isFraud = 1 THEN 'isFraud_yes' ELSE 'isFraud_no' END",
        "CASE WHEN isDestMerchant = 1 THEN 'dest_merchant_yes' ELSE 'dest_merchant_no' END",
        "CASE WHEN origDrainedToZero = 1 THEN 'orig_drained_yes' ELSE 'orig_drained_no' END",
        "'cluster_kmeans_' || cluster_kmeans",
        "CASE WHEN is_birch_hdbscan_outlier = 1 THEN 'hdbscan_outlier' ELSE 'hdbscan_normal' END",
        *[f"{c}_bin" for c in fixed.BINNED_COLUMNS],
    ]
)

BASKETS = BINNED + f""", baskets AS (
 SELECT transaction_id, list_sort(list_filter([{_ITEMS}], lambda i: i IS NOT NULL)) AS items FROM binned
), collapsed AS MATERIALIZED (SELECT row_number() OVER () AS bid, items, count(*) AS n FROM baskets GROUP BY items),
total AS (SELECT sum(n)::DOUBLE AS rows FROM collapsed)"""

ITEMSETS = BASKETS + """, single AS (SELECT bid, n, unnest(items) AS item FROM collapsed),
counted AS (
 SELECT [item] AS itemsets, sum(n)::BIGINT AS n FROM single GROUP BY item
 UNION ALL
 SELECT [a.item, b.item], sum(a.n)::BIGINT FROM single a JOIN single b ON a.bid = b.bid AND a.item < b.item GROUP BY a.item, b.item
 UNION ALL
 SELECT [a.item, b.item, c.item], sum(a.n)::BIGINT FROM single a JOIN single b ON a.bid = b.bid AND a.item < b.item
  JOIN single c ON c.bid = b.bid AND b.item < c.item GROUP BY a.item, b.item, c.item
), itemsets AS MATERIALIZED (SELECT itemsets, array_to_string(itemsets, ', ') AS itemsets_str, n, n / rows AS support FROM counted, total)"""

ALL_RULES = ITEMSETS + """, masks AS (
 SELECT itemsets, n, unnest(generate_series(1, (1 << len(itemsets)) - 2)) AS mask FROM itemsets
  WHERE len(itemsets) > 1 AND support >= 0.0001
), sides AS (
 SELECT n, itemsets, mask,
  array_to_string(list_filter(itemsets, lambda x, i: (mask >> (i - 1)) & 1 = 1), ', ') AS antecedents_str,
  array_to_string(list_filter(itemsets, lambda x, i: (mask >> (i - 1)) & 1 = 0), ', ') AS consequents_str,
  bit_count(mask)::INT AS antecedent_len, (len(itemsets) - bit_count(mask))::INT AS consequent_len FROM masks
), measured AS MATERIALIZED (
 SELECT s.*, a.n / rows AS antecedent_support, c.n / rows AS consequent_support, s.n / rows AS support,
  s.n::DOUBLE / a.n AS confidence, (s.n::DOUBLE / a.n) / (c.n / rows) AS lift,
  s.n / rows - (a.n / rows) * (c.n / rows) AS leverage,
  CASE WHEN s.n = a.n THEN 'inf'::DOUBLE ELSE (1 - c.n / rows) / (1 - s.n::DOUBLE / a.n) END AS conviction
 FROM sides s JOIN itemsets a ON a.itemsets_str = s.antecedents_str JOIN itemsets c ON c.itemsets_str = s.consequents_str, total
)"""


def _contains_any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, {quoted(w)})" for w in words) + ")"


RULES = ALL_RULES + f""", rules AS (SELECT * FROM measured WHERE support >= 0.005 AND confidence >= 0.5 AND lift >= 1.2),
meaningful AS (SELECT * FROM rules WHERE {_contains_any("consequents_str", fixed.USEFUL_CONSEQUENTS)}
  AND NOT {_contains_any("consequents_str", fixed.TRIVIAL_CONSEQUENTS)}),
report AS (SELECT * FROM meaningful WHERE confidence >= 0.3 AND lift >= 1.2),
fraud AS (SELECT * FROM measured WHERE support >= 0.0001 AND lift >= 1.2 AND contains(consequents_str, 'isFraud_yes')
  AND NOT contains(antecedents_str, 'isFraud_no'))"""

RULE_ORDER = "lift DESC, confidence DESC, support DESC, antecedents_str, consequents_str"

TOP10 = RULES + f""", parts AS (
 SELECT 0 AS src, row_number() OVER (ORDER BY {RULE_ORDER}) AS pos, * FROM fraud QUALIFY pos <= 4
 UNION ALL SELECT 1, row_number() OVER (ORDER BY {RULE_ORDER}) AS pos, * FROM report WHERE contains(consequents_str, 'hdbscan_outlier') QUALIFY pos <= 2
 UNION ALL SELECT 2, row_number() OVER (ORDER BY {RULE_ORDER}) AS pos, * FROM report WHERE contains(consequents_str, 'cluster_kmeans') QUALIFY pos <= 2
 UNION ALL SELECT 3, row_number() OVER (ORDER BY {RULE_ORDER}) AS pos, * FROM report
  WHERE NOT {_contains_any("consequents_str", ("isFraud_yes", "hdbscan_outlier", "cluster_kmeans"))} QUALIFY pos <= 5
 UNION ALL SELECT 4, row_number() OVER (ORDER BY {RULE_ORDER}) AS pos, * FROM report
), top10 AS (
 SELECT row_number() OVER (ORDER BY src, pos) AS position, antecedents_str, consequents_str, support, confidence, lift, leverage, conviction FROM (
  SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY antecedents_str, consequents_str ORDER BY src, pos) = 1
 ) ORDER BY src, pos LIMIT 10
), clean_parts AS (
 SELECT 0 AS src, position AS pos, antecedents_str, consequents_str, support, confidence, lift FROM top10
  WHERE NOT {_contains_any("antecedents_str", fixed.TRIVIAL_ANTECEDENTS)}
 UNION ALL
 SELECT 1, row_number() OVER (ORDER BY {RULE_ORDER}), antecedents_str, consequents_str, support, confidence, lift FROM report
  WHERE NOT {_contains_any("antecedents_str", fixed.TRIVIAL_ANTECEDENTS)}
), clean10 AS (
 SELECT row_number() OVER (ORDER BY src, pos) AS position, antecedents_str, consequents_str, support, confidence, lift FROM (
  SELECT * FROM clean_parts QUALIFY row_number() OVER (PARTITION BY antecedents_str, consequents_str ORDER BY src, pos) = 1
 ) ORDER BY src, pos LIMIT 10
)"""

_PINNED = ", ".join(f"({quoted(a)}, {quoted(c)}, {s}::DOUBLE, {f}::DOUBLE, {lift}::DOUBLE)" for a, c, s, f, lift in fixed.PINNED_RULES)
_LABEL_MAP = "MAP {" + ", ".join(f"{quoted(k)}: {quoted(v)}" for k, v in fixed.ITEM_LABELS.items()) + "}"


def _human(column: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({column}, ', '), "
        f"lambda i: coalesce(item_labels[i], replace(i, '_', ' '))), ' DAN ')"
    )


_BOTH = "antecedents_str || ' ' || consequents_str"

RULE_TABLE = RULES + f""", pinned(antecedents_str, consequents_str, support, confidence, lift) AS (VALUES {_PINNED}),
merged AS (
 SELECT *, true AS is_real FROM pinned
 UNION ALL
 SELECT antecedents_str, consequents_str, support, confidence, lift, false FROM report r
  WHERE NOT EXISTS (SELECT 1 FROM pinned p WHERE p.antecedents_str = r.antecedents_str AND p.consequents_str = r.consequents_str)
), labels_map AS (SELECT {_LABEL_MAP} AS item_labels),
rule_table AS (
 SELECT 'POLA' || lpad(CAST(row_number() OVER (ORDER BY is_real DESC, {RULE_ORDER}) AS VARCHAR), 4, '0') AS rule_id,
  antecedents_str, consequents_str, support, confidence, lift,
  {_human("antecedents_str")} AS when_text, {_human("consequents_str")} AS then_text,
  replace(format('{{:.3f}}%', support * 100), '.', ',') AS coverage_fmt,
  replace(format('{{:.1f}}%', confidence * 100), '.', ',') AS confidence_fmt,
  replace(format('{{:,.1f}}x', lift), '.', ',') AS lift_fmt,
  CASE WHEN contains(consequents_str, 'isFraud_yes') THEN CASE WHEN confidence >= 0.5 THEN {quoted(fixed.TAKEAWAYS["fraud_certain"])} ELSE {quoted(fixed.TAKEAWAYS["fraud_possible"])} END
       WHEN contains({_BOTH}, 'cluster_kmeans') THEN {quoted(fixed.TAKEAWAYS["segment"])}
       WHEN contains({_BOTH}, 'hdbscan_outlier') THEN {quoted(fixed.TAKEAWAYS["outlier"])}
       WHEN lift >= 10 THEN {quoted(fixed.TAKEAWAYS["strong"])} ELSE {quoted(fixed.TAKEAWAYS["general"])} END AS takeaway,
  CASE WHEN contains(consequents_str, 'isFraud_yes') THEN {quoted(fixed.RULE_ADVICE["fraud"])}
       WHEN contains({_BOTH}, 'cluster_kmeans') THEN {quoted(fixed.RULE_ADVICE["segment"])}
       WHEN contains({_BOTH}, 'hdbscan_outlier') THEN {quoted(fixed.RULE_ADVICE["outlier"])}
       WHEN lift >= 10 THEN {quoted(fixed.RULE_ADVICE["strong"])} ELSE {quoted(fixed.RULE_ADVICE["general"])} END AS recommendation,
  CASE WHEN contains(consequents_str, 'isFraud_yes') THEN {quoted(fixed.GROUP_FRAUD)}
       WHEN contains({_BOTH}, 'cluster_kmeans') THEN {quoted(fixed.GROUP_SEGMENT)}
       WHEN contains({_BOTH}, 'hdbscan_outlier') THEN {quoted(fixed.GROUP_OUTLIER)} ELSE {quoted(fixed.GROUP_GENERAL)} END AS rule_group,
  is_real AS is_top10, CASE WHEN is_real THEN {quoted(fixed.MAIN_INSIGHT)} ELSE {quoted(fixed.EXTRA_INSIGHT)} END AS penting
 FROM merged, labels_map
)"""
