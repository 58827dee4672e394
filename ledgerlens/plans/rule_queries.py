"""Association-rule queries: mining, selection and presentation."""

from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.operators import rule_views, rules
from ledgerlens.plans.registry import baskets, collapsed, query, rounded, rule_table
from ledgerlens.plans.sql_views import ALL_RULES, BASKETS, BINNED, ITEMSETS, RULE_ORDER, RULE_TABLE, RULES, TOP10, _binned, quoted
from ledgerlens.session import cut_lineage
from ledgerlens.sources.ledger import scoring_input

BINS = tuple(f"{c}_bin" for c in fixed.BINNED_COLUMNS)
_SHOWN = ("antecedents_str", "consequents_str", "support", "confidence", "lift")
_MEASURES = ("antecedent_support", "consequent_support", "support", "confidence", "lift", "leverage", "conviction")
_SHOWN_SQL = "antecedents_str, consequents_str, round(support, 8) AS support, round(confidence, 8) AS confidence, round(lift, 6) AS lift"


def shown(table):
    return rounded(rounded(table.select(*_SHOWN), 8, "support", "confidence"), 6, "lift")


def mined(spark, folder):
    return rules.mine(collapsed(spark, folder))


def report(spark, folder):
    return rules.report_rules(rules.meaningful_rules(mined(spark, folder)))


@query("quantile_bins", BINNED + f"SELECT transaction_id, {', '.join(BINS)} FROM binned")
def quantile_bins(spark, folder):
    return rules.quantile_bins(scoring_input(spark, folder), fixed.BINNED_COLUMNS).select("transaction_id", *BINS)


def _fixed_label(c: str) -> str:
    labels = "[" + ", ".join(quoted(f"{c}_{v}") for v in fixed.BIN_LABELS[5]) + "]"
    by_rank = " + ".join(f"CAST(k_{c} * 5 > (rows - 1) * {i} AS INT)" for i in range(1, 5))
    by_edge = f"len(list_filter(e_{c}[2:-2], lambda e: e < {c}))"
    return f"{labels}[1 + CASE WHEN len(e_{c}) = 6 THEN {by_edge} ELSE {by_rank} END] AS {c}_bin"


_RANKS = ", ".join(f"row_number() OVER (ORDER BY {c}, transaction_id) - 1 AS k_{c}" for c in fixed.BINNED_COLUMNS)
_FIXED_BINS = BINNED + f", ranked AS (SELECT *, {_RANKS}, count(*) OVER () AS rows FROM scored_in), fixed_bins AS (SELECT r.*, {', '.join(_fixed_label(c) for c in fixed.BINNED_COLUMNS)} FROM ranked r, edges) "


@query("quantile_bins_fixed_labels", _FIXED_BINS + f"SELECT transaction_id, {', '.join(BINS)} FROM fixed_bins")
def quantile_bins_fixed_labels(spark, folder):
    rows = cut_lineage(scoring_input(spark, folder).select("transaction_id", *fixed.BINNED_COLUMNS))
    return rules.quantile_bins_fixed_labels(rows, fixed.BINNED_COLUMNS, "transaction_id").select("transaction_id", *BINS)


@query("build_basket", BASKETS + "SELECT transaction_id, array_to_string(items, ', ') AS items FROM baskets")
def build_basket(spark, folder):
    return baskets(spark, folder).select("transaction_id", F.array_join("items", ", ").alias("items"))


_SUPPORT = BASKETS + ", s AS (SELECT item, round(sum(n) / any_value(rows), 8) AS support FROM (SELECT unnest(items) AS item, n FROM collapsed), total GROUP BY item) "


@query("item_support", _SUPPORT + "SELECT * FROM s")
def item_support(spark, folder):
    return rounded(rules.item_support(collapsed(spark, folder)), 8, "support")


@query("item_support_top_25", _SUPPORT + "SELECT * FROM s ORDER BY support DESC, item LIMIT 25")
def item_support_top_25(spark, folder):
    return rounded(rules.item_support(collapsed(spark, folder)), 8, "support").orderBy(F.desc("support"), "item").limit(25)


@query("important_item_support", _SUPPORT + f"SELECT * FROM s WHERE item IN ({', '.join(quoted(i) for i in fixed.IMPORTANT_ITEMS)})")
def important_item_support(spark, folder):
    return rounded(rules.important_item_support(collapsed(spark, folder)), 8, "support")


@query("frequent_itemsets", ITEMSETS + "SELECT itemsets_str, n, round(support, 8) AS support FROM itemsets WHERE support >= 0.005")
def frequent_itemsets(spark, folder):
    found = rules.frequent_itemsets(collapsed(spark, folder), 0.005)
    return rounded(found.select("itemsets_str", "n", "support"), 8, "support")


@query("frequent_itemsets_low_support", ITEMSETS + "SELECT itemsets_str, n, round(support, 8) AS support FROM itemsets WHERE support >= 0.0001")
def frequent_itemsets_low_support(spark, folder):
    found = rules.frequent_itemsets(collapsed(spark, folder), 0.0001)
    return rounded(found.select("itemsets_str", "n", "support"), 8, "support")


@query(
    "association_rules",
    RULES + "SELECT antecedents_str, consequents_str, antecedent_len, consequent_len, " + ", ".join(f"round({m}, 6) AS {m}" for m in _MEASURES if m != "conviction")
    + ", CASE WHEN isinf(conviction) THEN conviction ELSE round(conviction, 6) END AS conviction FROM rules",
)


def association_rules(spark, folder):
    found = mined(spark, folder).drop("antecedents", "consequents")
    finite = F.when(F.col("conviction") == float("inf"), F.col("conviction")).otherwise(F.round("conviction", 6))
    return rounded(found, 6, *[m for m in _MEASURES if m != "conviction"]).withColumn("conviction", finite)


@query("meaningful_rules", RULES + f"SELECT {_SHOWN_SQL} FROM meaningful")
def meaningful_rules(spark, folder):
    return shown(rules.meaningful_rules(mined(spark, folder)))


@query("report_rules", RULES + f"SELECT {_SHOWN_SQL} FROM report")
def report_rules(spark, folder):
    return shown(report(spark, folder))


@query("fraud_rules", RULES + f"SELECT {_SHOWN_SQL} FROM fraud")
def fraud_rules(spark, folder):
    return shown(rules.fraud_rules(collapsed(spark, folder)))


_VARIANT = (_FIXED_BINS + BASKETS[len(BINNED):].replace("FROM binned", "FROM fixed_bins") + ITEMSETS[len(BASKETS):] + ALL_RULES[len(ITEMSETS):]).replace(
    "FROM ranked r, edges) , baskets", "FROM ranked r, edges), baskets"
)


@query(
    "general_and_fraud_rules",
    _VARIANT
    + f" SELECT DISTINCT {_SHOWN_SQL} FROM measured, (SELECT coalesce(sum(n), 0) AS fraud_rows FROM collapsed WHERE list_contains(items, 'isFraud_yes')) "
    "WHERE lift >= 1.2 AND ((support >= 0.005 AND confidence >= 0.5) OR (fraud_rows >= 5 AND support >= 0.0008 AND list_contains(string_split(consequents_str, ', '), 'isFraud_yes')))",
)


def general_and_fraud_rules(spark, folder):
    rows = cut_lineage(scoring_input(spark, folder))
    table = rules.build_basket_fixed_labels(rows, "transaction_id", "is_birch_hdbscan_outlier")
    return shown(rules.general_and_fraud_rules(rules.collapse_baskets(table.select("items"))))


@query(
    "rules_mentioning",
    RULES + f"SELECT {_SHOWN_SQL} FROM report WHERE contains(antecedents_str, 'type_PAYMENT') OR contains(consequents_str, 'type_PAYMENT') ORDER BY {RULE_ORDER.replace('lift', 'report.lift').replace('confidence', 'report.confidence').replace('support', 'report.support')} LIMIT 5",
)


def rules_mentioning(spark, folder):
    return shown(rules.rules_mentioning(report(spark, folder), "type_PAYMENT"))


def _top(spark, folder):
    table = collapsed(spark, folder)
    reported = rules.report_rules(rules.meaningful_rules(rules.mine(table)))
    return rules.select_top10(rules.fraud_rules(table), reported), reported


@query("select_top10", TOP10 + f"SELECT position::INT AS position, {_SHOWN_SQL} FROM top10")
def select_top10(spark, folder):
    top, _ = _top(spark, folder)
    return rounded(rounded(top.select("position", *_SHOWN), 8, "support", "confidence"), 6, "lift")


@query("clean_top10", TOP10 + f"SELECT position::INT AS position, {_SHOWN_SQL} FROM clean10")
def clean_top10(spark, folder):
    top, reported = _top(spark, folder)
    return rounded(rounded(rules.clean_top10(top, reported).select("position", *_SHOWN), 8, "support", "confidence"), 6, "lift")


@query("merge_rule_pools", RULE_TABLE + f"SELECT {_SHOWN_SQL}, is_real FROM merged")
def merge_rule_pools(spark, folder):
    merged = rule_views.merge_rule_pools(rule_views.pinned_rules(spark), report(spark, folder))
    return rounded(rounded(merged, 8, "support", "confidence"), 6, "lift")


@query("rule_group", RULE_TABLE + "SELECT antecedents_str, consequents_str, rule_group FROM rule_table")
def rule_group(spark, folder):
    return rule_table(spark, folder).select("antecedents_str", "consequents_str", "rule_group")


@query("rule_takeaway", RULE_TABLE + "SELECT antecedents_str, consequents_str, takeaway, recommendation FROM rule_table")
def rule_takeaway(spark, folder):
    return rule_table(spark, folder).select("antecedents_str", "consequents_str", "takeaway", "recommendation")


_PRESENTED = ("rule_id", "antecedents_str", "consequents_str", "when_text", "then_text", "coverage_fmt", "confidence_fmt", "lift_fmt", "rule_group", "is_top10", "penting")


@query("rule_present", RULE_TABLE + f"SELECT {', '.join(_PRESENTED)} FROM rule_table")
def rule_present(spark, folder):
    return rule_table(spark, folder).select(*_PRESENTED)


_EDGES = RULE_TABLE + """, strongest AS (SELECT * FROM rule_table ORDER BY lift DESC, antecedents_str, consequents_str LIMIT 25),
sources AS (SELECT unnest(string_split(antecedents_str, ', ')) AS source, consequents_str, confidence, lift FROM strongest),
graph_edges AS (SELECT source, unnest(string_split(consequents_str, ', ')) AS target, confidence, lift, contains(consequents_str, 'isFraud_yes') AS is_fraud FROM sources) """


@query("rule_graph", _EDGES + "SELECT item, count(*) AS degree FROM (SELECT source AS item FROM graph_edges UNION ALL SELECT target FROM graph_edges) GROUP BY item")
def rule_graph(spark, folder):
    return rule_views.rule_graph(rule_table(spark, folder))


@query("rule_graph_edges", _EDGES + "SELECT source, target, round(confidence, 8) AS confidence, round(lift, 6) AS lift, is_fraud FROM graph_edges")
def rule_graph_edges(spark, folder):
    return rounded(rounded(rule_views.rule_graph_edges(rule_table(spark, folder)), 8, "confidence"), 6, "lift")


_TIER = (("lift >= 100"), ("lift >= 10 AND lift < 100"), ("lift >= 2 AND lift < 10"), ("lift < 2"))


@query(
    "lift_tiers",
    RULE_TABLE
    + " UNION ALL ".join(
        f"SELECT {i} AS position, {quoted(t)} AS tier, count(*) FILTER (WHERE contains(consequents_str, 'isFraud_yes')) AS fraud_rules, "
        f"count(*) FILTER (WHERE NOT contains(consequents_str, 'isFraud_yes')) AS general_rules FROM rule_table WHERE {w}"
        for i, (t, w) in enumerate(zip(fixed.LIFT_TIERS, _TIER), 1)
    ),
)


def lift_tiers(spark, folder):
    return rule_views.lift_tiers(rule_table(spark, folder))


@query(
    "rule_group_counts",
    RULE_TABLE + " UNION ALL ".join(f"SELECT {i} AS position, {quoted(g)} AS rule_group, count(*) AS rules FROM rule_table WHERE rule_group = {quoted(g)}" for i, g in enumerate(fixed.RULE_GROUPS, 1)),
)


def rule_group_counts(spark, folder):
    return rule_views.rule_group_counts(rule_table(spark, folder))


@query(
    "rule_scatter_points",
    RULE_TABLE + "SELECT antecedents_str, consequents_str, round(confidence * 100, 6) AS confidence_pct, round(lift, 6) AS lift, "
    "round(8.0 + support / max(support) OVER () * 26, 6) AS point_size, contains(consequents_str, 'isFraud_yes') AS is_fraud FROM rule_table",
)


def rule_scatter_points(spark, folder):
    return rounded(rule_views.rule_scatter_points(rule_table(spark, folder)), 6, "confidence_pct", "lift", "point_size")


_CATALOG = ", ".join(
    f"({i}, {quoted(title)}, {quoted(item)}, {quoted(label)})"
    for i, (_, title, prefixes) in enumerate(fixed.ITEM_GROUPS, 1)
    for item, label in fixed.ITEM_LABELS.items()
    if item.startswith(prefixes)
)


@query(
    "item_catalog",
    _SUPPORT + f", catalog(position, group_title, item, label) AS (VALUES {_CATALOG}) SELECT position, group_title, item, label, coalesce(support, 0.0::DOUBLE) AS support FROM catalog LEFT JOIN s USING (item)",
)


def item_catalog(spark, folder):
    used = rounded(rule_views.item_usage(spark, collapsed(spark, folder)), 8, "support")
    return used.select("position", "group_title", "item", "label", "support")


_LISTED = ("rule_id", "rule_group", "antecedents_str", "consequents_str", "lift_fmt")


@query("get_rules", RULE_TABLE + f"SELECT {', '.join(_LISTED)} FROM rule_table WHERE rule_group = 'Pola Segmen' AND lift >= 1.5 AND confidence >= 0.6 AND (antecedents_str ILIKE '%amount%' OR consequents_str ILIKE '%amount%')")
def get_rules(spark, folder):
    found = rule_views.get_rules(rule_table(spark, folder), "Pola Segmen", min_lift=1.5, min_confidence=0.6, attribute="amount")
    return found.select(*_LISTED)


@query("get_rules_by_text", RULE_TABLE + f"SELECT {', '.join(_LISTED)} FROM rule_table WHERE when_text ILIKE '%Setor Tunai%' OR then_text ILIKE '%Setor Tunai%' ORDER BY is_top10 DESC, lift DESC, rule_id LIMIT 200")
def get_rules_by_text(spark, folder):
    return rule_views.get_rules(rule_table(spark, folder), search="Setor Tunai", limit=200).select(*_LISTED)


@query(
    "rules_all_attributes",
    RULE_TABLE + f"SELECT {', '.join(_LISTED)} FROM rule_table WHERE (antecedents_str ILIKE '%type_PAYMENT%' OR consequents_str ILIKE '%type_PAYMENT%') "
    "AND contains(antecedents_str || ',' || consequents_str, 'dest_merchant_yes')",
)


def rules_all_attributes(spark, folder):
    return rule_views.rules_all_attributes(rule_table(spark, folder), ["type_PAYMENT", "dest_merchant_yes"]).select(*_LISTED)


@query(
    "top_rules_and_stats",
    RULE_TABLE + "SELECT rule_id, antecedents_str, consequents_str, round(lift, 6) AS lift, round(confidence, 8) AS confidence, (SELECT count(*) FROM rule_table) AS matching_rules, "
    "(SELECT round(max(lift), 6) FROM rule_table) AS max_lift, (SELECT round(max(confidence), 8) FROM rule_table) AS max_confidence FROM rule_table ORDER BY is_top10 DESC, rule_table.lift DESC, rule_id LIMIT 10",
)


def top_rules_and_stats(spark, folder):
    found = rule_views.top_rules_and_stats(rule_table(spark, folder))
    return rounded(rounded(found, 6, "lift", "max_lift"), 8, "confidence", "max_confidence")
