"""Presentation, lookup and chart data for mined rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.functions import text
from ledgerlens.operators.quality import count_where

RULE_COLUMNS = ("antecedents_str", "consequents_str", "support", "confidence", "lift")
RULE_SCHEMA = "antecedents_str string, consequents_str string, support double, confidence double, lift double"


def pinned_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.PINNED_RULES), RULE_SCHEMA)


def merge_rule_pools(pinned: DataFrame, pool: DataFrame) -> DataFrame:
    """Pinned rules plus the pool's other rules, marked by ``is_real``."""
    others = pool.select(*RULE_COLUMNS).join(
        pinned.select("antecedents_str", "consequents_str"), ["antecedents_str", "consequents_str"], "left_anti"
    )
    return pinned.select(*RULE_COLUMNS, F.lit(True).alias("is_real")).unionByName(
        others.withColumn("is_real", F.lit(False)).select(*RULE_COLUMNS, "is_real")
    )


def _leads_to_fraud() -> Column:
    return F.contains(F.col("consequents_str"), F.lit("isFraud_yes"))


def _either_side(word: str) -> Column:
    return F.contains(F.concat_ws(" ", "antecedents_str", "consequents_str"), F.lit(word))


def rule_group() -> Column:
    return (
        F.when(_leads_to_fraud(), fixed.GROUP_FRAUD)
        .when(_either_side("cluster_kmeans"), fixed.GROUP_SEGMENT)
        .when(_either_side("hdbscan_outlier"), fixed.GROUP_OUTLIER)
        .otherwise(fixed.GROUP_GENERAL)
    )


def _by_nature(texts: dict[str, str], fraud: Column) -> Column:
    return (
        F.when(_leads_to_fraud(), fraud)
        .when(_either_side("cluster_kmeans"), texts["segment"])
        .when(_either_side("hdbscan_outlier"), texts["outlier"])
        .when(F.col("lift") >= 10, texts["strong"])
        .otherwise(texts["general"])
    )


def rule_takeaway() -> Column:
    certain = F.when(F.col("confidence") >= 0.5, fixed.TAKEAWAYS["fraud_certain"]).otherwise(fixed.TAKEAWAYS["fraud_possible"])
    return _by_nature(fixed.TAKEAWAYS, certain)


def rule_recommendation() -> Column:
    return _by_nature(fixed.RULE_ADVICE, F.lit(fixed.RULE_ADVICE["fraud"]))


def rule_present(merged: DataFrame) -> DataFrame:
    """Readable rule table with ids following (pinned first, then lift)."""
    order = Window.orderBy(
        F.desc("is_real"), F.desc("lift"), F.desc("confidence"), F.desc("support"), "antecedents_str", "consequents_str"
    )
    return merged.select(
        F.format_string("POLA%04d", F.row_number().over(order)).alias("rule_id"),
        *RULE_COLUMNS,
        text.humanize_items(F.col("antecedents_str")).alias("when_text"),
        text.humanize_items(F.col("consequents_str")).alias("then_text"),
        text.format_pct(F.col("support"), 3).alias("coverage_fmt"),
        text.format_pct(F.col("confidence"), 1).alias("confidence_fmt"),
        text.format_multiplier(F.col("lift")).alias("lift_fmt"),
        rule_takeaway().alias("takeaway"),
        rule_recommendation().alias("recommendation"),
        rule_group().alias("rule_group"),
        F.col("is_real").alias("is_top10"),
        F.when(F.col("is_real"), fixed.MAIN_INSIGHT).otherwise(fixed.EXTRA_INSIGHT).alias("penting"),
    )


def get_rules(
    rules: DataFrame, rule_group: str | None = None, min_lift: float = 0.0, search: str = "", limit: int | None = None,
    min_confidence: float = 0.0, attribute: str | None = None,
) -> DataFrame:
    """Rules by group, strength, item (either side) and text; pinned first, then by lift."""

    def either(left: str, right: str, word: str) -> Column:
        needle = F.lit(f"%{word}%")
        return F.ilike(F.col(left), needle) | F.ilike(F.col(right), needle)

    conditions = [F.lit(True)]
    if rule_group:
        conditions.append(F.col("rule_group") == rule_group)
    if min_lift:
        conditions.append(F.col("lift") >= float(min_lift))
    if min_confidence:
        conditions.append(F.col("confidence") >= float(min_confidence))
    if attribute:
        conditions.append(either("antecedents_str", "consequents_str", attribute))
    if search:
        conditions.append(either("when_text", "then_text", search))
    found = rules.filter(reduce(lambda a, b: a & b, conditions)).orderBy(F.desc("is_top10"), F.desc("lift"), "rule_id")
    return found.limit(int(limit)) if limit else found


def rules_all_attributes(rules: DataFrame, attributes: Sequence[str], **filters) -> DataFrame:
    """Rules holding every selected item on either side."""
    found = get_rules(rules, attribute=attributes[0] if attributes else None, **filters)
    both = F.concat_ws(",", "antecedents_str", "consequents_str")
    for item in attributes[1:]:
        found = found.filter(F.contains(both, F.lit(item)))
    return found


def top_rules(rules: DataFrame, n: int = 10) -> DataFrame:
    return get_rules(rules, limit=n)


def rule_stats(rules: DataFrame) -> DataFrame:
    return rules.agg(
        F.count("*").alias("rules"),
        F.coalesce(F.max("lift"), F.lit(0.0)).alias("max_lift"),
        F.coalesce(F.max("confidence"), F.lit(0.0)).alias("max_confidence"),
    )


def top_rules_and_stats(rules: DataFrame, n: int = 10) -> DataFrame:
    """The first rules of a selection, each with the selection's size and best figures."""
    stats = rules.agg(
        F.count("*").alias("n"), F.max("lift").alias("lift"), F.max("confidence").alias("confidence")
    )
    return top_rules(rules, n).select(
        "rule_id", "antecedents_str", "consequents_str", "lift", "confidence",
        stats.select("n").scalar().alias("matching_rules"),
        stats.select("lift").scalar().alias("max_lift"),
        stats.select("confidence").scalar().alias("max_confidence"),
    )


def _strongest(rules: DataFrame, n: int) -> DataFrame:
    return rules.orderBy(F.desc("lift"), "antecedents_str", "consequents_str").limit(n)


def _atoms(column: str) -> Column:
    return F.filter(F.transform(F.split(column, ","), lambda a: F.trim(a)), lambda a: a != "")


def rule_graph_edges(rules: DataFrame, max_rules: int = 25) -> DataFrame:
    """One edge per condition item and outcome item of the strongest rules."""
    return (
        _strongest(rules, max_rules)
        .select(F.explode(_atoms("antecedents_str")).alias("source"), "consequents_str", "confidence", "lift")
        .select(
            "source",
            F.explode(_atoms("consequents_str")).alias("target"),
            "confidence",
            "lift",
            _leads_to_fraud().alias("is_fraud"),
        )
    )


def rule_graph(rules: DataFrame, max_rules: int = 25) -> DataFrame:
    """Items of the strongest rules with the number of edges that touch them."""
    ends = rule_graph_edges(rules, max_rules).select(F.explode(F.array("source", "target")).alias("item"))
    return ends.groupBy("item").agg(F.count("*").alias("degree"))


def lift_tiers(rules: DataFrame) -> DataFrame:
    """Rules per strength tier, split by whether they lead to fraud; empty tiers stay."""
    lift = F.col("lift")
    bounds = [lift >= 100, (lift >= 10) & (lift < 100), (lift >= 2) & (lift < 10), lift < 2]
    wide = rules.agg(
        *[count_where(b & _leads_to_fraud()).alias(f"f{i}") for i, b in enumerate(bounds)],
        *[count_where(b & ~_leads_to_fraud()).alias(f"g{i}") for i, b in enumerate(bounds)],
    )
    tiers = [
        F.struct(F.lit(i + 1).alias("position"), F.lit(t).alias("tier"), F.col(f"f{i}").alias("fraud_rules"), F.col(f"g{i}").alias("general_rules"))
        for i, t in enumerate(fixed.LIFT_TIERS)
    ]
    return wide.select(F.inline(F.array(*tiers)))


def rule_group_counts(rules: DataFrame) -> DataFrame:
    """Rules per group in the fixed group order, zeros kept."""
    wide = rules.agg(*[count_where(F.col("rule_group") == g).alias(f"n{i}") for i, g in enumerate(fixed.RULE_GROUPS)])
    groups = [
        F.struct(F.lit(i + 1).alias("position"), F.lit(g).alias("rule_group"), F.col(f"n{i}").alias("rules"))
        for i, g in enumerate(fixed.RULE_GROUPS)
    ]
    return wide.select(F.inline(F.array(*groups)))


def rule_scatter_points(rules: DataFrame) -> DataFrame:
    """Confidence percent, lift, marker size (8 to 34, by support) and fraud mark per rule."""
    largest = F.max("support").over(Window.partitionBy())
    size = F.lit(8.0) + F.when(largest > 0, F.col("support") / largest * 26).otherwise(0.0)
    return rules.select(
        "antecedents_str",
        "consequents_str",
        (F.col("confidence") * 100).alias("confidence_pct"),
        "lift",
        size.alias("point_size"),
        _leads_to_fraud().alias("is_fraud"),
    )


def item_catalog(spark: SparkSession) -> DataFrame:
    """Item labels under their filter groups, by group and label."""
    rows = [
        (position, key, title, item, label)
        for position, (key, title, prefixes) in enumerate(fixed.ITEM_GROUPS, 1)
        for item, label in fixed.ITEM_LABELS.items()
        if item.startswith(prefixes)
    ]
    return spark.createDataFrame(rows, "position int, group_key string, group_title string, item string, label string").orderBy("position", "label")


def item_usage(spark: SparkSession, collapsed: DataFrame) -> DataFrame:
    """The item catalogue with each item's support in a ledger (0 for items that never occur)."""
    from ledgerlens.operators.rules import item_support

    return item_catalog(spark).join(item_support(collapsed), "item", "left").withColumn("support", F.coalesce("support", F.lit(0.0)))
