"""Pre-aggregated cube and the analytic questions answered from it.

The cube has one row per combination of low-cardinality columns, so its size does not
follow the ledger's. Everything here aggregates that small table; windows run over a
handful of already grouped rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.operators.filters import Filters, cube_predicate
from ledgerlens.operators.quality import unpivot

EVERYTHING = Filters()


def _all() -> WindowSpec:
    """A window over all (few) grouped rows."""
    return Window.partitionBy()


def build_cube(serving: DataFrame, recompute_high_risk: bool = False) -> DataFrame:
    """Row counts per combination of the cube columns that exist."""
    if recompute_high_risk:
        serving = serving.withColumn(
            "high_risk", (F.col("risk_score") >= fixed.HIGH_RISK_SCORE) | F.col("flag_HDBSCAN").cast("boolean")
        )
    present = [c for c in fixed.CUBE_COLUMNS if c in serving.columns]
    return serving.groupBy(*present).agg(F.count("*").alias("n"))


def _flag(name: str) -> Column:
    return F.col(name).cast("boolean")


def _rows_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).cast("long")


def _rows() -> Column:
    return F.coalesce(F.sum("n"), F.lit(0)).cast("long")


def _mean_score() -> Column:
    return F.try_divide(F.sum(F.col("risk_score") * F.col("n")).cast("double"), F.sum("n"))


def _rate(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def _share(of: str) -> Column:
    return F.col(of) / F.sum(of).over(_all())


def _selected(cube: DataFrame, filters: Filters) -> DataFrame:
    return cube.filter(cube_predicate(filters))


def kpi(cube: DataFrame, filters: Filters = EVERYTHING, baseline: float = fixed.BASELINE_FRAUD_RATE) -> DataFrame:
    """Totals, rates, mean score, and how much fraud is concentrated in the high-risk queue."""
    sums = _selected(cube, filters).agg(
        _rows().alias("total_transaksi"),
        _rows_where(_flag("isFraud")).alias("total_fraud"),
        _rows_where(_flag("high_risk")).alias("total_high_risk"),
        _rows_where(F.col("risk_level") == fixed.CRITICAL_LABEL).alias("total_kritis"),
        F.coalesce(_mean_score(), F.lit(0.0)).alias("avg_risk_score"),
        _rows_where(_flag("high_risk") & _flag("isFraud")).alias("_high_risk_fraud"),
    )
    rated = sums.withColumns(
        {
            "fraud_rate": _rate("total_fraud", "total_transaksi"),
            "high_risk_rate": _rate("total_high_risk", "total_transaksi"),
            "high_risk_fraud_rate": F.try_divide(F.col("_high_risk_fraud"), F.col("total_high_risk")),
        }
    ).drop("_high_risk_fraud")
    concentrated = F.col("high_risk_fraud_rate")
    return rated.withColumn("fraud_enrichment", F.when(concentrated > 0, concentrated / F.lit(baseline)))


def breakdown(cube: DataFrame, dimension: str, filters: Filters = EVERYTHING, share: str = "share") -> DataFrame:
    """Rows, fraud, high risk, critical, mean score, share and rates per value of a dimension."""
    grouped = _selected(cube, filters).groupBy(dimension).agg(
        _rows().alias("transactions"),
        _rows_where(_flag("isFraud")).alias("fraud_count"),
        _mean_score().alias("avg_risk_score"),
        _rows_where(_flag("high_risk")).alias("high_risk_count"),
        _rows_where(F.col("risk_level") == fixed.CRITICAL_LABEL).alias("critical_count"),
    )
    return grouped.withColumns(
        {
            share: _share("transactions"),
            "fraud_rate": _rate("fraud_count", "transactions"),
            "high_risk_rate": _rate("high_risk_count", "transactions"),
        }
    )


def segment_summary(cube: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    return breakdown(cube, "cluster_kmeans", filters, "population_share").orderBy("cluster_kmeans")


def dimension_breakdown(cube: DataFrame, dimension: str, filters: Filters = EVERYTHING) -> DataFrame:
    """Receiver type or drain status, largest first."""
    return breakdown(cube, dimension, filters).drop("critical_count").orderBy(F.desc("transactions"), dimension)


def type_breakdown_cube(cube: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    kept = ("transaction_type", "transactions", "fraud_count", "share", "fraud_rate")
    return dimension_breakdown(cube, "transaction_type", filters).select(*kept)


def category_summary(cube: DataFrame, category: str, filters: Filters = EVERYTHING) -> DataFrame:
    """Rows and percent per category; no rows at all when the cube lacks the column."""
    if category not in cube.columns:
        return cube.sparkSession.createDataFrame([], f"{category} string, transactions long, percentage double")
    grouped = _selected(cube, filters).groupBy(category).agg(_rows().alias("transactions"))
    return grouped.withColumn("percentage", 100.0 * F.col("transactions") / F.sum("transactions").over(_all()))


def cluster_profile(cube: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    """Per segment: rates, merchant and drained shares, the most frequent type and its share."""
    by_type = _selected(cube, filters).groupBy("cluster_kmeans", "transaction_type").agg(
        F.sum("n").alias("n"),
        _rows_where(_flag("isFraud")).alias("fraud"),
        _rows_where(_flag("high_risk")).alias("high_risk"),
        _rows_where(F.col("jenis_tujuan") == fixed.DEST_MERCHANT).alias("to_merchant"),
        _rows_where(F.col("status_kuras") == fixed.DRAINED).alias("drained"),
    )
    # the largest count wins and, among equals, the first type name
    ranked = F.struct((-F.col("n")).alias("minus_n"), F.col("transaction_type").alias("name"))
    grouped = by_type.groupBy("cluster_kmeans").agg(
        _rows().alias("total"),
        *[F.sum(c).cast("long").alias(c) for c in ("fraud", "high_risk", "to_merchant", "drained")],
        F.min(ranked).alias("_top"),
    )
    return grouped.withColumns(
        {
            "fraud_rate": _rate("fraud", "total"),
            "high_risk_rate": _rate("high_risk", "total"),
            "merchant_share": _rate("to_merchant", "total"),
            "drained_share": _rate("drained", "total"),
            "dominant_type": F.col("_top.name"),
            "dominant_type_share": -F.col("_top.minus_n") / F.col("total"),
        }
    ).drop("_top").orderBy("cluster_kmeans")


def fraud_by_score_cube(cube: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    grouped = _selected(cube, filters).groupBy("risk_score").agg(
        _rows().alias("transactions"), _rows_where(_flag("isFraud")).alias("fraud_count")
    )
    return grouped.withColumn("fraud_rate", _rate("fraud_count", "transactions")).orderBy("risk_score")


def method_overlap_cube(cube: DataFrame, filters: Filters = EVERYTHING, methods: Sequence[str] = fixed.METHOD_FLAGS) -> DataFrame:
    wide = _selected(cube, filters).agg(
        *[_rows_where(_flag(a) & _flag(b)).alias(f"{a}__{b}") for a in methods for b in methods]
    )
    return unpivot(wide, "method", {a: {b: f"{a}__{b}" for b in methods} for a in methods})


def count_filtered(cube: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    return _selected(cube, filters).agg(_rows().alias("n"))


def filter_share(cube: DataFrame, filters: Filters) -> DataFrame:
    """Rows matching the filter, all rows, and the percentage, from one pass."""
    counted = cube.agg(_rows_where(cube_predicate(filters)).alias("matched"), _rows().alias("total"))
    return counted.withColumn("percentage", 100.0 * _rate("matched", "total"))

PROFILE_METRICS = ("population_share", "fraud_rate", "avg_risk_score", "high_risk_rate")


def segment_minmax_profile(cube: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    """Segment metrics scaled to 0..1 across segments; a constant metric becomes 0.5."""
    rows = segment_summary(cube, filters)

    def scaled(c: str) -> Column:
        low, high = F.min(c).over(_all()), F.max(c).over(_all())
        return F.when(high > low, (F.col(c) - low) / (high - low)).otherwise(0.5)

    return rows.select("cluster_kmeans", *[scaled(c).alias(c) for c in PROFILE_METRICS])


def segment_landscape(cube: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    """Position and marker size (18 to 73, by the root of the row count) per segment."""
    root = F.sqrt("transactions")
    low, high = F.min(root).over(_all()), F.max(root).over(_all())
    size = 18 + 55 * (root - low) / F.greatest(F.lit(1e-9), high - low)
    return segment_summary(cube, filters).select(
        "cluster_kmeans", "transactions", "avg_risk_score", size.alias("marker_size")
    )


def risk_funnel(cube: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    """All rows, the high-risk queue, and fraud inside that queue."""
    totals = kpi(cube, filters).select(
        F.col("total_transaksi").cast("double").alias("all"),
        F.col("total_high_risk").cast("double").alias("queue"),
        F.round(F.col("total_high_risk") * F.coalesce("high_risk_fraud_rate", F.lit(0.0))).alias("fraud"),
    )
    stages = dict(zip(fixed.FUNNEL_STAGES, ("all", "queue", "fraud")))
    return unpivot(totals, "stage", {stage: {"transactions": c} for stage, c in stages.items()})


def method_contribution(cube: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    """Rows flagged by each detector, under its display name."""
    wide = _selected(cube, filters).agg(*[_rows_where(_flag(m)).alias(m) for m in fixed.METHOD_FLAGS])
    return unpivot(wide, "method", {fixed.METHOD_LABELS[m]: {"flagged": m} for m in fixed.METHOD_FLAGS}).orderBy(
        "flagged", "method"
    )


def score_inversion(cube: DataFrame, filters: Filters = EVERYTHING, lower: int = 2, upper: int = 6) -> DataFrame:
    """Fraud rates at two scores side by side, and whether the lower score has the higher rate."""
    rates = fraud_by_score_cube(cube, filters).agg(
        F.max(F.when(F.col("risk_score") == lower, F.col("fraud_rate"))).alias("lower_rate"),
        F.max(F.when(F.col("risk_score") == upper, F.col("fraud_rate"))).alias("upper_rate"),
    )
    return rates.withColumns(
        {
            "both_present": F.col("lower_rate").isNotNull() & F.col("upper_rate").isNotNull(),
            "inverted": F.coalesce(F.col("lower_rate") > F.col("upper_rate"), F.lit(False)),
        }
    )


def segment_headline(cube: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    return segment_summary(cube, filters).agg(
        F.count("*").alias("segments"),
        F.max("population_share").alias("largest_share"),
        F.coalesce(F.sum("transactions"), F.lit(0)).cast("long").alias("total"),
    )

RECOMMENDATION_SCHEMA = (
    "position int, id string, priority string, category string, title string, "
    "related_segment int, related_anomaly_type string, related_rule_group string"
)


def recommendations(cube: DataFrame, rows: Sequence[tuple] = fixed.RECOMMENDATIONS) -> DataFrame:
    return cube.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(rows)], RECOMMENDATION_SCHEMA)


def _priority_rank(priority: Column) -> Column:
    place = F.array_position(F.array(*[F.lit(p) for p in fixed.PRIORITIES]), priority)
    return F.when(place > 0, place).otherwise(9)


def recommendation_relevance(cube: DataFrame, rules: DataFrame, filters: Filters = EVERYTHING, recs: DataFrame | None = None) -> DataFrame:
    """Each recommendation with the live count it refers to, in priority order.

    A related segment comes first, then a related anomaly type, then a related rule group.
    """
    recs = recommendations(cube) if recs is None else recs
    segments = segment_summary(cube, filters).select(
        F.col("cluster_kmeans").alias("related_segment"),
        F.col("transactions").alias("segment_rows"),
        F.col("high_risk_rate").alias("segment_high_risk_rate"),
    )
    types = category_summary(cube, "anomaly_type", filters).select(
        F.col("anomaly_type").alias("related_anomaly_type"),
        F.col("transactions").alias("type_rows"),
        F.col("percentage").alias("type_percentage"),
    )
    groups = rules.groupBy(F.col("rule_group").alias("related_rule_group")).agg(F.count("*").alias("group_rules"))
    joined = (
        recs.join(segments, "related_segment", "left").join(types, "related_anomaly_type", "left").join(groups, "related_rule_group", "left")
    )
    by_segment = F.col("related_segment").isNotNull()
    by_type = ~by_segment & F.col("related_anomaly_type").isNotNull()
    by_group = ~by_segment & ~by_type & F.col("related_rule_group").isNotNull()
    live = (
        F.when(by_segment, F.col("segment_rows"))
        .when(by_type, F.col("type_rows"))
        .when(by_group, F.coalesce("group_rules", F.lit(0)))
    )
    detail = F.when(by_segment, F.col("segment_high_risk_rate")).when(by_type, F.col("type_percentage"))
    kind = F.when(by_segment, "segment").when(by_type, "anomaly_type").when(by_group, "rule_group")
    return joined.select(
        "id", "priority", "category", "title", kind.alias("relation"), live.cast("long").alias("live_count"), detail.alias("live_detail"), "position"
    ).orderBy(_priority_rank(F.col("priority")), "position").drop("position")


def recommendation_map(recs: DataFrame) -> DataFrame:
    """Recommendations per category and priority, with their titles in list order."""
    grouped = recs.groupBy("category", "priority").agg(
        F.count("*").alias("recommendations"),
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("position", "title"))), lambda r: r["title"]), " | "
        ).alias("titles"),
    )
    return grouped.orderBy(_priority_rank(F.col("priority")), "category")


def serving_table_check(serving: DataFrame, cube: DataFrame, rules: DataFrame, projection: DataFrame | None = None) -> DataFrame:
    """One line per check on the served tables: columns, row totals, rows per segment and anomaly type."""
    needed = ("cluster_kmeans", "isFraud", "risk_score", "high_risk", "anomaly_type", "investigation_category", *fixed.METHOD_FLAGS)
    spark = cube.sparkSession
    static = spark.createDataFrame([("column", c, int(c in cube.columns), c in cube.columns) for c in needed], "kind string, item string, amount long, ok boolean")
    total = cube.agg(F.sum("n")).scalar()
    rows = serving.agg(F.count("*").alias("amount")).select(
        F.lit("total").alias("kind"), F.lit("rows").alias("item"), "amount", (F.col("amount") == total).alias("ok")
    )
    report = static.unionByName(rows)
    for dimension in ("cluster_kmeans", "anomaly_type"):
        if dimension in cube.columns:
            per_value = cube.groupBy(F.col(dimension).cast("string").alias("item")).agg(_rows().alias("amount"))
            report = report.unionByName(
                per_value.select(F.lit(dimension).alias("kind"), "item", "amount", (F.col("amount") > 0).alias("ok"))
            )
    for name, table in (("rules", rules), ("projection", projection)):
        if table is not None:
            counted = table.agg(F.count("*").alias("amount"))
            report = report.unionByName(
                counted.select(F.lit("table").alias("kind"), F.lit(name).alias("item"), "amount", (F.col("amount") > 0).alias("ok"))
            )
    return report
