"""The batch stages end to end: ledger, features, segments, rules, scores, serving tables.

Every stage reads the stored output of the one before, so a lost executor repeats tasks
of one stage only and multi-pass fits read pruned Parquet columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import cleaning, cluster_eval, isolation, risk, rule_views, rules, segments
from ledgerlens.operators import cube as cubes
from ledgerlens.plans.registry import MODEL_FEATURES
from ledgerlens.session import cut_lineage, tune
from ledgerlens.sources import ledger, writers

PAGE_ORDERS = (("risk_score", "desc"), ("amount", "desc"), ("amount", "asc"))
TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")


def engineer(raw: DataFrame) -> DataFrame:
    """Cleaned ledger rows with engineered columns; whole-row duplicates are dropped."""
    kept = cleaning.drop_nonpositive_amount(cleaning.dedup(raw, "transaction_id"))
    return cleaning.drop_columns(cleaning.ledger_features(kept), "isFlaggedFraud", "nameOrig", "nameDest")


def transform(engineered: DataFrame) -> tuple[DataFrame, dict[str, tuple[float, float]]]:
    """Model table (one-hot types, log and robust scaling) and the fitted scaler."""
    logged = cleaning.log1p_cols(cleaning.one_hot(engineered, "type", TYPES))
    params = cleaning.robust_scale_fit(logged)
    slim = cleaning.drop_columns(cleaning.scale(logged, params), "newbalanceOrig", "newbalanceDest")
    return cleaning.downcast(slim, dict.fromkeys(params, "float")), params


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    """The stored model table of the ledger; its fits pass over stored rows, too."""
    return cut_lineage(transform(cut_lineage(engineer(ledger.transactions(spark, folder))))[0])


def segment(model: DataFrame, keys: list[str], restarts: int = 10, threshold: float = 0.3, seed: int = 42) -> DataFrame:
    """All cluster labels and the structural outlier mark, beside the model columns."""
    labelled = segments.kmeans_segment(model, MODEL_FEATURES, restarts=restarts, seed=seed)
    typed = cleaning.inverse_one_hot(labelled, "type_", "_type")
    sampled = segments.density_cluster_sample_predict(typed, MODEL_FEATURES, "_type", keys, threshold=threshold, seed=seed).drop("_type")
    macro = segments.macro_cluster(cut_lineage(sampled), MODEL_FEATURES, threshold, seed=seed)
    dense = cut_lineage(segments.density_cluster_centres(cut_lineage(macro), MODEL_FEATURES, threshold))
    return cluster_eval.riskiest_cluster_flag(dense, "cluster_birch_hdbscan", name="is_birch_hdbscan_outlier")


def score(clustered: DataFrame, keys: list[str], trees: int = 100, seed: int = 42) -> DataFrame:
    flagged = isolation.isolation_forest_flag(clustered, keys, trees=trees, seed=seed)
    return risk.score_ledger(flagged)


def run(raw: DataFrame, output: str, key: str = "transaction_id", restarts: int = 10, trees: int = 100, threshold: float = 0.3) -> dict[str, DataFrame]:
    """Run all stages and store everything under ``output``; returns the serving tables."""
    spark = tune(raw.sparkSession)
    model, scaler = transform(writers.save_parquet(engineer(raw), f"{output}/engineered"))
    writers.save_scaler(spark, scaler, f"{output}/scaler")
    model = writers.save_parquet(model, f"{output}/model")
    clustered = writers.save_parquet(segment(model, [key], restarts, threshold), f"{output}/clustered")
    writers.split_export(clustered, f"{output}/segments")
    baskets = rules.collapse_baskets(rules.build_basket(clustered).select("items"))
    mined = rules.mine(baskets)
    meaningful = rules.meaningful_rules(mined)
    report = rules.report_rules(meaningful)
    fraud = rules.fraud_rules(baskets)
    top = rules.clean_top10(rules.select_top10(fraud, report), report)
    rule_files = {
        "frequent_itemsets": rules.frequent_itemsets(baskets, 0.005), "association_rules": mined, "meaningful_rules": meaningful,
        "report_worthy_rules": report, "fraud_focused_rules": fraud, "top_10_final_rules": top,
    }
    writers.save_summary_csvs(rule_files, f"{output}/rules")
    scored = writers.save_parquet(score(clustered, [key], trees), f"{output}/scored")
    summaries = {
        "risk_summary": risk.risk_summary(scored), "anomaly_type_summary": risk.anomaly_type_summary(scored),
        "investigation_summary": risk.investigation_summary(scored), "fraud_by_score": risk.fraud_by_score(scored),
        "method_overlap": risk.method_overlap(scored), "cluster_kmeans_risk_summary": risk.cluster_risk_summary(scored),
        "fraud_validation_metrics": risk.validation_metrics(scored),
        "high_risk_type_breakdown": risk.type_breakdown(scored.filter(F.col("high_risk") == 1), [f"type_{t}" for t in TYPES]),
    }
    writers.save_summary_csvs(summaries, f"{output}/summaries")
    writers.save_parquet(risk.top_anomalies(scored, key=key), f"{output}/suspicious")
    serving = cleaning.standardize_schema(scored)
    pool = rule_views.rule_present(rule_views.merge_rule_pools(top.select(*rule_views.RULE_COLUMNS), report.select(*rule_views.RULE_COLUMNS).unionByName(fraud.select(*rule_views.RULE_COLUMNS))))
    projection = segments.segment_projection_table(serving, [key])
    tables = writers.save_serving_tables(serving, cubes.build_cube(serving), pool, f"{output}/serving", projection)
    writers.save_page_maps(tables["transactions"], f"{output}/serving", PAGE_ORDERS)
    writers.run_manifest(spark, f"{output}/manifest", "batch", writers.table_counts(tables))
    return tables
