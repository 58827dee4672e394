"""Latency of the ten investigation scenarios and duration of the batch stages.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores,
``BENCH_ITERATIONS`` how often a scenario is repeated (medians are reported).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import cube as cubes
from ledgerlens.operators import isolation, quality, risk, rule_views, rules, segments
from ledgerlens.operators.cleaning import standardize_schema
from ledgerlens.plans.investigation import NO_FILTER, SCENARIO_FILTERS, Investigation
from ledgerlens.plans.registry import FLAGS
from ledgerlens.session import cut_lineage, scratch_path, tune
from ledgerlens.sources import ledger, writers

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ITERATIONS = int(os.environ.get("BENCH_ITERATIONS", "25"))
STAGE_ITERATIONS = 3


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ledgerlens-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def timed(action, times: int) -> list[float]:
    durations = []
    for _ in range(times):
        start = time.perf_counter()
        action()
        durations.append(time.perf_counter() - start)
    return durations


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stages(spark, rows, baskets, keyed) -> dict:
    scored = risk.score_ledger(rows)
    lineitem = ledger.table(spark, FOLDER, "lineitem")
    return {
        "stage_profile": lambda: quality.describe_numeric(lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).collect(),
        "stage_duplicates": lambda: run(quality.duplicate_on_subset(lineitem, ["l_orderkey", "l_linenumber"])),
        "stage_correlation": lambda: quality.correlation_matrix(lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]).collect(),
        "stage_score": lambda: run(risk.score_ledger(rows)),
        "stage_isolation_forest": lambda: run(isolation.isolation_forest_flag(keyed, ["transaction_id"])),
        "stage_cube": lambda: cubes.build_cube(standardize_schema(scored)).collect(),
        "stage_baskets": lambda: rules.collapse_baskets(rules.build_basket(rows).select("items")),
        "stage_rules": lambda: rules.mine(baskets).collect(),
        "stage_microclusters": lambda: run(segments.microclusters(rows.select(F.log1p("amount").alias("amount"), F.log1p("oldbalanceOrg").alias("oldbalanceOrg")), ["amount", "oldbalanceOrg"])),
        "stage_top_20000": lambda: run(risk.top_anomalies(scored)),
    }


def scenarios(desk: Investigation) -> dict:
    merchant, combined, risky, text = (SCENARIO_FILTERS[k] for k in ("merchant", "combined", "risky", "text"))

    def page(filters):
        found, _ = desk.search_transactions(filters)
        found.collect()

    return {
        "kpi": lambda: desk.get_kpi(NO_FILTER).collect(),
        "kpi_dest_type": lambda: desk.get_kpi(merchant).collect(),
        "kpi_combined": lambda: desk.get_kpi(combined).collect(),
        "segment_summary": lambda: desk.get_segment_summary().collect(),
        "dest_type_breakdown": lambda: desk.get_dest_type_breakdown().collect(),
        "drain_status_breakdown": lambda: desk.get_drain_status_breakdown().collect(),
        "method_overlap": lambda: desk.get_method_overlap().collect(),
        "search_page_1": lambda: page(NO_FILTER),
        "search_combined": lambda: page(risky),
        "search_text": lambda: page(text),
    }


def main() -> None:
    spark = session()
    rows = cut_lineage(ledger.scoring_input(spark, FOLDER))
    baskets = rules.collapse_baskets(rules.build_basket(rows).select("items"))
    keyed = rows.select("transaction_id", "amount", "origError", "destError")
    serving = standardize_schema(risk.score_ledger(rows)).withColumns({c: F.col(c).cast("boolean") for c in FLAGS})
    pool = rule_views.rule_present(rule_views.merge_rule_pools(rule_views.pinned_rules(spark), rules.mine(baskets)))
    tables = writers.save_serving_tables(serving, cubes.build_cube(serving), pool, scratch_path(spark, "serving"))
    desk = Investigation(tables)
    queries, spread = {}, {}
    for group, times in ((scenarios(desk), ITERATIONS), (stages(spark, rows, baskets, keyed), STAGE_ITERATIONS)):
        for name, action in group.items():
            action()  # first use plans and compiles
            durations = timed(action, times)
            queries[name] = round(statistics.median(durations), 4)
            spread[name] = [round(min(durations), 4), round(max(durations), 4)]
    print(
        json.dumps(
            {
                "metric": "sum of median seconds, ten investigation scenarios and batch stages",
                "value": round(sum(queries.values()), 4),
                "unit": "sec",
                "queries": queries,
                "min_max": spread,
                "sf": os.path.basename(FOLDER.rstrip("/")),
                "cpus": CPUS,
                "ledger_rows": rows.count(),
                "cube_rows": desk.cube.count(),
                "rules": desk.rules.count(),
            }
        )
    )


if __name__ == "__main__":
    sys.exit(main())
