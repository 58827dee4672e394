"""Reading and writing: every sink is read back, so its content can be compared."""

from pyspark.sql import functions as F

from ledgerlens.operators import cleaning, risk, rules
from ledgerlens.plans.registry import collapsed, query, rounded, scored, serving_inputs
from ledgerlens.plans.cube_queries import _SERVING_AND_RULES
from ledgerlens.plans.cleaning_queries import _LOGGED, SCALED
from ledgerlens.plans.rule_queries import _SHOWN_SQL, shown
from ledgerlens.plans.sql_views import RULES, SCORED, SCORED_IN, TX
from ledgerlens.functions import fixed_values as fixed
from ledgerlens.session import scratch_path
from ledgerlens.sources import readers, writers
from ledgerlens.sources.keyed_table import KeyedTable
from ledgerlens.sources.ledger import scoring_input, table, transactions


@query("load_ledger_csv", TX + "SELECT * EXCLUDE (transaction_id) FROM tx")
def load_ledger_csv(spark, folder):
    path = scratch_path(spark, "ledger-csv")
    transactions(spark, folder).drop("transaction_id").write.option("header", True).csv(path)
    return readers.load_ledger_csv(spark, path)


@query("load_parquet", "SELECT * FROM lineitem")
def load_parquet(spark, folder):
    return readers.load_parquet(spark, f"{folder}/lineitem.parquet")


@query("save_parquet", SCORED + "SELECT transaction_id, type, amount, risk_score, risk_level, anomaly_type FROM scored")
def save_parquet(spark, folder):
    rows = scored(spark, folder).select("transaction_id", "type", "amount", "risk_score", "risk_level", "anomaly_type")
    return writers.save_parquet(rows, scratch_path(spark, "scored"))


@query("save_summary_csvs", SCORED + "SELECT risk_level, count(*) AS transactions, round(count(*) / (SELECT count(*) FROM scored), 8) AS percentage FROM scored GROUP BY 1")
def save_summary_csvs(spark, folder):
    rows = scored(spark, folder)
    paths = writers.save_summary_csvs({"risk_summary": risk.risk_summary(rows), "fraud_by_score": risk.fraud_by_score(rows)}, scratch_path(spark, "summaries"))
    stored = spark.read.schema("risk_level string, transactions long, percentage double").option("header", True).csv(paths["risk_summary"])
    return rounded(stored, 8, "percentage")


def _split(spark, folder):
    return writers.split_export(scoring_input(spark, folder), scratch_path(spark, "split"))


@query("split_export", SCORED_IN + "SELECT * FROM scored_in WHERE is_birch_hdbscan_outlier = 1")
def split_export(spark, folder):
    return _split(spark, folder)[0]


@query("split_export_means", SCORED_IN + "SELECT cluster_kmeans, round(avg(amount), 4) AS amount, round(avg(isFraud), 8) AS isFraud FROM scored_in GROUP BY 1")
def split_export_means(spark, folder):
    means = _split(spark, folder)[1].select("cluster_kmeans", "amount", "isFraud")
    return rounded(rounded(means, 4, "amount"), 8, "isFraud")


@query("first_existing_source", "SELECT o_orderkey, o_totalprice FROM orders")
def first_existing_source(spark, folder):
    path = readers.first_existing_source(spark, [f"{folder}/absent.parquet", f"{folder}/orders.parquet"], f"{folder}/customer.parquet")
    return readers.load_parquet(spark, path).select("o_orderkey", "o_totalprice")


@query("multi_csv_rule_pool", RULES + f"SELECT {_SHOWN_SQL} FROM report UNION ALL SELECT {_SHOWN_SQL} FROM fraud")
def multi_csv_rule_pool(spark, folder):
    counted = collapsed(spark, folder)
    report = rules.report_rules(rules.meaningful_rules(rules.mine(counted)))
    path = scratch_path(spark, "rule-files")
    writers.save_summary_csvs({"report_worthy_rules": report, "fraud_focused_rules": rules.fraud_rules(counted)}, path)
    return shown(readers.multi_csv_rule_pool(spark, path)[1])


_CUBE_CTE = f", cube AS (SELECT {', '.join(fixed.CUBE_COLUMNS)}, count(*) AS n FROM serving GROUP BY ALL)"
_COUNTS = _SERVING_AND_RULES + _CUBE_CTE


def _serve(spark, folder):
    return writers.save_serving_tables(*serving_inputs(spark, folder), scratch_path(spark, "serving"))


@query(
    "save_serving_tables",
    _COUNTS + "SELECT 'transactions' AS table_name, count(*) AS row_count FROM serving UNION ALL SELECT 'cube', count(*) FROM cube UNION ALL SELECT 'rules', count(*) FROM rule_table",
)


def save_serving_tables(spark, folder):
    counts = writers.table_counts(_serve(spark, folder))
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count long")


@query("keyed_overwrite_sink", "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def keyed_overwrite_sink(spark, folder):
    return writers.keyed_overwrite_sink(table(spark, folder, "events"), scratch_path(spark, "keyed"), "user_id", version="event_id")


def _upserted(spark, folder):
    """The later half of the events first, then the earlier half, then the later half once more."""
    events = table(spark, folder, "events")
    middle = events.agg(F.avg("event_id")).first()[0]
    target = KeyedTable(spark, scratch_path(spark, "upsert"), "user_id", "event_id")
    later, earlier = events.filter(F.col("event_id") >= middle), events.filter(F.col("event_id") < middle)
    return target, [target.upsert(batch) for batch in (later, earlier, later)]


@query("keyed_upsert", "SELECT * FROM events WHERE user_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def keyed_upsert(spark, folder):
    return _upserted(spark, folder)[0].read()


@query(
    "keyed_upsert_counts",
    "WITH h AS (SELECT user_id, event_id >= (SELECT avg(event_id) FROM events) AS late FROM events), "
    "u AS (SELECT user_id, bool_or(late) AS late, bool_or(NOT late) AS early FROM h WHERE user_id IS NOT NULL GROUP BY 1), "
    "r AS (SELECT late, count(*) AS received, count(*) - count(user_id) AS failed FROM h GROUP BY 1) "
    "SELECT 1 AS batch, received, failed, (SELECT count(*) FROM u WHERE late) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS unchanged FROM r WHERE late UNION ALL "
    "SELECT 2, received, failed, (SELECT count(*) FROM u WHERE NOT late), 0, (SELECT count(*) FROM u WHERE late AND early) FROM r WHERE NOT late UNION ALL "
    "SELECT 3, received, failed, 0, 0, (SELECT count(*) FROM u WHERE late) FROM r WHERE late",
)


def keyed_upsert_counts(spark, folder):
    counts = [(i, c.received, c.failed, c.inserted, c.updated, c.unchanged) for i, c in enumerate(_upserted(spark, folder)[1], 1)]
    return spark.createDataFrame(counts, "batch int, received long, failed long, inserted long, updated long, unchanged long")


@query(
    "run_manifest",
    _COUNTS + "SELECT 'batch' AS mode, (SELECT count(*) FROM serving) AS transactions, (SELECT count(*) FROM cube) AS cube, (SELECT count(*) FROM rule_table) AS rules",
)


def run_manifest(spark, folder):
    counts = writers.table_counts(_serve(spark, folder))
    return writers.run_manifest(spark, scratch_path(spark, "manifest"), "batch", counts).drop("created_at")


@query(
    "fit_params_store",
    _LOGGED + " UNION ALL ".join(
        f" SELECT '{c}' AS column_name, round(quantile_cont({c}, 0.5), 8) AS center, round(CASE WHEN quantile_cont({c}, 0.75) > quantile_cont({c}, 0.25) "
        f"THEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) ELSE 1 END, 8) AS scale FROM logged" for c in SCALED
    ),
)


def fit_params_store(spark, folder):
    logged = cleaning.log1p_cols(scoring_input(spark, folder)).select("transaction_id", *SCALED)
    path = scratch_path(spark, "scaler")
    writers.save_scaler(spark, cleaning.robust_scale_fit(logged), path)
    stored = readers.load_parquet(spark, path)
    return rounded(stored, 8, "center", "scale")
