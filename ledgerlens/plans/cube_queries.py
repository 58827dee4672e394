"""Cube and analytic queries, without a filter and under a combined one."""

from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.operators import cube as cubes
from ledgerlens.operators import explorer
from ledgerlens.operators.filters import Filters
from ledgerlens.plans.registry import cube, query, rounded, rule_table, serving, serving_inputs
from ledgerlens.plans.sql_views import CUBE, RULE_TABLE, SERVING, quoted

COMBINED = Filters(jenis_tujuan=("Nasabah",), jenis_transaksi=("CASH_OUT", "TRANSFER"), segmen=(0, 1, 2), risk_score_min=1, risk_score_max=4)
COMBINED_SQL = "jenis_tujuan IN ('Nasabah') AND transaction_type IN ('CASH_OUT', 'TRANSFER') AND cluster_kmeans IN (0, 1, 2) AND risk_score BETWEEN 1 AND 4"
NOTHING = Filters(jenis_tujuan=("Merchant",), risk_score_min=6, risk_level=("Normal",))
NOTHING_SQL = "jenis_tujuan = 'Merchant' AND risk_score >= 6 AND risk_level = 'Normal'"


@query("build_cube", CUBE + "SELECT * FROM cube")
def build_cube(spark, folder):
    return cube(spark, folder)


@query("build_cube_recomputed", CUBE + "SELECT * REPLACE (risk_score >= 3 OR flag_HDBSCAN AS high_risk) FROM cube")
def build_cube_recomputed(spark, folder):
    return cubes.build_cube(serving(spark, folder), recompute_high_risk=True)


@query("filter_predicate_cube", CUBE + f"SELECT * FROM cube WHERE {COMBINED_SQL}")
def filter_predicate_cube(spark, folder):
    return explorer.filter_cube(cube(spark, folder), COMBINED)


_ROW_FILTER = Filters(**{**COMBINED.__dict__, "amount_min": 50_000, "amount_max": 400_000, "search": "amount anomaly"})


@query(
    "filter_predicate_rows",
    SERVING
    + f"SELECT transaction_id, amount, risk_score FROM serving WHERE {COMBINED_SQL} AND amount >= 50000 AND amount <= 4000000 "
    "AND (transaction_id ILIKE '%amount anomaly%' OR anomaly_reason ILIKE '%amount anomaly%')",
)


def filter_predicate_rows(spark, folder):
    wanted = Filters(**{**_ROW_FILTER.__dict__, "amount_max": 4_000_000})
    return explorer.filter_rows(serving(spark, folder), wanted).select("transaction_id", "amount", "risk_score")


def _kpi_sql(where: str) -> str:
    return CUBE + f""", s AS (SELECT coalesce(sum(n), 0)::BIGINT AS t, coalesce(sum(n) FILTER (WHERE isFraud), 0)::BIGINT AS fr,
 coalesce(sum(n) FILTER (WHERE high_risk), 0)::BIGINT AS hr, coalesce(sum(n) FILTER (WHERE risk_level = 'Kritis'), 0)::BIGINT AS kr,
 sum(risk_score * n)::DOUBLE / sum(n) AS avg_score, coalesce(sum(n) FILTER (WHERE high_risk AND isFraud), 0)::BIGINT AS hf FROM cube WHERE {where})
SELECT t AS total_transaksi, fr AS total_fraud, hr AS total_high_risk, kr AS total_kritis, round(coalesce(avg_score, 0), 8) AS avg_risk_score,
 CASE WHEN t > 0 THEN round(fr / t, 8) ELSE 0.0::DOUBLE END AS fraud_rate, CASE WHEN t > 0 THEN round(hr / t, 8) ELSE 0.0::DOUBLE END AS high_risk_rate,
 CASE WHEN hr > 0 THEN round(hf / hr, 8) END AS high_risk_fraud_rate, CASE WHEN hr > 0 AND hf > 0 THEN round(hf / hr / 0.0012883, 6) END AS fraud_enrichment FROM s"""


def _kpi(table, filters):
    return rounded(rounded(cubes.kpi(table, filters), 8, "avg_risk_score", "fraud_rate", "high_risk_rate", "high_risk_fraud_rate"), 6, "fraud_enrichment")


@query("kpi", _kpi_sql("true"))
def kpi(spark, folder):
    return _kpi(cube(spark, folder), Filters())


@query("kpi_filtered", _kpi_sql(COMBINED_SQL))
def kpi_filtered(spark, folder):
    return _kpi(cube(spark, folder), COMBINED)


@query("kpi_empty_filter_result", _kpi_sql(NOTHING_SQL))
def kpi_empty_filter_result(spark, folder):
    return _kpi(cube(spark, folder), NOTHING)


_SEGMENTS = """SELECT cluster_kmeans, sum(n)::BIGINT AS transactions, coalesce(sum(n) FILTER (WHERE isFraud), 0)::BIGINT AS fraud_count,
 sum(risk_score * n)::DOUBLE / sum(n) AS avg_risk_score, coalesce(sum(n) FILTER (WHERE high_risk), 0)::BIGINT AS high_risk_count,
 coalesce(sum(n) FILTER (WHERE risk_level = 'Kritis'), 0)::BIGINT AS critical_count, sum(n) / sum(sum(n)) OVER () AS population_share,
 coalesce(sum(n) FILTER (WHERE isFraud), 0) / sum(n) AS fraud_rate, coalesce(sum(n) FILTER (WHERE high_risk), 0) / sum(n) AS high_risk_rate
 FROM cube WHERE {where} GROUP BY cluster_kmeans"""
_ROUND_SEGMENTS = "SELECT * REPLACE (round(avg_risk_score, 8) AS avg_risk_score, round(population_share, 8) AS population_share, round(fraud_rate, 8) AS fraud_rate, round(high_risk_rate, 8) AS high_risk_rate) FROM segments"


def _segments(where: str = "true") -> str:
    return CUBE + f", segments AS ({_SEGMENTS.format(where=where)}) "


@query("segment_summary", _segments() + _ROUND_SEGMENTS)
def segment_summary(spark, folder):
    return rounded(cubes.segment_summary(cube(spark, folder)), 8, "avg_risk_score", "population_share", "fraud_rate", "high_risk_rate")


@query("segment_summary_filtered", _segments(COMBINED_SQL) + _ROUND_SEGMENTS)
def segment_summary_filtered(spark, folder):
    return rounded(cubes.segment_summary(cube(spark, folder), COMBINED), 8, "avg_risk_score", "population_share", "fraud_rate", "high_risk_rate")


def _category_sql(column: str, where: str) -> str:
    return CUBE + f"SELECT {column}, sum(n)::BIGINT AS transactions, round(100.0::DOUBLE * sum(n) / sum(sum(n)) OVER (), 8) AS percentage FROM cube WHERE {where} GROUP BY {column}"


def _register_category(name: str, column: str) -> None:
    @query(name, _category_sql(column, COMBINED_SQL))
    def summary(spark, folder):
        return rounded(cubes.category_summary(cube(spark, folder), column, COMBINED), 8, "percentage")


for _name, _column in (("category_summary_risk_level", "risk_level"), ("category_summary_anomaly_type", "anomaly_type"), ("category_summary_investigation", "investigation_category")):
    _register_category(_name, _column)


@query(
    "category_summary",
    CUBE
    + " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, {c} AS label, sum(n)::BIGINT AS transactions, round(100.0::DOUBLE * sum(n) / sum(sum(n)) OVER (), 8) AS percentage FROM cube GROUP BY {c}"
        for c in ("risk_level", "anomaly_type", "investigation_category")
    ),
)


def category_summary(spark, folder):
    table = cube(spark, folder)
    parts = [
        cubes.category_summary(table, c).select(F.lit(c).alias("dimension"), F.col(c).alias("label"), "transactions", "percentage")
        for c in ("risk_level", "anomaly_type", "investigation_category")
    ]
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), 8, "percentage")


_PROFILE = CUBE + """, p AS (SELECT cluster_kmeans, sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (WHERE isFraud), 0)::BIGINT AS fraud,
 coalesce(sum(n) FILTER (WHERE high_risk), 0)::BIGINT AS high_risk, coalesce(sum(n) FILTER (WHERE jenis_tujuan = 'Merchant'), 0)::BIGINT AS to_merchant,
 coalesce(sum(n) FILTER (WHERE status_kuras = 'Terkuras Habis'), 0)::BIGINT AS drained FROM cube GROUP BY 1),
d AS (SELECT cluster_kmeans, transaction_type, sum(n) AS n FROM cube GROUP BY cluster_kmeans, transaction_type QUALIFY row_number() OVER (PARTITION BY cluster_kmeans ORDER BY sum(n) DESC, transaction_type) = 1)
SELECT p.*, round(fraud / total, 8) AS fraud_rate, round(high_risk / total, 8) AS high_risk_rate, round(to_merchant / total, 8) AS merchant_share,
 round(drained / total, 8) AS drained_share, transaction_type AS dominant_type, round(n / total, 8) AS dominant_type_share FROM p JOIN d USING (cluster_kmeans)"""


@query("cluster_profile", _PROFILE)
def cluster_profile(spark, folder):
    return rounded(cubes.cluster_profile(cube(spark, folder)), 8, "fraud_rate", "high_risk_rate", "merchant_share", "drained_share", "dominant_type_share")


@query(
    "fraud_by_score_cube",
    CUBE + "SELECT risk_score, sum(n)::BIGINT AS transactions, coalesce(sum(n) FILTER (WHERE isFraud), 0)::BIGINT AS fraud_count, "
    "round(coalesce(sum(n) FILTER (WHERE isFraud), 0) / sum(n), 8) AS fraud_rate FROM cube GROUP BY 1",
)


def fraud_by_score_cube(spark, folder):
    return rounded(cubes.fraud_by_score_cube(cube(spark, folder)), 8, "fraud_rate")


@query(
    "method_overlap_cube",
    CUBE
    + " UNION ALL ".join(
        f"SELECT '{a}' AS method, " + ", ".join(f"coalesce(sum(n) FILTER (WHERE {a} AND {b}), 0)::BIGINT AS {b}" for b in fixed.METHOD_FLAGS) + " FROM cube" for a in fixed.METHOD_FLAGS
    ),
)


def method_overlap_cube(spark, folder):
    return cubes.method_overlap_cube(cube(spark, folder))


def _breakdown_sql(dimension: str) -> str:
    return CUBE + f"""SELECT {dimension}, sum(n)::BIGINT AS transactions, coalesce(sum(n) FILTER (WHERE isFraud), 0)::BIGINT AS fraud_count,
 round(sum(risk_score * n)::DOUBLE / sum(n), 8) AS avg_risk_score, coalesce(sum(n) FILTER (WHERE high_risk), 0)::BIGINT AS high_risk_count,
 round(sum(n) / sum(sum(n)) OVER (), 8) AS share, round(coalesce(sum(n) FILTER (WHERE isFraud), 0) / sum(n), 8) AS fraud_rate,
 round(coalesce(sum(n) FILTER (WHERE high_risk), 0) / sum(n), 8) AS high_risk_rate FROM cube GROUP BY 1"""


@query("dest_type_breakdown", _breakdown_sql("jenis_tujuan"))
def dest_type_breakdown(spark, folder):
    return rounded(cubes.dimension_breakdown(cube(spark, folder), "jenis_tujuan"), 8, "avg_risk_score", "share", "fraud_rate", "high_risk_rate")


@query("drain_status_breakdown", _breakdown_sql("status_kuras"))
def drain_status_breakdown(spark, folder):
    return rounded(cubes.dimension_breakdown(cube(spark, folder), "status_kuras"), 8, "avg_risk_score", "share", "fraud_rate", "high_risk_rate")


@query("type_breakdown_cube", f"SELECT transaction_type, transactions, fraud_count, share, fraud_rate FROM ({_breakdown_sql('transaction_type')})")
def type_breakdown_cube(spark, folder):
    return rounded(cubes.type_breakdown_cube(cube(spark, folder)), 8, "share", "fraud_rate")


@query("count_filtered", CUBE + f"SELECT coalesce(sum(n), 0)::BIGINT AS n FROM cube WHERE {COMBINED_SQL}")
def count_filtered(spark, folder):
    return cubes.count_filtered(cube(spark, folder), COMBINED)


@query(
    "filter_share",
    CUBE + f"SELECT m AS matched, t AS total, round(100.0::DOUBLE * m / t, 8) AS percentage FROM (SELECT coalesce(sum(n) FILTER (WHERE {COMBINED_SQL}), 0)::BIGINT AS m, sum(n)::BIGINT AS t FROM cube)",
)


def filter_share(spark, folder):
    return rounded(cubes.filter_share(cube(spark, folder), COMBINED), 8, "percentage")


@query(
    "segment_minmax_profile",
    _segments()
    + "SELECT cluster_kmeans, "
    + ", ".join(
        f"CASE WHEN max({c}) OVER () > min({c}) OVER () THEN round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) ELSE 0.5 END AS {c}"
        for c in cubes.PROFILE_METRICS
    )
    + " FROM segments",
)


def segment_minmax_profile(spark, folder):
    return rounded(cubes.segment_minmax_profile(cube(spark, folder)), 6, *cubes.PROFILE_METRICS)


@query(
    "segment_landscape",
    _segments()
    + "SELECT cluster_kmeans, transactions, round(avg_risk_score, 8) AS avg_risk_score, round(18 + 55 * (sqrt(transactions) - min(sqrt(transactions)) OVER ()) "
    "/ greatest(1e-9, max(sqrt(transactions)) OVER () - min(sqrt(transactions)) OVER ()), 6) AS marker_size FROM segments",
)


def segment_landscape(spark, folder):
    return rounded(rounded(cubes.segment_landscape(cube(spark, folder)), 8, "avg_risk_score"), 6, "marker_size")


@query(
    "risk_funnel",
    CUBE
    + " UNION ALL ".join(
        f"SELECT {quoted(stage)} AS stage, coalesce(sum(n) FILTER (WHERE {where}), 0)::DOUBLE AS transactions FROM cube"
        for stage, where in zip(fixed.FUNNEL_STAGES, ("true", "high_risk", "high_risk AND isFraud"))
    ),
)


def risk_funnel(spark, folder):
    return cubes.risk_funnel(cube(spark, folder))


@query(
    "method_contribution",
    CUBE + " UNION ALL ".join(f"SELECT {quoted(fixed.METHOD_LABELS[m])} AS method, coalesce(sum(n) FILTER (WHERE {m}), 0)::BIGINT AS flagged FROM cube" for m in fixed.METHOD_FLAGS),
)


def method_contribution(spark, folder):
    return cubes.method_contribution(cube(spark, folder))


@query(
    "score_inversion",
    CUBE + ", r AS (SELECT (sum(n) FILTER (WHERE isFraud AND risk_score = 2)) AS f2, sum(n) FILTER (WHERE risk_score = 2) AS n2, "
    "(sum(n) FILTER (WHERE isFraud AND risk_score = 6)) AS f6, sum(n) FILTER (WHERE risk_score = 6) AS n6 FROM cube), "
    "s AS (SELECT CASE WHEN n2 > 0 THEN coalesce(f2, 0) / n2 END AS a, CASE WHEN n6 > 0 THEN coalesce(f6, 0) / n6 END AS b FROM r) "
    "SELECT round(a, 8) AS lower_rate, round(b, 8) AS upper_rate, a IS NOT NULL AND b IS NOT NULL AS both_present, coalesce(a > b, false) AS inverted FROM s",
)


def score_inversion(spark, folder):
    return rounded(cubes.score_inversion(cube(spark, folder)), 8, "lower_rate", "upper_rate")


_RECS = ", ".join(
    "(" + ", ".join(str(v) if isinstance(v, int) else "NULL" if v is None else quoted(v) for v in (i, *r)) + ")" for i, r in enumerate(fixed.RECOMMENDATIONS)
)
_RELEVANCE = f""", cube AS (SELECT {", ".join(fixed.CUBE_COLUMNS)}, count(*) AS n FROM serving GROUP BY ALL),
recs(position, id, priority, category, title, seg, typ, grp) AS (VALUES {_RECS}),
seg AS (SELECT cluster_kmeans, sum(n)::BIGINT AS rows, coalesce(sum(n) FILTER (WHERE high_risk), 0) / sum(n) AS rate FROM cube GROUP BY 1),
typ AS (SELECT anomaly_type, sum(n)::BIGINT AS rows, 100.0::DOUBLE * sum(n) / sum(sum(n)) OVER () AS pct FROM cube GROUP BY 1),
grp AS (SELECT rule_group, count(*) AS rows FROM rule_table GROUP BY 1),
live AS (SELECT position, id, priority, category, title,
 CASE WHEN recs.seg IS NOT NULL THEN 'segment' WHEN recs.typ IS NOT NULL THEN 'anomaly_type' WHEN recs.grp IS NOT NULL THEN 'rule_group' END AS relation,
 CASE WHEN recs.seg IS NOT NULL THEN seg.rows WHEN recs.typ IS NOT NULL THEN typ.rows WHEN recs.grp IS NOT NULL THEN coalesce(grp.rows, 0) END AS live_count,
 CASE WHEN recs.seg IS NOT NULL THEN seg.rate WHEN recs.typ IS NOT NULL THEN typ.pct END AS live_detail
 FROM recs LEFT JOIN seg ON seg.cluster_kmeans = recs.seg LEFT JOIN typ ON typ.anomaly_type = recs.typ LEFT JOIN grp ON grp.rule_group = recs.grp) """
# both the serving view and the rule table start from the same ledger view
_SERVING_AND_RULES = RULE_TABLE + SERVING[SERVING.index(", fit AS ("):]


@query(
    "recommendation_relevance",
    _SERVING_AND_RULES + _RELEVANCE + "SELECT id, priority, category, title, relation, live_count, round(live_detail, 8) AS live_detail FROM live",
)


def recommendation_relevance(spark, folder):
    return rounded(cubes.recommendation_relevance(cube(spark, folder), rule_table(spark, folder)), 8, "live_detail")


@query(
    "recommendation_map",
    _SERVING_AND_RULES + _RELEVANCE + "SELECT category, priority, count(*) AS recommendations, string_agg(title, ' | ' ORDER BY position) AS titles, sum(live_count)::BIGINT AS live_rows FROM live GROUP BY 1, 2",
)


def recommendation_map(spark, folder):
    table = cube(spark, folder)
    counts = cubes.recommendation_map(cubes.recommendations(table))
    live = cubes.recommendation_relevance(table, rule_table(spark, folder)).groupBy("category", "priority").agg(F.sum("live_count").alias("live_rows"))
    return counts.join(live, ["category", "priority"])


@query("segment_headline", _segments() + "SELECT count(*) AS segments, round(max(population_share), 8) AS largest_share, sum(transactions)::BIGINT AS total FROM segments")
def segment_headline(spark, folder):
    return rounded(cubes.segment_headline(cube(spark, folder)), 8, "largest_share")


_CHECK_COLUMNS = ("cluster_kmeans", "isFraud", "risk_score", "high_risk", "anomaly_type", "investigation_category", *fixed.METHOD_FLAGS)


@query(
    "serving_table_check",
    _SERVING_AND_RULES
    + f", cube AS (SELECT {', '.join(fixed.CUBE_COLUMNS)}, count(*) AS n FROM serving GROUP BY ALL) "
    + " UNION ALL ".join(f"SELECT 'column' AS kind, '{c}' AS item, 1::BIGINT AS amount, true AS ok" for c in _CHECK_COLUMNS)
    + " UNION ALL SELECT 'total', 'rows', count(*), count(*) = (SELECT sum(n) FROM cube) FROM serving "
    "UNION ALL SELECT 'cluster_kmeans', CAST(cluster_kmeans AS VARCHAR), sum(n)::BIGINT, sum(n) > 0 FROM cube GROUP BY 2 "
    "UNION ALL SELECT 'anomaly_type', anomaly_type, sum(n)::BIGINT, sum(n) > 0 FROM cube GROUP BY 2 "
    "UNION ALL SELECT 'table', 'rules', count(*), count(*) > 0 FROM rule_table",
)


def serving_table_check(spark, folder):
    return cubes.serving_table_check(*serving_inputs(spark, folder))
