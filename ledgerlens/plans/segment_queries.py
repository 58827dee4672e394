"""Segmentation, cluster evaluation and projection queries."""

from functools import reduce

from pyspark.sql import functions as F

from ledgerlens.operators import cluster_eval, segments
from ledgerlens.operators import microclusters as micro
from ledgerlens.operators.cleaning import inverse_one_hot
from ledgerlens.operators.filters import Filters
from ledgerlens.plans.registry import MODEL_FEATURES, query, rounded, serving
from ledgerlens.plans.sql_views import SCORED_IN
from ledgerlens.plans.stages import prepared
from ledgerlens.session import cut_lineage
from ledgerlens.sources.ledger import scoring_input, table

_VECTORS = """WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(v) AS m, count(*) AS n FROM e GROUP BY 1, 2),
d AS (SELECT e.vec_id, e.label, c.label AS centre, sum((v - m) * (v - m)) AS sq FROM e JOIN c USING (i) GROUP BY 1, 2, 3),
own AS (SELECT vec_id, label, min(sq) FILTER (WHERE label = centre) AS a2, min(sq) FILTER (WHERE label <> centre) AS b2 FROM d GROUP BY 1, 2) """


@query("kmeans_segment")
def kmeans_segment(spark, folder):
    rows = prepared(spark, folder)
    return segments.kmeans_segment(rows, MODEL_FEATURES).select("transaction_id", "cluster_kmeans")


@query(
    "nearest_centroid_assign",
    _VECTORS + "SELECT vec_id, (dense_rank() OVER (ORDER BY centre) - 1)::INT AS cluster FROM (SELECT vec_id, centre, sq FROM d) "
    "QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY sq, centre) = 1",
)


def nearest_centroid_assign(spark, folder):
    rows = table(spark, folder, "embeddings")
    centres = cluster_eval.nearest_centroid_centres(rows, "embedding", "label")
    return segments.nearest_centroid_assign(rows, "embedding", centres).select("vec_id", "cluster")


@query(
    "nearest_centroid_assign_columns",
    SCORED_IN + ", c AS (SELECT type AS t, avg(amount) AS a, avg(oldbalanceOrg) AS b, row_number() OVER (ORDER BY type) - 1 AS k FROM scored_in GROUP BY type) "
    "SELECT transaction_id, k::INT AS cluster FROM scored_in, c QUALIFY row_number() OVER (PARTITION BY transaction_id "
    "ORDER BY (amount - a) * (amount - a) + (oldbalanceOrg - b) * (oldbalanceOrg - b), k) = 1",
)


def nearest_centroid_assign_columns(spark, folder):
    rows = scoring_input(spark, folder)
    features = ["amount", "oldbalanceOrg"]
    centres = cluster_eval.nearest_centroid_centres(rows, features, "type")
    return segments.nearest_centroid_assign(rows, features, centres).select("transaction_id", "cluster")


CELL_FEATURES = ("amount", "oldbalanceOrg", "destError")


def _logged(spark, folder):
    return scoring_input(spark, folder).select("transaction_id", "type", *[F.log1p(c).alias(c) for c in CELL_FEATURES])


_LOGGED = SCORED_IN + ", logged AS (SELECT " + ", ".join(f"ln(1 + {c}) AS {c}" for c in CELL_FEATURES) + " FROM scored_in)"


def _cell(threshold: float) -> str:
    return "concat_ws(',', " + ", ".join(f"CAST(floor({c} / (2 * {threshold} / sqrt(3))) AS BIGINT)" for c in CELL_FEATURES) + ")"


@query(
    "microcluster_grid",
    _LOGGED + f" SELECT {_cell(0.3)} AS cell, count(*) AS n, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in CELL_FEATURES)
    + ", round(sqrt(greatest(0, " + " + ".join(f"greatest(0, sum({c} * {c}) / count(*) - (sum({c}) / count(*)) * (sum({c}) / count(*)))" for c in CELL_FEATURES) + ")), 4) AS radius FROM logged GROUP BY 1",
)


def microcluster_grid(spark, folder):
    cells = segments.microcluster_grid(_logged(spark, folder), CELL_FEATURES)
    return rounded(rounded(cells, 6, *CELL_FEATURES), 4, "radius")


@query("microclusters")
def microclusters(spark, folder):
    """All micro-clusters of the model table; their order of merging is beyond SQL, see ``microcluster_totals``."""
    measured = MODEL_FEATURES[:6]
    return rounded(segments.microclusters(prepared(spark, folder), MODEL_FEATURES), 6, *measured, "radius")


@query(
    "microcluster_totals",
    _LOGGED.replace("logged AS (SELECT ", "logged AS (SELECT type, ") + " SELECT type, count(*) AS n, " + ", ".join(f"round(avg({c}), 5) AS {c}" for c in CELL_FEATURES)
    + ", round(sum(q) / 1000, 3) AS spread, true AS within_threshold FROM (SELECT *, "
    + " + ".join(f"pow({c} - avg({c}) OVER (PARTITION BY type), 2)" for c in CELL_FEATURES) + " AS q FROM logged) GROUP BY 1",
)


def microcluster_totals(spark, folder):
    """What merging must keep: rows, means and squares per exact feature add up again, and no radius exceeds the threshold."""
    found = micro.build(_logged(spark, folder), [*CELL_FEATURES, "type"], 0.3, exact=["type"])
    parts = found.table().join(found.summaries.select("id", "scatter"), "id")
    means = parts.groupBy("type").agg(*[(F.sum(F.col("n") * F.col(c)) / F.sum("n")).alias(f"m_{c}") for c in CELL_FEATURES])
    between = reduce(lambda a, b: a + b, [F.col("n") * F.pow(F.col(c) - F.col(f"m_{c}"), F.lit(2.0)) for c in CELL_FEATURES])
    totals = parts.join(means, "type").groupBy("type").agg(
        F.sum("n").alias("n"), *[F.first(f"m_{c}").alias(c) for c in CELL_FEATURES],
        (F.sum(F.col("scatter") + between) / 1000).alias("spread"), (F.max("radius") <= 0.3).alias("within_threshold"),
    )
    return rounded(rounded(totals, 5, *CELL_FEATURES), 3, "spread")


@query(
    "microcluster_threshold_sweep",
    _LOGGED + " UNION ALL ".join(f" SELECT {t}::DOUBLE AS threshold, count(DISTINCT {_cell(t)}) AS subclusters FROM logged" for t in (0.3, 0.4, 0.5, 0.6)),
)


def microcluster_threshold_sweep(spark, folder):
    from ledgerlens.operators.sampling import systematic_every_k

    return segments.microcluster_threshold_sweep(systematic_every_k(_logged(spark, folder), ["transaction_id"], 1_000_000), CELL_FEATURES)


@query("macro_cluster")
def macro_cluster(spark, folder):
    rows = prepared(spark, folder)
    return segments.macro_cluster(rows, MODEL_FEATURES).select("transaction_id", "cluster_birch")


@query("density_cluster_centres")
def density_cluster_centres(spark, folder):
    found = segments.density_cluster_centres(prepared(spark, folder), MODEL_FEATURES)
    return found.select("transaction_id", "cluster_birch_hdbscan")


@query("density_cluster_sample_predict")
def density_cluster_sample_predict(spark, folder):
    rows = inverse_one_hot(prepared(spark, folder), "type_", "type")
    found = segments.density_cluster_sample_predict(rows, MODEL_FEATURES, "type", ["transaction_id"])
    return found.select("transaction_id", "cluster_hdbscan")


@query(
    "riskiest_cluster_flag",
    SCORED_IN + "SELECT transaction_id, (cluster_kmeans = (SELECT cluster_kmeans FROM scored_in GROUP BY 1 ORDER BY avg(isFraud) DESC, cluster_kmeans LIMIT 1))::INT AS is_riskiest FROM scored_in",
)


def riskiest_cluster_flag(spark, folder):
    return cluster_eval.riskiest_cluster_flag(scoring_input(spark, folder), "cluster_kmeans").select("transaction_id", "is_riskiest")


_MANY = (
    _LOGGED.replace("logged AS (SELECT ", "logged AS (SELECT transaction_id, ") + f", labelled AS (SELECT transaction_id, {_cell(0.3)} AS label, " + ", ".join(CELL_FEATURES) + " FROM logged), "
    "middle AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS id, count(*) AS n, " + ", ".join(f"avg({f}) AS m_{f}" for f in CELL_FEATURES) + " FROM labelled GROUP BY label), "
    "apart AS (SELECT transaction_id, labelled.label, middle.label AS centre, id, " + " + ".join(f"({f} - m_{f}) * ({f} - m_{f})" for f in CELL_FEATURES) + " AS sq FROM labelled, middle)"
)


def _celled(spark, folder):
    """The ledger with a label per occupied grid cell: thousands of clusters."""
    label = segments.grid_cell(CELL_FEATURES, segments.cell_width(0.3, len(CELL_FEATURES)))
    return _logged(spark, folder).withColumn("label", label)


@query("nearest_centroid_assign_many", _MANY + " SELECT transaction_id, arg_min(id, (sq, id)) AS cluster FROM apart GROUP BY 1")
def nearest_centroid_assign_many(spark, folder):
    rows = _celled(spark, folder)
    centres = cluster_eval.centroid_table(rows, CELL_FEATURES, "label")
    return segments.nearest_centroid_assign(rows, CELL_FEATURES, centres).select("transaction_id", "cluster")


@query(
    "cluster_quality_many",
    _MANY + ", owned AS (SELECT transaction_id, label, min(sq) FILTER (WHERE label = centre) AS a2, min(sq) FILTER (WHERE label <> centre) AS b2 FROM apart GROUP BY 1, 2), "
    "spread_of AS (SELECT label, avg(sqrt(a2)) AS s FROM owned GROUP BY 1), measured AS (SELECT * FROM middle JOIN spread_of USING (label)), "
    "worst_of AS (SELECT x.label, max((x.s + y.s) / sqrt(" + " + ".join(f"(x.m_{f} - y.m_{f}) * (x.m_{f} - y.m_{f})" for f in CELL_FEATURES) + ")) AS worst FROM measured x JOIN measured y ON x.label <> y.label GROUP BY 1), "
    "grand AS (SELECT " + ", ".join(f"avg({f}) AS g_{f}" for f in CELL_FEATURES) + " FROM labelled), "
    "totals AS (SELECT (SELECT sum(middle.n * (" + " + ".join(f"(m_{f} - g_{f}) * (m_{f} - g_{f})" for f in CELL_FEATURES) + ")) FROM middle, grand) AS between_ss, "
    "(SELECT sum(a2) FROM owned) AS within_ss, (SELECT count(*) FROM middle) AS k, (SELECT count(*) FROM labelled) AS n) "
    "SELECT k AS clusters, round(within_ss, 4) AS wcss, round((SELECT avg((sqrt(b2) - sqrt(a2)) / greatest(sqrt(a2), sqrt(b2))) FROM owned), 8) AS silhouette, "
    "round((SELECT avg(worst) FROM worst_of), 6) AS davies_bouldin, round((between_ss / (k - 1)) / (within_ss / (n - k)), 3) AS calinski_harabasz FROM totals",
)


def cluster_quality_many(spark, folder):
    rows = cut_lineage(_celled(spark, folder))
    q = cluster_eval.many_cluster_quality(rows, CELL_FEATURES, "label")
    clusters = rows.select("label").distinct().count()
    values = (clusters, round(q["wcss"], 4), round(q["silhouette"], 8), round(q["davies_bouldin"], 6), round(q["calinski_harabasz"], 3))
    return spark.createDataFrame([values], "clusters long, wcss double, silhouette double, davies_bouldin double, calinski_harabasz double")


PROFILED = ("step", "amount", "oldbalanceOrg", "oldbalanceDest", "origError", "destError", "isDestMerchant", "origDrainedToZero", "isFraud")


@query(
    "cluster_profile_means",
    SCORED_IN + "SELECT cluster_kmeans, " + ", ".join(f"round(avg({c}), 4) AS {c}" for c in PROFILED) + " FROM scored_in GROUP BY 1",
)


def cluster_profile_means(spark, folder):
    return rounded(cluster_eval.cluster_profile_means(scoring_input(spark, folder), "cluster_kmeans", PROFILED), 4, *PROFILED)


@query(
    "cluster_summary",
    SCORED_IN + "SELECT cluster_kmeans, count(*) AS total, round(avg(isFraud) * 100, 2) AS fraud_rate_pct, sum(isFraud)::BIGINT AS fraud_count, "
    "round(avg(amount), 2) AS mean_amount, round(avg(step), 2) AS mean_step FROM scored_in GROUP BY 1",
)


def cluster_summary(spark, folder):
    return cluster_eval.cluster_summary(scoring_input(spark, folder), "cluster_kmeans", columns=["amount", "step"])


@query(
    "cluster_sizes",
    _LOGGED + f", s AS (SELECT count(*) AS n FROM logged GROUP BY {_cell(0.3)}) SELECT count(*) AS clusters, max(n) AS largest, min(n) AS smallest, round(avg(n), 6) AS mean, "
    "round(stddev_samp(n), 6) AS std, quantile_cont(n, 0.25)::DOUBLE AS q1, quantile_cont(n, 0.5)::DOUBLE AS median, quantile_cont(n, 0.75)::DOUBLE AS q3 FROM s",
)


def cluster_sizes(spark, folder):
    rows = _logged(spark, folder)
    celled = rows.withColumn("cell", segments.grid_cell(CELL_FEATURES, segments.cell_width(0.3, 3)))
    return rounded(cluster_eval.cluster_sizes(celled, "cell", noise="-1"), 6, "mean", "std")


@query("k_sweep")
def k_sweep(spark, folder):
    return segments.k_sweep(prepared(spark, folder), MODEL_FEATURES)


@query("approx_silhouette", _VECTORS + "SELECT round(avg((sqrt(b2) - sqrt(a2)) / greatest(sqrt(a2), sqrt(b2))), 8) AS silhouette FROM own")
def approx_silhouette(spark, folder):
    return rounded(cluster_eval.quality_index(table(spark, folder, "embeddings"), "embedding", "label", "silhouette"), 8, "silhouette")


@query(
    "davies_bouldin",
    _VECTORS + ", s AS (SELECT label, avg(sqrt(a2)) AS s FROM own GROUP BY 1), "
    "m AS (SELECT x.label AS i, y.label AS j, sqrt(sum((x.m - y.m) * (x.m - y.m))) AS dist FROM c x JOIN c y ON x.i = y.i AND x.label <> y.label GROUP BY 1, 2), "
    "r AS (SELECT m.i, max((p.s + q.s) / dist) AS worst FROM m JOIN s p ON p.label = m.i JOIN s q ON q.label = m.j GROUP BY 1) "
    "SELECT round(avg(worst), 6) AS davies_bouldin FROM r",
)


def davies_bouldin(spark, folder):
    return rounded(cluster_eval.quality_index(table(spark, folder, "embeddings"), "embedding", "label", "davies_bouldin"), 6, "davies_bouldin")


@query(
    "calinski_harabasz",
    _VECTORS + ", g AS (SELECT i, avg(v) AS g FROM e GROUP BY 1), k AS (SELECT count(DISTINCT label) AS k, count(DISTINCT vec_id) AS n FROM e), "
    "b AS (SELECT sum(c.n * (m - g) * (m - g)) AS between_ss FROM c JOIN g USING (i)), w AS (SELECT sum(a2) AS within_ss FROM own) "
    "SELECT round((between_ss / (k - 1)) / (within_ss / (n - k)), 6) AS calinski_harabasz FROM b, w, k",
)


def calinski_harabasz(spark, folder):
    return rounded(cluster_eval.quality_index(table(spark, folder, "embeddings"), "embedding", "label", "calinski_harabasz"), 6, "calinski_harabasz")


@query("pca_project")
def pca_project(spark, folder):
    rows = prepared(spark, folder)
    projected = segments.pca_project(rows, MODEL_FEATURES, segments.fit_pca(rows, MODEL_FEATURES))
    return rounded(projected.select("transaction_id", "pc1", "pc2"), 6, "pc1", "pc2")


@query("pca_explained_variance")
def pca_explained_variance(spark, folder):
    fit = segments.fit_pca(table(spark, folder, "embeddings"), "embedding", 2)
    return spark.createDataFrame([(i + 1, r) for i, r in enumerate(fit.ratios)], "component int, ratio double")


def _projection(spark, folder):
    return segments.segment_projection_table(serving(spark, folder), ["transaction_id"])


@query("segment_projection_table")
def segment_projection_table(spark, folder):
    return _projection(spark, folder)


@query("query_projection")
def query_projection(spark, folder):
    return segments.query_projection(_projection(spark, folder), Filters(jenis_tujuan=("Nasabah",), segmen=(0, 1, 2)), "PCA", 3)


@query(
    "cluster_minor_flag",
    "SELECT label, count(*) AS rows, count(*) < 0.01 * (SELECT count(*) FROM embeddings) AS is_minor FROM embeddings GROUP BY 1",
)


def cluster_minor_flag(spark, folder):
    return cluster_eval.cluster_minor_flag(table(spark, folder, "embeddings"), "label")
