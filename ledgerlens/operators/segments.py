"""Segmentation: k-means, micro-clusters, density clusters over them, projections."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.functions.centre_search import CentreIndex
from ledgerlens.functions.distance import Features, nearest, vector
from ledgerlens.operators import density, kmeans, sampling
from ledgerlens.operators import microclusters as micro
from ledgerlens.operators.cleaning import model_input, scale, standard_scale_fit
from ledgerlens.operators.cluster_eval import cluster_quality
from ledgerlens.operators.filters import Filters, all_of
from ledgerlens.session import cut_lineage


@dataclass(frozen=True)
class KMeansFit:
    """Centres in lexicographic order, so that labels do not depend on the run, and the cost."""

    features: Features
    centres: list[list[float]]
    cost: float


def fit_many_kmeans(
    df: DataFrame, features: Features, ks: Sequence[int], restarts: int = 10, seed: int = 42, max_iter: int = 100, weight: str | None = None
) -> dict[int, KMeansFit]:
    """Best of several k-means runs for each number of clusters, all of them in the same passes over all rows."""
    rows = df.select(vector(features).alias("point"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"))
    runs = [kmeans.Run(k, s) for k in ks for s in range(seed, seed + restarts)]
    fits = kmeans.fit_runs(rows, runs, max_iter)
    best = {k: min(fit for fit, run in zip(fits, runs) if run.k == k) for k in ks}
    return {k: KMeansFit(features, centres, cost) for k, (cost, centres) in best.items()}


def fit_kmeans(
    df: DataFrame, features: Features, k: int = 5, restarts: int = 10, seed: int = 42, max_iter: int = 100,
    weight: str | None = None,
) -> KMeansFit:
    """Best of several k-means runs, each over all rows at every size."""
    return fit_many_kmeans(df, features, [k], restarts, seed, max_iter, weight)[k]


def nearest_centroid_assign(
    df: DataFrame, features: Features, centres: Sequence[Sequence[float]] | DataFrame, name: str = "cluster"
) -> DataFrame:
    """The number of the nearest centre, the lowest among equals.

    Centres given as a table (id, point) may be of any number; rows with a null or non-finite
    feature then stay without a centre.
    """
    if not isinstance(centres, DataFrame):
        return df.withColumn(name, nearest(features, centres)["id"])
    stored = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    points = stored.select(F.col("_row").alias("row"), F.lit(-1).alias("own"), F.lit(0.0).alias("weight"), vector(features).alias("point"))
    found = CentreIndex.build(centres.select("id", "point", F.lit(0.0).alias("weight"))).search(points)
    chosen = found.select(F.col("row").alias("_row"), F.col("id").alias(name))
    return stored.join(chosen, "_row", "left").drop("_row")


def kmeans_segment(df: DataFrame, features: Features, k: int = 5, restarts: int = 10, seed: int = 42, name: str = "cluster_kmeans") -> DataFrame:
    return nearest_centroid_assign(df, features, fit_kmeans(df, features, k, restarts, seed).centres, name)


def k_sweep(df: DataFrame, features: Features, ks: Sequence[int] = range(2, 8), restarts: int = 10, seed: int = 42) -> DataFrame:
    """Within-cluster squares and the three quality indices for each number of clusters."""
    rows = []
    for k, fit in fit_many_kmeans(df, features, ks, restarts, seed).items():
        labelled = nearest_centroid_assign(df, features, fit.centres, "_cluster")
        q = cluster_quality(labelled, features, "_cluster")
        rows.append((k, fit.cost, q["silhouette"], q["davies_bouldin"], q["calinski_harabasz"]))
    return df.sparkSession.createDataFrame(rows, "k int, wcss double, silhouette double, davies_bouldin double, calinski_harabasz double")


# --- micro-clusters ----------------------------------------------------------------


def cell_width(threshold: float, dimensions: int) -> float:
    """Grid width whose cells have no point farther than ``threshold`` from their middle."""
    return 2 * threshold / math.sqrt(dimensions)


def grid_cell(features: Sequence[str], width: float) -> Column:
    """The grid cell of a row: one whole number per feature, joined by commas."""
    return F.concat_ws(",", *[F.floor(F.col(f).cast("double") / F.lit(width)).cast("string") for f in features])


def microcluster_grid(df: DataFrame, features: Sequence[str], threshold: float = 0.3) -> DataFrame:
    """Rows, centre and radius of every occupied grid cell, before anything is merged; one shuffle of partial sums."""
    width = cell_width(threshold, len(features))
    grouped = df.groupBy(grid_cell(features, width).alias("cell")).agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(f).cast("double")).alias(f"s_{f}") for f in features],
        *[F.sum(F.col(f).cast("double") * F.col(f).cast("double")).alias(f"ss_{f}") for f in features],
    )
    n = F.col("n")
    variances = [F.greatest(F.lit(0.0), F.col(f"ss_{f}") / n - (F.col(f"s_{f}") / n) * (F.col(f"s_{f}") / n)) for f in features]
    total = variances[0]
    for v in variances[1:]:
        total = total + v
    return grouped.select("cell", "n", *[(F.col(f"s_{f}") / n).alias(f) for f in features], F.sqrt(total).alias("radius"))


def microclusters(df: DataFrame, features: Sequence[str], threshold: float = 0.3, exact: Sequence[str] | None = None) -> DataFrame:
    """id, rows, centre and radius of summaries of all rows, merged as far as the radius stays within the threshold."""
    return micro.build(df, features, threshold, exact).table()


def microcluster_threshold_sweep(df: DataFrame, features: Sequence[str], thresholds: Sequence[float] = (0.3, 0.4, 0.5, 0.6)) -> DataFrame:
    """Occupied cells per threshold. Each threshold is one pre-aggregated distinct count."""
    rows = []
    for t in thresholds:
        cells = df.select(grid_cell(features, cell_width(t, len(features))).alias("cell")).distinct().count()
        rows.append((float(t), cells))
    return df.sparkSession.createDataFrame(rows, "threshold double, subclusters long")


def macro_cluster(df: DataFrame, features: Sequence[str], threshold: float = 0.3, k: int = 5, weighted: bool = False, seed: int = 42, name: str = "cluster_birch") -> DataFrame:
    """k-means over micro-cluster centres, mapped back to the rows of each micro-cluster."""
    found = micro.build(df, features, threshold)
    points = cut_lineage(found.points())
    fit = fit_kmeans(points, "point", k, 1, seed, weight="n" if weighted else None)
    return found.label(df, nearest_centroid_assign(points, "point", fit.centres, "label"), name)


def density_cluster_centres(
    df: DataFrame, features: Sequence[str], threshold: float = 0.3, min_cluster_size: int = 30, min_samples: int = 10,
    reach: float | None = None, name: str = "cluster_birch_hdbscan",
) -> DataFrame:
    """Density clusters of the micro-clusters of all rows, mapped back to the rows.

    A cluster has at least ``min_cluster_size`` micro-clusters; ``min_samples`` counts rows.
    Without ``reach``, it is twice the threshold, or what nine tenths of the micro-clusters
    need to be core points if that is more.
    """
    found = micro.build(df, features, threshold)
    labels, _ = density.clusters_of(found, reach, min_cluster_size, min_samples)
    return found.label(df, labels, name)


def density_cluster_sample_predict(
    df: DataFrame, features: Sequence[str], stratum: str, keys: Sequence[str], sample_size: int = 300_000,
    threshold: float = 0.3, min_cluster_size: int = 3_000, min_samples: int = 20, seed: int = 42,
    reach: float | None = None, name: str = "cluster_hdbscan",
) -> DataFrame:
    """Fit density clusters of at least ``min_cluster_size`` sampled rows on a proportional sample and label every row.

    A row takes the label of the nearest clustered core point (a micro-cluster of the
    sample) within reach; rows without one are noise.
    """
    sample = sampling.stratified_proportional(df, stratum, keys, sample_size, seed)
    found = micro.build(sample, features, threshold)
    labels, reach = density.clusters_of(found, reach, min_cluster_size, min_samples, size_in_rows=True)
    core = cut_lineage(found.points().join(labels.filter(F.col("label") >= 0).select("id", "label"), "id"))
    return density.nearest_labels(df, found.space, core, reach, name)


# --- linear projection -------------------------------------------------------------


@dataclass(frozen=True)
class PcaFit:
    mean_model: object
    pca_model: object
    ratios: list[float]


def fit_pca(df: DataFrame, features: Features, k: int = 2) -> PcaFit:
    """Principal components of centred data (the library's own projection does not centre)."""
    points = df.select(array_to_vector(vector(features)).alias("raw"))
    mean_model = StandardScaler(inputCol="raw", outputCol="centred", withMean=True, withStd=False).fit(points)
    pca_model = PCA(k=k, inputCol="centred", outputCol="projected").fit(mean_model.transform(points))
    return PcaFit(mean_model, pca_model, [float(r) for r in pca_model.explainedVariance.toArray()])


def pca_project(df: DataFrame, features: Features, fit: PcaFit, prefix: str = "pc") -> DataFrame:
    raw = df.withColumn("raw", array_to_vector(vector(features)))
    projected = fit.pca_model.transform(fit.mean_model.transform(raw))
    coordinates = vector_to_array(F.col("projected"))
    names = {f"{prefix}{i + 1}": F.get(coordinates, F.lit(i)) for i in range(len(fit.ratios))}
    return projected.withColumns(names).drop("raw", "centred", "projected")


def segment_projection_table(df: DataFrame, keys: Sequence[str], per_segment: int = 5_000, seed: int = 42, dims: Sequence[int] = (2, 3)) -> DataFrame:
    """Sampled points per segment in two and three principal dimensions, in long form."""
    sample = cut_lineage(sampling.stratified_fixed(df, "cluster_kmeans", keys, per_segment, seed))
    features = model_input(sample, fixed.NON_FEATURE_COLUMNS).columns
    filled = sample.withColumns({f: F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})
    scaled = scale(filled, standard_scale_fit(filled, features))
    kept = [c for c in ("jenis_tujuan", "risk_level") if c in sample.columns]
    variants = []
    # Components come by falling variance, so fewer dimensions are the first of more.
    points = pca_project(scaled, features, fit_pca(scaled, features, max(dims)))
    for dim in dims:
        z = F.col("pc3") if dim >= 3 else F.lit(0.0)
        variants.append(
            points.select(
                F.lit("pca").alias("method"), F.lit(dim).alias("dim"),
                F.col("pc1").cast("float").alias("proj_x"), F.col("pc2").cast("float").alias("proj_y"), z.cast("float").alias("proj_z"),
                F.col("cluster_kmeans").cast("short").alias("cluster_kmeans"), F.col("isFraud").cast("boolean").alias("isFraud"), *kept,
            )
        )
    table = variants[0]
    for part in variants[1:]:
        table = table.unionByName(part)
    return table


def query_projection(projection: DataFrame, filters: Filters = Filters(), method: str | None = None, dim: int | None = None, max_points: int = 3_000, seed: int = 42) -> DataFrame:
    """Points of one variant under receiver-type and segment filters, thinned to a plottable number."""
    have = projection.columns
    conditions = []
    if method and "method" in have:
        conditions.append(F.col("method") == method.lower())
    if dim and "dim" in have:
        conditions.append(F.col("dim") == int(dim))
    if filters.jenis_tujuan and "jenis_tujuan" in have:
        conditions.append(F.col("jenis_tujuan").isin(list(filters.jenis_tujuan)))
    if filters.segmen:
        conditions.append(F.col("cluster_kmeans").isin([int(s) for s in filters.segmen]))
    points = sampling.bernoulli_percent(projection.filter(all_of(conditions)), max_points, seed)
    shown = ["proj_x", "proj_y", *(["proj_z"] if "proj_z" in have and dim != 2 else []), "cluster_kmeans", "isFraud"]
    return points.select(*shown)
