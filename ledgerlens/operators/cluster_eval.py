"""Sizes, profiles and quality indices of a given cluster assignment."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.centre_search import RATIO, CentreIndex, usable
from ledgerlens.functions.distance import Features, own_and_other, vector
from ledgerlens.functions.ordering import with_global_index
from ledgerlens.functions.quantiles import numeric_profile
from ledgerlens.functions.skew import join_by_key
from ledgerlens.operators.quality import count_where, numeric_columns
from ledgerlens.session import cut_lineage

MAX_CLUSTERS = 1_000


@dataclass(frozen=True)
class Centroids:
    """Cluster labels in rising order with their sizes and mean points."""

    labels: list[int]
    sizes: list[int]
    points: list[list[float]]

    def position(self, label: str):
        """0-based position of a row's label, as a column."""
        place = F.array_position(F.array(*[F.lit(v) for v in self.labels]), F.col(label)) - 1
        return place.cast("int")


def width_of(df: DataFrame, features: Features) -> int:
    if isinstance(features, str):
        return df.select(F.size(features).alias("d")).first()["d"]
    return len(features)


def centroids(df: DataFrame, features: Features, label: str) -> Centroids:
    """Mean point per label; labels name clusters, so there are few."""
    if isinstance(features, str):
        dims = [F.get(F.col(features), F.lit(i)).cast("double") for i in range(width_of(df, features))]
    else:
        dims = [F.col(f).cast("double") for f in features]
    grouped = df.groupBy(label).agg(F.count("*").alias("n"), *[F.avg(d).alias(f"m{i}") for i, d in enumerate(dims)])
    rows = grouped.limit(MAX_CLUSTERS + 1).collect()
    if len(rows) > MAX_CLUSTERS:
        raise ValueError(f"{label} has more than {MAX_CLUSTERS} clusters")
    rows.sort(key=lambda r: r[label])
    return Centroids([r[label] for r in rows], [r["n"] for r in rows], [[r[f"m{i}"] for i in range(len(dims))] for r in rows])


def nearest_centroid_centres(df: DataFrame, features: Features, label: str) -> list[list[float]]:
    return centroids(df, features, label).points


def _spread(df: DataFrame, features: Features, label: str, found: Centroids) -> list:
    """Per cluster: rows, sums of distance, squared distance and silhouette terms, from one pass."""
    measured = df.select(F.col(label), own_and_other(features, found.points, found.position(label)).alias("d"))
    own, other = F.sqrt("d.own"), F.sqrt("d.other")
    silhouette = F.try_divide(other - own, F.greatest(own, other))
    return measured.groupBy(label).agg(
        F.count("*").alias("n"),
        F.sum(own).alias("distance"),
        F.sum("d.own").alias("squared"),
        F.sum(silhouette).alias("silhouette"),
    ).collect()


def _variance_ratio(between: float, within: float, k: int, n: int) -> float | None:
    """Calinski-Harabasz; undefined for one cluster and where every row is a cluster."""
    if k < 2 or n == k:
        return None
    return (between / (k - 1)) / (within / (n - k)) if within else float("inf")


def cluster_quality(df: DataFrame, features: Features, label: str) -> dict[str, float]:
    """Approximate silhouette, Davies-Bouldin and Calinski-Harabasz, plus within-cluster squares.

    Two passes over the rows; what follows is arithmetic on one line per cluster. More than
    ``MAX_CLUSTERS`` clusters are left to ``many_cluster_quality``.
    """
    if df.select(label).distinct().limit(MAX_CLUSTERS + 1).count() > MAX_CLUSTERS:
        return many_cluster_quality(df, features, label)
    found = centroids(df, features, label)
    spread = {r[label]: r for r in _spread(df, features, label, found)}
    k, n = len(found.labels), sum(found.sizes)
    mean_distance = [spread[v]["distance"] / spread[v]["n"] for v in found.labels]
    worst = []
    for i, a in enumerate(found.points):
        apart = [(j, math.dist(a, b)) for j, b in enumerate(found.points) if j != i]
        ratios = [(mean_distance[i] + mean_distance[j]) / distance for j, distance in apart if distance]
        worst.append(max(ratios, default=0.0))
    grand = [sum(p[d] * s for p, s in zip(found.points, found.sizes)) / n for d in range(len(found.points[0]))]
    between = sum(s * math.dist(p, grand) ** 2 for p, s in zip(found.points, found.sizes))
    within = sum(r["squared"] for r in spread.values())
    return {
        "wcss": within,
        "silhouette": sum(r["silhouette"] or 0.0 for r in spread.values()) / n,
        "davies_bouldin": sum(worst) / k if k > 1 else None,
        "calinski_harabasz": _variance_ratio(between, within, k, n),
    }


def centroid_table(df: DataFrame, features: Features, label: str) -> DataFrame:
    """label, n, point and a consecutive id in the order of the labels, for any number of labels."""
    width = width_of(df, features)
    points = df.select(label, vector(features).alias("_point"))
    means = points.groupBy(label).agg(F.count("*").alias("n"), *[F.avg(F.get("_point", F.lit(i))).alias(f"_m{i}") for i in range(width)])
    table = means.select(label, "n", F.array(*[f"_m{i}" for i in range(width)]).alias("point"))
    return cut_lineage(with_global_index(table, label, name="id"))


def _squared(a: str, b: str) -> Column:
    apart = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(apart, F.lit(0.0), lambda total, v: total + v)


def many_cluster_quality(df: DataFrame, features: Features, label: str) -> dict[str, float]:
    """The indices of ``cluster_quality`` for any number of clusters; the driver sees sums only.

    Rows find the nearest other centre, and centres their worst partner, by a search that
    opens only the centre cells that bounds leave open. Rows without a label, or with a null or
    non-finite feature, take no part.
    """
    rows = df.select(F.col(label).alias("label"), vector(features).alias("point")).filter(F.col("label").isNotNull() & usable("point"))
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    clusters = centroid_table(rows, "point", "label")
    named = clusters.select("label", "n", F.col("id").alias("own"), F.col("point").alias("centre"))
    owned = join_by_key(rows, named, ["label"], "n", "inner").select("row", "own", _squared("point", "centre").alias("weight"), "point")
    unweighted = clusters.select("id", "point", F.lit(0.0).alias("weight"))
    nearest_other = CentreIndex.build(unweighted).search(owned)
    own, other = F.sqrt("weight"), F.sqrt("value")
    spread = cut_lineage(nearest_other.groupBy(F.col("own").alias("id")).agg(
        F.sum(own).alias("distance"), F.sum("weight").alias("squared"),
        F.sum(F.coalesce(F.try_divide(other - own, F.greatest(own, other)), F.lit(0.0))).alias("silhouette"),
    ))
    weighted = cut_lineage(clusters.join(spread, "id").withColumn("weight", F.col("distance") / F.col("n")))
    worst = CentreIndex.build(weighted).search(weighted.select(F.col("id").alias("row"), F.col("id").alias("own"), "weight", "point"), RATIO)
    width = width_of(weighted, "point")
    grand = weighted.agg(*[F.sum(F.get("point", F.lit(i)) * F.col("n")) / F.sum("n") for i in range(width)]).first()
    total = weighted.withColumn("grand", F.array(*[F.lit(float(v)) for v in grand])).agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("squared").alias("within"), F.sum("silhouette").alias("silhouette"),
        F.sum(F.col("n") * _squared("point", "grand")).alias("between"),
    ).first()
    k, n = total["k"], total["n"]
    return {
        "wcss": total["within"],
        "silhouette": total["silhouette"] / n,
        "davies_bouldin": worst.agg(F.avg(F.coalesce("value", F.lit(0.0)))).first()[0] if k > 1 else None,
        "calinski_harabasz": _variance_ratio(total["between"], total["within"], k, n),
    }


def quality_index(df: DataFrame, features: Features, label: str, index: str) -> DataFrame:
    value = cluster_quality(df, features, label)[index]
    return df.sparkSession.createDataFrame([(None if value is None else float(value),)], f"{index} double")


def cluster_profile_means(df: DataFrame, by: str, columns: Sequence[str] | None = None) -> DataFrame:
    columns = columns or numeric_columns(df, exclude=[by])
    return df.groupBy(by).agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])


def cluster_summary(df: DataFrame, by: str, label: str = "isFraud", columns: Sequence[str] | None = None) -> DataFrame:
    """Size, label rate in percent, label count and rounded column means per cluster."""
    columns = columns or numeric_columns(df, exclude=[by, label])
    return df.groupBy(by).agg(
        F.count("*").alias("total"),
        F.round(F.avg(label) * 100, 2).alias("fraud_rate_pct"),
        F.sum(label).cast("long").alias("fraud_count"),
        *[F.round(F.avg(c), 2).alias(f"mean_{c}") for c in columns],
    ).orderBy(by)


def cluster_sizes(df: DataFrame, by: str, noise: int = -1) -> DataFrame:
    """Number of clusters without noise, extremes and distribution of the cluster sizes."""
    sizes = df.groupBy(by).agg(F.count("*").alias("rows"))
    proper = sizes.agg(
        count_where(F.col(by) != noise).alias("clusters"),
        F.max("rows").alias("largest"),
        F.min(F.when(F.col(by) != noise, F.col("rows"))).alias("smallest"),
    ).first()
    p = numeric_profile(sizes, ["rows"])["rows"]
    row = (proper["clusters"], proper["largest"], proper["smallest"], p.mean, p.stddev, *[p.quantiles[q] for q in (0.25, 0.5, 0.75)])
    return df.sparkSession.createDataFrame(
        [row], "clusters long, largest long, smallest long, mean double, std double, q1 double, median double, q3 double"
    )


def riskiest_cluster(df: DataFrame, by: str, label: str = "isFraud"):
    """The cluster with the highest label rate (lowest id among equals), with its rate and rows."""
    rates = df.groupBy(by).agg(F.avg(label).alias("rate"), F.count("*").alias("rows"))
    return rates.orderBy(F.desc("rate"), F.asc(by)).first()


def riskiest_cluster_flag(df: DataFrame, by: str, label: str = "isFraud", name: str = "is_riskiest") -> DataFrame:
    top = riskiest_cluster(df, by, label)
    hit = F.lit(False) if top is None else F.col(by).eqNullSafe(F.lit(top[by]))
    return df.withColumn(name, hit.cast("int"))


def cluster_minor_flag(df: DataFrame, by: str, share: float = 0.01) -> DataFrame:
    """Cluster sizes in falling order, those below a share of all rows marked as minor."""
    sizes = df.groupBy(by).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy())
    return sizes.select(by, "rows", (F.col("rows") < F.lit(share) * total).alias("is_minor")).orderBy(F.desc("rows"), by)
