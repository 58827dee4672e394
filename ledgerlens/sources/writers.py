"""Outputs: stage tables, CSV summaries, serving tables, manifest and fitted parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.cluster_eval import cluster_profile_means
from ledgerlens.operators.page_map import PageMap
from ledgerlens.operators.reason_index import ReasonIndex


def save_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write a stage's output and read on from the stored rows."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _flat(df: DataFrame) -> DataFrame:
    """CSV holds no arrays: join them to text."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns({a: F.array_join(a, ", ") for a in arrays}) if arrays else df


def save_summary_csvs(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write named tables as CSV with header; returns the path of each."""
    paths = {}
    for name, table in tables.items():
        paths[name] = f"{folder}/{name}.csv"
        _flat(table).write.mode("overwrite").option("header", True).option("escape", '"').csv(paths[name])
    return paths


def split_export(df: DataFrame, folder: str, flag: str = "is_birch_hdbscan_outlier", by: str = "cluster_kmeans") -> tuple[DataFrame, DataFrame]:
    """Store the flagged rows and the per-cluster column means as separate tables."""
    outliers = save_parquet(df.filter(F.col(flag) == 1), f"{folder}/outliers")
    means = cluster_profile_means(df, by)
    means.write.mode("overwrite").option("header", True).csv(f"{folder}/cluster-means")
    return outliers, df.sparkSession.read.schema(means.schema).option("header", True).csv(f"{folder}/cluster-means")


def save_serving_tables(serving: DataFrame, cube: DataFrame, rules: DataFrame, folder: str, projection: DataFrame | None = None) -> dict[str, DataFrame]:
    """Store the row, cube, rule and projection tables for querying.

    Rows are split by risk level and range-ordered by id inside a level, so level filters
    prune folders, ids prune row groups, and the largest level still spans many files. Where
    rows have reasons, an index of them is stored too (``reasons``, ``postings``).
    """
    if "anomaly_reason" in serving.columns:
        index, serving = ReasonIndex.build(serving)
        for name, table in (("reasons", index.reasons), ("postings", index.postings)):
            table.write.mode("overwrite").parquet(f"{folder}/{name}")
    layout = ("risk_level", "transaction_id")
    rows = serving.repartitionByRange(*layout).sortWithinPartitions(*layout)
    rows.write.mode("overwrite").partitionBy("risk_level").parquet(f"{folder}/transactions")
    small = {"cube": cube, "rules": rules, **({"projection": projection} if projection is not None else {})}
    for name, table in small.items():
        table.repartition(1).write.mode("overwrite").parquet(f"{folder}/{name}")
    spark = serving.sparkSession
    return {name: spark.read.parquet(f"{folder}/{name}") for name in ("transactions", *small)}


def save_page_maps(serving: DataFrame, folder: str, orders: Sequence[tuple[str, str]]) -> list[PageMap]:
    """Number the rows of each (column, direction), so that any page of these orders is a bounded read."""
    return [PageMap(serving.sparkSession, folder, column, direction).save(serving) for column, direction in orders]


def table_counts(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    return {name: table.count() for name, table in tables.items()}


def keyed_overwrite_sink(df: DataFrame, path: str, key: str, version: str | None = None) -> DataFrame:
    """Replace a table with one row per key; the highest ``version`` of a key wins, among equals the row that sorts last."""
    if version is None:
        latest = df.groupBy(key).agg(F.max(F.struct(*df.columns)).alias("row")).select("row.*")
    else:
        whole = F.struct(*df.columns)
        latest = df.groupBy(key).agg(F.max_by(whole, F.struct(F.col(version), whole)).alias("row")).select("row.*")
    return save_parquet(latest, path)


def run_manifest(spark: SparkSession, path: str, mode: str, counts: Mapping[str, int]) -> DataFrame:
    """Append one JSON line about a run: when, in which mode, how many rows per table."""
    fields = ", ".join(f"`{name}` long" for name in counts)
    stamp = datetime.now(timezone.utc).isoformat()
    row = spark.createDataFrame([(stamp, mode, *counts.values())], f"created_at string, mode string, {fields}")
    row.repartition(1).write.mode("append").json(path)
    return spark.read.schema(row.schema).json(path)


def save_scaler(spark: SparkSession, params: Mapping[str, tuple[float, float]], path: str) -> DataFrame:
    rows = [(c, float(center), float(spread)) for c, (center, spread) in params.items()]
    return save_parquet(spark.createDataFrame(rows, "column_name string, center double, scale double"), path)


def load_scaler(spark: SparkSession, path: str) -> dict[str, tuple[float, float]]:
    """Read a scaler back; it has one row per scaled column."""
    return {r["column_name"]: (r["center"], r["scale"]) for r in spark.read.parquet(path).collect()}
