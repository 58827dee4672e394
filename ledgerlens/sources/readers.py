"""Inputs: raw ledger CSV, stage tables, fallback locations, rule files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.operators.rule_views import RULE_SCHEMA, pinned_rules
from ledgerlens.session import path_exists

LEDGER_SCHEMA = (
    "step int, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, "
    "nameDest string, oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int"
)


def load_ledger_csv(spark: SparkSession, path: str, infer: bool = False, schema: str = LEDGER_SCHEMA) -> DataFrame:
    """Read a ledger CSV with header. The schema is given; inference costs a second read."""
    reader = spark.read.option("header", True)
    return reader.option("inferSchema", True).csv(path) if infer else reader.schema(schema).csv(path)


def load_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def first_existing_source(spark: SparkSession, candidates: Sequence[str], fallback: str | None = None) -> str:
    """The first candidate path that exists, else the fallback, else an error."""
    for path in [*candidates, *([fallback] if fallback else [])]:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these inputs exists: {[*candidates, fallback]}")


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A rule CSV: quoted item lists, the five measures every rule file has."""
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    return rows.select(
        "antecedents_str", "consequents_str", *[F.col(c).try_cast("double").alias(c) for c in ("support", "confidence", "lift")]
    )


def multi_csv_rule_pool(
    spark: SparkSession, folder: str, top_files: Sequence[str] = fixed.RULE_FILES_TOP10, pool_files: Sequence[str] = fixed.RULE_FILES_POOL
) -> tuple[DataFrame, DataFrame]:
    """Main rules from the first file present (the pinned ones if none is), and all pool files together."""
    top = next((f"{folder}/{f}" for f in top_files if path_exists(spark, f"{folder}/{f}")), None)
    main = read_rules(spark, top) if top else pinned_rules(spark)
    parts = [read_rules(spark, f"{folder}/{f}") for f in pool_files if path_exists(spark, f"{folder}/{f}")]
    pool = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts, spark.createDataFrame([], RULE_SCHEMA))
    return main, pool
