"""Sampling queries. Samples are the first rows of a stratum by the MD5 of seed and id, so a statement can pick them too."""

from pyspark.sql import functions as F

from ledgerlens.operators import sampling
from ledgerlens.plans.registry import query
from ledgerlens.plans.sql_views import TX
from ledgerlens.sources.ledger import table, transactions

KEY = ["transaction_id"]


def _rows(spark, folder):
    return transactions(spark, folder).select("transaction_id", "type", "amount")


def _sizes(sample, by):
    return sample.groupBy(by).agg(F.count("*").alias("row_count"))


def _sizes_sql(by: str, quota: str, source: str = "tx") -> str:
    return (
        f"SELECT {by}, least(n, {quota})::BIGINT AS row_count FROM (SELECT {by}, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} GROUP BY {by}) "
        f"WHERE least(n, {quota}) > 0"
    )


def _sample_sql(by: str, quota: str, columns: str = "transaction_id, type, amount") -> str:
    return (
        TX + f"SELECT {columns} FROM (SELECT *, count(*) OVER (PARTITION BY {by}) AS n, count(*) OVER () AS total, "
        f"row_number() OVER (PARTITION BY {by} ORDER BY md5('42|' || transaction_id)) AS place FROM tx) WHERE place <= {quota}"
    )


@query("stratified_proportional", _sample_sql("type", "floor(1000 * (n / total))"))
def stratified_proportional(spark, folder):
    return sampling.stratified_proportional(_rows(spark, folder), "type", KEY, 1_000)


@query("stratified_proportional_sizes", TX + _sizes_sql("type", "CAST(floor(1000 * (n / total)) AS BIGINT)"))
def stratified_proportional_sizes(spark, folder):
    return _sizes(stratified_proportional(spark, folder), "type")


@query("stratified_fixed", _sample_sql("type", "500"))
def stratified_fixed(spark, folder):
    return sampling.stratified_fixed(_rows(spark, folder), "type", KEY, 500)


@query("stratified_fixed_sizes", TX + _sizes_sql("type", "500"))
def stratified_fixed_sizes(spark, folder):
    return _sizes(stratified_fixed(spark, folder), "type")


@query("stratified_fraction", _sample_sql("type", "CASE WHEN total <= 3000 THEN n ELSE greatest(1, floor(n * (3000 / total))) END"))
def stratified_fraction(spark, folder):
    return sampling.stratified_fraction(_rows(spark, folder), "type", KEY)


@query("stratified_fraction_sizes", TX + _sizes_sql("type", "CASE WHEN total <= 3000 THEN n ELSE greatest(1, CAST(floor(n * (3000 / total)) AS BIGINT)) END"))
def stratified_fraction_sizes(spark, folder):
    return _sizes(stratified_fraction(spark, folder), "type")


@query("bernoulli_percent")
def bernoulli_percent(spark, folder):
    return sampling.bernoulli_percent(_rows(spark, folder))


@query("stratified_many_strata", _sample_sql("nameOrig", "2", "transaction_id, nameOrig"))
def stratified_many_strata(spark, folder):
    """Two transactions of every sender, which are as many strata as there are customers."""
    rows = transactions(spark, folder).select("transaction_id", "nameOrig")
    return sampling.stratified_fixed(rows, "nameOrig", KEY, 2)


@query("fixed_size_random_half", _sample_sql("1", "total // 2"))
def fixed_size_random_half(spark, folder):
    rows = _rows(spark, folder)
    return sampling.fixed_size_random(rows, rows.count() // 2, KEY)


@query("fixed_size_random", _sample_sql("1", "1000"))
def fixed_size_random(spark, folder):
    return sampling.fixed_size_random(_rows(spark, folder), 1_000, KEY)


@query("fixed_size_random_size", TX + "SELECT least(count(*), 1000)::BIGINT AS row_count, least(count(*), 1000)::BIGINT AS distinct_rows FROM tx")
def fixed_size_random_size(spark, folder):
    return fixed_size_random(spark, folder).agg(F.count("*").alias("row_count"), F.count_distinct("transaction_id").alias("distinct_rows"))


@query(
    "systematic_every_k",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) - 1 AS i, "
    "count(*) OVER () AS n FROM lineitem) WHERE i % greatest(1, n // 5000) = 0",
)


def systematic_every_k(spark, folder):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    sample = sampling.systematic_every_k(table(spark, folder, "lineitem").select(*order), order, 5_000)
    return sample.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
