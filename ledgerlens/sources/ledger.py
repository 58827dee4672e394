"""A transaction ledger derived from the ``orders`` and ``customer`` tables.

``transactions`` has the shape of the raw ledger plus an id; ``scoring_input`` adds the
engineered columns and fixed stand-ins for the three model outputs, so that everything
downstream of the models has one exact answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.cleaning import ledger_features


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger: one row per order, with balances on both sides."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    key, price, balance = F.col("o_orderkey"), F.col("o_totalprice"), F.col("c_acctbal")
    channel = F.col("o_orderpriority")
    priced = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("k"),
        F.col("o_custkey").alias("ck"),
        F.col("o_orderstatus").alias("status"),
        F.to_date("o_orderdate").alias("day"),
        balance.alias("bal"),
        F.when(key % 500 == 499, F.lit(0.0)).when(key % 50 == 0, F.round(price * 12, 2)).otherwise(price).alias("amount"),
        F.when(channel == "1-URGENT", "CASH_OUT")
        .when(channel == "2-HIGH", "TRANSFER")
        .when(channel == "3-MEDIUM", "PAYMENT")
        .when(channel == "4-NOT SPECIFIED", "CASH_IN")
        .otherwise("DEBIT")
        .alias("type"),
    )
    amount = F.col("amount")
    opened = priced.withColumns(
        {
            "merchant": F.col("type") == "PAYMENT",
            "ob": F.when(F.col("k") % 10 == 0, amount).when(F.col("bal") <= 0, F.lit(0.0)).otherwise(F.round(F.col("bal") * 60, 2)),
        }
    )
    settled = opened.withColumns(
        {
            "nb": F.when(F.col("type") == "CASH_IN", F.round(F.col("ob") + amount, 2))
            .when(F.col("ob") > amount, F.round(F.col("ob") - amount, 2))
            .otherwise(F.lit(0.0)),
            "od": F.when(F.col("merchant"), F.lit(0.0)).otherwise(F.round(amount * (F.col("k") % 7), 2)),
        }
    )
    drained = (F.col("ob") > 0) & (F.col("nb") == 0) & (F.col("k") % 4 == 0)
    return settled.select(
        F.format_string("TX%08d", F.col("k").cast("long")).alias("transaction_id"),
        (F.datediff("day", F.lit("1995-01-01").cast("date")) + 1).alias("step"),
        "type",
        "amount",
        F.concat(F.lit("C"), F.col("ck").cast("string")).alias("nameOrig"),
        F.col("ob").alias("oldbalanceOrg"),
        F.col("nb").alias("newbalanceOrig"),
        F.concat(
            F.when(F.col("merchant"), "M").otherwise("C"), ((F.col("ck") * 31 + F.col("k")) % 5000).cast("string")
        ).alias("nameDest"),
        F.col("od").alias("oldbalanceDest"),
        F.when(F.col("merchant"), F.lit(0.0))
        .when(F.col("status") == "P", F.col("od"))
        .otherwise(F.round(F.col("od") + amount, 2))
        .alias("newbalanceDest"),
        F.when(F.col("type").isin("CASH_OUT", "TRANSFER") & drained, 1).otherwise(0).alias("isFraud"),
        F.when((F.col("type") == "TRANSFER") & drained & (amount > 400000), 1).otherwise(0).alias("isFlaggedFraud"),
    )


def scoring_input(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger rows with a positive amount, engineered columns and stand-in model outputs."""
    rows = ledger_features(transactions(spark, folder).filter(F.col("amount") > 0))
    number = F.substring("transaction_id", 3, 20).cast("long")
    return rows.withColumns(
        {
            "isDestMerchant": F.col("isDestMerchant").cast("int"),
            "origDrainedToZero": F.col("origDrainedToZero").cast("int"),
            "cluster_kmeans": (number % 5).cast("int"),
            "flag_IsoForest": F.when(number % 150 == 0, 1).otherwise(0),
            "is_birch_hdbscan_outlier": F.when(number % 100 == 0, 1).otherwise(0),
        }
    )
