"""Where queries and their SQL counterparts are declared, and the inputs they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import cube as cubes
from ledgerlens.operators import risk, rule_views, rules
from ledgerlens.operators.cleaning import standardize_schema
from ledgerlens.session import cut_lineage, tune
from ledgerlens.sources import ledger

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
STATEMENTS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say the same, its statement."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(tune(spark), folder)
        if sql is not None:
            STATEMENTS[name] = sql
        return function

    return register


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round derived decimals, whose last bits depend on the order of summation."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- shared inputs -----------------------------------------------------------------

MODEL_FEATURES = (
    "step", "amount", "oldbalanceOrg", "oldbalanceDest", "origError", "destError",
    "isDestMerchant", "origDrainedToZero",
    "type_CASH_IN", "type_CASH_OUT", "type_DEBIT", "type_PAYMENT", "type_TRANSFER",
)


def stored_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The scoring input, stored: fits pass over it a dozen times, and every pass of the derived one sends the customers through the driver."""
    return cut_lineage(ledger.scoring_input(spark, folder))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return risk.score_ledger(stored_ledger(spark, folder))


FLAGS = ("isFraud", "high_risk", "flag_IQR", "flag_ZScore", "flag_IsoForest", "flag_HDBSCAN", "flag_BalanceMismatch")


def served(scored_rows: DataFrame) -> DataFrame:
    """Scored rows in the shape the explorer serves."""
    table = standardize_schema(scored_rows)
    return table.withColumns({c: F.col(c).cast("boolean") for c in FLAGS})


def serving(spark: SparkSession, folder: str) -> DataFrame:
    """The scored ledger in the shape the explorer serves."""
    return served(scored(spark, folder))


def cube(spark: SparkSession, folder: str) -> DataFrame:
    return cubes.build_cube(serving(spark, folder))


def baskets(spark: SparkSession, folder: str) -> DataFrame:
    return rules.build_basket(stored_ledger(spark, folder))


def collapsed(spark: SparkSession, folder: str) -> DataFrame:
    return rules.collapse_baskets(baskets(spark, folder).select("items"))


def presented_rules(spark: SparkSession, collapsed_baskets: DataFrame) -> DataFrame:
    """Pinned rules plus the rules mined from these baskets, as presented."""
    pool = rules.report_rules(rules.meaningful_rules(rules.mine(collapsed_baskets)))
    return rule_views.rule_present(rule_views.merge_rule_pools(rule_views.pinned_rules(spark), pool))


def rule_table(spark: SparkSession, folder: str) -> DataFrame:
    """Pinned rules plus the rules mined from the ledger, as presented."""
    return presented_rules(spark, collapsed(spark, folder))


def serving_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The serving rows, their cube and the rule table, all from one stored ledger."""
    rows = stored_ledger(spark, folder)
    shown = served(risk.score_ledger(rows))
    counted = rules.collapse_baskets(rules.build_basket(rows).select("items"))
    return shown, cubes.build_cube(shown), presented_rules(spark, counted)
