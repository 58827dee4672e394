"""Rows that the given tables don't have: long ids, nulls, NaN, constants, ties."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.quantiles import kth_largest, values_at_ranks
from ledgerlens.operators import cleaning, cluster_eval, quality, risk, rules
from ledgerlens.operators.filters import search_mode
from ledgerlens.plans import stages
from ledgerlens.sources import writers


@pytest.mark.parametrize("number, wanted", [(123456789, "TX123456789"), (123456789012, "TX123456789012"), (7, "TX00000007")])
def test_ids_keep_every_digit(spark, number, wanted):
    df = spark.createDataFrame([(number,)], "k long")
    assert df.select(F.format_string("TX%08d", "k")).first()[0] == wanted
    found = search_mode(wanted.lower())
    assert (found.mode, found.operand) == ("id_exact", wanted)


def top_rows(spark, amounts):
    rows = [(f"TX{i:08d}", 5, 2, 1, a) for i, a in enumerate(amounts)]
    return spark.createDataFrame(
        rows, "transaction_id string, risk_score int, risk_indicator_count int, flag_BalanceMismatch int, amount double"
    )


@pytest.mark.parametrize("amounts", [[None] * 8 + [1.0, 2.0], [float("nan")] * 8 + [1.0, None], [None] * 10])
def test_top_rows_are_complete_without_amounts(spark, amounts):
    found = [r["transaction_id"] for r in risk.top_anomalies(top_rows(spark, amounts), 5).collect()]
    assert len(found) == 5
    if amounts[9] == 2.0:
        assert found == ["TX00000009", "TX00000008", "TX00000000", "TX00000001", "TX00000002"]


def test_top_rows_with_null_sort_columns(spark):
    df = top_rows(spark, [1.0, 2.0, 3.0]).withColumn("risk_score", F.lit(None).cast("int"))
    assert [r["amount"] for r in risk.top_anomalies(df, 2).collect()] == [3.0, 2.0]


def test_order_statistics_of_odd_columns(spark):
    df = spark.createDataFrame([(float("nan"), None), (1.0, None), (2.0, None)], "x double, y double")
    assert kth_largest(df, "x", 1) == 2.0 and kth_largest(df, "x", 3) is None
    assert values_at_ranks(df, "y", [0, 1]) == [None, None] and kth_largest(df, "y", 1) is None
    with pytest.raises(ValueError):
        values_at_ranks(df, "x", [2])


def test_fixed_label_bins_of_a_column_without_values(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "id string, x double")
    assert {r["x_bin"] for r in rules.quantile_bins_fixed_labels(df, ["x"], "id").collect()} == {None}


@pytest.mark.parametrize("others", [["b"], ["b", "c", "d", "e", "f"]])
def test_constant_columns_have_no_correlation(spark, others):
    df = spark.range(20).select(F.lit(3.7).alias("a"), *[(F.col("id") * (i + 2)).cast("double").alias(c) for i, c in enumerate(others)])
    found = {(r[0], r[1]): r[2] for r in quality.correlation_matrix(df, ["a", *others]).collect()}
    assert found["a", "a"] is None and found["a", "b"] is None and found["b", "b"] == pytest.approx(1.0)


def test_rows_equal_but_for_their_id_are_duplicates(spark):
    columns = "step int, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, nameDest string, oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int"
    row = (1, "PAYMENT", 5.0, "C1", 9.0, 4.0, "M1", 0.0, 0.0, 0, 0)
    raw = spark.createDataFrame([row] * 3 + [(2, *row[1:])], columns)
    numbered = raw.withColumn("transaction_id", F.format_string("TX%08d", F.monotonically_increasing_id()))
    assert stages.engineer(numbered).count() == 2
    assert cleaning.dedup(raw).count() == 2


def test_cluster_indices_at_their_edges(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 1), (2.0, 1)], "x double, c int")
    one = cluster_eval.cluster_quality(df, ["x"], "c")
    assert one["davies_bouldin"] is None and one["calinski_harabasz"] is None
    same = spark.createDataFrame([(0.0, 1), (2.0, 1), (0.0, 2), (2.0, 2)], "x double, c int")
    assert cluster_eval.cluster_quality(same, ["x"], "c")["davies_bouldin"] == 0
    empty = cluster_eval.riskiest_cluster_flag(df.filter("false").withColumn("isFraud", F.lit(0)), "c")
    assert empty.count() == 0


@pytest.mark.parametrize("version", [None, "v"])
def test_keyed_overwrite_settles_ties(spark, tmp_path, version):
    rows = [("a", 1, "x"), ("a", 1, "z"), ("a", 1, "y")]
    for turn, order in enumerate((rows, rows[::-1])):
        df = spark.createDataFrame(order, "k string, v int, w string")
        kept = writers.keyed_overwrite_sink(df, str(tmp_path / f"{version}{turn}"), "k", version)
        assert [tuple(r) for r in kept.collect()] == [("a", 1, "z")]
