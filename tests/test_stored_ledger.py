"""Queries that pass over the ledger many times derive it from orders and customers once."""

from datetime import datetime, timedelta

import pytest

from ledgerlens.plans import registry, source_queries, stages
from ledgerlens.session import tune

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@pytest.fixture(scope="module")
def own(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("ledger"))
    day = datetime(1995, 1, 1)
    orders = [(k, k % 20, "OFP"[k % 3], 100.0 + 37 * (k % 91), day + timedelta(days=k % 300), PRIORITIES[k % 5]) for k in range(400)]
    fields = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(orders, fields).write.parquet(f"{folder}/orders.parquet")
    customers = [(k, 50.0 * (k - 3)) for k in range(20)]
    spark.createDataFrame(customers, "c_custkey long, c_acctbal double").write.parquet(f"{folder}/customer.parquet")
    return folder


def derived(df):
    return any("orders.parquet" in f or "customer.parquet" in f for f in df.inputFiles())


def test_serving_tables_derive_the_ledger_once(spark, own, monkeypatch):
    made, read = [], registry.ledger.transactions
    monkeypatch.setattr(registry.ledger, "transactions", lambda *args: made.append(args) or read(*args))
    inputs = registry.serving_inputs(tune(spark), own)
    assert len(made) == 1
    assert not any(derived(df) for df in inputs)
    counts = {r["table_name"]: r["row_count"] for r in source_queries.save_serving_tables(spark, own).collect()}
    assert len(made) == 2
    assert counts == {name: df.count() for name, df in zip(("transactions", "cube", "rules"), inputs)}
    assert counts["transactions"] == 400  # amounts are positive but for every 500th order


def test_fits_of_scores_and_baskets_pass_over_stored_rows(spark, own, monkeypatch):
    given = []
    monkeypatch.setattr(registry.risk, "score_ledger", lambda rows: given.append(rows) or rows)
    monkeypatch.setattr(registry.rules, "build_basket", lambda rows: given.append(rows) or rows)
    registry.scored(tune(spark), own)
    registry.baskets(spark, own)
    assert len(given) == 2 and not any(derived(df) for df in given)


def test_fits_of_the_model_table_pass_over_stored_rows(spark, own, monkeypatch):
    given = []
    monkeypatch.setattr(stages, "transform", lambda rows: given.append(rows) or (rows, {}))
    stages.prepared(tune(spark), own)
    assert not derived(given[0])
