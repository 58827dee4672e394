"""Word and free-text search through the index of reasons."""

import pytest

from ledgerlens.operators import explorer, reason_index
from ledgerlens.operators.filters import Search
from ledgerlens.operators.reason_index import ReasonIndex
from ledgerlens.session import cut_lineage

ROWS = [("TX1", "Isolation Forest, IQR"), ("TX2", "drained; IQR"), ("TX3", None), ("TX4", ""), ("iqr", "other"), ("TX6", "Forest_x"), ("TX1", "Isolation Forest, IQR")]


@pytest.fixture(scope="module")
def indexed(spark):
    df = spark.createDataFrame(ROWS, "transaction_id string, anomaly_reason string")
    index, rows = ReasonIndex.build(df)
    return df, index, cut_lineage(rows)


def ids(df):
    return sorted(r["transaction_id"] for r in df.collect())


@pytest.mark.parametrize("literals", [1_000, 0])
@pytest.mark.parametrize("text", ["iqr", "Forest", "forest iqr", "", "???", "TX3", "x", "%", "for_st"])
def test_same_rows_as_without_the_index(indexed, monkeypatch, text, literals):
    df, index, rows = indexed
    monkeypatch.setattr(reason_index, "MOST_LITERALS", literals)
    assert ids(index.token_search(rows, text)) == ids(explorer.token_search(df, text))
    assert ids(index.free_text(rows, text)) == ids(df.filter(Search("ilike", text).predicate()))


def test_the_scan_filters_by_number(indexed, capsys):
    _, index, rows = indexed
    index.token_search(rows, "forest").select("transaction_id").explain("formatted")
    plan = capsys.readouterr().out
    assert "In(reason_id" in plan or "EqualTo(reason_id" in plan
    assert "split(" not in plan and "anomaly_reason" not in plan.split("ReadSchema")[1].split("\n")[0]
