"""Upserts into a stored keyed table."""

import hashlib
import random
from pathlib import Path

import pytest

from ledgerlens.sources.keyed_table import KeyedTable, Upserted

SCHEMA = "k string, v int, w string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def winners(batch):
    best = {}
    for row in batch:
        if row[0] is not None:
            best[row[0]] = max(best.get(row[0], row), row, key=lambda r: r[1:])
    return sorted(best.values())


def test_batches_in_any_order_give_the_latest_rows(spark, tmp_path):
    rng = random.Random(1)
    batches = [[(f"k{rng.randrange(60)}", rng.randrange(5), rng.choice("abc")) for _ in range(150)] + [("hot", i, "x") for i in range(100)] for _ in range(2)]
    for turn, order in enumerate(([0, 1], [1, 0])):
        table = KeyedTable(spark, str(tmp_path / str(turn)), "k", "v", buckets=4)
        for at in order:
            table.upsert(spark.createDataFrame(batches[at], SCHEMA))
        assert rows(table.read()) == winners(batches[0] + batches[1])


def test_counts_and_a_retry(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "k", "v")
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.upsert(spark.createDataFrame([], SCHEMA)) == Upserted(0, 0, 0, 0, 0)
    assert table.upsert(spark.createDataFrame([("a", 1, "x"), ("b", 1, None), (None, 1, "x")], SCHEMA)) == Upserted(3, 1, 2, 0, 0)
    second = spark.createDataFrame([("a", 2, "y"), ("a", 1, "z"), ("b", 0, "old"), ("c", 1, "x")], SCHEMA)
    assert table.upsert(second) == Upserted(4, 0, 1, 1, 1)
    manifests = len(list((tmp_path / "manifest").iterdir()))
    assert table.upsert(second) == Upserted(4, 0, 0, 0, 3)
    assert len(list((tmp_path / "manifest").iterdir())) == manifests
    assert rows(table.read().fillna("-")) == [("a", 2, "y"), ("b", 1, "-"), ("c", 1, "x")]


def test_without_a_version_the_later_batch_wins(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "k")
    table.upsert(spark.createDataFrame([("a", 9, "x"), ("b", 1, "x")], SCHEMA))
    assert table.upsert(spark.createDataFrame([("a", 1, "y"), ("b", 1, "x")], SCHEMA)) == Upserted(2, 0, 0, 1, 1)
    assert rows(table.read()) == [("a", 1, "y"), ("b", 1, "x")]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "k", "v", buckets=8)
    table.upsert(spark.createDataFrame([(f"k{i}", 1, "x") for i in range(100)], SCHEMA))

    def digests():
        return {p: hashlib.md5(p.read_bytes()).hexdigest() for p in Path(tmp_path, "data").rglob("*.parquet")}

    before, folders = digests(), {r["bucket"]: r["folder"] for r in table._manifest()}
    table.upsert(spark.createDataFrame([("k3", 2, "y")], SCHEMA))
    after = {r["bucket"]: r["folder"] for r in table._manifest()}
    assert sum(folders[b] != after[b] for b in folders) == 1
    assert {p: d for p, d in digests().items() if p in before} == before


def test_a_batch_that_broke_off_is_not_seen(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "k", "v")
    table.upsert(spark.createDataFrame([("a", 1, "x")], SCHEMA))
    (tmp_path / "manifest" / "2").mkdir()
    assert rows(table.read()) == [("a", 1, "x")]
    table.upsert(spark.createDataFrame([("b", 1, "x")], SCHEMA))
    assert rows(table.read()) == [("a", 1, "x"), ("b", 1, "x")]


def test_other_columns_are_refused(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "k")
    table.upsert(spark.createDataFrame([("a", 1, "x")], SCHEMA))
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([("a", 1)], "k string, v int"))
    with pytest.raises(ValueError):
        table.upsert(spark.createDataFrame([("a", 1)], "k string, _batch int"))
