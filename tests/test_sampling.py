"""Order statistics of many strata at once, and samples of exact size."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import sampling


def first_by_hash(rows, quota):
    """Brute force: the first ids of each stratum by MD5."""
    by = {}
    for i, s in rows:
        by.setdefault(s, []).append(i)
    return {(i, s) for s, ids in by.items() for i in sorted(ids, key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())[:quota]}


def test_samples_are_the_first_rows_by_hash(spark, monkeypatch):
    monkeypatch.setattr(sampling, "DIRECT", 20)
    rows = [(i, None if i % 11 == 0 else "abc"[i * i % 3]) for i in range(5_000)]
    df = spark.createDataFrame(rows, "id long, s string")
    for quota in (7, 2_000, 10_000):
        found = sampling.stratified_fixed(df, "s", ["id"], quota)
        assert found.columns == ["id", "s"]
        assert {(r["id"], r["s"]) for r in found.collect()} == first_by_hash(rows, quota)
    half = sampling.fixed_size_random(df.repartition(7), 2_500, ["id"])
    assert {r["id"] for r in half.collect()} == {i for i, _ in first_by_hash([(i, 0) for i, _ in rows], 2_500)}


def test_cuts_where_the_first_guess_is_wrong(spark, monkeypatch):
    """Values far from evenly spread put the cut outside the guessed bracket, on either side."""
    monkeypatch.setattr(sampling, "DIRECT", 10)
    groups = {"low": [i * 3 for i in range(900)], "high": [sampling.HASH_END - 1 - i for i in range(900)], "same": [5] * 900}
    values = spark.createDataFrame([(s, v) for s, vs in groups.items() for v in vs], "stratum string, v long")
    wanted = spark.createDataFrame([(s, 900, q) for s, q in (("low", 450), ("high", 333), ("same", 17))], "stratum string, n long, quota long")
    found = {r["stratum"]: (r["cut"], r["take"], r["ties"]) for r in sampling.cuts(values, wanted).collect()}
    assert found == {"low": (449 * 3, 1, 1), "high": (sampling.HASH_END - 1 - 567, 1, 1), "same": (5, 17, 900)}


def test_repeated_ids_keep_sizes_exact(spark):
    same = [(1, "a", "x")] * 4_000
    differing = [(2, "a", str(i)) for i in range(3_000)]
    df = spark.createDataFrame(same + differing + [(i, "b", "y") for i in range(50)], "id long, s string, t string").repartition(6)
    for quota in (3_500, 6_999):
        found = Counter(r["s"] for r in sampling.stratified_fixed(df, "s", ["id"], quota).collect())
        assert found == {"a": quota, "b": min(50, quota)}
    one, two = (sorted(map(tuple, sampling.stratified_fixed(d, "s", ["id"], 1_500).collect())) for d in (df, df.repartition(3)))
    assert one == two


@pytest.mark.parametrize("rows", [120_000])
def test_as_many_strata_as_wanted(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") % 40_000).alias("s"))
    sizes = sampling.stratified_fixed(df, "s", ["id"], 2).groupBy("s").count().agg(F.count("*"), F.min("count"), F.max("count")).first()
    assert tuple(sizes) == (40_000, 2, 2)


def test_empty_tables_and_no_quota(spark):
    df = spark.createDataFrame([], "id long, s string")
    assert sampling.stratified_fixed(df, "s", ["id"]).collect() == []
    assert sampling.fixed_size_random(df, 5, ["id"]).collect() == []
    assert sampling.fixed_size_random(spark.range(10), 0, ["id"]).collect() == []
