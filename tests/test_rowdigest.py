"""Equal rows found by digest and compared in full."""

import random
from collections import Counter

from pyspark.sql import functions as F

from ledgerlens.functions import rowdigest
from ledgerlens.operators import cleaning, quality

ROW = "id long, a string, b double, c int"


def rows():
    rng = random.Random(8)
    found = [(i, rng.choice(("x", None, "")), rng.choice((0.0, -0.0, 1.5, float("nan"), None)), rng.randrange(40)) for i in range(600)]
    return found + [(900 + i, "hot", 1.0, 1) for i in range(400)] + [(2000 + i, f"own {i}", None, None) for i in range(300)]


def plain(r):
    b = r[2]
    return (r[1], "nan" if b != b and b is not None else (0.0 if b == 0 else b), r[3])


def test_duplicates_are_counted_and_the_lowest_id_stays(spark):
    data = rows()
    df = spark.createDataFrame(data, ROW).repartition(5)
    groups = {}
    for r in data:
        groups.setdefault(plain(r), []).append(r[0])
    kept = cleaning.dedup(df, "id").collect()
    assert sorted(r["id"] for r in kept) == sorted(min(ids) for ids in groups.values())
    assert kept and list(kept[0].asDict()) == df.columns
    assert quality.duplicate_rows(df.drop("id")).first()[0] == len(data) - len(groups)
    assert Counter(plain((None, *r)) for r in cleaning.dedup(df.drop("id")).collect()) == Counter(groups.keys())


def test_digests_that_meet_by_chance_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(rowdigest, "digest_halves", lambda columns: {rowdigest.HALVES[0]: F.lit(1).cast("long"), rowdigest.HALVES[1]: F.lit(2).cast("long")})
    df = spark.createDataFrame(rows(), ROW)
    assert cleaning.dedup(df).count() == len(rows())
    assert cleaning.dedup(df.drop("id")).count() == df.drop("id").distinct().count()


def test_only_repeats_travel_whole(spark):
    """Of a table without repeats, nothing but digests is shuffled, and no row is grouped."""
    df = spark.range(5_000).withColumn("wide", F.repeat(F.col("id").cast("string"), 50))
    single, repeated = rowdigest.split_by_digest(df, df.columns)
    assert single.count() == 5_000 and repeated.count() == 0
    assert "hashpartitioning(wide" not in single._jdf.queryExecution().executedPlan().toString()


def test_empty_table(spark):
    df = spark.createDataFrame([], ROW)
    assert cleaning.dedup(df, "id").collect() == []
    assert quality.duplicate_rows(df).first()[0] == 0
