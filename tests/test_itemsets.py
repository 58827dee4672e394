"""Level-wise itemsets on bitmaps against counting every combination."""

import random
from collections import Counter
from itertools import combinations

import pytest

from ledgerlens.operators import rules


def baskets(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = Counter()
    for _ in range(n):
        rows[tuple(sorted(i for i in "abcdefghijkl" if rng.random() < 0.15 + 0.05 * (ord(i) % 9)))] += rng.choice((1, 2, 700, 5_000_000_000))
    return rows, spark.createDataFrame([(list(i), c) for i, c in rows.items()], "items array<string>, n bigint").repartition(3)


def brute(rows, min_support, max_len):
    counts = Counter()
    for items, n in rows.items():
        for size in range(1, max_len + 1):
            for chosen in combinations(items, size):
                counts[chosen] += n
    total = sum(rows.values())
    return {c: n for c, n in counts.items() if n / total >= min_support}


@pytest.mark.parametrize("min_support, max_len", [(0.01, 5), (0.2, 3), (0.05, 1), (1e-9, 4)])
def test_itemsets_equal_every_combination(spark, monkeypatch, min_support, max_len):
    monkeypatch.setattr(rules, "CANDIDATES_AT_ONCE", 60)
    rows, df = baskets(spark)
    found = rules.frequent_itemsets(df, min_support, max_len).collect()
    assert {tuple(r["itemsets"]): r["n"] for r in found} == brute(rows, min_support, max_len)
    assert len({tuple(r["itemsets"]) for r in found}) == len(found)


def test_no_candidate_has_an_infrequent_part(spark):
    level = spark.createDataFrame([(list(x),) for x in ("ab", "ac", "bc", "bd", "cd", "ad", "ce")], "itemsets array<string>")
    found = {"".join(r[0]) for r in rules.itemset_candidates(level, 3).collect()}
    assert found == {"abc", "abd", "acd", "bcd"}
    level = spark.createDataFrame([(list(x),) for x in ("abc", "abd", "acd")], "itemsets array<string>")
    assert rules.itemset_candidates(level, 4).collect() == []


def test_empty_baskets(spark):
    none = spark.createDataFrame([], "items array<string>, n bigint")
    assert rules.frequent_itemsets(none, 0.1).collect() == []
    empty = spark.createDataFrame([([], 5), (["a", "a"], 5)], "items array<string>, n bigint")
    assert [(r["itemsets"], r["n"]) for r in rules.frequent_itemsets(empty, 0.1).collect()] == [(["a"], 5)]
