import random

import pytest

from ledgerlens.functions import components, skew
from ledgerlens.functions.components import connected_components


def by_search(edges):
    near = {}
    for a, b in edges:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    found = {}
    for start in sorted(near):
        stack = [start] if start not in found else []
        while stack:
            node = stack.pop()
            if node not in found:
                found[node] = start
                stack += near[node]
    return found


def graphs():
    rng = random.Random(5)
    yield "chain", [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(120)]
    yield "hub", [("hub", f"leaf{i:03d}") for i in range(200)] + [("a", "b")]
    yield "random", [(f"r{rng.randrange(300):03d}", f"r{rng.randrange(300):03d}") for _ in range(180)]


@pytest.mark.parametrize("name,edges", list(graphs()))
def test_components_equal_a_search(spark, name, edges):
    edges = [e for e in edges if e[0] != e[1]]
    found = connected_components(spark.createDataFrame(edges, "u string, v string"))
    assert {r["node"]: r["component"] for r in found.collect()} == by_search(edges)


def test_a_round_shuffles_little_and_gives_no_more_edges_than_it_gets(spark, monkeypatch):
    rng = random.Random(7)
    edges = [(f"n{i:03d}", f"n{i + rng.randrange(1, 4):03d}") for i in range(100)]
    plans, counts, cut = [], [], components.cut_lineage

    def recorded(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        counts.append((written := cut(df)).count())
        return written

    monkeypatch.setattr(components, "cut_lineage", recorded)
    found = connected_components(spark.createDataFrame(edges, "u string, v string"))
    assert {r["node"]: r["component"] for r in found.collect()} == by_search(edges)
    # The first aggregate stands in the plan twice, as both sides of the second join need it, and is shuffled once.
    assert len(plans) > 2 and max(p.count("Exchange hashpartitioning") for p in plans) <= 3
    assert counts == sorted(counts, reverse=True)


def test_many_repeated_edges_are_dropped(spark, monkeypatch):
    edges, counts, cut = [(f"n{i:02d}", f"n{k:02d}") for i in range(30) for k in range(i)], [], components.cut_lineage

    def recorded(df):
        counts.append((written := cut(df)).count())
        return written

    monkeypatch.setattr(components, "cut_lineage", recorded)
    found = connected_components(spark.createDataFrame(edges * 3, "u string, v string"))
    assert {r["node"]: r["component"] for r in found.collect()} == by_search(edges)
    assert counts[0] == 3 * len(edges) and counts[-1] == 29


@pytest.mark.parametrize("how", ["left_semi", "left", "inner"])
def test_hot_keys_join_like_any_other(spark, monkeypatch, how):
    rows = spark.createDataFrame([(k, i) for i in range(300) for k in (["hot"] * 5 + ["cold", None, f"k{i}"])], "k string, i int")
    table = rows.filter("k is null or k != 'cold'").groupBy("k").count().withColumn("label", skew.F.length("k"))
    plain = skew.join_by_key(rows, table, ["k"], "count", how)
    monkeypatch.setattr(skew, "FITS_ONE_TASK", 10)
    split = skew.join_by_key(rows, table, ["k"], "count", how)
    assert split.columns == plain.columns
    assert sorted(map(repr, split.collect())) == sorted(map(repr, plain.collect()))
    assert plain.count() == (300 * 8 if how == "left" else 300 * 7)
