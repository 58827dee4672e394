"""Connected components by alternating star contraction.

Each round links the neighbours of a node to the smallest one among them, first for
larger neighbours, then for smaller ones, which needs a logarithmic number of rounds
whatever the graph's diameter. A node that collects a large share of all edges is joined
by broadcast, so no task ever holds a whole neighbourhood.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.skew import join_by_key
from ledgerlens.session import cut_lineage


CROWDED = 2


def _large_star(edges: DataFrame, count: int) -> DataFrame:
    """Every larger end with the smallest node next to its smaller end; one edge for each."""
    both = edges.select(F.inline(F.array(F.struct("v", "u"), F.struct(F.col("u").alias("v"), F.col("v").alias("u")))))
    smallest = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"), F.count("*").alias("size"))
    return join_by_key(edges, smallest, ["v"], "size", "inner", total=2 * count).select("u", F.col("m").alias("v"))


def _small_star(edges: DataFrame, count: int) -> DataFrame:
    """A node and its smaller neighbours with the smallest of them: the edge to that one stays, the others move; one edge for each."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size"))
    linked = join_by_key(edges, smallest, ["u"], "size", "inner", total=2 * count)
    return linked.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def _fingerprint(edges: DataFrame) -> tuple:
    """Edges, a digest of them, and about how many larger ends they have."""
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.approx_count_distinct("u")).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node of every node's component, for the nodes of an edge list (``u``, ``v``).

    A round gives one edge for each it gets, so repeated edges add no rows and need not be
    sought after every step; they are dropped where they are most of the edges.
    """
    downward = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    stars = cut_lineage(downward)
    seen = _fingerprint(stars)
    while True:
        nearer = _small_star(_large_star(stars, seen[0]), seen[0])
        stars = cut_lineage(nearer.distinct() if seen[0] > CROWDED * seen[2] else nearer)
        now = _fingerprint(stars)
        if now == seen:
            break
        seen = now
    named = F.array(*(F.struct(F.col(end).alias("node"), F.col("v").alias("component")) for end in ("u", "v")))
    return stars.select(F.inline(named)).distinct()
