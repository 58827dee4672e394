"""Approximate nearest neighbours by counting collisions of single projections.

The index keeps, for every block of vectors, each vector's place on a number of random
lines and the vectors sorted along each line. A query opens a window around its own place
on every line; windows grow together (virtual rehashing doubles nothing on disk, only the
ends of the slices move). A vector in enough windows at once has collided often enough to
be verified by its exact distance. Windows stop growing when enough vectors were verified.

Queries are compared with all rows in blocks: each block of vectors meets each block of
queries once, both bounded in size, and every pair of blocks keeps ten rows per query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import prepare

QUERY_STEP = 100


@dataclass(frozen=True)
class Search:
    """``verified`` bounds nothing in the result: windows grow until that share of a block collided."""

    k: int = 10
    lines: int = 48
    threshold: float = 0.75
    verified: float = 0.20
    growth: float = 1.12
    vectors_per_block: int = 8_000
    queries_per_block: int = 2_000
    seed: int = 5


def usable(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vec (doubles): rows with a key, and a vector that is not null, empty, zero, and has finite parts only."""
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = df.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    return rows.filter(F.col("vec_id").isNotNull() & (F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0))


class Block:
    """The sorted lines of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, settings: Search):
        self.ids, self.vectors, self.settings = ids, vectors, settings
        rng = np.random.default_rng(settings.seed)
        self.directions = rng.standard_normal((vectors.shape[1], settings.lines))
        places = vectors @ self.directions
        self.order = np.argsort(places, axis=0, kind="stable").T.astype(np.int32)
        self.sorted = np.ascontiguousarray(np.take_along_axis(places, self.order.T, axis=0).T)
        spread = self.sorted[:, -1] - self.sorted[:, 0]
        self.width = float(np.median(spread)) / 16 if len(ids) > 1 else 1.0

    def candidates(self, query: np.ndarray) -> np.ndarray:
        """Rows that share enough windows with the query; all rows of a small block."""
        s, n = self.settings, len(self.ids)
        wanted = max(s.k + 1, int(s.verified * n)) + s.k
        if wanted >= n:
            return np.arange(n)
        places = query @ self.directions
        needed = int(np.ceil(s.threshold * s.lines))
        low = np.array([np.searchsorted(line, p) for line, p in zip(self.sorted, places)])
        high, counts, width = low.copy(), np.zeros(n, np.int16), self.width
        while True:
            for i, (line, p) in enumerate(zip(self.sorted, places)):
                a = np.searchsorted(line, p - width, "left")
                b = np.searchsorted(line, p + width, "right")
                # Only what the window gained since the last time.
                counts[self.order[i, a : low[i]]] += 1
                counts[self.order[i, high[i] : b]] += 1
                low[i], high[i] = min(a, low[i]), max(b, high[i])
            found = np.flatnonzero(counts >= needed)
            if len(found) >= wanted:
                return found
            width = max(width * s.growth, np.finfo(float).tiny)

    def nearest(self, query_id: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact distances of the nearest verified rows, ties to smaller ids."""
        rows = self.candidates(query)
        rows = rows[self.ids[rows] != query_id]
        distance = np.sqrt(((self.vectors[rows] - query) ** 2).sum(axis=1))
        best = np.lexsort((self.ids[rows], distance))[: self.settings.k]
        return self.ids[rows][best], distance[best]


def search(df: DataFrame, step: int = QUERY_STEP, settings: Search = Search()) -> DataFrame:
    """The nearest rows of every row whose id is divisible by ``step``: query_id, rank, vec_id, score.

    Every usable row is indexed and is a candidate for all queries but its own. Vectors of
    another length than a query's are not compared with it. Repeated ids keep one row (the
    smallest vector). Fewer rows than ``k`` give all of them; an empty table gives none.
    """
    spark = prepare(df.sparkSession)
    rows = usable(df).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    blocks = max(1, -(-total // settings.vectors_per_block))
    query_blocks = max(1, -(-total // (step * settings.queries_per_block)))
    deal = F.xxhash64("vec_id")
    size = F.size("vec").alias("size")
    data = rows.select(
        "vec_id", "vec", size, F.pmod(deal, F.lit(blocks)).alias("b"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q"),
    )
    queries = rows.filter(F.col("vec_id") % step == 0).select(
        F.col("vec_id").alias("query_id"), F.col("vec").alias("query"), size,
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("b"),
        F.pmod(deal, F.lit(query_blocks)).cast("int").alias("q"),
    )
    columns = ["query_id", "vec_id", "score"]

    def meet(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors) or not len(asked):
            return pd.DataFrame({c: pd.Series(dtype="float64" if c == "score" else "int64") for c in columns})
        block = Block(vectors["vec_id"].to_numpy(), np.stack(vectors["vec"].to_numpy()), settings)
        found = []
        for query_id, query in zip(asked["query_id"], asked["query"]):
            ids, scores = block.nearest(query_id, np.asarray(query))
            found.append(pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": scores}))
        return pd.concat(found)

    pairs = data.groupBy("b", "q", "size").cogroup(queries.groupBy("b", "q", "size")).applyInPandas(
        meet, "query_id bigint, vec_id bigint, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= settings.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
