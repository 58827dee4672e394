"""Finding equal rows without shuffling all of them whole.

A row's 128-bit digest is counted first; only rows whose digest occurs more than once are
compared in full. Digests that meet by chance cost a comparison and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.skew import join_by_key
from ledgerlens.session import cut_lineage

HALVES = ("_digest_a", "_digest_b")


def digest_halves(columns: Sequence[str]) -> dict[str, Column]:
    """Two independent 64-bit hashes of the named columns."""
    values = [F.col(f"`{c}`") for c in columns]
    return {HALVES[0]: F.xxhash64(*values), HALVES[1]: F.xxhash64(F.lit(7), *reversed(values))}


def repeated_digests(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both halves and the number of rows (``_copies``) of the digests that more than one row has; stored."""
    halves = df.select(*[h.alias(name) for name, h in digest_halves(columns).items()])
    return cut_lineage(halves.groupBy(*HALVES).agg(F.count("*").alias("_copies")).filter(F.col("_copies") > 1))


def split_by_digest(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows that no other row can equal in ``columns``, and the rest; hot digests are joined by broadcast."""
    table = repeated_digests(df, columns).withColumn("_again", F.lit(True))
    marked = join_by_key(df.withColumns(digest_halves(columns)), table, list(HALVES), "_copies", "left")
    return tuple(marked.filter(side).drop(*HALVES, "_again") for side in (F.col("_again").isNull(), F.col("_again").isNotNull()))
