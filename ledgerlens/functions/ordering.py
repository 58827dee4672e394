"""Consecutive row numbers over a stated order, numbered in parallel."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import pin_layout

_WITHIN_PARTITION = (1 << 33) - 1


def with_global_index(df: DataFrame, *order: str | Column, name: str = "row_index") -> DataFrame:
    """Add 0-based consecutive numbers following ``order`` (which must end in a unique key).

    A global ``row_number`` would sort everything in one task. Here rows are
    range-partitioned and sorted per partition, the layout is made durable, and each
    partition adds the number of rows before it. Only one count per partition reaches
    the driver.
    """
    spark = df.sparkSession
    laid_out = pin_layout(df.repartitionByRange(*order).sortWithinPartitions(*order))
    placed = laid_out.withColumns(
        {"_part": F.spark_partition_id(), name: F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN_PARTITION))}
    )
    sizes = sorted((r["_part"], r["count"]) for r in placed.groupBy("_part").count().collect())
    starts = accumulate((n for _, n in sizes), initial=0)
    offsets = spark.createDataFrame(
        [(part, start) for (part, _), start in zip(sizes, starts)], "_part int, _start long"
    )
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col(name) + F.col("_start"))
        .drop("_part", "_start")
    )
