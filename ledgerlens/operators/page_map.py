"""Any page of an ordered table by a bounded read.

``offset`` makes every partition keep all rows before the page. A page map numbers the rows of
an order once and stores number, level and id in blocks of ``ROWS_PER_BLOCK`` numbers, each in
a folder of its own. A page opens the one or two blocks its numbers fall in, and then reads
its rows by level and id, by which the serving table is laid out. Filtered results, which
no map can number, go on from the last row shown instead (``next_page``).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.functions.ordering import with_global_index
from ledgerlens.operators.filters import Filters, row_predicate
from ledgerlens.session import path_exists

ROWS_PER_BLOCK = 1_000_000
FIELDS = "place bigint, transaction_id string, risk_level string"


def descending(sort_dir: str) -> bool:
    return str(sort_dir).lower().startswith("desc")


def sort_order(sort_col: str, sort_dir: str) -> list[Column]:
    """The order of a result: the column, then the id, which is unique."""
    return [F.desc(sort_col) if descending(sort_dir) else F.asc(sort_col), F.asc("transaction_id")]


@dataclass(frozen=True)
class PageMap:
    """A stored map of one order; ids must be unique for a page to have exactly its rows."""

    spark: SparkSession
    folder: str
    sort_col: str
    sort_dir: str
    rows_per_block: int = ROWS_PER_BLOCK

    @property
    def path(self) -> str:
        return f"{self.folder}/pages/{self.sort_col}-{'desc' if descending(self.sort_dir) else 'asc'}"

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/_SUCCESS")

    def save(self, serving: DataFrame) -> PageMap:
        slim = serving.select(*dict.fromkeys(["transaction_id", "risk_level", self.sort_col]))
        numbered = with_global_index(slim, *sort_order(self.sort_col, self.sort_dir), name="place")
        block = F.floor(F.col("place") / self.rows_per_block).alias("block")
        kept = numbered.select("place", "transaction_id", F.col("risk_level").cast("string").alias("risk_level"), block)
        kept.write.mode("overwrite").partitionBy("block").parquet(self.path)
        return self

    def places(self, page: int, page_size: int) -> DataFrame:
        """Numbers, ids and levels of a page's rows, from the blocks that hold them."""
        start = max(0, (page - 1) * page_size)
        blocks = range(start // self.rows_per_block, (start + page_size - 1) // self.rows_per_block + 1)
        paths = [p for b in blocks if path_exists(self.spark, p := f"{self.path}/block={b}")]
        reader = self.spark.read.schema(FIELDS)
        found = reader.parquet(*paths) if paths else self.spark.createDataFrame([], FIELDS)
        return found.filter((F.col("place") >= start) & (F.col("place") < start + page_size))

    def page(self, serving: DataFrame, page: int, page_size: int = 25) -> DataFrame:
        """The page's rows in order."""
        wanted = self.places(page, page_size).collect()  # a page at most
        levels = {r["risk_level"] for r in wanted}
        in_level = F.col("risk_level").isin([v for v in levels if v is not None])
        if None in levels:
            in_level = in_level | F.col("risk_level").isNull()
        rows = serving.filter(in_level & F.col("transaction_id").isin([r["transaction_id"] for r in wanted]))
        return _shown(rows.orderBy(*sort_order(self.sort_col, self.sort_dir)))


def _shown(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).alias(c) for c in fixed.RESULT_COLUMNS])


def _later(sort_col: str, sort_dir: str, value: Any, last_id: str) -> Column:
    """Rows that come after (value, id); nulls come last when falling and first when rising."""
    column, tie = F.col(sort_col), F.col("transaction_id") > F.lit(last_id)
    if value is None:
        same = column.isNull() & tie
        return same if descending(sort_dir) else same | column.isNotNull()
    same = (column == F.lit(value)) & tie
    if descending(sort_dir):
        return (column < F.lit(value)) | same | column.isNull()
    return (column > F.lit(value)) | same


def next_page(
    serving: DataFrame, filters: Filters = Filters(), sort_col: str = "risk_score", sort_dir: str = "desc",
    after: tuple[Any, str] | None = None, page_size: int = 25,
) -> DataFrame:
    """The page after the row with sort value and id ``after``, the first one without it.

    However deep the page, a partition keeps no more rows than a page has.
    """
    by = sort_col if sort_col in fixed.SORTABLE else "risk_score"
    matching = serving.filter(row_predicate(filters))
    if after is not None:
        matching = matching.filter(_later(by, sort_dir, *after))
    return _shown(matching.orderBy(*sort_order(by, sort_dir)).limit(page_size))
