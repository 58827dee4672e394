"""Transaction search with paging, and the choice of table that answers its total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.operators import cube as cubes
from ledgerlens.operators.filters import Filters, cube_predicate, row_predicate, search_mode, token_predicate

COUNT_CAP, SORTABLE, RESULT_COLUMNS = fixed.COUNT_CAP, fixed.SORTABLE, fixed.RESULT_COLUMNS


def search_transactions(
    serving: DataFrame, filters: Filters = Filters(), sort_col: str = "risk_score", sort_dir: str = "desc", page: int = 1, page_size: int = 25
) -> DataFrame:
    """One page of matching rows; ties are ordered by id so that pages never overlap."""
    by = sort_col if sort_col in SORTABLE else "risk_score"
    direction = F.desc if str(sort_dir).lower().startswith("desc") else F.asc
    found = search_mode(filters.search)
    matching = serving.filter(row_predicate(filters))
    ordered = matching.orderBy("transaction_id") if found and found.mode == "id_exact" else matching.orderBy(direction(by), "transaction_id")
    shown = [F.col(c) if c in serving.columns else F.lit(None).alias(c) for c in RESULT_COLUMNS]
    return ordered.offset(max(0, (page - 1) * page_size)).limit(page_size).select(*shown)


def capped_count(serving: DataFrame, filters: Filters = Filters(), cap: int = COUNT_CAP) -> DataFrame:
    """Matching rows, counted no further than the cap: a page list never goes beyond it."""
    return serving.filter(row_predicate(filters)).agg(F.least(F.count("*"), F.lit(cap).cast("long")).alias("n"))


def count_routing(serving: DataFrame, cube: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """The total from the cheapest table that knows it, and which one that was."""
    found = search_mode(filters.search)
    if found is None and not filters.has_amount:
        return cubes.count_filtered(cube, filters).select("n", F.lit("cube").alias("source"))
    if found and found.mode == "id_exact":
        exact = serving.filter(row_predicate(filters)).agg(F.count("*").alias("n"))
        return exact.select("n", F.lit("rows").alias("source"))
    return capped_count(serving, filters).select("n", F.lit("capped").alias("source"))


def token_search(serving: DataFrame, text: str, filters: Filters = Filters()) -> DataFrame:
    """Word-wise search over reasons, under the same structured filters."""
    structured = Filters.from_dict({**filters.__dict__, "search": ""})
    return serving.filter(row_predicate(structured) & token_predicate(text))


def page_bounds(total: DataFrame, page_size: int = 25, reachable: int = 50_000) -> DataFrame:
    """Highest page number for a one-row total."""
    pages = F.ceil(F.least("n", F.lit(reachable)) / page_size).cast("long")
    return total.select("n", F.greatest(F.lit(1).cast("long"), pages).alias("max_page"))


def filter_rows(serving: DataFrame, filters: Filters) -> DataFrame:
    return serving.filter(row_predicate(filters))


def filter_cube(cube: DataFrame, filters: Filters) -> DataFrame:
    return cube.filter(cube_predicate(filters))
