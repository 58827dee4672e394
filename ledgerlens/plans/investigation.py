"""Investigation questions over stored serving tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed
from ledgerlens.operators import cube as cubes
from ledgerlens.operators import explorer, rule_views, segments
from ledgerlens.operators.filters import Filters, cube_predicate, search_mode
from ledgerlens.operators.page_map import PageMap, next_page
from ledgerlens.operators.reason_index import ReasonIndex
from ledgerlens.session import path_exists, tune

NO_FILTER = Filters()
CACHED_CUBE_ROWS = 1_000_000


class Investigation:
    """Figures from the cube, rows from the partitioned ledger, rules and projection.

    The cube is kept in memory as one partition when it is small, so that its
    aggregations need no shuffle. Results are DataFrames.
    """

    def __init__(self, tables: Mapping[str, DataFrame], folder: str | None = None):
        self.folder = folder
        self.rows = tables["transactions"]
        self.rules = tables["rules"]
        self.projection = tables.get("projection")
        self.reasons = ReasonIndex(tables["reasons"], tables["postings"]) if "reasons" in tables else None
        cube = tables["cube"]
        small = cube.limit(CACHED_CUBE_ROWS + 1).count() <= CACHED_CUBE_ROWS
        self.cube = cube.coalesce(1).cache() if small else cube

    @classmethod
    def open(cls, spark: SparkSession, folder: str, with_projection: bool = True) -> Investigation:
        names = ["transactions", "cube", "rules", *(["projection"] if with_projection else [])]
        names += [n for n in ("reasons", "postings") if path_exists(spark, f"{folder}/{n}")]
        return cls({n: tune(spark).read.parquet(f"{folder}/{n}") for n in names}, folder)

    def ping(self) -> bool:
        return bool(self.cube.head(1))

    def get_kpi(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.kpi(self.cube, filters)

    def get_segment_summary(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.segment_summary(self.cube, filters)

    def get_cluster_profile(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.cluster_profile(self.cube, filters)

    def get_risk_summary(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.category_summary(self.cube, "risk_level", filters)

    def get_anomaly_type_summary(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.category_summary(self.cube, "anomaly_type", filters)

    def get_investigation_summary(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.category_summary(self.cube, "investigation_category", filters)

    def get_fraud_by_score(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.fraud_by_score_cube(self.cube, filters)

    def get_method_overlap(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.method_overlap_cube(self.cube, filters)

    def get_dest_type_breakdown(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.dimension_breakdown(self.cube, "jenis_tujuan", filters)

    def get_drain_status_breakdown(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.dimension_breakdown(self.cube, "status_kuras", filters)

    def get_transaction_type_breakdown(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.type_breakdown_cube(self.cube, filters)

    def get_segment_projection(self, filters: Filters = NO_FILTER, method: str | None = None, dim: int | None = None) -> DataFrame | None:
        return None if self.projection is None else segments.query_projection(self.projection, filters, method, dim)

    def get_rules(self, rule_group: str | None = None, min_lift: float = 0.0, search: str = "", limit: int | None = None, min_confidence: float = 0.0, attribute: str | None = None) -> DataFrame:
        return rule_views.get_rules(self.rules, rule_group, min_lift, search, limit, min_confidence, attribute)

    def count(self, filters: Filters = NO_FILTER) -> int:
        return cubes.count_filtered(self.cube, filters).first()["n"]

    def _page_scores(self, filters: Filters, needed: int, descending: bool) -> tuple[list[int], list[str]]:
        """Scores and risk levels that hold the first ``needed`` rows in score order, from the cube."""
        by_score = self.cube.filter(cube_predicate(filters)).groupBy("risk_score", "risk_level").agg(F.sum("n").alias("n"))
        scores, levels, covered, last = [], [], 0, None
        for r in sorted(by_score.collect(), key=lambda r: r["risk_score"], reverse=descending):
            if covered >= needed and r["risk_score"] != last:
                break
            last = r["risk_score"]
            scores.append(last)
            levels.append(r["risk_level"])
            covered += r["n"]
        return scores, levels

    def search_transactions(
        self, filters: Filters = NO_FILTER, sort_col: str = "risk_score", sort_dir: str = "desc", page: int = 1, page_size: int = 25
    ) -> tuple[DataFrame, int]:
        """One page and the total.

        Without filters, a stored page map of the order leads straight to the page's rows.
        When the cube can answer the filter and the order is by score, it first tells which
        scores the page can hold, so that only those risk levels' folders are read.
        """
        if self.folder and filters.is_empty():
            pages = PageMap(self.rows.sparkSession, self.folder, sort_col if sort_col in explorer.SORTABLE else "risk_score", sort_dir)
            if pages.exists():
                return pages.page(self.rows, page, page_size), self.count()
        found = search_mode(filters.search)
        rows, total = self.rows, None
        by_score = sort_col == "risk_score" or sort_col not in explorer.SORTABLE
        if found is None and not filters.has_amount:
            total = self.count(filters)
            if by_score:
                scores, levels = self._page_scores(filters, page * page_size, str(sort_dir).lower().startswith("desc"))
                rows = rows.filter(F.col("risk_score").isin(scores) & F.col("risk_level").isin(levels))
        if found and found.mode == "ilike" and self.reasons:
            rows, filters = self.reasons.free_text(rows, found.operand), replace(filters, search="")
        result = explorer.search_transactions(rows, filters, sort_col, sort_dir, page, page_size)
        if total is None:
            counted = explorer.capped_count(rows, filters) if found is None or found.mode != "id_exact" else result.agg(F.count("*").alias("n"))
            total = counted.first()["n"]
        return result, total

    def next_page(
        self, filters: Filters = NO_FILTER, sort_col: str = "risk_score", sort_dir: str = "desc", after: tuple | None = None, page_size: int = 25
    ) -> DataFrame:
        """The page after the row with this sort value and id."""
        return next_page(self.rows, filters, sort_col, sort_dir, after, page_size)

    def token_search(self, text: str, filters: Filters = NO_FILTER) -> DataFrame:
        """Word-wise search over reasons; through their index where it is stored."""
        if self.reasons is None:
            return explorer.token_search(self.rows, text, filters)
        return explorer.filter_rows(self.reasons.token_search(self.rows, text), replace(filters, search=""))

    def relevance(self, filters: Filters = NO_FILTER) -> DataFrame:
        return cubes.recommendation_relevance(self.cube, self.rules, filters)

    def check(self) -> DataFrame:
        return cubes.serving_table_check(self.rows, self.cube, self.rules, self.projection)

    def close(self) -> None:
        self.cube.unpersist()


SCENARIO_FILTERS = {
    "merchant": Filters(jenis_tujuan=(fixed.DEST_MERCHANT,)),
    "combined": Filters(jenis_tujuan=(fixed.DEST_MERCHANT,), status_kuras=(fixed.DRAINED,), risk_level=("Tinggi", "Kritis"), segmen=(1, 2)),
    "risky": Filters(risk_level=("Tinggi", "Kritis"), jenis_tujuan=(fixed.DEST_MERCHANT,), status_kuras=(fixed.DRAINED,)),
    "text": Filters(search="TX0001"),
}
