"""Free text and word search over reasons through an index of the distinct reasons.

A ledger has far fewer different reasons than rows. Each gets a number that the serving rows
carry; a dictionary holds number and text, postings hold the numbers of every word. A search
reads these two tables and leaves the rows with a condition on a number, which the scan
takes over; no row's text is split or compared.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.ordering import with_global_index
from ledgerlens.functions.skew import join_by_key
from ledgerlens.session import cut_lineage

MOST_LITERALS = 1_000


@dataclass(frozen=True)
class ReasonIndex:
    """``reasons``: reason_id, anomaly_reason; ``postings``: token, reason_id."""

    reasons: DataFrame
    postings: DataFrame

    @staticmethod
    def build(serving: DataFrame) -> tuple[ReasonIndex, DataFrame]:
        """The index, and the rows with ``reason_id`` (null where there is no reason)."""
        counted = serving.filter(F.col("anomaly_reason").isNotNull()).groupBy("anomaly_reason").agg(F.count("*").alias("n"))
        numbered = cut_lineage(with_global_index(counted, "anomaly_reason", name="reason_id"))
        tokens = F.explode(F.array_distinct(F.split(F.lower("anomaly_reason"), r"\W+")))
        postings = numbered.select(tokens.alias("token"), "reason_id").filter("token <> ''")
        index = ReasonIndex(numbered.select("reason_id", "anomaly_reason"), postings)
        return index, join_by_key(serving, numbered, ["anomaly_reason"], "n", "left")

    def with_any_word(self, text: str) -> DataFrame:
        """Numbers of the reasons that hold at least one of the text's words."""
        words = [w for w in re.split(r"\W+", text.lower()) if w]
        return self.postings.filter(F.col("token").isin(words)).select("reason_id").distinct()

    def containing(self, text: str) -> DataFrame:
        """Numbers of the reasons that contain the text as a case-blind pattern."""
        return self.reasons.filter(F.ilike(F.col("anomaly_reason"), F.lit(f"%{text}%"))).select("reason_id")

    def token_search(self, rows: DataFrame, text: str) -> DataFrame:
        """Rows whose reason has a word of the text, or whose id is the text."""
        return _rows_with(rows, self.with_any_word(text), F.col("transaction_id") == text)

    def free_text(self, rows: DataFrame, text: str) -> DataFrame:
        """Rows whose reason or id contains the text."""
        return _rows_with(rows, self.containing(text), F.ilike(F.col("transaction_id"), F.lit(f"%{text}%")))


def _rows_with(rows: DataFrame, found: DataFrame, by_id: Column) -> DataFrame:
    """Few numbers become literals that the scan filters by; more are joined."""
    numbers = [r["reason_id"] for r in found.limit(MOST_LITERALS + 1).collect()]
    if len(numbers) <= MOST_LITERALS:
        return rows.filter(F.col("reason_id").isin(numbers) | by_id)
    marked = rows.join(found.withColumn("_found", F.lit(True)), "reason_id", "left")
    return marked.filter(F.coalesce("_found", F.lit(False)) | by_id).select(*rows.columns)
