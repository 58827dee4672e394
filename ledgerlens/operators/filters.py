"""Investigation filters and free-text search, compiled to column predicates."""

from __future__ import annotations

import re
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions import fixed_values as fixed

# filter field -> table column
CATEGORY_FIELDS = {
    "jenis_tujuan": "jenis_tujuan",
    "status_kuras": "status_kuras",
    "jenis_transaksi": "transaction_type",
    "segmen": "cluster_kmeans",
    "risk_level": "risk_level",
    "investigation_category": "investigation_category",
    "anomaly_type": "anomaly_type",
}
ID_TEXT = re.compile(r"^TX?\d+$", re.IGNORECASE)
ID_LENGTH = 10


@dataclass(frozen=True)
class Filters:
    """Seven value lists, a search text and two ranges. An empty field sets no condition."""

    jenis_tujuan: tuple = ()
    status_kuras: tuple = ()
    jenis_transaksi: tuple = ()
    segmen: tuple = ()
    risk_level: tuple = ()
    investigation_category: tuple = ()
    anomaly_type: tuple = ()
    search: str = ""
    amount_min: float | None = None
    amount_max: float | None = None
    risk_score_min: int | None = None
    risk_score_max: int | None = None

    @classmethod
    def from_dict(cls, values: dict | None) -> Filters:
        known = {f.name for f in fields(cls)}
        given = {k: v for k, v in (values or {}).items() if k in known and v not in (None, [], (), "")}
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in given.items()})

    def is_empty(self) -> bool:
        return self == Filters()

    @property
    def has_amount(self) -> bool:
        return self.amount_min is not None or self.amount_max is not None


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


def cube_predicate(filters: Filters) -> Column:
    """Value lists and score range: everything a cube row can answer."""
    conditions = []
    for name, column in CATEGORY_FIELDS.items():
        values = getattr(filters, name)
        if values:
            wanted = [int(v) for v in values] if name == "segmen" else list(values)
            conditions.append(F.col(column).isin(wanted))
    if filters.risk_score_min is not None:
        conditions.append(F.col("risk_score") >= int(filters.risk_score_min))
    if filters.risk_score_max is not None:
        conditions.append(F.col("risk_score") <= int(filters.risk_score_max))
    return all_of(conditions)


@dataclass(frozen=True)
class Search:
    """How a search text is understood: by exact id, id prefix, method word or substring."""

    mode: str
    operand: str

    def predicate(self) -> Column:
        if self.mode == "id_exact":
            return F.col("transaction_id") == self.operand
        if self.mode == "id_prefix":
            return F.col("transaction_id").startswith(self.operand)
        if self.mode == "keyword":
            return F.col(self.operand).cast("boolean")
        needle = F.lit(f"%{self.operand}%")
        return F.ilike(F.col("transaction_id"), needle) | F.ilike(F.col("anomaly_reason"), needle)


def search_mode(text: str) -> Search | None:
    """Decide the search mode; ids are completed to the TX form, whole ones match exactly."""
    if not text:
        return None
    text = text.strip()
    if ID_TEXT.match(text):
        wanted = "TX" + text.upper().lstrip("T").lstrip("X")
        if len(wanted) >= ID_LENGTH:
            return Search("id_exact", wanted)
        return Search("id_prefix", wanted)
    flag = fixed.SEARCH_KEYWORDS.get(text.lower())
    return Search("keyword", flag) if flag else Search("ilike", text)


def row_predicate(filters: Filters) -> Column:
    """The cube conditions plus amount range and search, for the row table."""
    conditions = [cube_predicate(filters)]
    if filters.amount_min is not None:
        conditions.append(F.col("amount") >= float(filters.amount_min))
    if filters.amount_max is not None:
        conditions.append(F.col("amount") <= float(filters.amount_max))
    found = search_mode(filters.search)
    if found:
        conditions.append(found.predicate())
    return all_of(conditions)


def token_predicate(text: str) -> Column:
    """Word search: any query word is a word of the reason, or the text is the id itself."""
    words = [w for w in re.split(r"\W+", text.lower()) if w]
    reason = F.split(F.lower("anomaly_reason"), r"\W+")
    by_word = F.arrays_overlap(reason, F.array(*[F.lit(w) for w in words])) if words else F.lit(False)
    return F.coalesce(by_word, F.lit(False)) | (F.col("transaction_id") == text)
