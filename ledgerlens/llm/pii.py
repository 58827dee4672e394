"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score.

The four base kinds (email, ip, card, phone) are kept whatever their score. The further
kinds (iban, ssn) need their checksum or number rules and a score of at least
``MINIMUM_SCORE``, which context words raise.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import prepare, whole_text

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
MINIMUM_SCORE = 0.5
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
START_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
CONTEXT_WORDS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "account", "bank"),
    "ssn": ("ssn", "social security"),
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits either matches from its first digit or not at all.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    moved = plain[4:] + plain[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern, found from their @ signs so that long runs cost their length once."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    plain = part.lstrip("0")
    return len(plain) <= 3 and int(plain or "0") <= 255


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans of every kind, before their scores."""
    for start, end in _emails(text):
        yield "email", start, end
    for m in _IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for m in _IBAN.finditer(text):
        if mod97(m[0]):
            yield "iban", m.start(), m.end()
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "ssn", m.start(), m.end()


def find_spans(text: str) -> list[Span]:
    """All spans of a text by kind, then start; ends are exclusive, positions are code points."""
    found = []
    for kind, start, end in _proposed(text):
        near = (text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]).lower()
        bonus = CONTEXT_BONUS if any(word in near for word in CONTEXT_WORDS[kind]) else 0.0
        score = min(1.0, START_SCORE[kind] + bonus)
        if kind in BASE_KINDS or score >= MINIMUM_SCORE:
            found.append(Span(kind, start, end, score))
    return found


def mask(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    parts, place = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= place:
            parts += [text[place : span.start], f"[{span.kind.upper()}]"]
        place = max(place, span.end)
    return "".join(parts) + text[place:]


def detect(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, spans (kind, start, end, score). Null and empty texts have no spans."""
    fields = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches):
        for batch in batches:
            spans = [[s._asdict() for s in find_spans(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(fields))], names=[key, "spans"])

    prepare(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(key, whole_text(text).alias("_text"))
    return rows.mapInArrow(run, f"`{key}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def mask_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns and rows of ``df``, personal data in the text masked; a null text stays null."""
    prepare(df.sparkSession)
    names, place = df.columns, df.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = [t if t is None else mask(t, find_spans(t)) for t in batch.column(place).to_pylist()]
            arrays = list(batch.columns)
            arrays[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, df.schema)


def digest(df: DataFrame) -> DataFrame:
    """Counts per base kind, the hash of the base spans and all spans, per document."""

    def joined(spans: list[dict]) -> str:
        return ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans)

    def run(batches):
        for batch in batches:
            out: dict[str, list] = {name: [] for name in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
            for spans in batch.column(1).to_pylist():
                base = [s for s in spans if s["kind"] in BASE_KINDS]
                for kind in BASE_KINDS:
                    out[f"n_{kind}"].append(sum(s["kind"] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out.values())], names=["doc_id", *out])

    counts = ", ".join(f"n_{kind} bigint" for kind in BASE_KINDS)
    return detect(df).mapInArrow(run, f"doc_id bigint, {counts}, base_sha256 string, spans string")
