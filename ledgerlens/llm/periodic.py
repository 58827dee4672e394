"""Periodic runs of words: maximal stretches that repeat with a short period.

A run is a stretch of consecutive words in which words ``period`` apart are equal, which no
neighbouring word extends, whose period is the smallest one, and which is at least
``times`` periods and ``shortest`` words long.

Runs with periods up to 5 are read off directly. Longer periods are found over string
synchronising sets. At scale t, a power of two, a position is selected when the hash of
the t words at it, or of the t words t further on, is the smallest of the t + 1 such hashes
from it on; windows whose own period is t / 3 at most take no part. Whether a position is
selected depends on the 2 t words from it on alone. Hence a run with a period p of
1.5 t <= p < 3 t holds two selected positions p apart with the same 2 t words:

- p <= 2 t: one of the run's first t positions is selected, since their 3 t - 1 words have no
  period of t / 3 or less, and 3 t + p <= 3 p leaves room for both contexts;
- p > 2 t: one of the run's first p positions is selected, since otherwise p + 2 t words in a
  row had a period of t / 3 or less, and 2 p + 2 t < 3 p leaves room.

Equal contexts of selected positions are more than t / 3 apart, so a position has at most
eight such partners within 3 t and no group of equal contexts is paired at large. A pair
proposes its distance as a period; comparing words then gives the whole stretch, or none.
The windows left out at a scale lie in runs of smaller scales, which are known by then.

Texts are joined in batches, with a word of its own between two texts, so that short texts
share the array work; texts too short for a scale leave the batch.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlens.llm.common import mix, prepare, whole_text

SMALL_PERIODS = 5
FIRST_SCALE = 4
PARTNERS = 8
WORDS_PER_BATCH = 1 << 17

_U = np.uint64
_NONE = np.iinfo(_U).max


@dataclass(frozen=True)
class Shape:
    """The least length of a run, in words and in periods; ``times`` must be 3 at least."""

    shortest: int = 24
    times: int = 3

    def __post_init__(self):
        if self.times < 3 or self.shortest < 3 * SMALL_PERIODS + 1:
            raise ValueError("runs need three periods and more than 15 words")

    def least(self, period: int) -> int:
        return max(self.shortest, self.times * period)


class Run(NamedTuple):
    start: int
    length: int
    period: int


# --- runs of one array of word numbers -------------------------------------------------


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).view(np.int8)))
    return edges[0::2], edges[1::2] - edges[0::2]


def _reach(words: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The widest stretch around ``at`` in which words ``period`` apart are equal, as start and end."""
    low, step = at, 64
    while low > 0:
        a = max(0, low - step)
        wrong = np.flatnonzero(words[a:low] != words[a + period : low + period])
        if len(wrong):
            low = a + int(wrong[-1]) + 1
            break
        low, step = a, 2 * step
    high, step, last = at, 64, len(words) - period
    while high < last:
        b = min(last, high + step)
        wrong = np.flatnonzero(words[high:b] != words[high + period : b + period])
        if len(wrong):
            high += int(wrong[0])
            break
        high, step = b, 2 * step
    return low, high + period


def _smallest_ahead(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width + 1`` keys from each position on; ``width`` is a power of two."""
    least, reach = keys, 1
    while reach < width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    return np.minimum(least[:-1], keys[width:])


class _Text:
    """The part of the batch that is still long enough, with its places in the whole batch."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray):
        self.place = np.arange(len(words))
        self.lengths = lengths  # of the texts, each followed by one separator
        self.hashes = mix(words.astype(_U) + _U(1))

    def keep(self, least: int) -> None:
        """Leave out texts of fewer than ``least`` words."""
        long = self.lengths >= least
        if long.sum() * 4 < 3 * len(long):
            mask = np.repeat(long, self.lengths + 1)[: len(self.hashes)]
            self.place, self.lengths = self.place[: len(mask)][mask], self.lengths[long]
            self.hashes = self.hashes[mask]

    def double(self, width: int) -> None:
        """From hashes of ``width`` words to hashes of twice as many."""
        with np.errstate(over="ignore"):
            ahead = np.zeros(len(self.hashes), _U)
            ahead[: len(ahead) - width] = self.hashes[width:]
            # A window that crosses the end of its batch has a separator or zeros in it.
            self.hashes = mix(self.hashes * _U(0x9E3779B97F4A7C15) + ahead + _U(width))


def _short_windows(runs: list[tuple[int, int]], width: int, size: int) -> np.ndarray:
    """Marks of the positions whose ``width`` words lie in one of the stretches (start, end)."""
    change = np.zeros(size + 1, np.int32)
    if runs:
        bounds = np.array(runs)
        inside = bounds[bounds[:, 1] - bounds[:, 0] >= width]
        np.add.at(change, inside[:, 0], 1)
        np.add.at(change, inside[:, 1] - width + 1, -1)
    return np.cumsum(change[:-1]) > 0


def find_runs(words: np.ndarray, lengths: np.ndarray, shape: Shape = Shape()) -> list[Run]:
    """All runs of the texts in ``words``: texts of the given lengths, each followed by a number that occurs once."""
    size = len(words)
    found: dict[tuple[int, int], int] = {}  # (start, end) -> smallest period
    periodic: list[tuple[int, int, int]] = []  # (start, end, period), also shorter ones for small periods
    for period in range(1, min(SMALL_PERIODS, size - 1) + 1):
        starts, equal = _stretches(words[period:] == words[:-period])
        wide = equal + period >= max(FIRST_SCALE, 3 * period)
        for start, length in zip(starts[wide].tolist(), (equal[wide] + period).tolist()):
            periodic.append((start, start + length, period))
            if length >= shape.least(period):
                found.setdefault((start, start + length), period)

    text, scale = _Text(words, lengths), 1
    while scale < FIRST_SCALE:
        text.double(scale)
        scale *= 2
    longest = int(lengths.max(initial=0))
    while shape.least(-(-3 * scale // 2)) <= longest:
        text.keep(shape.least(-(-3 * scale // 2)))
        for start, end, period in _proposed(words, text, scale, periodic):
            if end - start >= 3 * period:
                periodic.append((start, end, period))
            if end - start >= shape.least(period):
                found.setdefault((start, end), period)
        text.double(scale)
        scale *= 2
    # Smaller periods are found first, so a stretch has its smallest one.
    return [Run(start, end - start, period) for (start, end), period in found.items()]


def _proposed(words: np.ndarray, text: _Text, scale: int, periodic: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Stretches (start, end, period) that equal contexts at this scale propose, by period."""
    if len(text.hashes) < 2 * scale:
        return []
    small = [(start, end) for start, end, period in periodic if 3 * period <= scale]
    keys = text.hashes
    if small:
        keys = np.where(_short_windows(small, scale, len(words))[text.place], _NONE, keys)
    least = _smallest_ahead(keys, scale)
    chosen = np.flatnonzero(((keys[: len(least)] == least) | (keys[scale:] == least)) & (least != _NONE))
    if len(chosen) < 2:
        return []
    with np.errstate(over="ignore"):
        contexts = text.hashes[chosen] * _U(0xC2B2AE3D27D4EB4F) + mix(text.hashes[chosen + scale])
    order = np.lexsort((chosen, contexts))
    chosen, contexts = chosen[order], contexts[order]
    places, distances = [], []
    for ahead in range(1, PARTNERS + 1):
        same = contexts[ahead:] == contexts[:-ahead]
        if not same.any():
            break
        apart = chosen[ahead:] - chosen[:-ahead]
        fits = np.flatnonzero(same & (2 * apart >= 3 * scale) & (apart < 3 * scale))
        places.append(text.place[chosen[fits]])
        distances.append(apart[fits])
    if not places:
        return []
    at, period = np.concatenate(places), np.concatenate(distances)
    order = np.lexsort((at, period))
    result, done, last = [], -1, -1
    for p, i in zip(period[order].tolist(), at[order].tolist()):
        if p != last:
            last, done = p, -1
        if i < done:
            continue
        start, end = _reach(words, i, p)
        done = max(end - p, i + 1)
        result.append((start, end, p))
    return result


# --- texts and documents ---------------------------------------------------------------


def text_words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8: runs without space or bytes 9 to 13; null has none."""
    return (text or "").encode().split()


def runs_of(texts: Sequence[Sequence], shape: Shape = Shape()) -> list[list[Run]]:
    """The runs of every list of words, by start and then period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    numbers: dict = {}
    parts = []
    for i, words in enumerate(texts):
        parts.append(np.fromiter(map(numbers.setdefault, words, count(len(numbers))), np.int64, len(words)))
        parts.append(np.array([-1 - i]))
    if not parts:
        return []
    result: list[list[Run]] = [[] for _ in texts]
    starts = np.cumsum(lengths + 1) - lengths - 1
    for run in find_runs(np.concatenate(parts), lengths, shape):
        owner = int(np.searchsorted(starts, run.start, "right")) - 1
        result[owner].append(Run(run.start - int(starts[owner]), run.length, run.period))
    return [sorted(runs, key=lambda r: (r.start, r.period)) for runs in result]


def collapsed(words: list, runs: Sequence[Run]) -> list:
    """The words that are in no run, or only among the first ``period`` words of the runs they are in."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for run in runs:
        keep[run.start + run.period : run.start + run.length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def strongest(runs: Sequence[Run]) -> Run | None:
    """The run with the greatest length / period; ties go to the first, which has the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run.length * best.period > best.length * run.period:
            best = run
    return best


def _batched(words: list[list], shape: Shape) -> list[list[Run]]:
    """Runs of all texts, worked off in batches of about ``WORDS_PER_BATCH`` words, one text at least."""
    result, start, size = [], 0, 0
    for i, text in enumerate(words):
        if i > start and size + len(text) > WORDS_PER_BATCH:
            result.extend(runs_of(words[start:i], shape))
            start, size = i, 0
        size += len(text)
    result.extend(runs_of(words[start:], shape))
    return result


def looped(doc_id, words: list) -> list:
    """The words of a document with a planted run: of every tenth document, by the checksum of its id.

    A document without an id, and one without words, stays as it is.
    """
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


RUNS = "n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"


def digest(
    df: DataFrame, key: str = "doc_id", text: str = "text", shape: Shape = Shape(),
    changed: Callable[[object, list], list] | None = None,
) -> DataFrame:
    """One row per input row: its number of runs, its strongest run, and digests of all runs and of the collapsed text.

    ``changed`` may give other words than the text's, by key and words. Null and empty texts
    have no words and no runs; the four columns of the strongest run are null where there is
    none. Repeated rows each get their row; other columns are not read.
    """
    prepare(df.sparkSession)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            words = [text_words(t) for t in batch.column(1).to_pylist()]
            if changed:
                words = [changed(i, w) for i, w in zip(ids, words)]
            rows = []
            for own, runs in zip(words, _batched(words, shape)):
                best = strongest(runs)
                shown = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
                kept = b" ".join(collapsed(own, runs))
                rows.append((
                    len(own), len(runs), *((best.start, best.length, best.period, 1000 * best.length // best.period) if best else (None,) * 4),
                    hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
                ))
            names = [part.split()[0] for part in RUNS.split(", ")]
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *names])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, whole_text(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, {RUNS}")


def collapse_runs(df: DataFrame, text: str = "text", shape: Shape = Shape()) -> DataFrame:
    """All columns; texts with runs lose the repeats and have their remaining words joined by one space."""
    prepare(df.sparkSession)
    names, place = df.columns, df.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = batch.column(place).to_pylist()
            words = [text_words(t) for t in texts]
            fresh = [b" ".join(collapsed(w, r)).decode() if r else t for t, w, r in zip(texts, words, _batched(words, shape))]
            columns = list(batch.columns)
            columns[place] = pa.array(fresh, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, df.schema)
