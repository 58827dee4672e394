"""Suffix-array dedup: a depth-limited radix sort that finds every repeated byte window.

Suffixes are ordered by their first ``threshold`` bytes only, most significant digit first;
suffixes that stay together through the last digit are exactly the repeated windows. Groups
of one are dropped after every pass.

The first passes run over the whole corpus and must be small, so they take their digit at
anchors: a window's anchor is the leftmost of its smallest fingerprints of ``GRAM`` bytes,
so that every window belongs to one anchor, and an anchor to windows that start one after
another. Equal windows have their anchor at the same place, so they meet under its
fingerprint (first pass); most of these anchors are equal in all bytes of all windows that
belong to them, which settles all of those windows (second pass). For what is left, at the
edges of repeated passages, one occurrence per surrounding brings its bytes, and the windows
of the anchor go through the remaining passes in digits of ``DIGIT`` bytes; groups too large
for a task count their windows' fingerprints instead of sorting them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import mix, packed, powers, prepare, stored, unpack

_U = np.uint64
THRESHOLD = 200
GRAM = 32
DIGIT = 50
SURROUNDINGS_PER_TASK_GROUP = 20_000
ROWS_PER_SORT = 2_000
WINDOWS_AT_ONCE = 340_000
_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
_BASE = _U(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=1)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    return powers(_BASE, count), powers(_BASE_INVERSE, count)


class Fingerprints:
    """Fingerprints of any stretch of one text, from running sums."""

    def __init__(self, data: bytes):
        size = 1 << max(16, (len(data) + 1).bit_length())
        up, self._down = _powers(size)
        self.length = len(data)
        with np.errstate(over="ignore"):
            terms = _BYTE[np.frombuffer(data, np.uint8)] * up[: len(data)]
            self._sums = np.concatenate([np.zeros(1, _U), np.cumsum(terms, dtype=_U)])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])

    def every(self, width: int) -> np.ndarray:
        count = self.length - width + 1
        with np.errstate(over="ignore"):
            return mix((self._sums[width:] - self._sums[:count]) * self._down[:count])


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[: len(values) - step], values[step:])
        done += step
    return values


def anchors(data: bytes, threshold: int = THRESHOLD) -> tuple[np.ndarray, ...]:
    """Positions of a text's anchors, their fingerprints, those of their surroundings, and their room.

    Surroundings are all bytes of the windows that belong to the anchor, with the place of
    the anchor in them; the room is the number of these bytes before the anchor (upper 16
    bits) and from it on (lower 16 bits).
    """
    if len(data) < threshold:
        return np.empty(0, np.int64), np.empty(0, _U), np.empty(0, _U), np.empty(0, np.int32)
    prints, reach = Fingerprints(data), threshold - GRAM
    grams = prints.every(GRAM)
    smallest = _sliding(grams, reach + 1, np.minimum)
    padding = np.zeros(reach, _U)
    largest = _sliding(np.concatenate([padding, smallest, padding]), reach + 1, np.maximum)
    places = np.flatnonzero(largest == grams)
    # The anchor changes where the minimum does, and where the window leaves its anchor behind.
    left_behind = grams[: len(smallest) - 1] == smallest[:-1]
    first = np.flatnonzero(np.concatenate([[True], (smallest[1:] != smallest[:-1]) | left_behind]))
    last = np.concatenate([first[1:], [len(smallest)]]) - 1
    # The leftmost place from the first window's start on that has its minimum.
    values, rank = np.unique(grams[places], return_inverse=True)
    ranked = np.sort(rank * len(data) + places)
    base = np.searchsorted(values, smallest[first]) * len(data)
    place = ranked[np.searchsorted(ranked, base + first)] - base
    room = ((place - first) << 16) + (last + threshold - place)
    return place, smallest[first], mix(prints.of(first, last + threshold) ^ mix(room.astype(_U))), room.astype(np.int32)


def repeated_windows(surroundings: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray, threshold: int):
    """The last passes: which windows around anchors are repeated among the surroundings of their group.

    Row i has its anchor at column ``threshold - GRAM``, ``left`` bytes before it and
    ``right`` from it on that exist. Windows start at columns 0 to that one. Returns rows
    and start columns of the windows that occur more than once.
    """
    reach = threshold - GRAM
    up, down = _powers(1 << 16)
    digits = [*range(0, threshold - DIGIT, DIGIT), threshold - DIGIT]
    count = surroundings.shape[1] - DIGIT + 1
    prints = np.empty((len(surroundings), count), _U)
    # Some rows, then some columns at a time: a window only equals others of its column, and memory stays near that of the prints.
    step = max(1, WINDOWS_AT_ONCE // (reach + 1))
    with np.errstate(over="ignore"):
        for low in range(0, len(surroundings), step):
            terms = _BYTE[surroundings[low : low + step]] * up[: surroundings.shape[1]]
            sums = np.concatenate([np.zeros((len(terms), 1), _U), np.cumsum(terms, axis=1, dtype=_U)], axis=1)
            prints[low : low + step] = mix((sums[:, DIGIT:] - sums[:, :count]) * down[:count])
        rows, columns = [], []
        step = max(1, WINDOWS_AT_ONCE // max(1, len(surroundings)))
        for low in range(0, reach + 1, step):
            starts = np.arange(low, min(low + step, reach + 1))
            fits = (starts >= reach - left[:, None]) & (starts + threshold <= reach + right[:, None])
            row, column = np.nonzero(fits)
            column += low
            key = mix(group[row].astype(_U) * _U(reach + 1) + column.astype(_U))
            for digit in digits:
                key = mix(key ^ prints[row, column + digit])
                order = np.argsort(key, kind="stable")  # numpy's stable integer sort is a radix sort where it can
                same = key[order[1:]] == key[order[:-1]]
                together = np.zeros(len(key), bool)
                together[order[1:]] |= same
                together[order[:-1]] |= same
                row, column, key = row[together], column[together], key[together]
            rows.append(row)
            columns.append(column)
    return np.concatenate(rows), np.concatenate(columns)


def _runs(row: np.ndarray, column: np.ndarray, rows: int, reach: int, threshold: int) -> list[list[dict]]:
    """Covered stretches relative to the anchor, per row, from its repeated windows in order."""
    result: list[list[dict]] = [[] for _ in range(rows)]
    if len(row):
        order = np.lexsort((column, row))
        row, column = row[order], column[order]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (column[1:] > column[:-1] + threshold)])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(row)]]) - 1
        for r, a, b in zip(row[first].tolist(), column[first].tolist(), column[last].tolist()):
            result[r].append({"low": a - reach, "high": b - reach + threshold})
    return result


# --- Spark stages --------------------------------------------------------------------------

_SPANS = "array<struct<low:int,high:int>>"


def _documents(df: DataFrame) -> DataFrame:
    """doc_id and text with ``mark``, which tells the texts of one doc_id apart."""
    return df.select("doc_id", "text", F.hash(F.coalesce("text", F.lit(""))).alias("mark"))


def _anchor_rows(df: DataFrame, threshold: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, marks = batch.column(0), batch.column(2)
            found = [anchors((t or "").encode(), threshold) for t in batch.column(1).to_pylist()]
            owner = pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found]))
            if not len(owner):
                continue
            place, gram, around, room = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(gram.view(np.int64)), pa.array(around.view(np.int64)),
                    ids.take(owner), marks.take(owner), pa.array(place.astype(np.int32)), pa.array(room),
                ],
                names=["gram", "around", "doc_id", "mark", "place", "room"],
            )

    return df.mapInArrow(run, "gram bigint, around bigint, doc_id bigint, mark int, place int, room int")


def _with_bytes(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Bytes around the wanted anchors: (gram, around, times, doc_id, mark, place, left, right, bytes)."""
    per_text = wanted.groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("gram", "around", "times", "place", "room")).alias("wanted")
    )
    same = texts["doc_id"].eqNullSafe(per_text["doc_id"]) & (texts["mark"] == per_text["mark"])
    joined = texts.join(per_text, same).select(texts["doc_id"], texts["mark"], "packed", "wanted")

    def run(batches):
        names = ["gram", "around", "times", "doc_id", "mark", "place", "left", "right", "bytes"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), unpack(batch.column(2)), batch.column(3).to_pylist())
            for doc_id, mark, data, asked in rows:
                for w in asked:
                    place, left, right = w["place"], w["room"] >> 16, w["room"] & 0xFFFF
                    row = (w["gram"], w["around"], w["times"], doc_id, mark, place, left, right, data[place - left : place + right])
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return joined.mapInArrow(
        run,
        "gram bigint, around bigint, times bigint, doc_id bigint, mark int, place int, left int, right int, bytes binary",
    )


def _matrix(batch_bytes: list[bytes], left: np.ndarray, threshold: int) -> np.ndarray:
    """Surroundings as rows of equal width, anchors in one column."""
    reach = threshold - GRAM
    matrix = np.zeros((len(batch_bytes), reach + threshold), np.uint8)
    for i, (data, before) in enumerate(zip(batch_bytes, left.tolist())):
        matrix[i, reach - before : reach - before + len(data)] = np.frombuffer(data, np.uint8)
    return matrix


def _sorted_groups(rows: DataFrame, threshold: int) -> DataFrame:
    """Repeated stretches around single occurrences, group by group: (doc_id, mark, place, spans)."""
    reach = threshold - GRAM

    def settle(block: list[dict]) -> pa.RecordBatch:
        left = np.array([r["left"] for r in block])
        right = np.array([r["right"] for r in block])
        group = np.unique(np.array([r["gram"] for r in block]), return_inverse=True)[1]
        matrix = _matrix([r["bytes"] for r in block], left, threshold)
        spans = _runs(*repeated_windows(matrix, left, right, group, threshold), len(block), reach, threshold)
        kept = [i for i, r in enumerate(block) if r["times"] == 1 and spans[i]]
        kinds = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block[i]["doc_id"] for i in kept], pa.int64()),
                pa.array([block[i]["mark"] for i in kept], pa.int32()),
                pa.array([block[i]["place"] for i in kept], pa.int32()),
                pa.array([spans[i] for i in kept], kinds),
            ],
            names=["doc_id", "mark", "place", "spans"],
        )

    def run(batches):
        block: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(block) >= ROWS_PER_SORT and block[-1]["gram"] != row["gram"]:
                    yield settle(block)
                    block = []
                block.append(row)
        if block:
            yield settle(block)

    dealt = rows.repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, f"doc_id bigint, mark int, place int, spans {_SPANS}")


def _dealt_windows(rows: DataFrame, threshold: int) -> DataFrame:
    """The same for groups too large for a task: every window is a row, and equal ones are counted."""
    reach = threshold - GRAM

    def windows(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                left, right = (part.column(name).to_numpy() for name in ("left", "right"))
                data = part.column("bytes").to_pylist()
                index, column, first, second = [], [], [], []
                for i in range(len(data)):
                    prints = Fingerprints(data[i])
                    begin = np.arange(0, len(data[i]) - threshold + 1)
                    begin = begin[begin <= left[i]]
                    index += [i] * len(begin)
                    column.append(begin + reach - left[i])
                    first.append(prints.of(begin, begin + threshold // 2).view(np.int64))
                    second.append(prints.of(begin + threshold // 2, begin + threshold).view(np.int64))
                if index:
                    taken = part.select(["gram", "doc_id", "mark", "place", "times"]).take(pa.array(index))
                    added = [np.concatenate(c) for c in (column, first, second)]
                    yield pa.RecordBatch.from_arrays(
                        [*taken.columns, pa.array(added[0].astype(np.int32)), pa.array(added[1]), pa.array(added[2])],
                        names=["gram", "doc_id", "mark", "place", "times", "start", "first", "second"],
                    )

    each = rows.mapInArrow(
        windows,
        "gram bigint, doc_id bigint, mark int, place int, times bigint, start int, first bigint, second bigint",
    )
    same = ["gram", "start", "first", "second"]
    repeated = each.groupBy(*same).count().filter("count > 1").drop("count")
    hits = each.join(repeated, same, "left_semi").filter("times = 1")
    span = F.struct((F.col("start") - reach).alias("low"), (F.col("start") - reach + threshold).alias("high"))
    return hits.groupBy("doc_id", "mark", "place").agg(F.collect_list(span).alias("spans"))


def find_repeats(df: DataFrame, texts: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per text with repeats: doc_id, mark, and ``found``: places with the stretches around them that repeat."""
    rows = _anchor_rows(_documents(df), threshold)  # twice: cheaper than keeping all anchors on disk
    # First pass: fingerprints that occur more than once.
    more = rows.groupBy("gram").count().filter("count > 1").select("gram")
    rows = stored(rows.join(more, "gram", "left_semi"))
    # Second pass: all bytes of the windows that belong to the anchor are equal.
    classes = rows.groupBy("gram", "around").agg(
        F.count("*").alias("times"), F.min(F.struct("doc_id", "mark", "place", "room")).alias("one")
    )
    classes = stored(classes)
    whole = rows.join(classes.filter("times > 1").select("gram", "around"), ["gram", "around"], "left_semi")
    settled = whole.select(
        "doc_id", "mark", "place",
        F.array(F.struct((-F.shiftright("room", 16)).alias("low"), F.col("room").bitwiseAND(0xFFFF).alias("high"))).alias("spans"),
    )
    # The other passes: groups in which some surroundings occur once.
    groups = classes.groupBy("gram").agg(F.count("*").alias("members"), F.min("times").alias("fewest"))
    groups = groups.filter("members > 1 AND fewest = 1").select("gram", "members")
    wanted = classes.join(groups, "gram").select("gram", "around", "times", "one.*")
    around = _with_bytes(texts, wanted)
    large = groups.filter(F.col("members") > SURROUNDINGS_PER_TASK_GROUP).select("gram")
    if large.isEmpty():
        edges = _sorted_groups(around, threshold)
    else:
        around = stored(around)
        edges = _sorted_groups(around.join(large, "gram", "left_anti"), threshold).unionByName(
            _dealt_windows(around.join(large, "gram", "left_semi"), threshold)
        )
    return settled.unionByName(edges).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("place", "spans")).alias("found"))


def removed_runs(length: int, found: list[dict]) -> list[tuple[int, int]]:
    """Maximal covered byte ranges of a text of that many bytes."""
    stretches = sorted(
        (max(0, f["place"] + s["low"]), min(length, f["place"] + s["high"])) for f in found for s in f["spans"]
    )
    runs: list[tuple[int, int]] = []
    for low, high in stretches:
        if runs and low <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], high))
        else:
            runs.append((low, high))
    return runs


def without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, place = [], 0
    for low, high in runs:
        parts.append(data[place:low])
        place = high
    return b"".join([*parts, data[place:]])


def _with_found(df: DataFrame, threshold: int, *columns: str) -> DataFrame:
    """All rows: the columns under names of our own, packed text, and the repeats found in it (null for none)."""
    names = [f"column_{i}" for i in range(len(columns))]
    kept = [F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)]
    marked = df.select(*kept, F.col("doc_id").alias("owner"), "text", F.hash(F.coalesce("text", F.lit(""))).alias("mark"))
    found = find_repeats(df, packed(_documents(df), "doc_id", "mark"), threshold)
    texts = packed(marked, *names, "owner", "mark")
    same = texts["owner"].eqNullSafe(found["doc_id"]) & (texts["mark"] == found["mark"])
    return texts.join(found, same, "left").select(*(texts[n] for n in names), texts["packed"], found["found"])


def digest(df: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, hash of the kept bytes.

    A byte goes when a window of ``threshold`` bytes that covers it starts anywhere else
    too, in the same text or another; texts shorter than that stay whole, and null texts
    are empty. Repeated rows are texts of their own, so they lose all their windows.
    """

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for data, found in zip(unpack(batch.column(1)), batch.column(2).to_pylist()):
                runs = removed_runs(len(data), found or [])
                out[0].append(len(data))
                out[1].append(sum(high - low for low, high in runs))
                out[2].append(len(runs))
                out[3].append(hashlib.sha256(without(data, runs)).hexdigest())
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out)], names=names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return _with_found(df, threshold, "doc_id").mapInArrow(run, schema)


def remove_repeats(df: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """All columns and rows of ``df``, repeated stretches cut out of the text.

    Characters that a cut would split go whole. A null text becomes an empty one.
    """
    names = df.columns
    others = [c for c in names if c != "text"]

    def run(batches):
        for batch in batches:
            texts = []
            for data, found in zip(unpack(batch.column(len(others))), batch.column(len(others) + 1).to_pylist()):
                texts.append(without(data, removed_runs(len(data), found or [])).decode("utf-8", errors="ignore"))
            arrays = dict(zip(others, batch.columns)) | {"text": pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([arrays[c] for c in names], names=names)

    return _with_found(df, threshold, *others).mapInArrow(run, df.schema)
