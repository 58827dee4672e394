"""Line dedup: lines that many documents share stay in one document only.

Two Bloom filters go over the hashes of the lines, each taken once per document: the first
holds what was seen, and a hash that the first knows already goes into the second. Only
lines that the second filter knows are suspected repeats; only they leave their task, for
an exact count of documents and the choice of the one that keeps the line.

The first filter is as large as the corpus needs and is never in one place: hashes are
dealt into segments by range, each with a filter of its own that one task fills, and a task
sends a hash once, however often the line occurs in its documents. The second filter has a
fixed size, ``Repeats.suspect_bytes``; it is what travels to all tasks. With more repeats
than it can tell apart, more lines are suspected and counted, but none is missed.

Lines are told apart by 128-bit BLAKE2b digests of their keys. A line's key is the line
without space and bytes 9 to 13 at both ends, with A-Z as a-z.

Defined cases: a null or empty text is one empty line. Rows with one doc_id are one document
when documents are counted, and so are all rows without an id, which come before every other
document; each row has its own output. Where a line stays, all its repeats within that
document stay as well.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.skew import join_by_key
from ledgerlens.llm.common import mix, prepare, stored, whole_text

_U = np.uint64
_LOW = _U(0xFFFFFFFF)
_BLANK = b" \t\n\x0b\x0c\r"
HASHES_AT_ONCE = 400_000
INPUT_BYTES_PER_LINE = 100


@dataclass(frozen=True)
class Repeats:
    """Keys of ``shortest`` code points and more, in ``documents`` documents and more.

    ``segment`` is the number of hashes that a segment of the first filter is made for, with
    16 bits each; ``suspect_bytes`` is the size of the second filter.
    """

    shortest: int = 40
    documents: int = 5
    segment: int = 1 << 21
    suspect_bytes: int = 1 << 24


# --- lines -----------------------------------------------------------------------------


def lines_of(text: str) -> list[bytes]:
    return text.encode().split(b"\n")


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANK).lower()


def _long_enough(key: bytes, shortest: int) -> bool:
    return len(key) >= shortest and (len(key) >= 4 * shortest or len(key.decode()) >= shortest)


def long_keys(text: str, shortest: int) -> set[bytes]:
    """The distinct keys of a text that may be repeats."""
    keys = {line_key(line) for line in lines_of(text) if len(line) >= shortest}
    return {k for k in keys if _long_enough(k, shortest)}


def key_digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


# --- the filters -----------------------------------------------------------------------


def _bits(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Five of the 64 bits of a word for every hash (fewer where they coincide)."""
    with np.errstate(over="ignore"):
        spread = mix(hashes ^ _U(salt))
    mask = np.zeros(len(hashes), _U)
    for i in range(5):
        mask |= _U(1) << ((spread >> _U(6 * i)) & _U(63))
    return mask


class SeenOnce:
    """The first filter's part for one segment of hashes."""

    def __init__(self, words: int):
        self._words = np.zeros(words, _U)

    def add(self, hashes: np.ndarray) -> np.ndarray:
        """Add distinct hashes; those that were there already (or seem so) come back."""
        # The segment is chosen by the high bits, the word by the low ones.
        place = ((hashes & _LOW) * _U(len(self._words))) >> _U(32)
        mask = _bits(hashes, 0x5EE4)
        known = (self._words[place] & mask) == mask
        np.bitwise_or.at(self._words, place, mask)
        return hashes[known]


class SeenTwice:
    """The second filter, or a range of its words; hashes are in the order of its words."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def place(hashes: np.ndarray, words: int) -> np.ndarray:
        return ((hashes >> _U(32)) * _U(words)) >> _U(32)

    def add(self, hashes: np.ndarray) -> None:
        np.bitwise_or.at(self.words, self.place(hashes, len(self.words)), _bits(hashes, 0x2ECE))

    def knows(self, hashes: np.ndarray) -> np.ndarray:
        mask = _bits(hashes, 0x2ECE)
        return (self.words[self.place(hashes, len(self.words))] & mask) == mask


def _hash_rows(hashes: list[int], segments: int) -> pa.RecordBatch:
    """One row per segment: its distinct hashes, and those of them that came more than once."""
    values, counts = np.unique(np.array(hashes, _U), return_counts=True)
    segment = ((values >> _U(32)) * _U(segments)) >> _U(32)
    found, starts = np.unique(segment, return_index=True)
    once, again = [], []
    for a, b in zip(starts, [*starts[1:], len(values)]):
        once.append(values[a:b].tobytes())
        again.append(values[a:b][counts[a:b] > 1].tobytes())
    columns = [pa.array(found.astype(np.int64)), pa.array(once, pa.binary()), pa.array(again, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["segment", "once", "again"])


def _line_hashes(df: DataFrame, text: str, settings: Repeats, segments: int) -> DataFrame:
    def run(batches):
        held: list[int] = []
        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.extend(map(xxhash.xxh3_64_intdigest, long_keys(t, settings.shortest)))
                if len(held) >= HASHES_AT_ONCE:
                    yield _hash_rows(held, segments)
                    held = []
        if held:
            yield _hash_rows(held, segments)

    return df.select(whole_text(text).alias("_text")).mapInArrow(run, "segment bigint, once binary, again binary")


def _segment_filters(rows: DataFrame, settings: Repeats) -> DataFrame:
    """Per segment that holds repeats: a range of the second filter's words, compressed, and where it starts."""
    once_words, twice_words = settings.segment // 4, settings.suspect_bytes // 8

    def finish(suspects: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate(suspects) if suspects else np.empty(0, _U)
        if not len(hashes):
            return
        place = SeenTwice.place(hashes, twice_words)
        first, last = int(place.min()), int(place.max())
        words = np.zeros(last - first + 1, _U)
        np.bitwise_or.at(words, place - _U(first), _bits(hashes, 0x2ECE))
        data = zstandard.ZstdCompressor(level=1).compress(words.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([data], pa.binary())], names=["first", "words"])

    def run(batches):
        segment, seen, suspects = None, None, []
        for batch in batches:
            for at, once, again in zip(*(c.to_pylist() for c in batch.columns)):
                if at != segment:
                    yield from finish(suspects)
                    segment, seen, suspects = at, SeenOnce(once_words), []
                suspects.append(np.frombuffer(again, _U))
                suspects.append(seen.add(np.frombuffer(once, _U)))
        yield from finish(suspects)

    spread = rows.repartition("segment").sortWithinPartitions("segment")
    return spread.mapInArrow(run, "first bigint, words binary")


def suspect_filter(df: DataFrame, text: str = "text", settings: Repeats = Repeats()) -> bytes:
    """The second filter over all texts, compressed; at most ``suspect_bytes`` come to the driver."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    segments = max(1, size // (INPUT_BYTES_PER_LINE * settings.segment))
    words = np.zeros(settings.suspect_bytes // 8, _U)
    expand = zstandard.ZstdDecompressor()
    for row in _segment_filters(_line_hashes(df, text, settings, segments), settings).toLocalIterator():
        part = np.frombuffer(expand.decompress(bytes(row["words"])), _U)
        words[row["first"] : row["first"] + len(part)] |= part
    return zstandard.ZstdCompressor(level=1).compress(words.tobytes())


# --- suspected lines and what goes -----------------------------------------------------


def suspected_lines(df: DataFrame, filter_data: bytes, key: str = "doc_id", text: str = "text", settings: Repeats = Repeats()) -> DataFrame:
    """doc_id and digest of every distinct line of a document that the second filter knows."""
    shipped = df.sparkSession.sparkContext.broadcast(filter_data)

    def run(batches):
        twice = SeenTwice(np.frombuffer(zstandard.ZstdDecompressor().decompress(shipped.value), _U))
        for batch in batches:
            keys, owners = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                own = long_keys(t, settings.shortest)
                keys.extend(own)
                owners.extend([i] * len(own))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), _U, len(keys))
            known = np.flatnonzero(twice.knows(hashes)).tolist()
            ids = batch.column(0).take(pa.array([owners[i] for i in known], pa.int64()))
            digests = pa.array([key_digest(keys[i]) for i in known], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, digests], names=["doc_id", "digest"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, whole_text(text).alias("_text")).mapInArrow(run, f"doc_id {kind}, digest binary")


def repeated_lines(suspects: DataFrame, settings: Repeats = Repeats()) -> DataFrame:
    """digest, number of documents and the largest doc_id of the lines in enough documents.

    Documents are made distinct by line and document, so that a line of a third of the
    corpus meets in no task; counts are summed up before they travel.
    """
    found = suspects.distinct().groupBy("digest").agg(F.count("*").alias("documents"), F.max("doc_id").alias("last"))
    return found.filter(F.col("documents") >= settings.documents)


def lines_to_drop(df: DataFrame, key: str = "doc_id", text: str = "text", settings: Repeats = Repeats()) -> DataFrame:
    """doc_id and the digests of the lines that it loses, for documents that lose any."""
    prepare(df.sparkSession)
    suspects = stored(suspected_lines(df, suspect_filter(df, text, settings), key, text, settings))
    repeated = stored(repeated_lines(suspects, settings))
    held = join_by_key(suspects, repeated, ["digest"], "documents", "inner")
    going = held.filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    return going.groupBy("doc_id").agg(F.collect_set("digest").alias("digests"))


def kept_lines(text: str, digests: set[bytes], shortest: int) -> tuple[list[bytes], int]:
    """The lines that stay, and how many there were."""
    lines = lines_of(text)
    if not digests:
        return lines, len(lines)

    def stays(line: bytes) -> bool:
        if len(line) < shortest:
            return True
        own = line_key(line)
        return not (_long_enough(own, shortest) and key_digest(own) in digests)

    return [line for line in lines if stays(line)], len(lines)


def _with_drops(df: DataFrame, key: str, text: str, settings: Repeats) -> tuple[DataFrame, str]:
    """``df`` with the digests its rows lose, in a column whose name none of its columns has."""
    name = "digests_going"
    while name in df.columns:
        name += "_"
    drops = lines_to_drop(df, key, text, settings).select(F.col("doc_id").alias(f"{name}_of"), F.col("digests").alias(name))
    return df.join(drops, df[key].eqNullSafe(drops[f"{name}_of"]), "left").drop(f"{name}_of"), name


def drop_repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text", settings: Repeats = Repeats()) -> DataFrame:
    """All columns of ``df``; texts lose the lines that stay in another document. A null text stays null."""
    marked, name = _with_drops(df, key, text, settings)
    names = df.columns
    at, going = marked.columns.index(text), marked.columns.index(name)

    def run(batches):
        for batch in batches:
            fresh = []
            for t, digests in zip(batch.column(at).to_pylist(), batch.column(going).to_pylist()):
                fresh.append(b"\n".join(kept_lines(t, set(digests), settings.shortest)[0]).decode() if digests and t else t)
            columns = list(batch.columns)
            columns[at] = pa.array(fresh, columns[at].type)
            del columns[going]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return marked.mapInArrow(run, df.schema)


def digest(df: DataFrame, key: str = "doc_id", text: str = "text", settings: Repeats = Repeats()) -> DataFrame:
    """One row per input row: number of lines, how many of them went, SHA-256 of the rest."""
    marked, name = _with_drops(df.select(key, whole_text(text).alias("text")), key, "text", settings)
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lines, dropped, sums = [], [], []
            for t, digests in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept, n = kept_lines(t, set(digests or ()), settings.shortest)
                lines.append(n)
                dropped.append(n - len(kept))
                sums.append(hashlib.sha256(b"\n".join(kept)).hexdigest())
            columns = [batch.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(sums, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "n_lines", "n_dropped", "kept_sha256"])

    return marked.select(key, "text", name).mapInArrow(run, f"`{key}` {kind}, n_lines bigint, n_dropped bigint, kept_sha256 string")
