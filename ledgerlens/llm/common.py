"""What the text operators share: reading tables, and hashing words of whole texts in numpy.

Rules that hold for every operator: a null text counts as empty, a row whose id is null is
kept under the null id, extra columns of the input are never read, and repeated rows each
get their own output row unless the operator's docstring says otherwise.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import cut_lineage

ROWS_PER_BATCH = 1_000
CHUNK_BYTES = 1 << 18
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def prepare(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a Python worker's memory does not follow the text length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from there.

    Shuffle files stay on the executors until the driver collects the plans they belong to,
    which nothing else makes it do between the stages of one query.
    """
    spark = df.sparkSession
    written = cut_lineage(df)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return written


_HELD: dict = {}


def held(key: tuple, make: Callable[[], object]):
    """The one large helper a worker keeps between tasks; asking for another lets the last one go."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts with about ``limit`` bytes together, at least one text each."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


# --- hashing words and shingles --------------------------------------------------------

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a multiply-xorshift finaliser)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_POSITION = _U(0x2545F4914F6CDD1D)


def powers(base: np.uint64, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(max(count - 1, 0), base, _U)]))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles of each UTF-8 text.

    A-Z count as a-z; words are runs without space or bytes 9 to 13. A text with fewer
    words than ``width`` has its whole word sequence as one shingle, a text without words none.
    """
    result: list[np.ndarray] = []
    for a, b in chunks(texts):
        result.extend(_shingle_sets(texts[a:b], width))
    return result


def _shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    ends_of_text = np.cumsum([len(t) + 1 for t in texts])
    with np.errstate(over="ignore"):
        low = data + ((data >= 65) & (data <= 90)).view(np.uint8) * np.uint8(32)
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        starts, ends = edges[0::2], edges[1::2]
        if not len(starts):
            return [np.empty(0, _U) for _ in texts]
        inside = np.flatnonzero(~blank)
        lengths = ends - starts
        place = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        value = _BYTE[low[inside]] * powers(_POSITION, int(lengths.max()))[place]
        words = mix(np.add.reduceat(value, np.cumsum(lengths) - lengths) + lengths.astype(_U))
        weights = mix(np.arange(1, width + 1, dtype=_U))
        total = np.zeros(max(len(words) - width + 1, 0), _U)
        for j in range(width):
            total += words[j : j + len(total)] * weights[j]
        hashed = mix(total)
    result, first = [], 0
    for last in np.searchsorted(starts, ends_of_text).tolist():
        count = last - first
        if count >= width:
            result.append(np.unique(hashed[first : last - width + 1]))
        elif count:
            with np.errstate(over="ignore"):
                result.append(mix((words[first:last] * weights[:count]).sum(keepdims=True) + _U(count)))
        else:
            result.append(np.empty(0, _U))
        first = last
    return result


# --- texts on their way through a shuffle --------------------------------------------------


def packed(df: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """The key columns and the UTF-8 text, compressed, as ``packed``; a null text counts as empty."""
    prepare(df.sparkSession)
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            data = [squeeze.compress((t or "").encode()) for t in batch.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(data, pa.binary())], names=[*keys, "packed"])

    return df.select(*keys, text).mapInArrow(run, f"{kinds}, packed binary")


def unpack(data: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor()
    return [expand.decompress(d) for d in data.to_pylist()]
