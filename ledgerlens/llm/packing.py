"""Packing documents into sequences by shortest-pack-first over the histogram of lengths.

Documents are tokenized once; a document is cut into full sequences and one remainder, and
only lengths and checksums of these pieces are kept. The histogram of piece lengths, at
most one row per length, is packed from the longest length down: pieces of a length go to
the packs that are shortest so far (most space left) as long as they fit, else open new
packs. The plan holds patterns with counts, never single pieces. Each piece then gets its
rank among the pieces of its length and finds its pattern, sequence and offset by it.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from collections import defaultdict
from collections.abc import Mapping
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm.byte_bpe import byte_characters
from ledgerlens.llm.common import held, prepare, stored, whole_text
from ledgerlens.llm.stretches import WORD_AND_MARKS, Remembered, ids_by

CAPACITY = 4096
END_ID = 2
ROWS_PER_SHARE = 2_000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"

_ODD = "\x1c\x1d\x1e\x1fΣ"


class WordTokens:
    """Ids of whole texts for a vocabulary that lower-cases and drops white space.

    White space ends every piece of this vocabulary, and letters and other marks are
    pieces of their own, so a text is its stretches without white space, and a word with
    one mark behind it is the word and the mark. Plain words go to the model directly.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # Texts that may hold a special token's own text go to the library whole.
        self._marks = {token.content[:2] for token in self.tokenizer.get_added_tokens_decoder().values()}
        self._whole = ids_by(self.tokenizer)
        self._model = self.tokenizer.model
        self._shown = dict(enumerate(byte_characters()))
        self._remembered = Remembered(self._encode)

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self._shown)
        return array("I", [token.id for token in self._model.tokenize(shown)]).tobytes()

    def _encode(self, stretch: str) -> bytes:
        if stretch.isalpha():
            return self._word(stretch)
        if parts := WORD_AND_MARKS.fullmatch(stretch):
            return self._remembered.one(parts[1]) + self._remembered.one(parts[2])
        return self._whole(stretch)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text.

        Characters that Python and the tokenizer treat differently, and the beginnings of
        special tokens, send the text to the tokenizer whole.
        """
        if any(c in text for c in _ODD) or any(m in text for m in self._marks):
            return self._whole(text)
        return self._remembered.ids(unicodedata.normalize("NFC", text).lower().split())


def shared(path: str) -> WordTokens:
    return held(("words", path), lambda: WordTokens(path))


def tokenize_pieces(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, checksum of its ids, tokens of the document.

    A null or empty text is a document with the end id alone; repeated rows are documents
    of their own.
    """
    prepare(df.sparkSession)
    ending = end_id.to_bytes(4, "little")

    def run(batches):
        words = shared(path)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = words.ids(text) + ending
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    for column, value in zip(out, (doc_id, start, len(piece) // 4, zlib.crc32(piece), total)):
                        column.append(value)
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)

    return df.select("doc_id", whole_text().alias("_text")).mapInArrow(run, PIECES)


class Slot(NamedTuple):
    """``count`` packs from ``first_pack`` on take pieces of this length at this offset."""

    length: int
    first_rank: int
    count: int
    first_pack: int
    offset: int


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """Shortest-pack-first: where the pieces of every length go, by rank.

    Groups of equal packs are kept by their filling. The work follows the number of
    lengths, not of pieces.
    """
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)  # filling -> (first pack, count)
    packs, slots = 0, []
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        placed = []
        for filling in sorted(groups):
            while left and filling + length <= capacity and groups[filling]:
                first, count = groups[filling].pop()
                used = min(count, left)
                if used < count:
                    groups[filling].append((first + used, count - used))
                slots.append(Slot(length, rank, used, first, filling))
                placed.append((filling + length, first, used))
                left, rank = left - used, rank + used
        for filling, first, used in placed:
            groups[filling].append((first, used))
        # Pieces that open packs may share them as far as the length fits more than once.
        while left:
            fitting = capacity // length
            opened = -(-left // fitting)
            for i in range(fitting):
                used = min(opened, left)
                if used:
                    slots.append(Slot(length, rank, used, packs, i * length))
                    left, rank = left - used, rank + used
                    full = used
                    if i + 1 == fitting or not left:
                        groups[(i + 1) * length].append((packs, full))
                        if full < opened and i:
                            groups[i * length].append((packs + full, opened - full))
            packs += opened
    return slots


def with_rank(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0.

    A length's pieces are dealt into shares by a hash; a piece's rank is its place in its
    share after the pieces of earlier shares, so that no task sorts a frequent length alone.
    """
    total = pieces.count()
    shares = max(1, -(-total // ROWS_PER_SHARE))
    dealt = pieces.withColumn("share", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shares)))
    sizes = dealt.groupBy("length", "share").count()
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "share").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    placed = dealt.withColumn("place", F.row_number().over(order) - 1)
    return placed.join(sizes, ["length", "share"]).withColumn("rank", F.col("before") + F.col("place")).drop(
        "before", "place", "share"
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to stored pieces; an empty table gives an empty one.

    The histogram has at most ``capacity`` rows and the plan a few slots for each, which
    bounds what goes through the driver and what is joined as a small table.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    by_length: dict[int, list[Slot]] = defaultdict(list)
    for slot in plan(histogram, capacity):
        by_length[slot.length].append(slot)
    rows = [(n, [list(s[1:]) for s in slots]) for n, slots in by_length.items()]
    slots = spark.createDataFrame(rows, "length bigint, slots array<array<bigint>>")
    found = F.element_at(F.filter("slots", lambda s: F.get(s, F.lit(0)) <= F.col("rank")), -1)
    joined = with_rank(pieces).join(F.broadcast(slots), "length").withColumn("slot", found)
    inside = F.col("rank") - F.get("slot", F.lit(0))
    return joined.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.get("slot", F.lit(2)) + inside).alias("sequence_id"),
        F.get("slot", F.lit(3)).alias("offset"),
    )


def pack_documents(df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenize, cut and pack all documents; the pieces are stored once and then ranked."""
    return pack(stored(tokenize_pieces(df, path, capacity, end_id)), capacity)
