"""Byte-level BPE over Arrow batches with the tokenizers library, and its reverse.

A rank file maps byte strings to ids. Bytes are shown to the library as one character
each; a merge exists for every split of a known byte string into two known ones, in the
order of the rank of the result. Ids decode through the reversed table, so a character
split over several ids comes back whole once all its bytes are there.

Whole texts are encoded. Because a piece never goes past a single blank between two
non-blank characters, a text is the sequence of its stretches between blanks, and each
worker keeps the ids of recent short stretches.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, pre_tokenizers

from ledgerlens.llm.common import held, prepare, whole_text
from ledgerlens.llm.stretches import WORD_AND_MARKS, Remembered, ids_by

_BLANK = re.compile(r"(?<=\S) (?=\S)")
_OTHER_BLANK = re.compile(r"[^\S \n]|\0")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where visible, else one from U+0100 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(visible) else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """All splits of known strings into known strings, by the rank of the whole."""
    found = []
    for token in sorted(ranks, key=ranks.get):
        splits = [(token[:i], token[i:]) for i in range(1, len(token))]
        found += [(a, b) for a, b in splits if a in ranks and b in ranks]
    return found


def build_tokenizer(path: str, pattern: str) -> Tokenizer:
    ranks, shown = read_ranks(path), byte_characters()

    def show(token: bytes) -> str:
        return "".join(shown[b] for b in token)

    model = models.BPE(
        vocab={show(t): r for t, r in ranks.items()},
        merges=[(show(a), show(b)) for a, b in merges_of(ranks)],
        ignore_merges=True,
    )
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    tokenizer.decoder = decoders.ByteLevel()
    return tokenizer


def stretches_of(text: str) -> list[str]:
    """A text cut where no piece can go on: before single blanks, around single line ends."""
    if _OTHER_BLANK.search(text) or any(pair in text for pair in ("  ", "\n ", " \n", "\n\n")):
        first, *rest = _BLANK.split(text)
        return [first, *(" " + r for r in rest)]
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")


class ByteBpe:
    """Encoder and decoder of one vocabulary, built once in each worker."""

    def __init__(self, path: str, pattern: str):
        self.tokenizer = build_tokenizer(path, pattern)
        ranks = read_ranks(path)
        size = max(ranks.values(), default=-1) + 1
        self._lengths = np.zeros(size, np.int64)
        for token, rank in ranks.items():
            self._lengths[rank] = len(token)
        self._places = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(sorted(ranks, key=ranks.get)), np.uint8)
        self.digits = np.array([str(i) for i in range(size)], object)
        self._model, self._whole = self.tokenizer.model, ids_by(self.tokenizer)
        self._shown = dict(enumerate(byte_characters()))
        self._remembered = Remembered(self._stretch)

    def _piece(self, piece: str) -> bytes:
        shown = piece.encode().decode("latin-1").translate(self._shown)
        return array("I", [token.id for token in self._model.tokenize(shown)]).tobytes()

    def _stretch(self, stretch: str) -> bytes:
        """Ids of a stretch; a plain word, or one with marks behind it, goes to the model directly."""
        if stretch.removeprefix(" ").isalpha():
            return self._piece(stretch)
        if parts := WORD_AND_MARKS.fullmatch(stretch):
            return self._remembered.one(parts[1]) + self._remembered.one(parts[2])
        return self._whole(stretch)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; an empty text has none."""
        return np.frombuffer(self._remembered.ids(stretches_of(text)), "<u4")

    def encode_with_offsets(self, text: str) -> tuple[list[int], list[tuple[int, int]]]:
        """Ids and the code points that each covers; parts of one character all point at it."""
        encoding = self.tokenizer.encode(text, add_special_tokens=False)
        return encoding.ids, encoding.offsets

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes of a run of ids, which may begin or end inside a character."""
        ids = np.asarray(ids, np.int64)
        lengths = self._lengths[ids]
        first = np.cumsum(lengths) - lengths
        return self._bytes[np.repeat(self._places[ids] - first, lengths) + np.arange(lengths.sum())].tobytes()

    def decode_text(self, ids: Sequence[int]) -> str:
        """The text of a run of ids; characters that are not whole become U+FFFD."""
        return self.decode(ids).decode("utf-8", errors="replace")


def shared(path: str, pattern: str) -> ByteBpe:
    return held(("bytes", path, pattern), lambda: ByteBpe(path, pattern))


def encode_documents(
    df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", offsets: bool = False
) -> DataFrame:
    """Per row: key, ids, and with ``offsets`` the start and end code points of each id."""
    prepare(df.sparkSession)
    whole = pa.list_(pa.int32())

    def run(batches):
        coder = shared(path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if not offsets:
                columns = [pa.array([coder.encode(t).astype(np.int32) for t in texts], whole)]
            else:
                both = [coder.encode_with_offsets(t) for t in texts]
                columns = [pa.array([ids for ids, _ in both], whole)]
                columns += [pa.array([[place[i] for place in places] for _, places in both], whole) for i in (0, 1)]
            names = [key, "ids", "starts", "ends"][: len(columns) + 1]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    kind = df.schema[key].dataType.simpleString()
    extra = ", starts array<int>, ends array<int>" if offsets else ""
    return df.select(key, whole_text(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, ids array<int>{extra}")


def decode_documents(df: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """Per row of (key, ids): key and the decoded bytes; null ids decode to no bytes."""
    prepare(df.sparkSession)

    def run(batches):
        coder = shared(path, pattern)
        for batch in batches:
            decoded = [coder.decode(() if ids is None else ids) for ids in batch.column(1).to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded, pa.binary())], names=[key, "bytes"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, bytes binary")


def digest(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode every document, decode the ids, and return hashes of both."""
    encoded = encode_documents(df, path, pattern)

    def run(batches):
        coder = shared(path, pattern)
        for batch in batches:
            counts, hashes, decoded = [], [], []
            for ids in batch.column(1).to_numpy(zero_copy_only=False):
                counts.append(len(ids))
                hashes.append(hashlib.sha256(",".join(coder.digits[ids].tolist()).encode()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            arrays = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
