"""Ids of recent short stretches of text, so that a tokenizer sees a frequent word once."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Sequence

from tokenizers import Tokenizer

LONGEST = 60
GENERATION = 450_000
# A word of ASCII or Latin letters and the marks behind it, which are a piece of their own.
WORD_AND_MARKS = re.compile(r"( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!#$%&*+,./:;<=>?@|~()\[\]\"-]+)")


def ids_by(tokenizer: Tokenizer) -> Callable[[str], bytes]:
    """The ids of a text as little-endian unsigned 32-bit numbers, without special tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side

    def encode(text: str) -> bytes:
        return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    return encode


class Remembered:
    """Two generations of known stretches: the older is dropped when the newer is full.

    A stretch in use moves to the newer one, so frequent words stay and memory is bounded.
    Stretches longer than ``LONGEST`` characters are never kept.
    """

    def __init__(self, encode: Callable[[str], bytes], generation: int = GENERATION):
        self._encode, self._generation = encode, generation
        self._new: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def ids(self, stretches: Sequence[str]) -> bytes:
        """The ids of all stretches, one after another."""
        found = list(map(self._new.get, stretches))
        if None in found:
            for i, ids in enumerate(found):
                if ids is None:
                    found[i] = self.one(stretches[i])
            if len(self._new) > self._generation:
                self._old, self._new = self._new, {}
        return b"".join(found)

    def one(self, stretch: str) -> bytes:
        ids = self._new.get(stretch) or self._old.get(stretch) or self._encode(stretch)
        if len(stretch) <= LONGEST:
            self._new[stretch] = ids
        return ids
