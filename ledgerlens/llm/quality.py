"""Quality classifier: hashed word and character n-gram vectors averaged per document.

Each word has a vector: the mean of the learned vectors of its hashed word and of its
hashed character 3- to 5-grams. Word pairs count where a word follows itself; all these
pairs share one vector. A document is the mean of the vectors of its words and pairs,
followed by a softmax over the labels. Training is stochastic gradient descent in numpy over a bounded
sample of labelled rows; the model is a few hundred kilobytes, whatever the corpus.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import prepare, whole_text

CUTOFF = 0.3
GRAMS = (3, 4, 5)
LONGEST_REMEMBERED = 40
REMEMBERED = 450_000
GRAMS_AT_ONCE = 10_000


@dataclass(frozen=True)
class Training:
    """``rows`` bounds the labelled rows that training reads, chosen by a hash of their id."""

    rows: int = 3_000
    buckets: int = 1 << 15
    size: int = 8
    epochs: int = 5
    batch: int = 32
    rate: float = 1.0
    seed: int = 11


def word_buckets(word: str, buckets: int) -> Iterator[list[int]]:
    """Buckets of a word and of all its character n-grams, a bounded number at once however long it is."""
    marked = f"<{word}>"
    yield [zlib.crc32(f"={word}".encode()) % buckets]
    for n in GRAMS:
        for start in range(0, len(marked) - n + 1, GRAMS_AT_ONCE):
            last = min(start + GRAMS_AT_ONCE, len(marked) - n + 1)
            yield [zlib.crc32(marked[i : i + n].encode()) % buckets for i in range(start, last)]


def follows_itself(words: list[str]) -> int:
    """How many words equal the one before them."""
    return sum(map(eq, words, islice(words, 1, None)))


class Model:
    """Learned vectors, the softmax layer, and what recent words add to the logit."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, bias: np.ndarray):
        self.vectors, self.weights, self.bias = vectors, weights, bias
        self._parts = (vectors @ (weights[:, 1] - weights[:, 0])).tolist()
        self._bias = float(bias[1] - bias[0])
        self._known: dict[str, float] = {}

    def __reduce__(self):
        return Model, (self.vectors, self.weights, self.bias)

    def _word(self, word: str) -> float:
        """A word's part of the difference of the two logits."""
        total, count = 0.0, 0
        for own in word_buckets(word, len(self._parts) - 1):
            total, count = total + sum(map(self._parts.__getitem__, own)), count + len(own)
        part = total / count
        if len(word) <= LONGEST_REMEMBERED:
            self._known[word] = part
        return part

    def score(self, text: str) -> float:
        """Probability of label 1; a text without words has the bias alone."""
        words, known = text.split(), self._known
        if not words:
            return _probability(self._bias)
        parts = list(map(known.get, words))
        if None in parts:
            for i, part in enumerate(parts):
                if part is None:
                    parts[i] = known.get(words[i]) or self._word(words[i])
            if len(known) > REMEMBERED:
                known.clear()
        pairs = follows_itself(words)
        return _probability(self._bias + (sum(parts) + pairs * self._parts[-1]) / (len(words) + pairs))


def _probability(logit: float) -> float:
    return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, logit))))


def fit(texts: list[str], labels: list[int], settings: Training = Training()) -> Model:
    """Train on whole texts. Without rows, or with one label only, the score is the smoothed share of label 1."""
    rng = np.random.default_rng(settings.seed)
    vectors = ((rng.random((settings.buckets + 1, settings.size)) - 0.5) / settings.size).astype(np.float32)
    weights = np.zeros((settings.size, 2), np.float32)
    target = np.array(labels, np.int64)
    share = (target.sum() + 1) / (len(target) + 2)
    bias = np.log(np.array([1 - share, share], np.float32))
    if len(set(labels)) < 2:
        return Model(vectors, weights, bias)
    own: dict[str, np.ndarray] = {}
    rows = [_features(t, settings.buckets, own) for t in texts]
    steps, total = 0, settings.epochs * -(-len(rows) // settings.batch)
    for _ in range(settings.epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), settings.batch):
            chosen = order[start : start + settings.batch]
            _step(vectors, weights, bias, [rows[i] for i in chosen], target[chosen], settings.rate * (1 - steps / total))
            steps += 1
    return Model(vectors, weights, bias)


def _features(text: str, buckets: int, own: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares of its average; the last bucket is for pairs of equal words."""
    words = text.split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    pairs = follows_itself(words)
    counts = Counter(words)
    for w in counts:
        if w not in own:
            own[w] = np.concatenate([np.array(part, np.int32) for part in word_buckets(w, buckets)])
    lists = [own[w] for w in counts]
    lengths = np.array(list(map(len, lists)))
    each = np.array(list(counts.values())) / lengths / (len(words) + pairs)
    shares = np.bincount(np.concatenate(lists), np.repeat(each, lengths), buckets + 1)
    shares[buckets] = pairs / (len(words) + pairs)
    found = np.flatnonzero(shares)
    return found.astype(np.int32), shares[found].astype(np.float32)


def _step(vectors, weights, bias, rows, target, rate) -> None:
    """One step of stochastic gradient descent over a few texts, in place."""
    lengths = np.array([len(b) for b, _ in rows])
    buckets = np.concatenate([b for b, _ in rows])
    shares = np.concatenate([s for _, s in rows])
    owner = np.repeat(np.arange(len(rows)), lengths)
    weighted = vectors[buckets] * shares[:, None]
    hidden = np.stack([np.bincount(owner, column, len(rows)) for column in weighted.T], axis=1).astype(np.float32)
    logits = hidden @ weights + bias
    odds = np.exp(logits - logits.max(axis=1, keepdims=True))
    error = odds / odds.sum(axis=1, keepdims=True)
    error[np.arange(len(rows)), target] -= 1
    back = (error @ weights.T)[owner] * shares[:, None]
    weights -= rate * (hidden.T @ error)
    bias -= rate * error.mean(axis=0)
    for d, column in enumerate(back.T):
        vectors[:, d] -= (rate * np.bincount(buckets, column, len(vectors))).astype(np.float32)


def held_out(doc_id) -> F.Column:
    """The fifth of documents that training never sees."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(df: DataFrame, labels: DataFrame, settings: Training = Training()) -> Model:
    """Fit on at most ``settings.rows`` labelled, not held-out documents (and as many texts on the driver).

    ``labels`` has doc_id and quality; null labels and documents without one are not used.
    """
    known = labels.filter(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.filter(~held_out("doc_id"))
    sample = known.orderBy(F.xxhash64("doc_id", F.lit(settings.seed)), "doc_id").limit(settings.rows)
    texts = df.select("doc_id", whole_text().alias("text")).join(F.broadcast(sample), "doc_id")
    found = sorted((r["doc_id"], r["text"], int(r["quality"] == 1)) for r in texts.collect())
    return fit([t for _, t, _ in found], [q for _, _, q in found], settings)


def score_documents(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key and score. Null and empty texts get the score of a text without words."""
    prepare(df.sparkSession)
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = shipped.value
        for batch in batches:
            scores = [scorer.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[key, "score"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, whole_text(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, score double")


def judge(scores: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    return scores.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= cutoff).cast("int").alias("predicted"),
    )


def keep_good(df: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """All columns of the rows whose text scores at least ``cutoff``."""
    prepare(df.sparkSession)
    names, place = df.columns, df.columns.index("text")
    shipped = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = shipped.value
        for batch in batches:
            keep = [scorer.score(t or "") >= cutoff for t in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns, names=names).filter(pa.array(keep))

    return df.mapInArrow(run, df.schema)
