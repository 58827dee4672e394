"""Periodic runs against brute force."""

import hashlib
import random

import numpy as np
import pytest

from ledgerlens.llm import periodic
from ledgerlens.llm.periodic import Run, Shape

DOCUMENT = "doc_id bigint, text string, n_runs string, start string, _text string"


def smallest_period(words):
    border, k = [0] * len(words), 0
    for i in range(1, len(words)):
        while k and words[i] != words[k]:
            k = border[k - 1]
        k += words[i] == words[k]
        border[i] = k
    return len(words) - border[-1]


def brute(words, shape=Shape()):
    found = []
    for q in range(1, len(words) // shape.times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= shape.least(q) and smallest_period(words[i : j + q]) == q:
                found.append(Run(i, j + q - i, q))
            i = max(j, i) + 1
    return sorted(found, key=lambda r: (r.start, r.period))


def random_words(rng):
    """Pieces of random words, powers of random roots, and powers of roots that are nearly periodic themselves."""
    letters = "abcdefgh"[: rng.choice([1, 2, 2, 3, 8])]
    words = []
    for _ in range(rng.randrange(1, 6)):
        root = [rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 5, 6, 7, 8, 11, 12, 13, 17, 23, 24, 25, 31, 47, 48, 60]))]
        if rng.random() < 0.4:
            root = root * rng.randrange(1, 7) + [rng.choice(letters + "z")]
        if rng.random() < 0.3:
            root = root * rng.randrange(1, 4) + root[: rng.randrange(len(root))]
        words += (root * 9)[: rng.randrange(1, 8 * len(root))][:500]
        words += [rng.choice("abcdefghijklmnopq") for _ in range(rng.choice([0, 0, 1, 30]))]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(1)
    texts = [random_words(rng) for _ in range(250)] + [[], ["a"], ["a"] * 23, ["a"] * 24, list("abc") * 8]
    for words, runs in zip(texts, periodic.runs_of(texts)):
        assert runs == brute(words), words


def test_every_period_with_three_repeats():
    rng = random.Random(2)
    texts = []
    for period in range(8, 130):
        root = [str(rng.randrange(3)) for _ in range(period)]
        texts.append(["x"] + root * 3 + ["y"])
    assert periodic.runs_of(texts) == [brute(t) for t in texts]


def test_other_shapes():
    rng = random.Random(3)
    shape = Shape(shortest=40, times=4)
    texts = [random_words(rng) for _ in range(80)]
    assert periodic.runs_of(texts, shape) == [brute(t, shape) for t in texts]
    with pytest.raises(ValueError):
        Shape(times=2)


def test_fibonacci_and_binary_words():
    a, b = "0", "01"
    while len(b) < 1500:
        a, b = b, b + a
    thue = [str(bin(i).count("1") % 2) for i in range(1500)]
    for words in (list(b), thue, thue[:200] * 4):
        assert periodic.runs_of([words])[0] == brute(words)


def test_long_text_takes_its_runs_whole():
    rng = random.Random(4)
    root = [str(rng.randrange(10**6)) for _ in range(40_000)]
    words = [f"s{i}" for i in range(1000)] + root * 3 + ["end"]
    assert periodic.runs_of([words, ["a"] * 100_000]) == [[Run(1000, 120_000, 40_000)], [Run(0, 100_000, 1)]]


def test_selected_positions_depend_on_their_context_only():
    """Two copies of a passage in other surroundings are selected alike, up to the width of a context."""
    rng = random.Random(5)
    passage = [rng.randrange(4, 50) for _ in range(400)]
    words = np.array([1] * 10 + passage + [2] * 7 + passage + [3] * 10)
    text, scale = periodic._Text(words, np.array([len(words) - 1])), 1
    while scale < 16:
        text.double(scale)
        scale *= 2
    least = periodic._smallest_ahead(text.hashes, scale)
    chosen = (text.hashes[: len(least)] == least) | (text.hashes[scale:] == least)
    assert (chosen[10 : 10 + 400 - 31] == chosen[417 : 417 + 400 - 31]).all()
    assert all(chosen[i : i + scale].any() for i in range(10, 350))


def expected(doc_id, text):
    words = periodic.looped(doc_id, (text or "").encode().split())
    runs = brute(words)
    best = min(runs, key=lambda r: (-r.length / r.period, r.start, r.period), default=None)
    dropped = {i for r in runs for i in range(r.start + r.period, r.start + r.length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    strongest = (best.start, best.length, best.period, 1000 * best.length // best.period) if best else (None,) * 4
    shown = "".join(f"{r.start},{r.length},{r.period}\n" for r in runs)
    return (doc_id, len(words), len(runs), *strongest, hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_digest_on_hard_rows(spark):
    rng = random.Random(6)
    texts = [" ".join(random_words(rng)) for _ in range(60)]
    texts += [None, "", " \n\t", "one", "é é " * 30, "A a " * 30, "x\x1cx " * 26]
    rows = [(i, t, "n", "s", "clash") for i, t in enumerate(texts)] + [(None, texts[0], "n", "s", "c"), (3, texts[3], "n", "s", "c")]
    df = spark.createDataFrame(rows, DOCUMENT).repartition(3)
    found = periodic.digest(df, changed=periodic.looped).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(repr(expected(r[0], r[1])) for r in rows)
    assert periodic.digest(df.limit(0)).columns == ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert periodic.digest(df.limit(0)).count() == 0


def test_query_equals_brute_force_on_given_documents(spark, folder):
    from ledgerlens.llm.queries import op13_periodic_runs

    found = {r["doc_id"]: tuple(r) for r in op13_periodic_runs(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    short = [r for r in rows if len((r["text"] or "").split()) < 900]
    assert len(short) > len(rows) // 2
    for r in short:
        assert found[r["doc_id"]] == expected(r["doc_id"], r["text"])


def test_collapse_keeps_columns_and_clean_texts(spark):
    rows = [(1, "keep  this \n text", "n", "s", "t"), (2, "go " + "a b c " * 20 + "end", "n", "s", "t"), (3, None, None, None, None)]
    found = periodic.collapse_runs(spark.createDataFrame(rows, DOCUMENT)).collect()
    assert [tuple(r) for r in found] == [rows[0], (2, "go a b c end", "n", "s", "t"), rows[2]]
