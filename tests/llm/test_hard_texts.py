"""Rows that the given tables do not have: special tokens as text, extreme ids, clashing columns, endless words, no labels."""

import math
import random
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerlens.llm import common, fingerprints, packing, quality, repeats, url_filters

WORD_PATH = public_tokenizers.path("word_bpe_49k.json")


def test_special_tokens_in_a_text_get_the_librarys_ids():
    words, plain = packing.WordTokens(WORD_PATH), Tokenizer.from_file(WORD_PATH)
    for text in ("a <|endoftext|> b", "<|startoftext|>", "<|ENDOFTEXT|>", "<| endoftext |>", "x<|endoftext|>y <|", "|> <|"):
        assert np.frombuffer(words.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
    assert 49407 in np.frombuffer(words.ids("a <|endoftext|> b"), "<u4")


def test_one_helper_is_held_at_a_time():
    first = common.held(("a",), list)
    assert common.held(("a",), list) is first
    assert common.held(("b",), dict) == {}
    assert common.held(("a",), list) is not first


def test_fingerprints_of_ids_far_apart(spark):
    ids = [-(2**63), -9_000_000_000_000_000_000, -5, 0, 7, 9_000_000_000_000_000_000, 2**63 - 1]
    rows = [(i, " ".join(f"w{n}x{k}" for k in range(40))) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for given in (df, spark.createDataFrame(rows[-1:], "doc_id bigint, text string")):
        found = {r["doc_id"]: r for r in fingerprints.compare_edited(given).collect()}
        wanted = sorted(r["doc_id"] for r in given.collect())
        assert sorted(found) == wanted
    texts = dict(rows)
    followers = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(df).collect()}
    assert followers == {a: texts[b] for a, b in zip(ids, [*ids[1:], ids[0]])}


def test_repeat_removal_keeps_columns_of_any_name(spark):
    passage = "a passage that two documents have in common, word for word, " * 5
    rows = [(1, "x" + passage, 1, 2, 3, "o"), (2, passage + "y", 4, 5, 6, None), (3, "short", 7, 8, 9, "p")]
    names = "doc_id bigint, text string, mark int, packed int, found int, `column_0` string"
    kept = repeats.remove_repeats(spark.createDataFrame(rows, names))
    assert kept.columns == ["doc_id", "text", "mark", "packed", "found", "column_0"]
    found = sorted(map(tuple, kept.collect()))
    assert [r[2:] for r in found] == [r[2:] for r in rows]
    assert found[2][1] == "short" and len(found[0][1]) < 60


def test_without_labels_nothing_is_blocked_but_by_rule(spark):
    pages = spark.createDataFrame([(1, "http://a.example.com/x"), (2, "http://b.net/"), (None, None)], "page_id bigint, url string")
    none = spark.createDataFrame([], "page_id bigint, bad int")
    found = {r["page_id"]: r["verdict"] for r in url_filters.judge_urls(pages, none).collect()}
    assert found == {1: "allow", 2: "block", None: "allow"}


def plain_score(model, text):
    """The softmax over the average of the vectors of all words, and of all pairs of a word with itself."""
    words = text.split()
    size = len(model.vectors) - 1
    rows = []
    for w in words:
        grams = [f"={w}"] + [f"<{w}>"[i : i + n] for n in quality.GRAMS for i in range(len(w) + 3 - n)]
        rows.append(np.mean([model.vectors[zlib.crc32(g.encode()) % size] for g in grams], axis=0))
    rows += [model.vectors[-1]] * sum(a == b for a, b in zip(words, words[1:]))
    logits = np.mean(rows, axis=0).astype(float) @ model.weights + model.bias if rows else model.bias
    odds = np.exp(logits - logits.max())
    return float(odds[1] / odds.sum())


def test_scores_are_the_softmax_over_averaged_vectors():
    rng = random.Random(5)
    good = [" ".join(rng.choice(("lorem", "ipsum", "dolor", "sit")) for _ in range(30)) for _ in range(60)]
    bad = [" ".join(rng.choice(("buy", "now", "cheap", "cheap")) for _ in range(30)) for _ in range(60)]
    model = quality.fit(good + bad, [1] * 60 + [0] * 60, quality.Training(buckets=1 << 10))
    for text in [*good[:5], *bad[:5], "", "unseen words here", "a" * 500, "é" * 100 + " dolor dolor", "x" * 25_000]:
        assert math.isclose(model.score(text), plain_score(model, text), rel_tol=0.02, abs_tol=1e-12), text[:30]
    assert min(map(model.score, good)) > 0.5 > max(map(model.score, bad))


def test_the_middle_of_an_endless_word_counts():
    model = quality.fit(["aaa bbb ccc"] * 20 + ["xyz zyx yxz"] * 20, [1] * 20 + [0] * 20, quality.Training(buckets=1 << 10))
    ends = "q" * 30
    assert model.score(ends + "aaabbbccc" * 200 + ends) > model.score(ends + "xyzzyxyxz" * 200 + ends) + 0.1
    model.score("w" * 100)
    assert max(map(len, model._known), default=0) <= quality.LONGEST_REMEMBERED


def test_a_large_group_of_surroundings_is_sorted_in_little_memory():
    rng = np.random.default_rng(17)
    count, reach, threshold = 6_000, repeats.THRESHOLD - repeats.GRAM, repeats.THRESHOLD
    around = rng.integers(97, 101, (count, reach + threshold), dtype=np.uint8)
    around[1::2, 60:330] = around[:-1:2, 60:330]  # rows equal in pairs, over 270 columns
    around[:, [59, 330]] = 97 + np.arange(count)[:, None] % 2
    left, right, group = np.full(count, reach), np.full(count, threshold), np.zeros(count, np.int64)
    left[:2] = 90
    tracemalloc.start()
    row, column = repeats.repeated_windows(around, left, right, group, threshold)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 70 << 20
    expected = {(r, c) for r in range(count) for c in range(60, 330 - threshold + 1) if r > 1 or c >= reach - 90}
    assert set(zip(row.tolist(), column.tolist())) == expected
