"""Line dedup against brute force, and its filters on their own."""

import hashlib
import random
from collections import defaultdict

import numpy as np

from ledgerlens.llm import line_dedup
from ledgerlens.llm.line_dedup import Repeats, SeenOnce, SeenTwice

DOCUMENT = "doc_id bigint, text string, digests_going string, digest string, lang string"


def brute(rows, shortest=40, documents=5):
    def key(line):
        stripped = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)

    where = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            where[key(line)].add(float("-inf") if doc_id is None else doc_id)
    result = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        own = float("-inf") if doc_id is None else doc_id
        kept = [x for x in lines if len(key(x)) < shortest or len(where[key(x)]) < documents or max(where[key(x)]) == own]
        result.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return result


def hard_rows():
    rng = random.Random(7)
    common = ["This line is in a great many of the documents, number %d" % i for i in range(12)]
    common += ["é" * 39, "é" * 40, "x" * 39, "x" * 40, "short", "", "long " * 5000]
    rows = []
    for i in range(300):
        lines = [rng.choice(common) for _ in range(rng.randrange(6))] + [f"a line of its own that nobody else has, {i} {j}" for j in range(3)]
        rng.shuffle(lines)
        if i % 3 == 0:
            lines = ["\t " + x.upper().replace("É", "é") + " \r" for x in lines]
        rows.append((rng.randrange(-(2**62), 2**62) if i % 7 else i, "\n".join(lines)))
    rows += [(1000, None), (1001, ""), (1002, "\n\n"), (None, common[0]), (None, common[0] + "\n" + common[1])]
    rows += [rows[1], rows[1], (2**63 - 1, common[2]), (-(2**63), common[2])]
    return rows


def in_four_documents():
    line = "a line that is found in four documents only, but often"
    return [(i, f"{line}\n{line}") for i in (1, 2, 3, 4)] + [(4, line), (4, line)]


def test_digest_equals_brute_force(spark):
    for rows in (hard_rows(), in_four_documents()):
        df = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], DOCUMENT).repartition(4)
        assert sorted(map(repr, map(tuple, line_dedup.digest(df).collect()))) == sorted(map(repr, brute(rows)))


def test_small_segments_and_a_full_second_filter_change_nothing(spark):
    rows = hard_rows()
    df = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], DOCUMENT).repartition(4)
    settings = Repeats(segment=64, suspect_bytes=64)
    found = line_dedup.digest(df, settings=settings).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, brute(rows)))


def test_empty_table_and_columns(spark):
    df = spark.createDataFrame([], DOCUMENT)
    assert line_dedup.digest(df).collect() == []
    assert line_dedup.drop_repeated_lines(df).collect() == []
    rows = [(i, f"the very same line of more than forty characters\nown {i}", "a", "b", None) for i in range(6)] + [(9, None, None, None, None)]
    kept = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, DOCUMENT))
    assert kept.columns == df.columns
    found = {r["doc_id"]: tuple(r) for r in kept.collect()}
    assert found[2] == (2, "own 2", "a", "b", None)
    assert found[5] == rows[5]
    assert found[9] == rows[6]


def test_filters_miss_nothing():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 2**64, 60_000, dtype=np.uint64))
    once = SeenOnce(1 << 14)
    assert len(once.add(hashes[:40_000])) < 800
    again = once.add(hashes[20_000:])
    assert np.isin(hashes[20_000:40_000], again).all()
    assert len(again) < 21_500
    twice = SeenTwice(np.zeros(1 << 14, np.uint64))
    twice.add(again)
    assert twice.knows(again).all()
    assert twice.knows(hashes[:15_000]).mean() < 0.01


def test_only_suspects_leave_their_tasks(spark):
    """Lines of one document each are hardly ever suspected; every repeated line is."""
    rows = [(i, "\n".join(f"line {i} {j} of a document, not found anywhere else" for j in range(20)) + ("\nthe line that all of these documents have in common" if i % 2 else "")) for i in range(400)]
    df = spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], DOCUMENT).repartition(4)
    suspects = line_dedup.suspected_lines(df, line_dedup.suspect_filter(df))
    assert 200 <= suspects.count() < 280
