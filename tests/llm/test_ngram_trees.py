"""Pairs that leave the trees of the n-gram join, and the memory that shingling takes."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import common, ngram_join
from ledgerlens.llm.ngram_join import CountTree, Likeness, parities, point

LIKE = Likeness(words=5, share=80, share_of=100)


@pytest.fixture(scope="module")
def sets():
    """Variants of one set, of which no two are linked, and one that is linked with the first."""
    rng = np.random.default_rng(3)
    common_part = rng.integers(0, 2**63, 360, dtype=np.uint64)
    apart = [np.unique(np.concatenate([common_part, rng.integers(0, 2**63, 60, dtype=np.uint64)])) for _ in range(60)]
    return [*apart, np.unique(np.concatenate([apart[0][:-5], rng.integers(0, 2**63, 5, dtype=np.uint64)]))]


def linked(sets):
    found = set()
    for i in range(len(sets)):
        for j in range(i):
            shared = np.array(len(np.intersect1d(sets[i], sets[j])))
            if LIKE.linked(shared, np.array(len(sets[i]) + len(sets[j]))):
                found.add((j, i))
    return found


def test_parities_drop_pairs_within_a_tree_and_no_link(sets):
    points = np.stack([point(s) for s in sets]).astype(np.int32)
    sizes, groups = np.array([len(s) for s in sets]), np.arange(len(sets))
    words = np.stack([parities(s) for s in sets]).view(np.uint64)
    plain = {tuple(sorted(p)) for a, b, _ in CountTree(points, sizes, groups).pairs(LIKE) for p in zip(a.tolist(), b.tolist())}
    fewer = {tuple(sorted(p)) for a, b, _ in CountTree(points, sizes, groups, words).pairs(LIKE) for p in zip(a.tolist(), b.tolist())}
    assert linked(sets) <= fewer < plain
    assert len(fewer) < len(sets) < len(plain) / 4


def test_unlinked_documents_of_a_block_leave_no_pairs(spark):
    rng = random.Random(5)
    passage = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    own = [[f"v{n}x{k}" for k in range(55)] for n in range(40)]
    texts = [" ".join(passage[:200] + own[n] + passage[200:]) for n in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = ngram_join._sets(df, df.select("doc_id"), LIKE)
    rows = sets.selectExpr("1L AS key", "doc_id", "doc_id AS component", "size", "point", "parity")
    assert ngram_join._tree_pairs(rows, LIKE, 16).count() < 40
    assert {r["component_id"] for r in ngram_join.linked_groups(df, LIKE).collect()} == set(range(40))


def test_a_pair_of_many_blocks_leaves_the_trees_once(spark):
    rng = random.Random(11)
    passage = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    # Linked neighbours of a row of documents; all of them share many blocks.
    texts = [" ".join(passage + [f"v{k}" for k in range(4 * n, 4 * n + 40)]) for n in range(12)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    members = ngram_join._in_blocks(ngram_join._keyed(df, df.select("doc_id"), LIKE)).cache()
    sets = ngram_join._sets(df, df.select("doc_id"), LIKE).cache()
    found = spark.createDataFrame([], "doc_id bigint, component bigint")
    rows = ngram_join._open_rows(members, sets, found).cache()
    assert rows.count() > 12 * ngram_join.EARLIER_BLOCKS

    given = []
    tree = ngram_join.CountTree
    table = rows.toArrow().to_pydict()
    for key in sorted(set(table["key"])):
        at = [i for i, k in enumerate(table["key"]) if k == key]
        others = np.full((len(at), ngram_join.EARLIER_BLOCKS), key)
        for line, i in zip(others, at):
            line[: len(table["earlier"][i])] = table["earlier"][i]
        ids = np.array([table["doc_id"][i] for i in at])
        points = ngram_join.unpacked_points([table["point"][i] for i in at])
        words = np.array([table["parity"][i] for i in at]).view(np.uint64)
        built = tree(points, np.array([table["size"][i] for i in at]), ids, words, others, key)
        given += [tuple(sorted(p)) for a, b, _ in built.pairs(LIKE) for p in zip(ids[a].tolist(), ids[b].tolist())]
    every = {tuple(sorted((r["u"], r["v"]))) for r in ngram_join._tree_pairs(rows.drop("earlier"), LIKE, 100).collect()}
    once = {tuple(sorted((r["u"], r["v"]))) for r in ngram_join._tree_pairs(rows, LIKE, 100).collect()}
    assert once == every
    assert set(given) == every and len(every) >= 11
    assert len(given) < 1.5 * len(every)
    assert {r["component_id"] for r in ngram_join.linked_groups(df, LIKE).collect()} == {0}


def test_parities_of_long_texts_drop_pairs_too():
    rng = np.random.default_rng(9)
    passage = rng.integers(0, 2**63, 3_600, dtype=np.uint64)
    long = [np.unique(np.concatenate([passage, rng.integers(0, 2**63, own, dtype=np.uint64)])) for own in [2_400] * 11 + [200]]
    given = [parities(s) for s in long]
    assert len(given[0]) > len(given[-1])
    words = ngram_join.folded(pa.array(given, pa.list_(pa.int64())))
    points, sizes = np.stack([point(s) for s in long]).astype(np.int32), np.array([len(s) for s in long])
    tree = [CountTree(points, sizes, np.arange(12), w) for w in (None, words)]
    plain, fewer = (sum(len(a) for a, _, _ in t.pairs(LIKE)) for t in tree)
    assert plain >= 55 and fewer == 0
    for i in range(12):
        for j in range(i):
            apart = len(np.setxor1d(long[i], long[j]))
            assert ngram_join.cells_apart(words[i : i + 1], words[j : j + 1])[0] <= apart


def test_no_pair_is_verified_in_two_rounds(spark, monkeypatch):
    rng = random.Random(13)
    passage = [f"w{rng.randrange(10**7)}" for _ in range(1_765)]
    # Just not linked, which the parities of so many shingles do not tell; two are linked.
    texts = [" ".join(passage + [f"v{n}x{k}" for k in range(235)]) for n in range(20)]
    texts.append(texts[4] + " one more")
    seen, verified = [], ngram_join._verified

    def recorded(pairs, sets, like):
        seen.append({(r["u"], r["v"]) for r in pairs.collect()})
        return verified(pairs, sets, like)

    monkeypatch.setattr(ngram_join, "_verified", recorded)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.linked_groups(df, LIKE).collect()}
    assert found == {n: 4 if n == 20 else n for n in range(21)}
    rounds = seen[1:]
    assert len(rounds) > 2
    assert sum(map(len, rounds)) == len(set().union(*rounds))


def test_shingling_holds_little_beside_the_texts():
    rng = random.Random(7)
    texts = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(300)).encode() for _ in range(1_200)]
    expected = [common.shingle_sets([t], 3)[0] for t in texts[::100]]
    tracemalloc.start()
    found = common.shingle_sets(texts, 3)
    peak, kept = tracemalloc.get_traced_memory()[1], sum(s.nbytes for s in found)
    tracemalloc.stop()
    assert peak - kept < 30 << 20
    assert all((a == b).all() for a, b in zip(expected, found[::100]))
